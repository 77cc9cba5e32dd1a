"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

Voters look for words of fixed lexicons, for words and word beginnings that a bounded sample of labelled rows shows
to be toxic, and for patterns of hits. The label model is a mixture of two classes; in each a voter depends on the
class and on one other voter, the tree of strongest remaining correlations, so voters that repeat each other count
less. It is fitted by expectation maximisation to the counted vote patterns of the whole corpus, of which there are at
most 2^13 for each label; rows with a training label keep theirs. A logistic classifier over the words found and
the votes is then fitted to the posterior labels of a bounded sample of rows, and scores every row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of the fixed lexicons.
INSULTS = ["idiot", "moron", "loser", "clown", "scum", "trash", "fool", "freak", "pig", "rat", "coward", "liar", "bastard", "jerk", "creep"]
SLIGHTS = ["stupid", "pathetic", "worthless", "disgusting", "dumb", "ugly", "useless", "filthy", "vile", "hateful", "moronic", "idiotic"]
ABROAD = ["dumm", "blöd", "abschaum", "versager", "arschloch", "trottel", "stupide", "imbécile", "connard", "ordure", "abruti", "estúpido", "imbécil", "basura", "asqueroso", "inútil"]

#: Most labelled rows a class gives to the search for words, and most rows the classifier is fitted to.
LABELLED = 8000
FITTED = 8000
WORDS, BEGINNINGS = 128, 64
#: Share of the toxic sample rows that must hold a drawn word.
LEAST_SHARE = 0.005
BEGINNING = 4
LEAST_LENGTH = 6
LEAST_ODDS = 1.5
VOTERS = 13
#: Weight, in rows, of what is thought of a voter beforehand.
PRIOR = 4.0
#: Weight, in rows, of the mixture's word on a pattern against its labelled rows.
PATTERN_PRIOR = 5.0


@dataclass
class Lexicon:
    """Hashes by kind, sorted, with the number of each term; terms of a voter are those whose number it holds."""

    words: np.ndarray
    word_terms: np.ndarray
    beginnings: np.ndarray
    beginning_terms: np.ndarray
    voter: np.ndarray


def hashes_of(words: list[str]) -> np.ndarray:
    out = []
    for word in words:
        raw = np.frombuffer(word.encode(), np.uint8)
        out.append(tb.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
    return np.array(out, dtype=np.uint64)


def _terms(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text) of each word, then of each beginning of a longer word, and at last the number of words of each text."""
    starts, ends, first = tb.word_bounds(data, offsets, tb.ALNUM)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    yield tb.word_hashes(data, starts, ends), text
    long = ends - starts >= LEAST_LENGTH
    yield tb.word_hashes(data, starts[long], starts[long] + BEGINNING), text[long]
    yield np.diff(first), text


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (toxic, text): how many texts of each class hold each word and beginning."""
    for batch in batches:
        for begin, end, data, offsets in tb.slices(batch.column(1)):
            toxic = batch.column(0).slice(begin, end - begin).to_numpy().astype(bool)
            parts = []
            for kind, (hashes, text) in enumerate(list(_terms(data, offsets))[:2]):
                own, back = np.unique(hashes, return_inverse=True)
                pairs = np.unique(back * (end - begin) + text)
                of, doc = pairs // (end - begin), pairs % (end - begin)
                bad = np.bincount(of, toxic[doc], len(own)).astype(np.int64)
                parts.append((np.full(len(own), kind), own.view(np.int64), bad, np.bincount(of, minlength=len(own)) - bad))
            columns = [np.concatenate(c) for c in zip(*parts)]
            yield pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["kind", "term", "bad", "good"])


def lexicon(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Lexicon:
    """Fixed words and, from at most `labelled` rows a class (in expectation), those with the surest log-odds."""
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, labelled / max(1, counts.get(1, 0))).otherwise(labelled / max(1, counts.get(0, 0)))
    sample = labels.where(F.pmod(F.xxhash64("doc_id", F.lit("words")), F.lit(1_000_003)) / 1_000_003 < share)
    # At most twice `labelled` rows of two numbers.
    rows = docs.join(F.broadcast(sample), "doc_id").select("toxic", "text")
    found = rows.mapInArrow(_frequencies, "kind int, term long, bad long, good long").groupBy("kind", "term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = (max(1, min(labelled, counts.get(c, 0))) for c in (1, 0))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    sure = odds - F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    found = found.where(F.col("bad") >= max(4.0, LEAST_SHARE * bad)).withColumn("sure", sure).where(F.col("sure") > LEAST_ODDS)
    best = [found.where(F.col("kind") == kind).orderBy(F.desc("sure"), "term").limit(most).select("term").collect() for kind, most in ((0, WORDS), (1, BEGINNINGS))]
    terms, voters = [], []
    for voter, words in enumerate((INSULTS, SLIGHTS, ABROAD)):
        terms.append(hashes_of(words))
        voters.append(np.full(len(words), voter))
    fixed = set(np.concatenate(terms).tolist())
    drawn = [np.array([r["term"] for r in rows], dtype=np.int64).view(np.uint64) for rows in best]
    drawn[0] = np.array([t for t in drawn[0].tolist() if t not in fixed], dtype=np.uint64)
    words = np.concatenate([*terms, drawn[0]])
    voter = np.concatenate([*voters, 3 + np.arange(len(drawn[0])) % 4, 7 + np.arange(len(drawn[1])) % 2])
    by, by2 = np.argsort(words), np.argsort(drawn[1])
    return Lexicon(words[by], by, drawn[1][by2], len(words) + by2, voter.astype(np.int64))


def _hits(data: np.ndarray, offsets: np.ndarray, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term) of every occurrence of a term, and the number of words of each text."""
    parts = list(_terms(data, offsets))
    texts, terms = [], []
    for (hashes, text), known, numbers in zip(parts, (lex.words, lex.beginnings), (lex.word_terms, lex.beginning_terms)):
        if len(known):
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            there = known[at] == hashes
            texts.append(text[there])
            terms.append(numbers[at[there]])
    return np.concatenate([*texts, np.zeros(0, np.int64)]), np.concatenate([*terms, np.zeros(0, np.int64)]), parts[2][0]


def votes_of(texts: np.ndarray, terms: np.ndarray, words: np.ndarray, shouts: np.ndarray, lex: Lexicon) -> np.ndarray:
    """0 or 1 of each voter for each text; the last two vote for clean."""
    n = len(words)
    out = np.zeros((n, VOTERS), dtype=np.int64)
    out[texts, lex.voter[terms]] = 1
    hits = np.bincount(texts, minlength=n)
    out[:, 9] = hits >= 3
    out[:, 10] = (hits > 0) & ((hits * 150 >= words) | shouts)
    out[:, 11] = hits == 0
    out[:, 12] = (hits <= 1) & (words > 600)
    return out


def voted(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """`doc_id`, `held_out`, `pattern` (votes as bits), `terms` (distinct terms found) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(lex))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(**sent.value)
        for batch in batches:
            for begin, end, data, offsets in tb.slices(batch.column(2)):
                n = end - begin
                texts, terms, words = _hits(data, offsets, lex)
                loud = np.concatenate([[0], np.cumsum((data[:-1] == 33) & (data[1:] == 33)), [0]])
                shouts = loud[offsets[1:] - 1] > loud[offsets[:-1]]
                votes = votes_of(texts, terms, words, shouts, lex)
                pairs = np.unique(texts * max(1, len(lex.voter)) + terms)
                bounds = np.searchsorted(pairs, np.arange(n + 1) * max(1, len(lex.voter)))
                found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pairs % max(1, len(lex.voter)), pa.int32()))
                columns = [batch.column(c).slice(begin, n) for c in (0, 1)]
                yield pa.record_batch([*columns, pa.array(votes @ (1 << np.arange(VOTERS)), pa.int32()), found], names=["doc_id", "held_out", "pattern", "terms"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(tasks, "doc_id long, held_out boolean, pattern int, terms array<int>")


def _tree(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parent of each voter (-1 for the root): the spanning tree of largest mutual information given the class."""
    m = votes.shape[1]
    gain = np.zeros((m, m))
    for w in weight:
        total = max(w.sum(), 1e-9)
        for a in range(m):
            for b in range(a):
                for x in (0, 1):
                    for y in (0, 1):
                        both = (w * (votes[:, a] == x) * (votes[:, b] == y)).sum() / total + 1e-9
                        alone = ((w * (votes[:, a] == x)).sum() / total + 1e-9) * ((w * (votes[:, b] == y)).sum() / total + 1e-9)
                        gain[a, b] += total * both * np.log(both / alone)
    gain = gain + gain.T
    parent, inside = np.full(m, -1), [0]
    best, link = gain[0].copy(), np.zeros(m, dtype=int)
    while len(inside) < m:
        best[inside] = -np.inf
        new = int(best.argmax())
        parent[new] = link[new]
        inside.append(new)
        closer = gain[new] > best
        best[closer], link[closer] = gain[new][closer], new
    return parent


def posteriors(patterns: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 30) -> tuple[dict[int, float], np.ndarray]:
    """Probability of class 1 of each pattern, and the tree of correlations; labels are 0, 1, or -1 for none."""
    votes = (patterns[:, None] >> np.arange(VOTERS)) & 1
    counts = counts.astype(float)
    # What is thought of a voter before any vote: how often it votes in a clean and in a toxic text.
    often = np.where(np.arange(VOTERS) >= 11, [[0.9], [0.1]], [[0.05], [0.5]])
    before = PRIOR * np.stack([1 - often, often], axis=2)
    log = np.log([0.9, 0.1])[:, None] + sum(np.log(before[:, v, :] / PRIOR)[:, votes[:, v]] for v in range(VOTERS))
    post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -6, 6)))
    parent = np.full(VOTERS, -1)
    for turn in range(rounds):
        post = np.where(labels >= 0, labels, post)
        weight = np.stack([counts * (1 - post), counts * post])
        if turn % 10 == 0:
            parent = _tree(votes, weight)
        prior = (weight.sum(axis=1) + [9, 1]) / (counts.sum() + 10)
        log = np.log(prior)[:, None] + np.zeros((2, len(votes)))
        for v in range(VOTERS):
            given = votes[:, parent[v]] if parent[v] >= 0 else np.zeros(len(votes), dtype=int)
            for c in (0, 1):
                table = np.stack([before[c, v]] * 2)
                np.add.at(table, (given, votes[:, v]), weight[c])
                log[c] += np.log(table / table.sum(axis=1, keepdims=True))[given, votes[:, v]]
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
    # Labelled rows of a pattern speak for its rows without a label too.
    free = {}
    for p in set(patterns.tolist()):
        own = patterns == p
        bad, good = (counts[own & (labels == c)].sum() for c in (1, 0))
        free[p] = float((PATTERN_PRIOR * post[own][0] + bad) / (PATTERN_PRIOR + bad + good))
    return free, parent


def fitted(patterns: np.ndarray, terms: list[np.ndarray], target: np.ndarray, weight: np.ndarray, size: int, rounds: int = 1500) -> np.ndarray:
    """Weights of terms, then votes, then the bias: logistic regression by accelerated gradient steps."""
    rows = np.concatenate([np.repeat(np.arange(len(terms)), [len(t) for t in terms]), np.repeat(np.arange(len(terms)), VOTERS), np.arange(len(terms))])
    votes = ((patterns[:, None] >> np.arange(VOTERS)) & 1).astype(float)
    columns = np.concatenate([*terms, np.tile(size + np.arange(VOTERS), len(terms)), np.full(len(terms), size + VOTERS)]).astype(np.int64)
    values = np.concatenate([np.ones(sum(map(len, terms))), votes.ravel(), np.ones(len(terms))])
    w, step, before = np.zeros(size + VOTERS + 1), np.zeros(size + VOTERS + 1), np.zeros(size + VOTERS + 1)
    weight = weight / max(1e-9, weight.sum())
    for turn in range(rounds):
        ahead = w + 0.9 * step
        p = 1 / (1 + np.exp(-np.bincount(rows, values * ahead[columns], len(terms)).clip(-40, 40)))
        grad = np.bincount(columns, values * (weight * (p - target))[rows], len(w)) + 1e-5 * ahead
        before = 0.95 * before + 0.05 * grad * grad
        step = 0.9 * step - 0.05 * grad / (np.sqrt(before / (1 - 0.95 ** (turn + 1))) + 1e-8)
        w = w + step
    return w


def score(docs: DataFrame, labels: DataFrame, held_out: Column, labelled: int = LABELLED, fitted_rows: int = FITTED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs` (doc_id, text); `labels` has doc_id, toxic.

    Labels are learned only from rows whose `held_out` is false; a null toxic, a label without a document and labels
    that contradict each other on one doc_id are left out. Labels, lang, source and doc_id are no inputs of a score.
    A null or empty text is scored as a text without words; rows that repeat are scored each; an empty table gives
    an empty table. Without any label the fixed lexicons and patterns vote alone. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(~F.coalesce(held_out, F.lit(False))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).where("toxic = _most").drop("_most")
    lex = lexicon(rows, known, labelled)
    found = settled(voted(rows, lex))
    told = found.select("doc_id", "pattern").join(known, "doc_id", "left").groupBy("pattern", F.coalesce("toxic", F.lit(-1)).alias("label")).count().collect()
    told = sorted((r["pattern"], r["label"], r["count"]) for r in told)
    patterns, label, counts = (np.array([t[i] for t in told], dtype=np.int64) for i in range(3))
    size = len(lex.voter)
    if not len(told):
        return found.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    post, _ = posteriors(patterns, label, counts)
    # The classifier's rows: as many with as without a word of the lexicons.
    none = 1 << 11
    clean = int(counts[(patterns & none) > 0].sum())
    shares = {True: min(1.0, fitted_rows / 2 / max(1, clean)), False: min(1.0, fitted_rows / 2 / max(1, int(counts.sum()) - clean))}
    empty = F.col("pattern").bitwiseAND(F.lit(none)) > 0
    share = F.when(empty, shares[True]).otherwise(shares[False])
    drawn = found.where(F.pmod(F.xxhash64("doc_id", F.lit("rows")), F.lit(1_000_003)) / 1_000_003 < share).select("doc_id", "pattern", "terms")
    drawn = drawn.join(known, "doc_id", "left").select("pattern", "terms", F.coalesce("toxic", F.lit(-1)).alias("label"))
    drawn = sorted((r["pattern"], r["terms"], r["label"]) for r in drawn.collect())
    own = np.array([d[0] for d in drawn], dtype=np.int64)
    target = np.array([post[d[0]] if d[2] < 0 else float(d[2]) for d in drawn])
    weight = np.where(own & none, 1 / shares[True], 1 / shares[False])
    w = fitted(own, [np.array(d[1], dtype=np.int64) for d in drawn], target, weight, size) if drawn else np.zeros(size + VOTERS + 1)
    terms = F.array(*[F.lit(float(x)) for x in w[:size]]) if size else F.array().cast("array<double>")
    total = F.aggregate("terms", F.lit(float(w[-1])), lambda s, t: s + F.get(terms, t))
    for v in range(VOTERS):
        total = total + F.when(F.col("pattern").bitwiseAND(F.lit(1 << v)) > 0, float(w[size + v])).otherwise(0.0)
    value = 1 / (1 + F.exp(-total))
    return found.select("doc_id", "held_out", value.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
