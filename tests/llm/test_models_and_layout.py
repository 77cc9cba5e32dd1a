"""Language, toxicity, scoring, personal data, shards, packing and the pipeline, with the odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm.language import fit, identified, predict, start_weights, train
from tidemark.llm.lm_scoring import count_of, level_of, score
from tidemark.llm.packing import Encoder, differencing, pack, packed
from tidemark.llm.personal_data import personal_data, reliabilities
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.sharding import byte_shards, write_shards
from tidemark.llm.toxicity import posteriors
from tidemark.llm.toxicity import score as toxicity

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34 %%"), (5, "x" * 50_000), (6, "ab"), (6, "ab"), (None, "no id é")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit("?").alias(c) for c in ("size", "shard", "slot", "row", "chunk", "score", "terms", "pattern", "ids", "base", "spans", "_range")])


def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    assert difference(spark, connect(SF), SF, name, QUERIES[name], ORACLES[name]) is None


def test_all_queries_are_registered():
    assert sorted(re.match(r"op(\d+)|pipeline", n)[0] for n in QUERIES) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows_without_a_cross_join(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


# --- language -----------------------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark, documents):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    rows = predict(documents, held).join(documents.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == documents.count() and len(out) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (brute.crc(r["doc_id"]) % 4 == 2) for r in rows)


def test_language_of_odd_rows(spark, documents):
    weights, languages = train(documents)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identified(frame(spark, ODD), weights, languages).collect()]
    assert [g[1] == "und" for g in got] == [True] * 4 + [False] * 4 and all(s == 0 for _, p, s in got if p == "und")
    assert identified(empty(spark), weights, languages).columns == [c for c in empty(spark).columns if c != "score"] + ["lang_pred", "score"]
    nothing = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in predict(nothing, F.lit(False)).collect()} == {"und"}
    assert predict(documents.limit(0), F.lit(False)).count() == 0


def test_network_learns_what_only_order_tells():
    """Windows of the same letters, told apart by their order alone; and the gradient against differences."""
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 600)
    windows = np.where(labels[:, None] == 0, np.tile([97, 98, 99], 22)[:64], np.tile([97, 99, 98], 22)[:64]).astype(np.uint8)
    windows = np.stack([np.roll(w, s) for w, s in zip(windows, rng.integers(0, 3, 600))])
    weights = fit(windows, np.ones_like(windows, dtype=bool), labels, 2, steps=60)
    from tidemark.llm.language import pooled

    data = np.concatenate([np.append(w, 10) for w in windows]).astype(np.uint8)
    p = pooled(data, np.arange(601) * 65, weights)
    assert (p.argmax(axis=1) == labels).mean() > 0.98 and np.allclose(p.sum(axis=1), 1, atol=1e-3)
    assert start_weights(0)["bias"].shape == (0,)


# --- toxicity -----------------------------------------------------------------------------------------------


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 0.95 * len(out)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)


def test_toxicity_of_odd_rows(spark):
    rows = [*ODD, (9, "you stupid pathetic loser"), (10, "a calm text about the weather")]
    labels = spark.createDataFrame([(9, 1), (10, 0), (10, 0), (6, None), (77, 1), (6, 1), (6, 0)], "doc_id long, toxic int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for known in (labels, none):
        got = toxicity(frame(spark, rows), known, F.lit(False)).collect()
        by = {r["doc_id"]: r["score"] for r in got}
        assert len(got) == len(rows) and all(0 <= s <= 1 for s in by.values()) and by[9] > 0.5 > by[10]
    assert toxicity(empty(spark), labels, F.lit(False)).count() == 0


def test_label_model_counts_repeated_voters_once():
    """Three copies of a weak voter against two good ones: without correlations the copies would win."""
    rng = np.random.default_rng(2)
    truth = rng.integers(0, 2, 20_000)
    good = [np.where(rng.random(20_000) < 0.9, truth, 1 - truth) for _ in range(4)]
    weak = np.where(rng.random(20_000) < 0.6, truth, 1 - truth)
    votes = np.zeros((20_000, 13), dtype=np.int64)
    for v, column in zip((0, 1, 2, 3, 4, 5, 6), (*good, weak, weak, weak)):
        votes[:, v] = column
    patterns, back, counts = np.unique(votes @ (1 << np.arange(13)), return_inverse=True, return_counts=True)
    post, parent = posteriors(patterns, np.full(len(patterns), -1), counts)
    guess = np.array([post[p] for p in patterns.tolist()])[back] > 0.5
    assert (guess == truth).mean() > 0.94
    assert {4, 5, 6} & {int(parent[v]) for v in (4, 5, 6)}


# --- scoring ------------------------------------------------------------------------------------------------


def test_base_scores_and_both_ways_to_look_up(spark, texts):
    rows = [*texts[10:70], *[(i, t) for i, t in ODD if i is not None]]
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", brute.lower(t)), None]
    c = Counter()
    for i, t in rows:
        if brute.crc(i) % 5 != 1:
            c.update(tokens(t))
    total = sum(c.values())
    results = []
    for options in ({}, {"head": 50}, {"head": 50, "broadcast_bytes": 1}):
        got = sorted(score(frame(spark, rows), held, **options).collect(), key=lambda r: (r["doc_id"], r["base_score"]))
        assert len(got) == len(rows)
        for r, (i, t) in zip(got, sorted(rows, key=lambda r: (r[0], 0))):
            own = tokens(t)
            base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (len(c) + 1))) for w in own)
            assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, len(own), sum(c[w] > 0 for w in own), total)
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0
        results.append([r["score"] for r in got])
    assert results[0] == pytest.approx(results[1]) and results[0] == pytest.approx(results[2])
    seen = [r for r in got if not r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)


def test_scores_of_odd_tables(spark):
    assert score(empty(spark), F.lit(False)).count() == 0
    got = score(frame(spark, ODD), F.lit(True)).collect()
    assert len(got) == len(ODD) and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in got)
    assert level_of(np.array([1, 2, 3, 4, 1000])).tolist() == [1, 2, 2, 3, 10] and count_of(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


# --- personal data ------------------------------------------------------------------------------------------


def test_base_spans(spark, texts):
    rng = random.Random(3)
    pieces = ["a@b.c", "x.y@z-.d_e@f.g", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "007.08.9.0000255", "4111 1111-1111 1111", "4111111111111112", "9" * 25]
    pieces += ["+1 (555) 555-0100", "+1", "+12 34 5 6 7 8", "+(1", "é", " ", "\n", "12", "-", "7 ", "99999999999999999999999.1.2.3", "%+-._@a.b."]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))) for i in range(1000, 1600)]
    rows += [(i, t) for i, t in [*ODD, *texts[10:90]] if i is not None and i != 6]
    got = {r["doc_id"]: r for r in personal_data(frame(spark, rows)).collect()}
    for i, t in rows:
        base = [(s["kind"], s["start"], s["end"]) for s in got[i]["base"]]
        assert base == brute.personal(t), (i, t)
        assert got[i]["spans"][: len(base)] == got[i]["base"]
    assert sum(len(r["base"]) for r in got.values()) > 300


def test_added_spans_are_secrets(spark):
    rng = random.Random(4)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n)) + "a1f9"
    rows = [(i, rng.choice([f'the token = "{hexa(36)}" of it', f"so password={hexa(14)} it is", f"key: AKIA{hexa(12).upper()} there"])) for i in range(60)]
    rows += [(i, rng.choice(["version 2.0.1 of it", "in 1999 there were 120000 people", "see page 1234567", "covid19 and b2b", "call +1 (555) 555-0100 now"])) for i in range(100, 200)]
    got = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "secret"] for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(s) for i, s in got.items() if i < 100) >= 55 and not any(s for i, s in got.items() if i >= 100)
    assert personal_data(empty(spark)).count() == 0
    assert all(r["spans"] == r["base"] == [] for r in personal_data(spark.createDataFrame([(1, None), (1, None), (2, "words only")], "doc_id long, text string")).collect())


def test_reliabilities_find_the_bad_labeler():
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 2, 5000)
    votes = np.stack([np.where(rng.random(5000) < p, 2 * truth - 1, 1 - 2 * truth) for p in (0.9, 0.9, 0.85, 0.5)], axis=1)
    post, table, _ = reliabilities(votes, np.ones(5000))
    assert ((post > 0.5) == truth).mean() > 0.93
    assert abs(table[3, 1, 2] - table[3, 0, 2]) < 0.2 < abs(table[0, 1, 2] - table[0, 0, 2])


# --- shards -------------------------------------------------------------------------------------------------


def test_shards(spark, texts, tmp_path):
    rows = [*texts, (10**12, "x" * 5), (10**12 + 1, None)]
    got = byte_shards(frame(spark, rows), 7).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append((r["slot"], r["doc_id"], r["size"]))
    own = {i: len((t or "").encode()) + 16 for i, t in rows}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, own[i], brute.crc((t or "").encode())) for i, t in rows}
    assert all(sorted(s for s, _, _ in v) == list(range(len(v))) for v in by.values())
    assert [i for s in sorted(by) for _, i, _ in sorted(by[s])] == sorted(own)
    target = sum(own.values()) / 7
    assert all(abs(sum(b for _, _, b in v) - target) <= max(own.values()) for v in by.values())
    write_shards(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "shards"), 7)
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert {(r["doc_id"], r["text"], r["shard"]) for r in back} == {(i, dict(rows)[i], s) for s, v in by.items() for _, i, _ in v}


def test_shards_of_odd_tables(spark):
    assert byte_shards(empty(spark)).count() == 0
    got = byte_shards(frame(spark, [*ODD, *[(7, "same")] * 50]), 3).collect()
    assert len(got) == len(ODD) + 50
    for s in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


# --- packing ------------------------------------------------------------------------------------------------


def test_differencing_is_near_equal():
    rng = random.Random(1)
    known = np.bincount(differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])
    assert sorted(known) == [14, 16]
    for parts in (1, 3, 8):
        sizes = [rng.randrange(1, 400) for _ in range(200)]
        sums = np.bincount(differencing(sizes, parts), weights=sizes, minlength=parts)
        assert sums.max() - sums.min() <= 20
    assert differencing([], 3) == []
    # Three pieces of two thirds cannot share two windows even with one cut each, so the count rises.
    for sizes in ([], [5], [10, 10, 10], [6, 6, 6], [7] * 9, [rng.randrange(1, 11) for _ in range(60)]):
        windows = packed(sizes, 10)
        assert all(sum(n for _, _, n in w) <= 10 for w in windows)
        parts = sorted(p for w in windows for p in w)
        for item, size in enumerate(sizes):
            own = [(s, n) for i, s, n in parts if i == item]
            assert sum(n for _, n in own) == size and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pack_is_an_exact_round_trip(spark, texts, capacity):
    odd = "Don't.stop,me a.b..c É é.́,́x 1,2.3 <|endoftext|> Ünï,ß. x y İstanbul ǅ"
    rows = [*[(i, t) for i, t in ODD if i is not None and i != 6], *texts[10:70], (5000, odd), (5001, odd.upper())]
    got = pack(frame(spark, [*rows, rows[-1]]).repartition(3), TOKENIZER, capacity, windows=4).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert own == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] and len(own) == r["length"] > 0
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in ids.items():
        times = 2 if i == 5001 else 1
        assert sum(n for _, n in pieces[i]) == times * len(own)
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(map(len, ids.values()))
    assert len(sequences) * capacity <= total * 1.05 + 8 * capacity
    assert pack(empty(spark), TOKENIZER).count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_added_tokens_and_their_other_spellings_in_one_worker(turned):
    texts = ["<|endoftext|>", "<|ENDOFTEXT|>", "Ab <|StartOfText|> x<|endoftext|>Y", "ab <|startoftext|> X<|ENDOFTEXT|>y <|", "x<|endoftext|>y. AB<", ""]
    texts = texts[::-1] if turned else texts
    tokenizer, encoder = Tokenizer.from_file(TOKENIZER), Encoder(TOKENIZER)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [own.tolist() for own in encoder.encode(pa.array(texts))] == want
    assert [own.tolist() for t in texts for own in encoder.encode(pa.array([t]))] == want


# --- pipeline -----------------------------------------------------------------------------------------------


def test_no_clean_text_is_rejected_by_language(spark, documents):
    """Texts in all languages at once and single letters stay, and so does a table without any label."""
    by_lang = defaultdict(list)
    for r in documents.where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect():
        by_lang[r["lang"]].append(r["text"][:200])
    mixed = [" ".join(parts) for parts in zip(*by_lang.values())][:10]
    rows = [(10_000 + i, t, None, "made", len(t)) for i, t in enumerate([*mixed, "e", "é", "Ж", "a 1 2 3"])]
    rows += [(20_000, "12 %%", "en", "made", 5), (20_001, None, "en", "made", 0), (20_002, "", None, "made", 0)]
    both = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    kept = corpus_pipeline.language_id(spark, both, SF)
    assert {r["doc_id"] for r in kept.where("doc_id >= 10000").collect()} == {10_000 + i for i in range(len(mixed) + 4)}
    bare = documents.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, bare, SF).count() == documents.count()


def test_blanked_texts_leave_after_the_line_stage(spark, documents):
    line = "one and the same line of more than forty characters here"
    rows = [(i, f"{line}\n{line}", "en", "made", 0) for i in range(6)] + [(9, "short", "en", "made", 5), (3, "other text", "en", "made", 0)]
    got = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, documents.schema), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(3, "other text"), (5, f"{line}\n{line}"), (9, "short")]


def test_pipeline_stages(spark, documents, texts):
    columns = documents.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, documents, SF)
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {i for i, t in texts if any(map(str.isalpha, t or ""))}
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    lined = stages["line_dedup"](spark, kept, SF)
    want = {i: v for i, v in brute.shared_lines(rows).items() if v[2].strip("\x20\x09\x0a\x0b\x0c\x0d")}
    assert lined.columns == columns and {r["doc_id"]: (r["text"], r["n_chars"]) for r in lined.collect()} == {i: (t, len(t)) for i, (_, _, t) in want.items()}
    rows = [(i, t) for i, (_, _, t) in want.items()]
    first = stages["near_dedup"](spark, lined, SF)
    want = {i for i, (_, c) in brute.near_duplicates(rows).items() if i == c}
    assert first.columns == columns and {r["doc_id"] for r in first.collect()} == want
    rows = [r for r in rows if r[0] in want]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, first, SF)
    want = {i for i, (_, h, _) in brute.matches(rows, items).items() if not h}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == want
    whole = stages["packing"](spark, clean, SF)
    assert {r["doc_id"] for r in whole.collect()} == want
    total = lambda rows: Counter({(r["doc_id"], r["doc_tokens"]): 0 for r in rows}) + sum((Counter({r["doc_id"]: r["length"]}) for r in rows), Counter())
    assert total(corpus_pipeline.run(spark, SF).collect()) == total(whole.collect())


def test_pipeline_of_an_empty_table(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
