"""Cross-tokenizer alignment, importance resampling and SimHash beside brute force, with the odd rows."""

import itertools
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, resampling
from tidemark.llm.alignment import Fragment, aligned, compose, cuts
from tidemark.llm.resampling import Dictionary, composed, drawn, ranked, resampled
from tidemark.llm.simhash import MATCHES, POSITIONS, linked, near_duplicates

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["ab", "é", "don't", "", "\n", " ", "中文", "😀", "x" * 30, "123", " ", "<s>", "<|endoftext|>", "...", "\t", "ß", "Ôi", "\x00", "á", "The", "of"]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = [(i, text_of(rng, rng.choice([1, 3, 20, 300]))) for i in range(50)]
    rows += [(100, None), (101, ""), (102, "a▁b " * 50), (103, "a" * 3000), (104, " "), (105, "\n"), (106, "a b " * 700)]
    return rows + [(107, "abc def"), (108, "abc def"), (109, "中" * 500), (110, "an unmarked é here " * 30)]


def frame(spark, rows):
    """doc_id and text with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(7).alias(c) for c in ("row", "slice", "fp", "pair", "rank", "score", "groups", "component", "_row", "_drawn")])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"chunk": 64, "slice_bytes": 500}, {"chunk": 7}])
def test_alignment(spark, corpus, options):
    rows = [*corpus, (None, "x y"), (107, "abc def")]
    got = rows_of(aligned(frame(spark, rows), *PATHS, **options))
    assert got == sorted(brute.Tokenizers(*PATHS).aligned(rows), key=str)


def test_alignment_digest_and_empty_table(spark):
    rows = [(1, "The same words of two tokenizers " * 20), (2, None)]
    got = {r["doc_id"]: r["groups"] for r in aligned(frame(spark, rows), *PATHS, digest=True, chunk=100).collect()}
    assert got == {1: brute.sha(brute.Tokenizers(*PATHS).aligned(rows)[0][-1]), 2: ""}
    assert aligned(frame(spark, []), *PATHS).count() == 0


def test_slices_are_small_and_few_in_a_file(spark, corpus, monkeypatch):
    """What a task holds of the written slices does not follow the size of its input."""
    kept, written = alignment.settled, []

    def settled(df, **of):
        out = kept(df, **of)
        if "entries" in out.columns:
            sizes = out.groupBy(F.input_file_name()).count().collect()
            written.extend(r["count"] for r in sizes)
        return out

    monkeypatch.setattr(alignment, "settled", settled)
    rows = [(i, t) for i, t in corpus if t and len(t) < 50] * 4
    aligned(frame(spark, rows).coalesce(1), *PATHS, slice_bytes=1).collect()
    few = [(1, "x y")] * 30
    aligned(frame(spark, few).coalesce(1), *PATHS, slice_bytes=1, chunk=1).collect()
    assert sum(written) > 8 and max(written) <= alignment.SLICES_A_FILE
    assert alignment.SLICE <= 1 << 19


def test_fragments_compose_in_any_order():
    rng = random.Random(1)
    empty = np.zeros(0, np.int32)

    def ids():
        return np.array([rng.randrange(9) for _ in range(rng.randrange(3))], np.int32)

    def fragment(place):
        closed = rng.random() < 0.6
        return Fragment(closed, place, ids(), ids(), *((ids(), ids()) if closed else (empty, empty)))

    def folded(parts):
        """One fragment and the groups closed, by a random order of neighbours."""
        parts, groups = list(parts), []
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            one, group = compose(parts[i], parts[i + 1])
            parts[i : i + 2] = [one]
            groups += [group] if group else []
        shown = [x.tolist() if isinstance(x, np.ndarray) else x for x in vars(parts[0]).values()]
        return shown if parts[0].closed else [shown[0], *shown[2:]], sorted((at, a.tolist(), b.tolist()) for at, a, b in groups)

    for _ in range(50):
        parts = [fragment(i) for i in range(rng.randrange(1, 9))]
        assert folded(parts) == folded(parts)


def test_no_token_crosses_a_cut():
    """Tokens of the whole stream are those of the parts between cuts."""
    rng, own = random.Random(9), brute.Tokenizers(*PATHS)
    for _ in range(200):
        raw = f" {text_of(rng, 12)}x".encode()
        at = [0, *cuts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
        parts = [raw[s:e].decode() for s, e in itertools.pairwise(at)]
        assert own.a.encode(raw.decode()).ids == [i for p in parts for i in own.a.encode(p).ids]
        assert own.b.encode(raw.decode()[1:]) == [i for p in parts for i in own.b.encode(p[1:])]


def test_payloads_compose():
    rng = np.random.default_rng(1)
    parts = [rng.bytes(int(n)) for n in rng.integers(0, 5000, 200)]
    payload = lambda own: (np.array([zlib.crc32(x) for x in own], np.uint32), np.array([len(x) for x in own]))
    crc, length = composed(payload(parts), payload(parts[::-1]))
    assert crc.tolist() == [zlib.crc32(x + y) for x, y in zip(parts, parts[::-1])]
    assert length.tolist() == [len(x) + len(y) for x, y in zip(parts, parts[::-1])]


@pytest.mark.parametrize("words", [0, 3, 10_000])
def test_dictionary_of_any_size_gives_the_same_payloads(words):
    rng = random.Random(2)
    texts = [(text_of(rng, 60) + "\n").encode() for _ in range(20)]
    own = Dictionary(words)
    for _ in range(2):
        for text in texts:
            (crc, length), first = own.payloads(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            want = brute.re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text.decode()))
            assert crc.tolist() == [zlib.crc32(w.encode()) for w in want] and first.tolist() == [0, len(want)]
            assert length.tolist() == [len(w.encode()) for w in want]
    assert len(own.crc) <= words and bool(words) == bool(len(own.crc))


def test_resampling(spark, corpus):
    rng = random.Random(6)
    rows = corpus + [(200 + i, text_of(rng, 40)) for i in range(60)]
    target = [text_of(rng, 30) for _ in range(5)] + [None]
    got = rows_of(resampled(frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string")))
    assert got == sorted(brute.resampled(rows, target), key=str)
    few = {"buckets": 16, "percent": 50, "least_words": 1, "seed": 8}
    assert rows_of(resampled(frame(spark, rows), frame(spark, []), **few)) == sorted(brute.resampled(rows, [], **few), key=str)


def test_resampling_of_odd_tables(spark):
    target = spark.createDataFrame([("of the",)], "text string")
    assert resampled(frame(spark, []), target).count() == 0
    same = "the words of one text that is repeated " * 4
    rows = [(5, same)] * 6 + [(None, same), (None, None), (3, same)]
    got = resampled(frame(spark, rows), target).collect()
    assert len(got) == len(rows) and sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert {r["weight"] for r in got if r["n_features"] == 0} == {0}
    kept = drawn(frame(spark, rows), target)
    assert kept.columns == frame(spark, []).columns and {r["doc_id"] for r in kept.collect()} <= {3, 5}


def test_ranks_over_many_ranges(spark):
    rng = random.Random(3)
    values = [rng.choice([1, 1, 1, rng.randrange(500)]) for _ in range(3000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long").repartition(7)
    got = ranked(df, [F.col("v").desc(), F.col("i")], "rank").collect()
    assert [r["i"] for r in sorted(got, key=lambda r: r["rank"])] == sorted(range(3000), key=lambda i: (-values[i], i))
    assert {r["rank"] for r in got} == set(range(1, 3001)) and {r["_total"] for r in got} == {3000}


def test_simhash(spark, corpus):
    rng = random.Random(8)
    rows = list(corpus)
    for group in range(6):
        base = [rng.choice(["alpha", "beta", "gamma", "delta", "Eta"]) + str(rng.randrange(40)) for _ in range(400)]
        for i in range(6):
            own = list(base)
            own[rng.randrange(400)] = "other"
            rows.append((1000 + 10 * group + i, " ".join(own)))
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    want = sorted((i, f"{fp:016x}", c) for (i, fp), c in zip(prints, brute.close_fingerprints(prints)))
    assert rows_of(near_duplicates(frame(spark, rows))) == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len({fp for _, fp, _ in want})


def test_simhash_of_odd_tables(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "one text"), (4, None), (4, "one text"), (2, "one text"), (2, ""), (9, "One\ttext")]
    got = rows_of(near_duplicates(frame(spark, rows)))
    text = f"{brute.fingerprint('one text'):016x}"
    assert got == sorted([(None, text, None), (4, "0" * 16, 2), (4, text, 2), (2, text, 2), (2, "0" * 16, 2), (9, text, 2)], key=str)


def test_simhash_reaches_through_rows_without_id(spark):
    """A chain of three fingerprints, two bits from one to the next, whose middle has no doc_id."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(40)}" for _ in range(300)]
    texts = [" ".join(base)]
    while len(texts) < 400:
        base[rng.randrange(300)] = f"v{rng.randrange(40)}"
        texts.append(" ".join(base))
    prints = [brute.fingerprint(t) for t in texts]
    near = lambda a, b: (a ^ b).bit_count() <= 2
    steps = range(1, len(texts) - 1)
    a, b, c = next((i, k, j) for k in steps for i in range(k) for j in range(k + 1, len(texts)) if near(prints[i], prints[k]) and near(prints[k], prints[j]) and not near(prints[i], prints[j]))
    rows = [(5, texts[a]), (None, texts[b]), (3, texts[c]), (None, "far away from all of them")]
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in near_duplicates(frame(spark, rows)).collect()}
    assert {k: v for k, v in got.items() if k[0] is not None} == {(5, f"{prints[a]:016x}"): 3, (3, f"{prints[c]:016x}"): 3}
    assert len(got) == 4


def test_links_of_crowded_lists(spark):
    """A ball of fingerprints that fills long lists: every pair within reach once, none beyond."""
    rng = random.Random(5)
    prints = {0} | {1 << b for b in range(64)} | {(1 << a) | (1 << b) for a in range(16) for b in range(a)}
    prints |= {rng.getrandbits(64) for _ in range(40)} | {rng.getrandbits(16) << 24 for _ in range(300)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = [tuple(x % (1 << 64) for x in r) for r in linked(spark.createDataFrame(signed, "fp long").repartition(3)).collect()]
    want = {frozenset(p) for p in itertools.combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= 2}
    assert len(got) == len(want) and {frozenset(p) for p in got} == want
    tally = lambda a, b: sum((a >> 8 * k) & 255 == (b >> 8 * k) & 255 for k in range(POSITIONS))
    assert all(tally(*p) >= MATCHES for p in want)


def test_words_of_a_worker_are_bounded():
    assert resampling.WORDS <= 1 << 16
