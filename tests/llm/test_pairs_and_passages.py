"""Near duplicates, fingerprints, line dedup and decontamination beside brute force, with the odd rows."""

import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import graph, near_dedup
from tidemark.llm import textbytes as tb
from tidemark.llm.decontamination import decontaminated, occurrences, suffix_array, tests_of, verbatim_matches
from tidemark.llm.fingerprints import containment, edited_fingerprints, likeness, merged, sketch
from tidemark.llm.graph import components
from tidemark.llm.line_dedup import keep_bitmaps, without_shared_lines
from tidemark.llm.near_dedup import first_of_each, near_duplicates

WORDS = [a + b for a in ("ab", "cé", "do", "fu", "gi") for b in ("na", "ro", "ß", "ti", "lu", "ke", "")]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Groups of near copies of several strengths, exact copies, shared passages, odd and very long texts."""
    rng = random.Random(3)
    rows, doc_id = [], 10
    for group in range(12):
        base = text_of(rng, rng.choice([3, 6, 40, 120, 400])).split()
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(int(len(own) * rng.choice([0, 0.005, 0.02, 0.05, 0.3]))):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((doc_id, " ".join(own).capitalize()))
            doc_id += rng.choice([1, 1, 7])
    passage = text_of(rng, 25)
    for _ in range(8):
        rows.append((doc_id, f"{text_of(rng, 8)}\n{passage}\n{text_of(rng, 30)}"))
        doc_id += 1
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "é" * 50), (7, text_of(rng, 30_000)), (8, "\n".join(["x" * 45] * 3))]
    return rows


def frame(spark, rows):
    """doc_id and text with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(7).alias(c) for c in ("print", "cls", "signs", "_keep", "_doc", "matches", "n_words", "component_id", "kept")])


def test_near_duplicates(spark, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, corpus)).collect()}
    assert got == brute.near_duplicates(corpus)


def _joins(df):
    """The joins of a plan by broadcast, as planned before sizes are measured."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]


def test_near_duplicates_broadcast_no_table_that_grows(spark, corpus, monkeypatch):
    """Only the sieve of hash values is broadcast: what stands behind an explode is larger than Spark takes it for."""
    plans, kept = [], near_dedup.settled
    monkeypatch.setattr(near_dedup, "settled", lambda df, *of: plans.append(_joins(df)) or kept(df, *of))
    plans.append(_joins(near_duplicates(frame(spark, corpus))))
    plans.append(_joins(first_of_each(frame(spark, corpus))))
    assert len(plans) > 10 and all("LeftSemi" in line for plan in plans for line in plan)


def test_labels_of_many_links_are_not_broadcast(spark, monkeypatch):
    """The same components where tables of labels are merged."""
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 7], "a long, b long")
    want = {tuple(r) for r in components(links, "a", "b").collect()}
    plans, kept = [], graph.settled
    monkeypatch.setattr(graph, "FEW_LINKS", 10)
    monkeypatch.setattr(graph, "settled", lambda df, *of: plans.append(_joins(df)) or kept(df, *of))
    assert {tuple(r) for r in components(links, "a", "b").collect()} == want
    assert len(plans) > 2 and not any(plans)


def test_bitmaps_of_lines_are_not_broadcast(spark):
    line = "a line of more than forty characters that is shared"
    docs = frame(spark, [(i, f"{line}\n" + "x\n" * 50 + str(i)) for i in range(6)])
    rows = without_shared_lines(docs)
    assert not [x for x in _joins(rows) if "_keep" in x or "LeftOuter" in x]
    assert sorted((r["doc_id"], r["n_dropped"]) for r in rows.collect()) == [(i, int(i < 5)) for i in range(6)]


def test_near_copies_in_a_chain_and_a_crowd(spark):
    rng = random.Random(5)
    rows, own = [], text_of(rng, 60).split()
    for i in range(150):
        own = list(own)
        if i % 3 == 0:
            own[rng.randrange(60)] = rng.choice(WORDS)
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, f"{text_of(rng, 25)} {' '.join(own[:20])}") for i in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_duplicates(rows)


def test_near_duplicates_of_odd_tables(spark, corpus):
    empty = frame(spark, [])
    assert near_duplicates(empty).count() == 0 and first_of_each(empty).columns == empty.columns
    text = corpus[0][1] + " and more words to be sure"
    rows = [(None, text), (None, text), (9, text), (9, text), (9, "another text of one id"), (3, text)]
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_duplicates(frame(spark, rows)).collect() if r["doc_id"] != 9)
    assert got == [(0, None, True), (0, None, True), (3, 3, True)]
    assert {r["component_id"] for r in near_duplicates(frame(spark, rows)).where("doc_id = 9").collect()} <= {3, 9}


@pytest.mark.parametrize("turned", [False, True])
def test_near_duplicates_where_an_id_has_two_texts(spark, turned):
    """Each text is linked for itself, whichever of the two has the smaller hash; no text leaves the corpus altogether."""
    rng = random.Random(12)
    a, b = sorted((text_of(rng, 60) for _ in range(2)), reverse=turned)
    near_b = f"{b} at the end"
    gone = frame(spark, [(3, a), (9, a), (9, b)])
    assert sorted(map(tuple, near_duplicates(gone).select("doc_id", "component_id", "kept").collect())) == [(3, 3, True), (9, 3, False), (9, 9, True)]
    assert {(r["doc_id"], r["text"]) for r in first_of_each(gone).collect()} == {(3, a), (9, b)}
    lost = frame(spark, [(9, a), (9, b), (12, b), (15, near_b), (15, a), (20, a), (21, near_b)])
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(lost).collect()} == {(9, 9, True), *((i, 9, False) for i in (12, 15, 20, 21))}
    assert sorted((r["doc_id"], r["text"]) for r in first_of_each(lost).collect()) == sorted([(9, a), (9, b)])


def test_first_of_each_keeps_one_of_a_group(spark, corpus):
    df = frame(spark, corpus)
    kept = first_of_each(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in brute.near_duplicates(corpus).items() if i == c}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 100), (5, 5), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 50: 50, 60: 50, 100: 50, 200: 200, 201: 200}


def test_fingerprints(spark, corpus):
    rows = [r for r in corpus if r[0] != 8] + [(8, None)]
    got = {r["doc_id"]: r for r in edited_fingerprints(frame(spark, rows)).collect()}
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    assert got.keys() == texts.keys()
    same = {}
    for i, r in got.items():
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after[i]][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(texts[i]), brute.sha(edited))
        for name, other in (("near_edited", edited), ("near_next", texts[after[i]])):
            a, b = brute.shingles(texts[i]), brute.shingles(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(r[name] - exact) < (0.3 if len(a | b) > 32 else 1e-9), (i, name)
        assert same.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]


def test_fingerprints_of_odd_tables(spark):
    assert edited_fingerprints(frame(spark, [])).count() == 0
    one = edited_fingerprints(frame(spark, [(5, "abcd")])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == brute.sha("abab")
    twice = edited_fingerprints(frame(spark, [(None, "ab cd"), (4, "x y z w v u"), (4, "x y z w v u"), (4, "x y z w v u")])).collect()
    assert len(twice) == 4 and sum(r["near_next"] == 1.0 for r in twice) == 2


def test_sketches_merge_and_contain(spark):
    rng = random.Random(8)
    small, rest = text_of(rng, 400), text_of(rng, 6000)
    row = spark.createDataFrame([(small, rest, f"{small} {rest}")], "a string, b string, c string").select(*[sketch(F.col(c)).alias(c) for c in "abc"])
    got = row.select(containment(F.col("a"), F.col("c")).alias("ac"), containment(F.col("c"), F.col("a")).alias("ca"), likeness(F.col("c"), merged(F.col("a"), F.col("b"))).alias("m")).first()
    assert got["ac"] > 0.95 and got["ca"] < 0.2 and got["m"] > 0.95


def test_shared_lines(spark):
    rng = random.Random(4)
    lines = [text_of(rng, 12) for _ in range(30)] + [text_of(rng, 3) for _ in range(5)]
    rows = [(i, "\n".join(rng.choice([" %s", "%s\t", "%s"]) % rng.choice(lines).capitalize() for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join([lines[0]] * 400)), (-5, lines[1] + "\n")]
    df = frame(spark, rows)
    got = without_shared_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    want = brute.shared_lines(rows)
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"] or "") for r in got.collect()} == want
    assert sum(n for _, n, _ in want.values()) > 50
    assert got.where("doc_id = 100").first()["text"] is None


def test_one_line_over_many_tasks(spark):
    """Most rows hold the same line, so its rows are cut over all tasks; ids that repeat count once."""
    hot, rare = "the very same line that nearly every document holds", "a line of forty characters that four documents hold"
    rows = [(i % 700, f"{hot}\nown {i % 700}\n{hot if i % 2 else rare if i % 700 in (3, 5, 7, 9) else ''}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in without_shared_lines(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute.shared_lines(rows)
    again = spark.createDataFrame([(1, hot)] * 9 + [(i, hot) for i in (2, 3, 4)] + [(None, hot)] * 3, "doc_id long, text string")
    assert keep_bitmaps(again).count() == 4
    assert keep_bitmaps(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_passages(spark, block_bytes):
    rng = random.Random(6)
    items = [(i, text_of(rng, n)) for i, n in enumerate([12, 40, 10, 3, 1, 25])] + [(6, None), (7, ""), (8, "?!")]
    items += [(9, items[1][1].upper()), (10, items[5][1])]
    rows = []
    for i in range(50):
        words = text_of(rng, 60).split()
        source = rng.choice(items[:6])[1].split()
        s = rng.randrange(len(source))
        words[20:20] = source[s : s + rng.choice([5, 9, 10, 11, 40])]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(60, None), (61, ""), (62, items[0][1]), (63, "X " * 20_000 + items[1][1]), (64, items[3][1] + " 1")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], {m["item_id"] for m in r["matches"]}) for r in verbatim_matches(frame(spark, rows), tests, block_bytes=block_bytes).collect()}
    want = brute.matches(rows, items)
    assert got == want and sum(h > 0 for _, h, _ in want.values()) > 20
    df = frame(spark, rows)
    kept = decontaminated(df, tests, block_bytes=block_bytes)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, (_, h, _) in want.items() if not h}


def test_longest_match_and_place(spark):
    rng = random.Random(9)
    item = [f"w{i}" for i in range(30)]
    text = " ".join([*("z" * 3), *item[4:27], "q", *item[:12]])
    got = verbatim_matches(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string"), spark.createDataFrame([("a", " ".join(item))], "item_id string, text string")).collect()
    assert [[(m["start"], m["length"], m["item_start"]) for m in r["matches"]] for r in got] == [[(3, 23, 4), (27, 12, 0)]] * 2
    none = verbatim_matches(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")).collect()
    assert none[0]["n_words"] == 39 and none[0]["matches"] == [] and rng


def test_suffix_array_is_in_order():
    import numpy as np

    words = np.array([2, 1, 2, 1, 3, 0, 2, 1, 2, 0, 0, 3, 3])
    got = suffix_array(words, 12)
    tail = lambda i: [w for w in words[i:].tolist()][: (words[i:].tolist() + [0]).index(0)]
    assert sorted(got.tolist()) == [i for i, w in enumerate(words) if w]
    assert [tail(i) for i in got] == sorted(tail(i) for i in got)


def test_cells_of_long_near_copies_are_bounded(spark, monkeypatch):
    """A crowd of long near copies: the pieces of a bucket follow the shingles, and no run of rows holds more than one long text."""
    monkeypatch.setattr(near_dedup, "SHINGLES", 2000)
    rng = random.Random(21)
    base = text_of(rng, 900).split()
    rows = []
    for i in range(24):
        own = list(base)
        for _ in range(12 * (i % 4)):
            own[rng.randrange(900)] = rng.choice(WORDS) + str(i)
        rows.append((i, " ".join(own)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_duplicates(rows)
    n = pa.array([1500, 400, 200, 3000, 10, 10])
    columns = [n if c == "n" else pa.array([0] * 6) for c in near_dedup.MEMBER]
    runs = list(near_dedup._bounded(iter([pa.record_batch(columns, names=near_dedup.MEMBER)])))
    assert [r.num_rows for r in runs] == [2, 1, 1, 2]


def test_memory_of_a_cell_of_long_near_copies():
    """Links of one full cell of texts of 10,000 words stay below 300 MB."""
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(5000)])
    base = rng.choice(words, 10_000)
    count = near_dedup.SHINGLES // 10_000
    columns = {c: [] for c in [*near_dedup.MEMBER, "text"]}
    for i in range(2 * count):
        own = base.copy()
        own[rng.integers(0, 10_000, 100)] = rng.choice(words, 100)
        text = " ".join(own)
        columns["text"].append(text)
        (_, _, data, offsets) = next(tb.slices(pa.array([text])))
        starts, ends, bounds = tb.word_bounds(data, offsets, tb.NOT_SPACE)
        (found,) = tb.shingle_sets(tb.word_hashes(data, starts, ends), bounds, near_dedup.WIDTH)
        signs, checks = near_dedup.signature(found)
        for c, v in zip(near_dedup.MEMBER, [1, 0, 0, i, i, int(i >= count), len(found), i, signs, checks]):
            columns[c].append(v)
    kinds = {"block": pa.int32(), "part": pa.int32(), "role": pa.int32(), "signs": pa.list_(pa.int32()), "checks": pa.binary(), "text": pa.string()}
    batch = pa.record_batch([pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()], names=list(columns))
    tracemalloc.start()
    links = [r for b in near_dedup._links(iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links and peak < 300e6, peak


def test_one_word_repeated_in_text_and_item():
    """500,000 times against 1,000 times: matches that go no further to the left, in bounded memory."""
    tests = tests_of([("i", "a " * 1000), ("j", "b " + "a " * 20)], 10)
    words = tb.word_hashes(np.frombuffer(b"a ", np.uint8), np.array([0]), np.array([1])).repeat(500_000)
    tracemalloc.start()
    ours, theirs, length = occurrences(words, np.array([0, len(words)]), tests)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6, peak
    got = set(zip(ours.tolist(), theirs.tolist(), length.tolist()))
    want = {(i, 0, min(1000, 500_000 - i)) for i in range(500_000 - 9)} | {(0, t, 1000 - t) for t in range(991)}
    assert len(got) == len(ours) and {g for g in got if g[1] < 1001} == want
    assert {(o, n) for o, t, n in got if t > 1001} == {(i, min(20, 500_000 - i)) for i in range(500_000 - 9)} | {(0, 20 - k) for k in range(11)}


def test_repetitive_texts_against_brute_force(spark):
    rng = random.Random(31)
    rows = [(i, " ".join(rng.choice(["a", "a", "a", "b"]) for _ in range(rng.randrange(60)))) for i in range(25)]
    items = [(i, " ".join(rng.choice(["a", "a", "b"]) for _ in range(rng.choice([3, 12, 30])))) for i in range(6)]
    test = spark.createDataFrame(items, "item_id long, text string")
    want = brute.matches(rows, items, 4)
    for blocks in (1 << 20, 40):
        got = verbatim_matches(frame(spark, rows), test, width=4, block_bytes=blocks).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], {m["item_id"] for m in r["matches"]}) for r in got} == want
