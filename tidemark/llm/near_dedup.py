"""Near duplicates: b-bit MinHash signatures joined on a multi-index, links confirmed on whole shingle sets.

A signature has 3 slots in each of CHUNKS chunks. Two signatures that differ in at most 2 * CHUNKS - 1 slots
have, by the pigeonhole principle, a chunk with at most one differing slot; each chunk is therefore indexed
three times, each time without one slot. All pairs within that signature distance share a key. CHECKS more
slots of 8 bits, outside of the index, sort out pairs whose whole signatures differ in more than FAR slots. At a
similarity of 0.75 a slot differs with probability 0.25, so a pair beyond either distance is a 1e-6 event.

Groups: texts with equal shingle sets are one class, known by 64 bits of the set's digest; its smallest doc_id is an
attribute, so a doc_id with several texts stands in several classes. In each of ROUNDS rounds every key's bucket names a head
out of its largest component and compares the members outside with it, one pair a member; what is linked
becomes one component. Only buckets that then still hold several components are searched whole: members
outside the largest component against all of the bucket, in blocks.

Spark takes a table behind an explode for as small as the one before it, and a written one for as small as its compressed
file, and would broadcast it through the driver. Joins of tables that grow with the corpus therefore ask for a merge.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.graph import components
from tidemark.operators.salting import salted_join
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNKS = 10
SLOTS = 3 * CHUNKS
#: Largest signature distance at which the index finds every pair.
REACH = 2 * CHUNKS - 1
BITS = 24
CHECKS = 98
#: Largest distance of whole signatures: five standard deviations beyond a quarter of the slots.
FAR = 56
ROUNDS = 3
WIDTH = 5
#: Classes of a cell, outer and other ones, and the shingles of either side: a cell is bounded by both.
BLOCK = 512
PART = 1024
SHINGLES = 1 << 19
#: Tasks over which the classes of one head or bucket are dealt before they are cut into cells.
SALTS = 16
SIEVE = 1 << 19
#: Pairs compared at a time.
PAIRS = 100_000
#: Rows whose shingle sets are made at a time, besides those of an unfinished cell; fewer where they are long.
ROWS = 1024

_rng = np.random.default_rng(77)
FACTOR = _rng.integers(0, 2**63, SLOTS + CHECKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 2**63, SLOTS + CHECKS, dtype=np.uint64)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The low bits of the smallest value of each slot's hash over the set: indexed slots, and those that check."""
    low = np.full(SLOTS + CHECKS, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for s in range(0, len(shingles), 4096):
            np.minimum(low, (shingles[None, s : s + 4096] * FACTOR[:, None] + SHIFT[:, None]).min(axis=1), out=low)
        low = tb.mix(low)
    return (low[:SLOTS] & np.uint64((1 << BITS) - 1)).astype(np.int32), low[SLOTS:].astype(np.uint8).tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in tb.slices(batch.column(1)):
            starts, ends, bounds = tb.word_bounds(data, offsets, tb.NOT_SPACE)
            words = tb.word_hashes(data, starts, ends)
            n, digest, signs, checks = [], [], [], []
            for own in tb.shingle_sets(words, bounds, WIDTH):
                n.append(len(own))
                digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sign, check = signature(own) if len(own) else (None, None)
                signs.append(sign)
                checks.append(check)
            named = [batch.column(c).slice(first, end - first) for c in (0, 2)]
            columns = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(signs, pa.list_(pa.int32())), pa.array(checks, pa.binary())]
            yield pa.record_batch([*named, *columns], names=["doc_id", "print", "n_shingles", "digest", "signs", "checks"])


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, print, n_shingles, digest, signs, checks) of each text; the last three are null for a text without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print"))
    return rows.mapInArrow(_describe, "doc_id long, print long, n_shingles long, digest binary, signs array<int>, checks binary")


def _keys() -> Column:
    keys = []
    for chunk in range(CHUNKS):
        for left_out in range(3):
            kept = [F.col("signs")[3 * chunk + s] for s in range(3) if s != left_out]
            keys.append(F.xxhash64(F.lit(3 * chunk + left_out), *kept))
    return F.array(*keys)


def _near(n: tuple[np.ndarray, np.ndarray], same: np.ndarray, same_checks: np.ndarray) -> np.ndarray:
    """Pairs that sizes and signatures do not rule out."""
    index = SLOTS - same.sum(axis=1)
    near = (index <= REACH) & (index + CHECKS - same_checks.sum(axis=1) <= FAR)
    return near & (100 * np.minimum(*n) >= 75 * np.maximum(*n))


def _matrix(signs: pa.Array, checks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return signs.flatten().to_numpy().reshape(-1, SLOTS), np.frombuffer(b"".join(checks.to_pylist()), np.uint8).reshape(-1, CHECKS)


CELL = ["g", "block", "part"]
MEMBER = [*CELL, "cls", "component", "role", "n", "doc", "signs", "checks"]
LINK = ["a", "a_doc", "b", "b_doc"]


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ROWS rows and SHINGLES shingles, or one row."""
    for whole in batches:
        upto = np.cumsum(whole.column(MEMBER.index("n")).to_numpy())
        s = 0
        while s < whole.num_rows:
            full = int(np.searchsorted(upto, (upto[s - 1] if s else 0) + SHINGLES, "right"))
            e = max(s + 1, min(s + ROWS, full))
            yield whole.slice(s, e - s)
            s = e


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, list[np.ndarray]]]:
    """Rows of whole cells out of batches sorted by cell: columns, number of the cell, shingle sets where texts are given."""
    held: dict[str, np.ndarray] = {}
    held_sets: list[np.ndarray] = []

    def numbers(rows: dict[str, np.ndarray]) -> np.ndarray:
        new = np.zeros(len(rows["cls"]), dtype=bool)
        for c in CELL:
            new[1:] |= rows[c][1:] != rows[c][:-1]
        return np.cumsum(new)

    for batch in _bounded(batches):
        rows = {c: batch.column(i).to_numpy() for i, c in enumerate(MEMBER[:-2])}
        rows["signs"], rows["checks"] = _matrix(batch.column(len(MEMBER) - 2), batch.column(len(MEMBER) - 1))
        sets: list[np.ndarray] = []
        for _, _, data, offsets in tb.slices(batch.column(len(MEMBER))) if batch.num_columns > len(MEMBER) else ():
            starts, ends, bounds = tb.word_bounds(data, offsets, tb.NOT_SPACE)
            sets += tb.shingle_sets(tb.word_hashes(data, starts, ends), bounds, WIDTH)
        if held:
            rows, sets = {c: np.concatenate([held[c], rows[c]]) for c in rows}, held_sets + sets
        cell = numbers(rows)
        end = int(np.searchsorted(cell, cell[-1]))
        held, held_sets = {c: v[end:] for c, v in rows.items()}, sets[end:]
        if end:
            yield {c: v[:end] for c, v in rows.items()}, cell[:end], sets[:end]
    if held:
        yield held, numbers(held), held_sets


def _near_pairs(rows: dict[str, np.ndarray], cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an outer row (role 0) and another row (role 1) of its cell, of two components, within reach; outer rows in order."""
    outer, other = np.flatnonzero(rows["role"] == 0), np.flatnonzero(rows["role"] == 1)
    low, high = (np.searchsorted(cell[other], cell[outer], side) for side in ("left", "right"))
    done = np.cumsum(high - low) // PAIRS
    for part in np.split(np.arange(len(outer)), np.flatnonzero(np.diff(done)) + 1):
        count = (high - low)[part]
        x = np.repeat(outer[part], count)
        y = other[np.repeat(low[part] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        apart = rows["component"][x] != rows["component"][y]
        x, y = x[apart], y[apart]
        near = _near((rows["n"][x], rows["n"][y]), rows["signs"][x] == rows["signs"][y], rows["checks"][x] == rows["checks"][y])
        yield x[near], y[near]


def _members_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have another row within reach in their cell."""
    for rows, cell, _ in _cells(batches):
        keep = np.zeros(len(cell), dtype=bool)
        for x, y in _near_pairs(rows, cell):
            keep[x] = keep[y] = True
        columns = MEMBER[:6]
        yield pa.record_batch([pa.array(rows[c][keep]) for c in columns], names=columns)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, confirmed on whole sets; of a cell's links, those that join what it has not joined yet."""
    for rows, cell, sets in _cells(batches):
        bounds = np.concatenate([[0], np.cumsum([len(own) for own in sets])])
        shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
        marked = np.zeros(int(shingle.max()) + 1, dtype=np.int32)
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                root[c] = root.get(root[c], root[c])
                c = root[c]
            return c

        found = []
        for xs, ys in _near_pairs(rows, cell):
            for part in np.split(np.arange(len(xs)), np.flatnonzero(np.diff(xs)) + 1) if len(xs) else ():
                x, y = int(xs[part[0]]), ys[part]
                own = shingle[bounds[x] : bounds[x + 1]]
                marked[own] = 1
                low, high = int(y[0]), int(y[-1]) + 1
                both = np.add.reduceat(marked[shingle[bounds[low] : bounds[high]]], bounds[low:high] - bounds[low])[y - low]
                marked[own] = 0
                either = len(own) + np.diff(bounds)[y] - both
                y = y[100 * both >= 75 * either]
                for c, first in zip(*np.unique(rows["component"][y], return_index=True)):
                    a, b = find(int(rows["component"][x])), find(int(c))
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append([int(rows[c][i]) for i in (x, y[first]) for c in ("cls", "doc")])
        yield pa.record_batch([pa.array([p[at] for p in found], pa.int64()) for at in range(len(LINK))], names=LINK)


def merged(df: DataFrame) -> DataFrame:
    """The table as a side of joins that are not to be broadcast, whatever size Spark takes either side for."""
    return df.hint("merge")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text) of the wanted (cls, _id, _print), one text each.

    A table of the hash values modulo SIEVE, at most SIEVE rows at any size, first lets through the rows that can
    be wanted, so other texts are not shuffled.
    """

    def sieve() -> Column:
        return F.pmod(F.xxhash64("_id"), F.lit(SIEVE))

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", F.xxhash64("text").alias("_print")).withColumn("_s", sieve())
    rows = rows.join(F.broadcast(wanted.select(sieve().alias("_s")).distinct()), "_s", "left_semi").drop("_s")
    return rows.join(merged(wanted), ["_id", "_print"]).dropDuplicates(["cls"]).select("cls", "text")


def linked(cells: DataFrame, signs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, a_doc, b, b_doc): confirmed links between outer rows (role 0) and other rows (role 1) of the same cell.

    `cells` has g, block, part, cls, component, role. Signatures decide which rows have a near partner at all;
    only these fetch their texts, once for each cell.
    """

    def sorted_(rows: DataFrame) -> DataFrame:
        return rows.repartition(*CELL).sortWithinPartitions(*CELL, "role")

    signs = merged(signs)
    near = sorted_(cells.join(signs, "cls").select(*MEMBER)).mapInArrow(_members_near, "g long, block int, part int, cls long, component long, role int")
    near = settled(near)
    wanted = near.select("cls").distinct().join(signs.select("cls", "doc", "print"), "cls").select("cls", F.col("doc").alias("_id"), F.col("print").alias("_print"))
    texts = _texts(docs, wanted)
    return sorted_(near.join(signs, "cls").join(merged(texts), "cls").select(*MEMBER, "text")).mapInArrow(_links, ", ".join(f"{c} long" for c in LINK))


def _joined(links: DataFrame) -> DataFrame:
    """(cls, component, first): the component of each linked class, and the smallest doc_id in it."""
    ends = [F.when(F.col(end).isNotNull(), F.struct(F.col(f"{end}_doc").alias("doc"), F.col(end).alias("cls"))).alias(end) for end in ("a", "b")]
    found = components(links.select(*ends), "a", "b")
    return found.select("node.cls", F.col("component.cls").alias("component"), F.col("component.doc").alias("first"))


def _labelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("component", F.col("cls"))
    found = buckets.join(merged(labels), "cls", "left")
    return found.select("slot", "key", "cls", "n", F.coalesce("component", "cls").alias("component"))


def _pieces(which: Column, rows: int) -> Column:
    """Into how many pieces the classes go, by their number and by their shingles."""
    return F.greatest(F.ceil(F.sum(which.cast("int")) / rows), F.ceil(F.sum(F.when(which, F.col("n"))) / SHINGLES)).cast("int")


def _stars(rays: DataFrame) -> DataFrame:
    """Cells of a head (g, of component main) and some classes to be compared with it, BLOCK or SHINGLES shingles."""
    sizes = rays.groupBy("g", "main").agg(_pieces(F.lit(True), BLOCK).alias("blocks"))
    outer = salted_join(rays, merged(sizes.select("g", "blocks")), ["g"], ["cls"], salts=SALTS).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    outer = outer.select("g", "block", F.lit(0).alias("part"), "cls", "component", F.lit(0).alias("role"))
    head = sizes.select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("part"), F.col("g").alias("cls"), F.col("main").alias("component"), F.lit(1).alias("role"))
    return outer.union(head)


def _blocks(pending: DataFrame) -> DataFrame:
    """Cells of BLOCK classes outside of the component g and PART classes of the same buckets, each with each; fewer where they are long."""
    outside = F.col("component") != F.col("g")
    sizes = pending.groupBy("g").agg(_pieces(outside, BLOCK).alias("blocks"), _pieces(F.lit(True), PART).alias("parts"))
    rows = salted_join(pending, merged(sizes), ["g"], ["cls"], salts=SALTS)
    outer = rows.where(outside).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    outer = outer.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*MEMBER[:5], F.lit(0).alias("role"))
    other = rows.withColumn("part", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("parts")).cast("int"))
    other = other.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*MEMBER[:5], F.lit(1).alias("role"))
    return outer.union(other)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (columns doc_id, text; others are ignored).

    Texts are linked when 100 * intersection >= 75 * union of their sets of 5-word shingles; component_id is the
    smallest doc_id that links reach, kept marks that document. A null or wordless text has no shingles and is
    linked with nothing. Rows that repeat a doc_id with one text share their component. Rows that repeat it with
    several texts are each linked by their own text, not by the id: components and kept can differ from row to row,
    and two components with the same smallest doc_id have the same name. A row without doc_id is not linked, has no
    component and is kept. An empty table gives an empty table.
    """
    return _marked(docs).drop("print")


def _marked(docs: DataFrame) -> DataFrame:
    """The rows of near_duplicates with print, the hash of their text."""
    docs = docs.select("doc_id", "text")
    rows = settled(described(docs))
    named = rows.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = named.groupBy("digest").agg(F.min(F.struct("doc_id", "print", "n_shingles", "signs", "checks")).alias("_c"))
    number = F.xxhash64("digest").alias("cls")
    classes = settled(classes.select(number, F.col("_c.doc_id").alias("doc"), "_c.print", "digest", F.col("_c.n_shingles").alias("n"), "_c.signs", "_c.checks"))
    signs = classes.select("cls", "doc", "print", "n", "signs", "checks")
    keyed = classes.select("cls", "n", F.posexplode(_keys()).alias("slot", "key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    buckets = settled(keyed.join(merged(shared), "key"))

    labels = links = None
    for turn in range(ROUNDS):
        member = _labelled(buckets, labels)
        sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("cls", F.lit(turn)), "cls"))["cls"].alias("head"))
        heads = sizes.groupBy("key").agg(F.max(F.struct("size", F.xxhash64("component", F.lit(turn)), "component", "head")).alias("_m"), F.count(F.lit(1)).alias("parts"))
        heads = heads.where("parts > 1").select("key", F.col("_m.component").alias("main"), F.col("_m.head").alias("g"))
        rays = settled(member.join(merged(heads), "key").where("component != main").select("g", "main", "cls", "n", "component").distinct())
        new = settled(linked(_stars(rays), signs, docs))
        links = new if links is None else links.union(new)
        if turn and new.isEmpty():
            break
        labels = _joined(links)

    member = _labelled(buckets, labels)
    sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "component"))["component"].alias("g"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    pending = settled(member.join(merged(main.select("key", "g")), "key").select("g", "cls", "n", "component").distinct())
    links = links.union(linked(_blocks(pending), signs, docs))
    every = _joined(links)

    of_class = classes.select("digest", "cls", "doc").join(merged(every), "cls", "left").select("digest", F.coalesce("first", "doc").alias("_component"))
    out = rows.join(merged(of_class), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "print", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without those whose component has a smaller doc_id; other texts of their doc_id stay."""
    gone = _marked(docs).where("NOT kept").select(F.col("doc_id").alias("_gone"), F.col("print").alias("_gone_text")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_text"]), "left_anti")
