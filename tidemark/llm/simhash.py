"""SimHash near duplicates: an inverted index over the fingerprints' positional bytes, filtered by counts.

A fingerprint has 8 positional bytes. Each differing bit spoils one of them at most, so two fingerprints within
NEAR bits share at least MATCHES = 8 - NEAR positional bytes: the guaranteed minimum of the count filter. A list of
the index for one positional byte would hold a 256th of the corpus, and tallies over pairs of its entries would grow with
the square of the input. The lists are therefore those of MATCHES positional bytes together, one for each choice of the
bytes: two fingerprints meet in a list exactly if their tally reaches the minimum, and the bytes left
out differ only, so a list has at most 256 ** NEAR entries at any size of the corpus.
Inside a list the tally of a pair is MATCHES and the left-out bytes it shares; short lists are compared pair by pair, long
ones by a table of the left-out bits, looked up under every pattern of at most NEAR bits. What is within NEAR
bits becomes a link, given by one of the lists that both are in.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.graph import components
from tidemark.operators.salting import hot_join
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 3
SEED = 42
POSITIONS = 8
NEAR = 2
MATCHES = POSITIONS - NEAR
#: The positions a list leaves out.
LEFT_OUT = list(itertools.combinations(range(POSITIONS), NEAR))
#: Longest list that is compared pair by pair.
SHORT = 32
#: Hash values whose bits are spread out at a time.
HASHES = 1 << 15
#: Patterns of one and two set bits among the left-out ones.
PATTERNS = np.array([sum(1 << b for b in bits) for k in range(1, NEAR + 1) for bits in itertools.combinations(range(8 * NEAR), k)])


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of each text, repeats included, and for each text the number of hashes before it."""
    data = tb.LOWER[data]
    starts, ends, first = tb.word_bounds(data, offsets, tb.NOT_SPACE)
    # Words with one space behind each: the byte behind a word is white space, as a line feed ends each text.
    inside = tb.NOT_SPACE[data]
    data[ends], inside[ends] = 32, True
    raw = data[inside].tobytes()
    size = ends - starts
    end = np.cumsum(size + 1) - 1
    start = end - size
    words = np.diff(first)
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    before = np.concatenate([[0], np.cumsum(count)])
    word = np.repeat(first[:-1] - before[:-1], count) + np.arange(before[-1])
    last = word + np.repeat(np.minimum(words, width) - 1, count)
    spans = zip(start[word].tolist(), end[last].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(raw[a:z], SEED) for a, z in spans), np.uint64, len(word)), before


def _majority(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each text the bits set in over half of its hashes; zero for a text without hashes."""
    ones = np.zeros((len(before) - 1, 64), dtype=np.int64)
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    for s in range(0, len(hashes), HASHES):
        bits = np.unpackbits(hashes[s : s + HASHES].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own, at = np.unique(owner[s : s + HASHES], return_index=True)
        ones[own] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > np.diff(before)[:, None], axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) for each row of `docs` (doc_id, text): the 64 bits as a signed long; a text without words has 0."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in tb.slices(batch.column(1)):
                found = _majority(*_shingle_hashes(data, offsets, width))
                yield pa.record_batch([batch.column(0).slice(first, end - first), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tasks, "doc_id long, fp long")


def _lists() -> Column:
    """The lists of a fingerprint: number of the choice of bytes, and the bytes themselves in their places."""
    found = []
    for number, left_out in enumerate(LEFT_OUT):
        kept = (1 << 64) - 1 - sum(255 << (8 * p) for p in left_out)
        mask = F.lit(kept - (1 << 64) if kept >> 63 else kept).cast("long")
        found.append(F.struct(F.lit(number).cast("tinyint").alias("list"), F.col("fp").bitwiseAND(mask).alias("bytes")))
    return F.array(*found)


def _given_here(number: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs within NEAR bits, each in one of the lists that it is in: the first of those by number."""
    differ = a ^ b
    near = np.bitwise_count(differ) <= NEAR
    here = np.full(len(a), -1, dtype=np.int64)
    for n in range(len(LEFT_OUT) - 1, -1, -1):
        free = sum(255 << (8 * p) for p in LEFT_OUT[n])
        here[differ & np.uint64((1 << 64) - 1 - free) == 0] = n
    return near & (here == number)


def _long_list(number: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    free = np.zeros(len(own), dtype=np.int64)
    for place, p in enumerate(LEFT_OUT[number]):
        free |= ((own >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << (8 * place)
    at = np.full(1 << (8 * NEAR), -1, dtype=np.int64)
    at[free] = np.arange(len(own))
    for pattern in PATTERNS:
        other = at[free ^ pattern]
        x = np.flatnonzero(other > np.arange(len(own)))
        yield own[x], own[other[x]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of each pair within NEAR bits, from entries sorted by list; entries of a list are distinct."""
    held: list[np.ndarray] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            number, key, fp = (batch.column(c).to_numpy() for c in range(3))
            rows = [number.astype(np.int64), key, fp.view(np.uint64)]
            rows = [np.concatenate([h, r]) for h, r in zip(held, rows)] if held else rows
        else:
            rows = held
        if not rows or not len(rows[0]):
            continue
        new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        bounds = np.concatenate([[0], new, [len(rows[0])] if batch is None else []]).astype(np.int64)
        held = [r[bounds[-1] :] for r in rows]
        size, start = np.diff(bounds), bounds[:-1]
        for a, b in _pairs(rows[0], rows[2], start, size):
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _pairs(number: np.ndarray, fp: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for m in range(2, SHORT + 1):
        own = start[size == m]
        for x, y in itertools.combinations(range(m), 2) if len(own) else ():
            a, b = fp[own + x], fp[own + y]
            good = _given_here(number[own], a, b)
            if good.any():
                yield a[good], b[good]
    for s, m in zip(start[size > SHORT].tolist(), size[size > SHORT].tolist()):
        for a, b in _long_list(int(number[s]), fp[s : s + m]):
            good = _given_here(np.full(len(a), number[s]), a, b)
            if good.any():
                yield a[good], b[good]


def linked(prints: DataFrame) -> DataFrame:
    """(a, b): every pair of the distinct fingerprints `prints` (fp) within NEAR bits, once."""
    entries = prints.select("fp", F.explode(_lists()).alias("_l")).select("_l.list", "_l.bytes", "fp")
    return entries.repartition("list", "bytes").sortWithinPartitions("list", "bytes").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (columns doc_id, text; others are ignored).

    fingerprint has 16 lowercase hex digits. Rows whose fingerprints differ in at most NEAR bits are linked; equal ones are
    one entry of the index, so copies cost no pairs. component_id is the smallest doc_id that links reach. A null
    or wordless text has the fingerprint zero and is linked like any other; a text of fewer than `width` words has one
    shingle. Rows that repeat a doc_id are each linked by their own text, not by the id. A row without doc_id
    links others like any row, but has no component itself. An empty table gives an empty table.
    """
    rows = settled(fingerprints(docs, width))
    classes = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n")))
    found = components(linked(classes.select("fp")), "a", "b")
    member = found.join(classes, found["node"] == classes["fp"]).select("fp", "component", "doc")
    smallest = member.groupBy("component").agg(F.min("doc").alias("smallest"))
    moved = member.join(smallest, "component").select("fp", "smallest")
    named = classes.join(moved, "fp", "left").select("fp", F.coalesce("smallest", "doc").alias("_component"), "n")
    out = hot_join(rows, settled(named), ["fp"], "n", rows.count())
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return out.select("doc_id", digits.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("_component")).alias("component_id"))
