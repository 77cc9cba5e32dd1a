"""Benchmark passages in documents, found by binary search in suffix arrays of the documents.

Each slice of documents gets the sorted array of its word suffixes. Every suffix of every test item is looked
up in it by binary search, which gives the range of places where its first words stand verbatim. A suffix can
only be found if its first words all occur in some item, so runs of other words are left out of the array.
The array is built, searched and dropped inside a task: no shuffle, and memory for one slice.

Test items travel to the tasks in blocks of at most `block_bytes` of text; each block is a pass of its own.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
BLOCK_BYTES = 32 << 20
#: Runs of the suffix array looked at together.
RUNS = 1 << 20
MATCHES = "array<struct<start:int,length:int,item_id:string,item_start:int>>"


@dataclass
class Tests:
    """Words of the items of one block as numbers from 1, items one behind the other, each followed by a zero."""

    ids: list[str | None]
    vocabulary: np.ndarray
    words: np.ndarray
    item: np.ndarray
    place: np.ndarray
    need: np.ndarray
    shortest: int


def tests_of(rows: list[tuple[str | None, str | None]], width: int) -> Tests:
    hashes = []
    for _, text in rows:
        _, _, data, offsets = next(tb.slices(pa.array([text or ""], pa.large_string())))
        starts, ends, _ = tb.word_bounds(data, offsets, tb.ALNUM)
        hashes.append(tb.word_hashes(data, starts, ends))
    vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
    lengths = np.array([len(h) for h in hashes], dtype=np.int64)
    words = np.concatenate([np.append(np.searchsorted(vocabulary, h) + 1, 0) for h in hashes] or [np.zeros(0, np.int64)])
    item = np.repeat(np.arange(len(rows)), lengths + 1)
    place = np.concatenate([np.arange(n + 1) for n in lengths] or [np.zeros(0, np.int64)])
    # Words a suffix must find: a window, the whole of a shorter item; 0 where no window starts.
    need = np.where(place + np.minimum(width, lengths[item]) <= lengths[item], np.minimum(width, lengths[item]), 0) if len(rows) else place
    wanted = need[need > 0]
    return Tests([i for i, _ in rows], vocabulary, words, item, place, need, int(wanted.min()) if len(wanted) else 0)


def suffix_array(words: np.ndarray, longest: int) -> np.ndarray:
    """Places with a word, in the order of what follows them up to the next zero; ties beyond `longest` words are free."""
    rank, k = words.astype(np.int64), 1
    while k < longest:
        after = np.zeros_like(rank)
        after[: max(0, len(rank) - k)] = rank[k:]
        key = rank * (int(rank.max(initial=0)) + 1) + after
        key[words == 0] = 0
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + (0 if (key == 0).any() else 1)
        k *= 2
    order = np.argsort(rank, kind="stable")
    return order[words[order] > 0]


def _below(shard: np.ndarray, at: np.ndarray, tests: np.ndarray, suffix: np.ndarray, need: np.ndarray, strict: bool) -> np.ndarray:
    """Whether the shard's suffix, cut to `need` words, is smaller than the test's (with `strict`) or not larger."""
    less = np.full(len(at), not strict)
    active, k = np.arange(len(at)), 0
    while len(active):
        active = active[need[active] > k]
        mine, theirs = shard[at[active] + k], tests[suffix[active] + k]
        less[active[mine != theirs]] = (mine < theirs)[mine != theirs]
        active = active[mine == theirs]
        k += 1
    return less


def _bound(shard: np.ndarray, order: np.ndarray, tests: Tests, suffix: np.ndarray, strict: bool) -> np.ndarray:
    """First place in the suffix array that is not below (`strict`) or that is above each test suffix."""
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(order), np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        under = np.zeros(len(suffix), dtype=bool)
        under[open_] = _below(shard, order[middle[open_]], tests.words, suffix[open_], tests.need[suffix[open_]], strict)
        low, high = np.where(open_ & under, middle + 1, low), np.where(open_ & ~under, middle, high)
    return low


def _begun(shard: np.ndarray, order: np.ndarray, tests: Tests, suffix: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of each test suffix's range that the match cannot be carried on from to the left, and the suffix.

    Neighbours of the array with the same word before them are one run. A run whose word also stands before the test suffix
    is left out as a whole, so the work follows the number of matches that remain, also where one word repeats.
    """
    none = np.zeros(0, np.int64)
    before = np.where(order > 0, shard[order - 1], 0)
    starts = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
    stops = np.append(starts[1:], len(order))
    some = high > low
    suffix, low, high = suffix[some], low[some], high[some]
    # A suffix at the start of its item is carried on from nowhere.
    previous = np.where((suffix > 0) & (tests.need[suffix - 1] > 0), tests.words[suffix - 1], 0)
    first, last = (np.searchsorted(starts, x, "right") - 1 for x in (low, high - 1))
    ours, theirs = [none], [none]
    for part in np.array_split(np.arange(len(suffix)), max(1, int((last - first + 1).sum()) // RUNS)):
        count = (last - first + 1)[part]
        of = np.repeat(part, count)
        run = np.repeat(first[part] - np.cumsum(count) + count, count) + np.arange(count.sum())
        kept = (before[starts[run]] != previous[of]) | (previous[of] == 0)
        of, run = of[kept], run[kept]
        begin = np.maximum(low[of], starts[run])
        size = np.minimum(high[of], stops[run]) - begin
        ours.append(order[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())])
        theirs.append(np.repeat(suffix[of], size))
    return np.concatenate(ours), np.concatenate(theirs)


def occurrences(words: np.ndarray, first: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word of the slice, place among the test words, length) of every longest verbatim match of a window or more."""
    none = np.zeros(0, np.int64)
    if not tests.shortest or len(words) == 0:
        return none, none, none
    at = np.minimum(np.searchsorted(tests.vocabulary, words), len(tests.vocabulary) - 1)
    number = np.where(tests.vocabulary[at] == words, at + 1, 0)
    # Runs of known words inside a text; shorter ones cannot hold a window.
    known = number > 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    inner = first[(first > 0) & (first < len(words))]
    opens[inner] = known[inner]
    run = np.cumsum(opens) - 1
    sizes = np.bincount(run[known], minlength=int(run[-1]) + 1 if len(run) else 0)
    kept = np.flatnonzero(known)
    kept = kept[sizes[run[kept]] >= tests.shortest]
    if len(kept) == 0:
        return none, none, none
    gaps = np.cumsum(np.diff(run[kept], prepend=run[kept[0]]) != 0)
    shard = np.zeros(len(kept) + int(gaps[-1]) + 1, np.int64)
    origin = np.full(len(shard), -1)
    places = np.arange(len(kept)) + gaps
    shard[places], origin[places] = number[kept], kept
    suffix = np.flatnonzero(tests.need)
    suffix = suffix[np.isin(tests.words[suffix], shard[places])]
    order = suffix_array(shard, int(tests.need.max()))
    low, high = (_bound(shard, order, tests, suffix, strict) for strict in (True, False))
    ours, theirs = _begun(shard, order, tests, suffix, low, high)
    # As far right as each goes.
    length, active, k = np.zeros(len(ours), np.int64), np.arange(len(ours)), 0
    while len(active):
        same = (shard[ours[active] + k] == tests.words[theirs[active] + k]) & (shard[ours[active] + k] > 0)
        active = active[same]
        k += 1
        length[active] = k
    return origin[ours], theirs, length


_MATCH = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32())])


def _read(column: pa.Array, tests: Tests) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, pa.Array]]:
    """(first row, end row, words, hit words, lists of matches) of each slice of a column of texts."""
    names = pa.array(tests.ids, pa.string())
    for begin, end, data, offsets in tb.slices(column):
        starts, ends, first = tb.word_bounds(data, offsets, tb.ALNUM)
        ours, theirs, length = occurrences(tb.word_hashes(data, starts, ends), first, tests)
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, ours, 1)
        np.add.at(cover, ours + length, -1)
        hits = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
        placed = np.lexsort((length, theirs, ours))
        ours, theirs, length = ours[placed], theirs[placed], length[placed]
        doc = np.searchsorted(first, ours, "right") - 1
        columns = [pa.array(ours - first[doc], pa.int32()), pa.array(length, pa.int32()), names.take(pa.array(tests.item[theirs])), pa.array(tests.place[theirs], pa.int32())]
        found = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(end - begin + 1)), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_MATCH)))
        yield begin, end, np.diff(first), np.diff(hits[first]), found


def _block_count(items: DataFrame, block_bytes: int) -> int:
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    return max(1, math.ceil(size / block_bytes))


def _block(items: DataFrame, block: int, count: int, width: int) -> Tests:
    """One of `count` blocks of the items with a text, each about as large; one is on the driver at a time."""
    part = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    if count > 1:
        part = part.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
    return tests_of([(r["item_id"], r["text"]) for r in part.collect()], width)


def verbatim_matches(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, matches) for each row of `docs` (doc_id, text); `items` has item_id, text.

    `matches` are the longest verbatim matches of at least `width` words, or of a whole shorter item: first word
    in the document, words, item, first word in the item. n_hit counts the document's words inside any of them.
    A null or wordless text has none; items without words match nothing; equal items are all reported; rows
    that repeat a doc_id are answered each. Other columns are ignored. With several blocks of items a row's matches are
    gathered by (doc_id, text), and the passes run when this is called, one block in memory at a time.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")

    def passed(sent: Broadcast) -> DataFrame:

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin, end, words, hits, found in _read(batch.column(1), Tests(**sent.value)):
                    columns = [batch.column(c).slice(begin, end - begin) for c in (0, 2)]
                    yield pa.record_batch([*columns, pa.array(words, pa.int64()), pa.array(hits, pa.int64()), found], names=["doc_id", "print", "n_words", "n_hit", "matches"])

        named = docs.withColumn("print", F.xxhash64("text"))
        return named.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long, n_words long, n_hit long, matches {MATCHES}")

    count = _block_count(items, block_bytes)
    if count == 1:
        return passed(spark.sparkContext.broadcast(vars(_block(items, 0, 1, width)))).drop("print")
    key, rows, gathered = ["doc_id", "print"], None, None
    for number in range(count):
        sent = spark.sparkContext.broadcast(vars(_block(items, number, count, width)))
        found = settled(passed(sent) if rows is None else passed(sent).where("size(matches) > 0"))
        sent.destroy()
        rows = found.select(*key, "n_words") if rows is None else rows
        found = found.where("size(matches) > 0").dropDuplicates(key)
        gathered = found if gathered is None else gathered.union(found)
    gathered = gathered.groupBy(*key).agg(F.flatten(F.collect_list("matches")).alias("matches"))
    covered = F.aggregate(
        F.array_sort("matches"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0), m["start"] + m["length"] - F.greatest(m["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], m["start"] + m["length"]).alias("end"),
        ),
    )["n"].cast("long")
    gathered = gathered.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), covered.alias("n_hit"), "matches")
    joined = rows.join(gathered, rows["doc_id"].eqNullSafe(gathered["_id"]) & (rows["print"] == gathered["_print"]), "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("matches", F.array().cast(MATCHES)).alias("matches"))


def decontaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no window of an item; a null text is kept."""
    spark, place = docs.sparkSession, docs.columns.index("text")
    kept, count = docs, _block_count(items, block_bytes)
    for number in range(count):
        sent = spark.sparkContext.broadcast(vars(_block(items, number, count, width)))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin, end, _, hits, _ in _read(batch.column(place), Tests(**sent.value)):
                    yield batch.slice(begin, end - begin).filter(pa.array(hits == 0))

        kept = kept.mapInArrow(scan, docs.schema)
        if number + 1 < count:
            kept = settled(kept)
            sent.destroy()
    return kept
