"""Target-distribution importance resampling over hashed word runs, found by an Aho-Corasick dictionary.

The dictionary holds distinct words, each between two delimiters, with the word's CRC-32 and length as payload. A scan
of a text whose delimiters are blanks emits one payload for each word. The checksum of a run of words
follows from its payloads alone: crc(x + y) is crc(x) moved on by the length of y, plus crc(y). Its
remainder is the run's bucket. A first scan counts buckets, over all documents and over the target; a second one
adds up each document's gains. Scores are drawn by rank, from range partitions and their sizes.

A worker's dictionary is bounded: it takes in words that repeat until it is full. Words outside of it get the
same payload computed on the spot, so its content changes no result.
"""

from __future__ import annotations

import itertools
import math
import sys
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.worker import of_worker
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Words a dictionary holds at most.
WORDS = 1 << 16
#: New words are taken in when they repeat in a slice and make up one of so many of its words.
WORTH = 32
POLYNOMIAL = 0xEDB88320
BLANK = zlib.crc32(b" ")

#: Bytes as they are scanned: A-Z lower-cased, what is in no word a blank.
FOLDED = np.where(tb.ALNUM, tb.LOWER, 32).astype(np.uint8)


def _byte_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return crc


def _moved_by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def _move_tables(powers: int = 24) -> list[np.ndarray]:
    """For each power k, tables by byte of the linear map that moves a checksum on by 2 ** k bytes."""
    byte = _byte_table()
    columns = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint32)
    tables = [(columns >> np.uint32(8)) ^ byte[columns & 255]]
    while len(tables) < powers:
        tables.append(_moved_by(tables[-1], _moved_by(tables[-1], columns)))
    return tables


MOVES = _move_tables()


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The part of each checksum in that of its bytes with `by` further bytes behind them."""
    crc = crc.copy()
    for k, table in enumerate(MOVES):
        if not (by >> k).any():
            break
        here = np.flatnonzero((by >> k) & 1)
        crc[here] = _moved_by(table, crc[here])
    return crc


def composed(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Payload (checksum, length) of two neighbours from their payloads; associative."""
    return moved(left[0], right[1]) ^ right[0], left[1] + right[1]


class Dictionary:
    """Distinct words in an automaton, with their payloads."""

    def __init__(self, words: int = WORDS) -> None:
        self.words = words
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        words = words[: self.words - len(self.crc)]
        for number, word in enumerate(words, len(self.crc)):
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.crc = np.concatenate([self.crc, np.array([zlib.crc32(w) for w in words], np.uint32)])
        self.length = np.concatenate([self.length, np.array([len(w) for w in words], np.int64)])

    def payloads(self, data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Payload of each word of the texts, and for each text the number of words before it."""
        starts, ends, first = tb.word_bounds(data, offsets, tb.ALNUM)
        folded = FOLDED[data].tobytes()
        crc, known = np.zeros(len(starts), np.uint32), np.zeros(len(starts), bool)
        if len(self.crc):
            # Bytes as characters; the blank in front delimits the first word, a line feed ends each text.
            hits = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(" " + folded.decode("latin-1"))), np.int64)
            at = np.searchsorted(ends, hits[0::2] - 1)
            crc[at], known[at] = self.crc[hits[1::2]], True
        left = np.flatnonzero(~known)
        if len(left):
            _, one, back, times = np.unique(tb.word_hashes(data, starts[left], ends[left]), return_index=True, return_inverse=True, return_counts=True)
            words = [folded[s:e] for s, e in zip(starts[left[one]].tolist(), ends[left[one]].tolist())]
            crc[left] = np.array([zlib.crc32(w) for w in words], np.uint32)[back]
            if len(self.crc) < self.words and WORTH * int(times[times > 1].sum()) >= len(starts):
                self.learn([words[i] for i in np.flatnonzero(times > 1).tolist()])
        return (crc, ends - starts), first


def _runs(dictionary: Dictionary, data: np.ndarray, offsets: np.ndarray, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each run length: bucket by first word, and the bounds of each text's runs among them; runs over bounds are in between."""
    word, first = dictionary.payloads(data, offsets)
    run = word
    for n in range(1, longest + 1):
        if n > 1:
            blank = np.full(max(0, len(run[0]) - 1), BLANK, np.uint32), np.ones(max(0, len(run[0]) - 1), np.int64)
            run = composed(composed((run[0][:-1], run[1][:-1]), blank), (word[0][n - 1 :], word[1][n - 1 :]))
        last = np.maximum(first[:-1], first[1:] - n + 1)
        yield (run[0] % np.uint32(buckets)).astype(np.int64), first[:-1], last


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): runs of 1 to `longest` words of all texts by bucket; a task hands over one row a bucket at most."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, total = of_worker(__name__, Dictionary), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in tb.slices(batch.column(0)):
                for bucket, begin, end in _runs(dictionary, data, offsets, buckets, longest):
                    inside = np.zeros(len(bucket) + 1, np.int64)
                    some = end > begin
                    np.add.at(inside, begin[some], 1)
                    np.add.at(inside, end[some], -1)
                    total += np.bincount(bucket[np.cumsum(inside[:-1]) > 0], minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.record_batch([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(tasks, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket from its counts (bucket, n), at most `buckets` rows each, in the corpus and in the target."""
    s, t = np.zeros(buckets, dtype=object), np.zeros(buckets, dtype=object)
    for counts, into in ((source, s), (target, t)):
        for row in counts.collect():
            into[row["bucket"]] = row["n"]
    in_all, in_target = float(int(s.sum()) + buckets), float(int(t.sum()) + buckets)
    return np.array([math.floor(1000 * math.log((float(y) + 1) * in_all / ((float(x) + 1) * in_target))) for x, y in zip(s, t)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for each row of `docs` (doc_id, text): the floored mean gain of its runs."""
    buckets = len(gain)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = of_worker(__name__, Dictionary)
        for batch in batches:
            for begin, end, data, offsets in tb.slices(batch.column(1)):
                words = None
                features = total = np.zeros(end - begin, np.int64)
                for bucket, low, high in _runs(dictionary, data, offsets, buckets, longest):
                    before = np.concatenate([[0], np.cumsum(gain[bucket])])
                    inside = high > low
                    features = features + (high - low)
                    total = total + np.where(inside, before[np.where(inside, high, 0)] - before[np.where(inside, low, 0)], 0)
                    words = high - low if words is None else words
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.record_batch([batch.column(0).slice(begin, end - begin), *map(pa.array, (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tasks, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a digest of the seed and the id; a null id counts as no characters."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Rows with their number in `order`, from 1, and their count `_total`. Each range is sorted by itself; a table of one row a
    range has the number of rows before it."""
    place = F.monotonically_increasing_id()
    ranged = settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    ranged = ranged.withColumn("_range", F.shiftrightunsigned("_place", 33))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy()).alias("_total"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(starts), "_range").withColumn(rank, F.col("_before") + inside + 1).drop("_range", "_place", "_before")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of `docs` (columns doc_id, text; others are ignored).

    weight is the floored mean, over the text's runs of 1 to `longest` words, of how much more frequent their buckets are in
    `target` (column text) than in `docs`; score adds noise fixed by the seed and the id. Of the rows with at least
    `least_words` words, `percent` of a hundred are drawn, the highest scores first; ties go to the smaller doc_id, a null id last,
    and among rows of one id to either. rank counts them from 1; other rows have none. A null or wordless text
    has no runs and weight 0. An empty target leaves all gains to the counts of `docs`; empty `docs` give an empty table.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest), buckets)
    scored = weighted(docs, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = settled(scored.withColumn("_row", F.monotonically_increasing_id()))
    enough = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    drawn = F.col("rank") <= F.floor(F.col("_total") * percent / 100)
    named = ["doc_id", "n_features", "weight", "score"]
    above = ranked(scored.where(enough), order, "rank").select(*named, F.when(drawn, F.col("rank")).cast("long").alias("rank"))
    return above.union(scored.where(~enough).select(*named, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The drawn rows of `docs`, all columns. Rows that repeat an id are drawn together; rows without id are not drawn."""
    chosen = resampled(docs, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(chosen, docs["doc_id"] == chosen["_drawn"], "left_semi")
