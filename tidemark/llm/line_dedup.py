"""Lines that many documents share: kept in one document, dropped in the others, told by bitmaps.

Line keys are hashed, and (hash, document, position) is partitioned by range and sorted, larger documents
first, so a task streams over the lines of a key and meets first the document that keeps them. A frequent key
is cut by document over as many tasks as its rows fill. What a task cannot settle alone are the first and the
last key it sees; of those it reports counts, at most two rows a task, which settle the few rows left open.
Text does not travel with the lines: the result is a compressed bitmap for each document that loses lines.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType

from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_CHARS = 40
LEAST_DOCS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
#: Rows without doc_id count as one document, smaller than all others.
NO_ID = -(2**63)
DROP, OPEN, TALLY = 0, 1, 2
ROWS = ["h1", "h2", "doc", "print", "pos"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, doc, print, pos) of every line whose key is long enough; print tells texts of one doc_id apart."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("print"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"),
    )
    rows = rows.where(F.octet_length("line") >= least_chars).withColumn("key", F.translate(F.trim(F.col("line"), F.lit(SPACE)), UPPER, LOWER))
    rows = rows.where(F.char_length("key") >= least_chars)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "print", "pos")


class _Run:
    """The rows of one key in one task so far; rows wait only until enough documents are known."""

    def __init__(self, h1: int, h2: int, first: bool) -> None:
        self.h1, self.h2, self.first = h1, h2, first
        self.docs, self.top, self.doc = 0, 0, None
        self.waiting: list[tuple[np.ndarray, ...]] = []

    def add(self, doc: np.ndarray, mark: np.ndarray, pos: np.ndarray, least: int) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        rank = self.docs + np.cumsum(np.concatenate([[doc[0] != self.doc or self.docs == 0], doc[1:] != doc[:-1]]))
        if self.docs == 0:
            self.top = int(doc[0])
        self.docs, self.doc = int(rank[-1]), int(doc[-1])
        self.waiting.append((rank, doc, mark, pos))
        if self.docs >= least:
            for rank, *row in self.waiting:
                yield DROP, tuple(c[rank > 1] for c in row)
                if self.first:
                    yield OPEN, tuple(c[rank == 1] for c in row)
            self.waiting = []

    def close(self, last: bool) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        if self.first or last:
            for _, *row in self.waiting:
                yield OPEN, tuple(row)
            yield TALLY, (np.array([self.top]), np.array([0]), np.array([self.docs]))


def _stream(least: int):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: _Run | None = None

        def told(of: _Run, parts) -> Iterator[pa.RecordBatch]:
            for state, (doc, mark, pos) in parts:
                if len(doc):
                    n = len(doc)
                    columns = [np.full(n, of.h1), np.full(n, of.h2), doc, mark, pos.astype(np.int32), np.full(n, state, np.int32)]
                    yield pa.record_batch([pa.array(c) for c in columns], names=[*ROWS, "state"])

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, doc, mark, pos = (batch.column(c).to_numpy() for c in range(5))
            edges = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(h1)]])
            # A key that begins and ends inside the batch with too few rows is neither frequent nor at an edge.
            long = (ends - starts >= least) | (starts == 0) | (ends == len(h1))
            for s, e in zip(starts[long].tolist(), ends[long].tolist()):
                if run is None or (run.h1, run.h2) != (h1[s], h2[s]):
                    if run is not None:
                        yield from told(run, run.close(last=False))
                    run = _Run(int(h1[s]), int(h2[s]), first=run is None)
                yield from told(run, run.add(doc[s:e], mark[s:e], pos[s:e], least))
        if run is not None:
            yield from told(run, run.close(last=True))

    return tasks


@F.pandas_udf(BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    def one(dropped: np.ndarray) -> bytes:
        keep = np.ones(int(dropped.max()) + 1, dtype=bool)
        keep[dropped] = False
        return zlib.compress(len(keep).to_bytes(8, "little") + np.packbits(keep).tobytes())

    return positions.map(lambda p: one(np.asarray(p)))


@F.pandas_udf(ArrayType(BooleanType()))
def bitmap_lines(bitmaps: pd.Series) -> pd.Series:
    """Keep or drop for each line up to the last dropped one; the lines behind it are kept."""

    def one(packed: bytes) -> np.ndarray:
        raw = zlib.decompress(packed)
        return np.unpackbits(np.frombuffer(raw[8:], np.uint8), count=int.from_bytes(raw[:8], "little")).astype(bool)

    return bitmaps.map(one)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc, print, bitmap) for each document that loses lines.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least `least_chars`
    code points found in at least `least_docs` documents stay only in the largest doc_id that holds them, there
    in all their lines. Rows of one doc_id are one document; `print` (a hash of the text) tells them apart.
    """
    keys = line_keys(docs, least_chars)
    order = ["h1", "h2", F.desc("doc")]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order, "print", "pos")
    names = "h1 long, h2 long, doc long, print long, pos int, state int"
    told = settled(ranged.mapInArrow(_stream(least_docs), names))
    tally = told.where(F.col("state") == TALLY).groupBy("h1", "h2").agg(F.sum("pos").alias("docs"), F.max("doc").alias("top"))
    # At most two rows for each task of the streamed stage.
    opened = told.where(F.col("state") == OPEN).join(F.broadcast(tally), ["h1", "h2"]).where((F.col("docs") >= least_docs) & (F.col("doc") != F.col("top")))
    dropped = told.where(F.col("state") == DROP).select("doc", "print", "pos").union(opened.select("doc", "print", "pos"))
    return dropped.groupBy("doc", "print").agg(_sorted_set("pos").alias("_p")).select("doc", "print", _bitmap("_p").alias("bitmap"))


def _sorted_set(column: str) -> Column:
    return F.array_sort(F.collect_set(column))


def without_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of `docs` with all columns, `text` cut to its kept lines, and `n_lines`, `n_dropped` (long).

    A null or empty text is one empty line; a null text stays null, a text that loses all its lines becomes
    empty. An empty table stays empty. Columns named n_lines or n_dropped are replaced.
    """
    doc, mark, keep = (_free(docs, name) for name in ("_doc", "_print", "_keep"))
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), least_chars, least_docs)
    bitmaps = bitmaps.select(F.col("doc").alias(doc), F.col("print").alias(mark), bitmap_lines("bitmap").alias(keep))
    # Spark takes an unpacked bitmap for one value; its lines are as many as the text has.
    bitmaps = bitmaps.hint("merge")
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == bitmaps[doc]) & (F.xxhash64(docs["text"]) == bitmaps[mark])
    rows = docs.join(bitmaps, same, "left")
    kept = F.filter(_lines(F.col("text")), lambda line, i: F.coalesce(F.get(F.col(keep), i), F.lit(True)))
    dropped = F.coalesce(F.size(F.filter(keep, lambda k: ~k)), F.lit(0))
    rows = rows.withColumns({
        "n_lines": F.size(_lines(F.col("text"))).cast("long"),
        "n_dropped": F.when(F.col(keep).isNull(), 0).otherwise(dropped).cast("long"),
        "text": F.when(F.col(keep).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
    })
    return rows.drop(doc, mark, keep)


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
