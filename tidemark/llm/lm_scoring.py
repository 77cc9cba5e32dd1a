"""Language-model scores from a log-frequency Bloom filter of n-gram counts, beside exact unigram scores.

Training texts are counted as word and word-pair hashes. A task sends its counts as one block of keys for each
segment of the hash space, so each segment is merged in one task of bounded size; the number of segments follows
the bytes of the corpus. A segment becomes a Bloom filter that holds (n-gram, level) for every level up to the
n-gram's quantised logarithmic count: a lookup asks for level 1, 2, ... until one is missing.

Filters up to `broadcast_bytes` in all go to the workers as one broadcast. Larger ones stay where they are: the
n-grams of a group of documents are looked up segment by segment, and the answers meet the documents again.
The exact part joins words to their counts; words too frequent to be shuffled come from a table of at most HEAD.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Share of the pair model; the rest is the smoothed word model.
PAIR_SHARE = 0.2
BITS_PER_ENTRY = 8
PROBES = 5
LEVELS = 48
#: Words with counts sent to every task, 16 bytes each; rarer ones are joined.
HEAD = 1 << 19
BROADCAST_BYTES = 96 << 20
SEGMENT_BYTES = 8 << 20
FLUSH_TOKENS = 2_000_000
END = np.uint64(0x9E3779B97F4A7C15)

Lookup = Callable[[int, np.ndarray], np.ndarray]


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, an end behind each text, and the bounds of each text among them."""
    starts, ends, first = tb.word_bounds(data, offsets, tb.NOT_SPACE)
    out = np.insert(tb.word_hashes(data, starts, ends), first[1:], END)
    return out, first + np.arange(len(first))


def pairs_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; a text begins after an end."""
    before = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    before[first[:-1]] = END
    with np.errstate(over="ignore"):
        return tb.mix(before * tb.WINDOW[0] + tokens * tb.WINDOW[1])


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, LEVELS)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level: 0, 1, 2.5, 5.5, 11.5, ..."""
    return np.where(levels > 0, (3.0 * 2.0 ** (levels - 1) - 1) / 2, 0.0)


def _places(keys: np.ndarray, level: int, size: np.ndarray) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        h = tb.mix(keys + np.uint64(level) * tb.WINDOW[2])
        step = tb.mix(h) | np.uint64(1)
        for i in range(PROBES):
            yield ((h + np.uint64(i) * step) % size).astype(np.int64)


def filter_of(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The log-frequency Bloom filter of distinct keys, BITS_PER_ENTRY bits for each (key, level)."""
    levels = level_of(counts)
    bits = np.zeros(max(64, -(-int(levels.sum()) * BITS_PER_ENTRY // 64) * 64), dtype=np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        for at in _places(own, level, np.uint64(len(bits))):
            bits[at] = 1
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Levels of keys in filters that lie one behind the other in one array of bytes."""

    def __init__(self, bits: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.bits, self.start, self.size = bits, start, size

    def levels(self, segment: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        active = np.arange(len(keys))
        for level in range(1, LEVELS + 1):
            if not len(active):
                break
            start, size = self.start[segment[active]], self.size[segment[active]]
            there = np.arange(len(active))
            for at in _places(keys[active], level, size):
                place = start[there] + at[there]
                there = there[(self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]
                if not len(there):
                    break
            active = active[there]
            out[active] = level
        return out


def _segments(hashes: np.ndarray, count: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - 32)).astype(np.int64) * count >> 32


def _key(order: int, hashes: np.ndarray) -> np.ndarray:
    """What a segment knows an n-gram by: the whole hash of a word, the low half of a pair's."""
    return hashes if order == 1 else (hashes & np.uint64(0xFFFFFFFF))


def _blob(order: int, keys: np.ndarray) -> bytes:
    return keys.astype("<u8" if order == 1 else "<u4").tobytes()


def _keys_of(order: int, blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u8" if order == 1 else "<u4").astype(np.uint64)


def _cut(order: int, hashes: np.ndarray, segments: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted hashes by segment: a segment is a range of the hash space."""
    bounds = np.searchsorted(_segments(hashes, segments), np.arange(segments + 1))
    for s in range(segments):
        if bounds[s] < bounds[s + 1]:
            yield s, slice(int(bounds[s]), int(bounds[s + 1]))


def _counted(segments: int):
    schema = pa.schema([("order", pa.int32()), ("segment", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def flushed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        rows = []
        for order, part in enumerate(parts, 1):
            own, counts = np.unique(np.concatenate(part), return_counts=True)
            for s, cut in _cut(order, own, segments):
                rows.append((order, s, _blob(order, _key(order, own[cut])), counts[cut].astype("<u4").tobytes()))
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), schema.types)], schema=schema)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[], []]
        held = 0
        for batch in batches:
            for _, _, data, offsets in tb.slices(batch.column(0)):
                tokens, first = tokens_of(data, offsets)
                parts[0].append(tokens)
                parts[1].append(pairs_of(tokens, first))
                held += len(tokens)
                if held >= FLUSH_TOKENS:
                    yield flushed(parts)
                    parts, held = [[], []], 0
        if held:
            yield flushed(parts)

    return tasks


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    order, segment = int(rows["order"].iloc[0]), int(rows["segment"].iloc[0])
    keys = np.concatenate([_keys_of(order, k) for k in rows["keys"]])
    counts = np.concatenate([np.frombuffer(c, "<u4") for c in rows["counts"]]).astype(np.int64)
    own, back = np.unique(keys, return_inverse=True)
    total = np.bincount(back, weights=counts, minlength=len(own)).astype(np.int64)
    words = order == 1
    return pd.DataFrame({
        "order": [order], "segment": [segment], "bits": [filter_of(own, total)], "types": [len(own)], "tokens": [int(total.sum())],
        "keys": [own.astype("<u8").tobytes() if words else None], "counts": [total.astype("<i8").tobytes() if words else None],
    })


MODEL = "order int, segment int, bits binary, types long, tokens long, keys binary, counts binary"


def train(texts: DataFrame) -> tuple[DataFrame, int]:
    """The model table of the column `text`, one row per order and segment, and the number of segments."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    segments = 1 << max(2, math.ceil(size / SEGMENT_BYTES) - 1).bit_length()
    counts = texts.select("text").mapInArrow(_counted(segments), "order int, segment int, keys binary, counts binary")
    return settled(counts.groupBy("order", "segment").applyInPandas(_merged, MODEL)), segments


def _vocabulary(model: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.record_batch([pa.array(np.frombuffer(keys, "<i8")), pa.array(np.frombuffer(counts, "<i8"))], names=["word", "c"])

    return model.where(F.col("order") == 1).select("keys", "counts").mapInArrow(rows, "word long, c long")


def _head(vocabulary: DataFrame, types: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and counts of the largest count classes that stay within `head` words, by word."""
    least = 0
    if types > head:
        sizes = vocabulary.groupBy(F.floor(F.log2("c")).alias("level")).count().collect()
        taken, least = 0, 63
        for row in sorted(sizes, key=lambda r: -r["level"]):
            taken += row["count"]
            if taken > head:
                break
            least = row["level"]
    rows = vocabulary.where(F.col("c") >= 2**least).toArrow()
    words, counts = rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    order = np.argsort(words)
    return words[order], counts[order]


def _scores(tokens: np.ndarray, first: np.ndarray, look: Lookup, total: int, types: int) -> np.ndarray:
    """log10 of each token's smoothed probability after the one before it."""
    own, back = np.unique(tokens, return_inverse=True)
    count = count_of(look(1, own))
    alone = (count + 0.5) / (total + 0.5 * (types + 1))
    pairs, back2 = np.unique(pairs_of(tokens, first), return_inverse=True)
    both = count_of(look(2, pairs))[back2]
    before = np.concatenate([[0.0], count[back][:-1]])
    end = np.searchsorted(own, END)
    before[first[:-1]] = count[end] if end < len(own) and own[end] == END else 0.0
    share = np.divide(np.minimum(both, before), before, out=np.zeros(len(before)), where=before > 0)
    return np.log10(np.where(before > 0, PAIR_SHARE * share + (1 - PAIR_SHARE) * alone[back], alone[back]))


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first[:-1]) if len(first) > 1 else np.zeros(0)


def _answer(column: pa.Array, look: Lookup, facts: dict) -> Iterator[tuple[int, int, list[pa.Array]]]:
    words, counts, whole = facts["words"], facts["counts"], facts["whole"]
    for begin, end, data, offsets in tb.slices(column):
        tokens, first = tokens_of(data, offsets)
        at = np.minimum(np.searchsorted(words, tokens), max(0, len(words) - 1))
        there = words[at] == tokens if len(words) else np.zeros(len(tokens), dtype=bool)
        c = np.where(there, counts[at], 0) if len(words) else np.zeros(len(tokens))
        settled_here = there | whole
        base = np.where(settled_here, np.log10((c + 0.5) / (facts["tokens"] + 0.5 * (facts["types"] + 1))), 0.0)
        open_ = np.concatenate([[0], np.cumsum(~settled_here)])[first].astype(np.int32)
        rest = pa.ListArray.from_arrays(pa.array(open_), pa.array(tokens[~settled_here].view(np.int64)))
        scores = _scores(tokens, first, look, facts["tokens"], facts["types"])
        yield begin, end, [
            pa.array(np.diff(first), pa.int64()),
            pa.array(_per_text((there & (c > 0)).astype(np.int64), first), pa.int64()),
            pa.array(_per_text(base, first), pa.float64()),
            pa.array(_per_text(scores, first), pa.float64()),
            rest,
        ]


OUT = "n_tokens long, n_known long, base_score double, score double, rest array<long>"
OUT_NAMES = ["n_tokens", "n_known", "base_score", "score", "rest"]


def _by_broadcast(rows: DataFrame, model: DataFrame, segments: int, facts: dict) -> DataFrame:
    sizes = {(r["order"], r["segment"]): r["n"] for r in model.select("order", "segment", F.octet_length("bits").alias("n")).collect()}
    filters = {}
    for order in (1, 2):
        size = np.array([8 * sizes.get((order, s), 8) for s in range(segments)], dtype=np.uint64)
        start = (np.cumsum(size) - size).astype(np.int64)
        filters[order] = (np.zeros(int(size.sum()) // 8, np.uint8), start, size)
    # Segment by segment into one array each: the driver never holds the filter twice.
    for r in model.select("order", "segment", "bits").repartition(32).toLocalIterator():
        bits, start, _ = filters[r["order"]]
        at = int(start[r["segment"]]) // 8
        bits[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    sent = rows.sparkSession.sparkContext.broadcast((filters, facts))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, facts = sent.value
        held = {order: Filter(*f) for order, f in filters.items()}

        def look(order: int, hashes: np.ndarray) -> np.ndarray:
            return held[order].levels(_segments(hashes, segments), _key(order, hashes))

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, end, columns in _answer(batch.column(2), look, facts):
                n = end - begin
                ids = pa.array(np.arange(number, number + n), pa.int64())
                number += n
                yield pa.record_batch([ids, *(batch.column(c).slice(begin, n) for c in (0, 1)), *columns], names=["row", "doc_id", "held_out", *OUT_NAMES])

    return rows.mapInArrow(tasks, f"row long, doc_id long, held_out boolean, {OUT}")


def _by_segments(rows: DataFrame, model: DataFrame, segments: int, facts: dict, group_bytes: int = 4 << 20) -> DataFrame:
    """The same without a broadcast of the filter: lookups travel to the segments and their answers come back."""
    sent = rows.sparkSession.sparkContext.broadcast(facts)
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    groups = max(1, math.ceil(size / group_bytes))
    named = rows.withColumn("row", F.monotonically_increasing_id())
    named = settled(named.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")))

    def asked(rows: pd.DataFrame) -> pd.DataFrame:
        seen: list[list[np.ndarray]] = [[], []]
        for _, _, data, offsets in tb.slices(pa.array(rows["text"], pa.large_string())):
            tokens, first = tokens_of(data, offsets)
            seen[0].append(tokens)
            seen[1].append(pairs_of(tokens, first))
        out = []
        for order, parts in enumerate(seen, 1):
            own = np.unique(np.concatenate(parts))
            out += [(order, s, int(rows["chunk"].iloc[0]), own[cut].tobytes()) for s, cut in _cut(order, own, segments)]
        return pd.DataFrame(out, columns=["order", "segment", "chunk", "hashes"])

    def answered(asks: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asks):
            return pd.DataFrame(columns=["order", "chunk", "hashes", "levels"])
        order = int(asks["order"].iloc[0])
        bits = own["bits"].iloc[0] if len(own) else bytes(8)
        held = Filter(np.frombuffer(bits, np.uint8), np.zeros(1, np.int64), np.array([8 * len(bits)], np.uint64))
        levels = []
        for blob in asks["hashes"]:
            hashes = np.frombuffer(blob, np.uint64)
            levels.append(held.levels(np.zeros(len(hashes), np.int64), _key(order, hashes)).astype(np.uint8).tobytes())
        return asks[["order", "chunk", "hashes"]].assign(levels=levels)

    def scored(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = {}
        for order in (1, 2):
            part = answers[answers["order"] == order]
            hashes = np.frombuffer(b"".join(part["hashes"]), np.uint64)
            by = np.argsort(hashes)
            known[order] = hashes[by], np.frombuffer(b"".join(part["levels"]), np.uint8)[by].astype(np.int64)

        def look(order: int, hashes: np.ndarray) -> np.ndarray:
            return known[order][1][np.searchsorted(known[order][0], hashes)]

        out = [pd.DataFrame({n: c.to_pylist() for n, c in zip(OUT_NAMES, columns)}) for _, _, columns in _answer(pa.array(rows["text"], pa.large_string()), look, sent.value)]
        return pd.concat([rows[["row", "doc_id", "held_out"]].reset_index(drop=True), pd.concat(out, ignore_index=True)], axis=1)

    asks = named.groupBy("chunk").applyInPandas(asked, "order int, segment int, chunk int, hashes binary")
    answers = asks.groupBy("order", "segment").cogroup(model.select("order", "segment", "bits").groupBy("order", "segment")).applyInPandas(answered, "order int, chunk int, hashes binary, levels binary")
    return named.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(scored, f"row long, doc_id long, held_out boolean, {OUT}")


def score(docs: DataFrame, held_out: Column, head: int = HEAD, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs` (doc_id, text).

    The model learns from the rows where `held_out` is false. Tokens are the words with A-Z lower-cased, then one
    end. base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))) over exact counts; score is the log10 probability
    under the filter's quantised counts, pairs mixed with words. A null or empty text is its end alone. A null
    doc_id stays null and counts as training unless `held_out` says otherwise; rows that repeat are counted and
    scored each. Without training rows every count is 0. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    model, segments = train(rows.where("NOT held_out"))
    sums = model.groupBy("order").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), F.sum(F.octet_length("bits")).alias("bytes"))
    sums = {r["order"]: r for r in sums.collect()}
    total, types = (sums[1]["tokens"], sums[1]["types"]) if sums else (0, 0)
    vocabulary = _vocabulary(model)
    words, counts = _head(vocabulary, types, head)
    facts = {"words": words, "counts": counts, "whole": len(words) == types, "tokens": total, "types": types}
    small = sum(r["bytes"] for r in sums.values()) <= broadcast_bytes
    found = (_by_broadcast if small else _by_segments)(rows, model, segments, facts)
    per_doc = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"]
    if facts["whole"]:
        return found.select(*per_doc)
    found = settled(found)
    rest = found.select("row", F.explode("rest").alias("word")).join(vocabulary, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = rest.groupBy("row").agg(F.sum(F.log10((c + 0.5) / (total + 0.5 * (types + 1)))).alias("_base"), F.count("c").alias("_known"))
    found = found.join(rest, "row", "left").withColumns({
        "n_known": F.col("n_known") + F.coalesce("_known", F.lit(0)),
        "base_score": F.col("base_score") + F.coalesce("_base", F.lit(0.0)),
    })
    return found.select(*per_doc)
