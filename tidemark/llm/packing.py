"""Token packing: documents as token ids, cut into pieces and laid into near-equal windows by differencing.

A task tokenizes its rows in their order and packs them block by block, so no row is shuffled and a block of
WINDOWS windows is all that is held. Texts longer than a window fill whole windows first; what is left of each
is packed by the multiway differencing method of Karmarkar and Karp: the two partial partitions with the
largest imbalance are merged, the fullest part of one onto the emptiest of the other, until one is left. What
a window then has over the capacity is cut off and moved to the emptiest window; where that does not hold, the
block gets one window more and is partitioned again.
"""

from __future__ import annotations

import heapq
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
WINDOWS = 64
END_ID = 2
#: Words whose ids a worker remembers before it starts anew.
REMEMBERED = 1 << 18
#: 1 for ASCII letters, 2 for what ends clauses; neighbours that add up to 3 belong to two parts.
KIND = np.full(256, 4, dtype=np.uint8)
KIND[65:91] = KIND[97:123] = 1
KIND[[44, 46]] = 2
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], parts: int) -> list[int]:
    """The part of each item, by the largest differencing method for `parts` parts; ties go to the earlier item."""
    if not sizes:
        return []
    # A partial partition: sums in falling order with the items behind each; entries beyond its length are empty.
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for i, size in enumerate(sizes):
        heapq.heappush(heap, (-(size if parts > 1 else 0), i, [(size, [i])]))
    while len(heap) > 1:
        _, i, first = heapq.heappop(heap)
        _, j, second = heapq.heappop(heap)
        a = first + [(0, [])] * (parts - len(first))
        b = second + [(0, [])] * (parts - len(second))
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b)) if x[1] or y[1]]
        merged.sort(key=lambda p: -p[0])
        low = merged[-1][0] if len(merged) == parts else 0
        heapq.heappush(heap, (low - merged[0][0], min(i, j), merged))
    out = [0] * len(sizes)
    for part, (_, items) in enumerate(heap[0][2]):
        for i in items:
            out[i] = part
    return out


def packed(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length), in the fewest windows from ceil(total / capacity) on that keep the capacity.

    A window that differencing leaves over the capacity is cut once: the tail of its largest item goes to the
    emptiest window. Where that window has no room for it, the number of windows rises by one.
    """
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        windows: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
        for item, part in enumerate(differencing(sizes, count)):
            windows[part].append((item, 0, sizes[item]))
        totals = [sum(length for _, _, length in w) for w in windows]
        room = [(total, w) for w, total in enumerate(totals) if total < capacity]
        heapq.heapify(room)
        for w in sorted((w for w in range(count) if totals[w] > capacity), key=lambda w: -totals[w]):
            over = totals[w] - capacity
            total, other = heapq.heappop(room) if room else (capacity, -1)
            at = max(range(len(windows[w])), key=lambda i: windows[w][i][2])
            item, start, length = windows[w][at]
            if total + over > capacity or length <= over:
                break
            windows[w][at] = (item, start, length - over)
            windows[other].append((item, start + length - over, over))
            if total + over < capacity:
                heapq.heappush(room, (total + over, other))
        else:
            return [w for w in windows if w]
        count += 1


class Encoder:
    """Ids of texts from the ids of their parts: what the tokenizer never joins is tokenized once and remembered.

    Parts are bounded by white space, and by a change between ASCII letters and full stops or commas. A part is
    known by its 64-bit hash with A-Z lower-cased, as the tokenizer lower-cases; a part with the first two bytes of an
    added token by its hash as it is, since those tokens are looked for before that.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if not t.normalized]
        self.opens = sorted({(t[0], t[1] if len(t) > 1 else -1) for t in added})
        self.forget()

    @staticmethod
    def of_worker(path: str) -> Encoder:
        """The encoder of this Python worker: it outlives a task, so later tasks find its words known."""
        state = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders"))
        if path not in vars(state):
            vars(state)[path] = Encoder(path)
        return vars(state)[path]

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.array([i for ids in lists for i in ids], np.uint32), counts

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters only, tokenized as texts of many words: the last id of each word closes it."""
        texts = [" ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.closes[flat]) + 1
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(words) and ends[-1] == len(flat) else self._one_by_one(words)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.fromiter((w.isalpha() for w in words), bool, len(words))
        for own, encode in ((np.flatnonzero(plain), self._together), (np.flatnonzero(~plain), self._one_by_one)):
            if len(own):
                flat, counts = encode([words[i] for i in own.tolist()])
                at = np.searchsorted(self.known, hashes[own])
                self.known = np.insert(self.known, at, hashes[own])
                self.starts = np.insert(self.starts, at, len(self.ids) + np.cumsum(counts) - counts)
                self.sizes = np.insert(self.sizes, at, counts)
                self.ids = np.concatenate([self.ids, flat])

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = tb.word_hashes(data, starts, ends)
        at = [np.flatnonzero(data == a) if b < 0 else np.flatnonzero((data[:-1] == a) & (data[1:] == b)) for a, b in self.opens]
        exact = np.unique(np.searchsorted(starts, np.concatenate(at), "right") - 1) if at else np.zeros(0, np.int64)
        if len(exact):
            sizes = ends[exact] - starts[exact]
            stop = np.cumsum(sizes)
            own = data[np.repeat(starts[exact] - stop + sizes, sizes) + np.arange(int(stop[-1]))]
            hashes[exact] = tb.word_hashes(own, stop - sizes, stop, fold=False)
        return hashes

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of the column, END_ID behind them."""
        for begin, end, data, offsets in tb.slices(column):
            starts, ends, first = _parts(data, offsets)
            hashes = self._hashes(data, starts, ends)
            own, one, back = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) > REMEMBERED:
                self.forget()
            at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
            fresh = self.known[at] != own if len(self.known) else np.ones(len(own), dtype=bool)
            if fresh.any():
                raw = data.tobytes()
                self.learn(own[fresh], [raw[x:y].decode() for x, y in zip(starts[one[fresh]].tolist(), ends[one[fresh]].tolist())])
                at = np.searchsorted(self.known, own)
            start, size = self.starts[at][back], self.sizes[at][back]
            stop = np.cumsum(size)
            ids = self.ids[np.repeat(start - stop + size, size) + np.arange(int(size.sum()))]
            bound = np.concatenate([[0], stop])[first]
            for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
                yield np.append(ids[a:b], np.uint32(END_ID))


def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, _ = tb.word_bounds(data, offsets, tb.NOT_SPACE)
    kind = KIND[data]
    cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
    starts, ends = (np.sort(np.concatenate([bounds, cuts])) for bounds in (starts, ends))
    return starts, ends, np.searchsorted(starts, offsets, "left")


def _blocks(rows: Iterator[tuple[int | None, np.ndarray]], capacity: int, windows: int) -> Iterator[tuple[list, list]]:
    """Pieces (doc_id, start, ids, doc_tokens) block by block: those that fill a window, and those to be packed.

    The piece at which a block is full is cut, and goes on in the next block. A 256th of the capacity is left
    to even out windows.
    """
    limit = windows * (capacity - capacity // 256)
    full, rest, held = [], [], 0
    for doc_id, ids in rows:
        n, s = len(ids), 0
        while s < n:
            size = min(capacity, n - s)
            if size == capacity:
                full.append((doc_id, s, ids[s : s + size], n))
            else:
                size = min(size, limit - held)
                rest.append((doc_id, s, ids[s : s + size], n))
                held += size
            s += size
            if held >= limit:
                yield full, rest
                full, rest, held = [], [], 0
            elif len(full) >= windows:
                yield full, []
                full = []
    if full or rest:
        yield full, rest


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, windows: int = WINDOWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    `docs` has doc_id (null allowed) and text; `tokenizer` is the path of a tokenizers file that every worker
    can open. A null or empty text is its end id alone; rows that repeat a doc_id are packed each; other columns
    are ignored. Pieces of a sequence lie in the order of the input, without gaps, from offset 0. sequence_id is
    made of the partition and a running number, so it is unique in a run and the same when a task is run again.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(tokenizer)
        number = TaskContext.get().partitionId() << 40

        def rows() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)))

        for full, rest in _blocks(rows(), capacity, windows):
            out = []
            used = 0
            for used, window in enumerate(packed([len(p[2]) for p in rest], capacity) if rest else [], 1):
                offset = 0
                for item, start, length in window:
                    doc_id, before, ids, n = rest[item]
                    out.append(((doc_id, before + start, ids[start : start + length], n), number + used - 1, offset))
                    offset += length
            out += [(piece, number + used + i, 0) for i, piece in enumerate(full)]
            number += used + len(full)
            columns = [
                pa.array([p[0] for p, _, _ in out], pa.int64()),
                pa.array([p[1] for p, _, _ in out], pa.int64()),
                pa.array([len(p[2]) for p, _, _ in out], pa.int64()),
                pa.array([p[2].astype("<u4").tobytes() for p, _, _ in out], pa.binary()),
                pa.array([p[3] for p, _, _ in out], pa.int64()),
                pa.array([s for _, s, _ in out], pa.int64()),
                pa.array([o for _, _, o in out], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tasks, SCHEMA)
