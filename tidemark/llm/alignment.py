"""Cross-tokenizer alignment: two tokenizations of one byte stream, cut into groups where tokens of both end.

The stream of a text is one blank and the text. A byte range of it yields a fragment: an open prefix (the tokens up to
the first common end, whose group may have begun earlier), closed groups, and an open suffix (the tokens behind the last
common end). Fragments form a monoid: where two meet, the left one's suffix and the right one's prefix close a
group; a fragment without a common end is a prefix only. Short texts are one range and closed as they are. Longer texts
are cut into segments, tokenized by any task, and into byte ranges of a fixed size; levels of tasks
compose FAN neighbours each until one fragment is left. Closed groups stay where they arose; only open ends
travel up.

How many documents hold a pair of ids linked is summed over slices of the corpus. A slice asks once for each of its
distinct pairs, whatever their number of occurrences, and gets counts back; tokens are not made twice, and a frequent
pair is one row a slice.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.worker import of_worker
from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a range; longer texts are spread over tasks.
CHUNK = 1 << 16
#: Neighbours composed by one task of a level.
FAN = 16
#: Bytes of text from which on texts ask for their pairs together: a slice is a row of several times its text, in tasks of the JVM and in workers.
SLICE = 1 << 19
#: Slices, and byte ranges or segments, of a file: as many are held at once by what writes or reads it.
SLICES_A_FILE, RANGES_A_FILE = 8, 128
#: Units a worker remembers before it starts anew.
REMEMBERED = 1 << 19
#: Groups with more links are counted by their distinct ids.
LARGE = 256
#: Pairs of one large group made at a time.
PAIRS = 1 << 20
BLANK, NONE = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())

_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[33:127] = True
#: First bytes beyond ASCII of characters none of which is white space.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[0xC3:] = True
_LEAD[[0xE1, 0xE2, 0xE3]] = False


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of single blanks between two characters that are surely no white space.

    No token of either tokenizer crosses such a place: the one splits texts there before it merges, and the other has no
    piece with a blank behind another character.
    """
    at = np.flatnonzero(data[1:-1] == 32) + 1
    back = [data[np.maximum(at - k, 0)] for k in (1, 2, 3)]
    lead = np.where(back[1] >= 0xC0, back[1], np.where(back[2] >= 0xC0, back[2], 0xF0))
    before = _GRAPHIC[back[0]] | ((back[0] >= 0x80) & _LEAD[lead])
    behind = _GRAPHIC[data[at + 1]] | _LEAD[data[at + 1]]
    return at[before & behind]


@dataclass
class Side:
    """Ids of one tokenizer for all remembered units."""

    lengths: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def learn(self, at: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        self.start = np.insert(self.start, at, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.ids = np.concatenate([self.ids, ids])

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and where each ends in bytes."""
        size = self.size[units]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[units] - stop + size, size) + np.arange(int(size.sum()))]
        return ids, np.cumsum(self.lengths[ids])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for ids in lists for i in ids], np.int32), np.fromiter(map(len, lists), np.int64, len(lists))


def _between_cuts(unit: bytes) -> bool:
    """Whether a unit begins and ends with characters that are surely no white space, its first blank aside."""
    if len(unit) < 2 or not (_GRAPHIC[unit[1]] or _LEAD[unit[1]]):
        return False
    if unit[-1] < 0x80:
        return bool(_GRAPHIC[unit[-1]])
    return bool(_LEAD[unit[-2] if unit[-2] >= 0xC0 else unit[-3] if unit[-3] >= 0xE0 else 0xF0])


class Tokenizers:
    """Both tokenizers of a worker: units between cuts are tokenized once and remembered by a 64-bit hash."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        # The byte-level alphabet in the order of its characters stands for the printable bytes, then for the others.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in set(printable)]
        letters = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(others)}
        assert set(letters) == set(ByteLevel.alphabet())
        tokens = sorted((i, t) for t, i in self.a.get_vocab().items())
        self.bytes_a = {i: bytes(letters[c] for c in t) if set(t) <= set(letters) else t.encode() for i, t in tokens}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        #: Whether cuts are safe for the pieces at hand; else a text is one unit.
        self.cuttable = not any(" " in x.decode(errors="replace").lstrip(" ") for i, x in self.bytes_b.items() if not self.b.is_byte(i))
        self.forget()

    def forget(self) -> None:
        self.known, self.good = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.sides = [Side(np.array([len(own[i]) for i in range(max(own) + 1)], np.int64)) for own in (self.bytes_a, self.bytes_b)]

    def _alone(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.a.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)])

    def _together(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units that may follow one another with a cut between them, tokenized as texts of many units."""
        texts = [b"".join(units[i : i + 256]).decode() for i in range(0, len(units), 256)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        ends, wanted = np.cumsum(self.sides[0].lengths[ids]), np.cumsum([len(u) for u in units])
        at = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
        return (ids, np.diff(at + 1, prepend=0)) if np.array_equal(ends[at], wanted) and at[-1] == len(ends) - 1 else self._alone(units)

    def learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        followed = np.fromiter(map(_between_cuts, units), bool, len(units))
        for own, encode in ((np.flatnonzero(followed & self.cuttable), self._together), (np.flatnonzero(~(followed & self.cuttable)), self._alone)):
            if len(own):
                part = [units[i] for i in own.tolist()]
                a, b = encode(part), _flat(self.b.encode([u[1:].decode() for u in part], num_threads=1))
                at = np.searchsorted(self.known, hashes[own])
                good = self._spelled(part, self.bytes_a, *a) & self._spelled(part, self.bytes_b, *b)
                self.known, self.good = np.insert(self.known, at, hashes[own]), np.insert(self.good, at, good)
                for side, (ids, size) in zip(self.sides, (a, b)):
                    side.learn(at, ids, size)

    @staticmethod
    def _spelled(units: list[bytes], spelling: dict[int, bytes], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the tokens of each unit spell it; all units are compared at once where all of them agree."""
        parts = [spelling[i] for i in ids.tolist()]
        ends = np.cumsum(size)
        lengths = np.cumsum([0, *map(len, parts)])[np.concatenate([[0], ends])]
        if np.array_equal(np.diff(lengths), [len(u) for u in units]) and b"".join(parts) == b"".join(units):
            return np.ones(len(units), dtype=bool)
        return np.array([b"".join(parts[e - n : e]) == u for u, e, n in zip(units, ends.tolist(), size.tolist())], dtype=bool)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of each stream, and for each stream the number of units before it; a line feed ends each."""
        starts = np.unique(np.concatenate([offsets[:-1], cuts(data) if self.cuttable else offsets[:0]]))
        ends = np.concatenate([starts[1:], offsets[-1:]])
        first = np.searchsorted(starts, offsets)
        ends[first[1:] - 1] -= 1
        hashes = tb.word_hashes(data, starts, ends, fold=False)
        own, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        fresh = self.known[at] != own if len(self.known) else np.ones(len(own), dtype=bool)
        if fresh.any():
            raw = data.tobytes()
            self.learn(own[fresh], [raw[x:y] for x, y in zip(starts[one[fresh]].tolist(), ends[one[fresh]].tolist())])
            at = np.searchsorted(self.known, own)
        return at[back], first


def _digits(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below `ids`, a place for a separator behind them, and which places are used."""
    powers = 10 ** np.arange(len(str(ids)) - 1, -1, -1)
    numbers = np.arange(ids)[:, None]
    shown = np.concatenate([numbers // powers % 10 + 48, np.zeros((ids, 1), np.int64)], axis=1).astype(np.uint8)
    used = np.concatenate([numbers >= powers, np.ones((ids, 1), bool)], axis=1)
    used[0, -2] = True
    return shown, used


class Groups:
    """Groups of two token streams over the same bytes, from ids and ends; what is behind the last common end is left out."""

    def __init__(self, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> None:
        self.ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last = self.ends[-1] if len(self.ends) else 0
        self.a, self.b = a[ends_a <= last], b[ends_b <= last]
        self.of_a, self.of_b = (np.searchsorted(self.ends, e[e <= last]) for e in (ends_a, ends_b))
        self.n_a, self.n_b = (np.bincount(g, minlength=len(self.ends)) for g in (self.of_a, self.of_b))
        self.first_a, self.first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b

    def links(self, pieces: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(group, pair, times) of all links; a pair is its id of the first tokenizer times `pieces` plus that of the second."""
        many = self.n_a * self.n_b > LARGE
        few = np.flatnonzero(~many[self.of_a])
        group = self.of_a[few]
        times = self.n_b[group]
        total = int(times.sum())
        partner = np.repeat(self.first_b[group] - np.cumsum(times) + times, times) + np.arange(total)
        yield np.repeat(group, times), np.repeat(self.a[few].astype(np.int64), times) * pieces + self.b[partner], np.ones(total, np.int64)
        for g in np.flatnonzero(many).tolist():
            a, of_a = np.unique(self.a[self.first_a[g] : self.first_a[g] + self.n_a[g]], return_counts=True)
            b, of_b = np.unique(self.b[self.first_b[g] : self.first_b[g] + self.n_b[g]], return_counts=True)
            step = max(1, PAIRS // len(b))
            for s in range(0, len(a), step):
                pairs = a[s : s + step, None].astype(np.int64) * pieces + b
                yield np.full(pairs.size, g), pairs.ravel(), np.outer(of_a[s : s + step], of_b).ravel()

    def text(self, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of `a1,a2|b1;` for each group, and where each group ends in them."""
        place_a = np.arange(len(self.a)) + self.first_b[self.of_a]
        place_b = np.arange(len(self.b)) + (self.first_a + self.n_a)[self.of_b]
        ids, behind = np.zeros(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        ends = np.cumsum(self.n_a + self.n_b)
        behind[ends - self.n_b - 1], behind[ends - 1] = ord("|"), ord(";")
        shown, used = digits[0][ids], digits[1][ids]
        shown[:, -1] = behind
        return shown[used], np.cumsum(used.sum(axis=1))[ends - 1] if len(ends) else ends


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their sums."""
    key, time = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key)
    key, time = key[order], time[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(time, first) if len(first) else time


SLICES = (
    "slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "entries array<long>, entry array<int>, times array<long>, pairs array<long>, docs array<int>"
)
SLICE_COLUMNS = [c.split()[0] for c in SLICES.split(", ")]
FRAGMENT = "row long, idx long, closed boolean, first long, a array<int>, b array<int>, a_open array<int>, b_open array<int>"
CLOSED = "row long, at long, place int, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


@dataclass
class Fragment:
    """Open ends of a byte range; without a common end all its tokens are the prefix. `first` is the range of its first common end."""

    closed: bool
    first: int
    a: np.ndarray
    b: np.ndarray
    a_open: np.ndarray
    b_open: np.ndarray


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, np.ndarray, np.ndarray] | None]:
    """The fragment of two neighbours, and the group closed between them: its place and its ids; associative."""
    join = np.concatenate
    if not x.closed:
        return Fragment(y.closed, y.first, join([x.a, y.a]), join([x.b, y.b]), y.a_open, y.b_open), None
    if not y.closed:
        return Fragment(True, x.first, x.a, x.b, join([x.a_open, y.a]), join([x.b_open, y.b])), None
    return Fragment(True, x.first, x.a, x.b, y.a_open, y.b_open), (y.first, join([x.a_open, y.a]), join([x.b_open, y.b]))


class Aligner:
    """The tasks of one alignment; goes to the workers without the tokenizers, which they open by path."""

    def __init__(self, path_a: str, path_b: str, chunk: int, slice_bytes: int, digest: bool) -> None:
        self.path_a, self.path_b, self.chunk, self.slice_bytes, self.digest = path_a, path_b, chunk, slice_bytes, digest

    def opened(self) -> Tokenizers:
        self.tokenizers: Tokenizers = of_worker(f"{__name__} {self.path_a} {self.path_b}", lambda: Tokenizers(self.path_a, self.path_b))
        self.pieces = len(self.tokenizers.bytes_b)
        self.digits = of_worker(f"{__name__} digits", lambda: _digits(max(len(self.tokenizers.bytes_a), self.pieces)))
        return self.tokenizers

    @staticmethod
    def streams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return tb.slices(pc.binary_join_element_wise(BLANK, pc.fill_null(column.cast(pa.large_string()), ""), NONE))

    def shown(self, raw: bytes) -> str:
        return hashlib.sha256(raw).hexdigest() if self.digest and raw else raw.decode()

    def short(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of whole texts."""
        self.opened()
        number, size = TaskContext.get().partitionId() << 40, 0
        rows: list[dict] = []
        for batch in batches:
            for begin, end, data, offsets in self.streams(batch.column(1)):
                rows.append(self._texts(batch.column(0).slice(begin, end - begin).to_pylist(), data, offsets))
                size += len(data)
                if size >= self.slice_bytes:
                    yield self._slice(number, rows)
                    number, size, rows = number + 1, 0, []
        if rows:
            yield self._slice(number, rows)

    def _texts(self, doc_ids: list, data: np.ndarray, offsets: np.ndarray) -> dict:
        units, first = self.tokenizers.units(data, offsets)
        bad = np.add.reduceat(~self.tokenizers.good[units], first[:-1]) > 0
        lengths = np.diff(offsets) - 1
        own = np.flatnonzero(~bad & (lengths > 1))
        units = units[np.repeat(~bad & (lengths > 1), np.diff(first))]
        (a, ends_a), (b, ends_b) = (side.of(units) for side in self.tokenizers.sides)
        groups = Groups(a, ends_a, b, ends_b)
        ends = np.cumsum(lengths[own])
        text = np.searchsorted(ends, groups.ends)
        keys, times = [], []
        for g, pair, n in groups.links(self.pieces):
            keys.append(text[g] * (1 << 32) + pair)
            times.append(n)
        key, n = _summed(keys, times)
        raw, stop = groups.text(self.digits)
        stop = np.concatenate([[0], stop[np.searchsorted(groups.ends, ends)] if len(own) else []]).astype(np.int64)
        raw = raw.tobytes()
        shown = [""] * len(doc_ids)
        for i, s, e in zip(own.tolist(), stop[:-1].tolist(), stop[1:].tolist()):
            shown[i] = self.shown(raw[s : e - 1])

        def of_all(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(doc_ids), np.int64)
            out[own] = values
            return out

        count = lambda e: np.diff(np.searchsorted(e, ends, "right"), prepend=0)
        n_links = np.bincount(text, groups.n_a * groups.n_b, len(own)).astype(np.int64)
        return {
            "doc_id": doc_ids,
            "n_a": of_all(count(ends_a)),
            "n_b": of_all(count(ends_b)),
            "n_groups": of_all(count(groups.ends)),
            "n_links": of_all(n_links),
            "groups": shown,
            "entries": of_all(np.bincount(key >> 32, minlength=len(own))),
            "pair": key & ((1 << 32) - 1),
            "times": n,
        }

    @staticmethod
    def _slice(number: int, rows: list[dict]) -> pa.RecordBatch:
        joined = {c: np.concatenate([r[c] for r in rows]) for c in rows[0] if c not in ("doc_id", "groups")}
        pairs, entry, docs = np.unique(joined.pop("pair"), return_inverse=True, return_counts=True)
        lists = {c: [x for r in rows for x in r[c]] for c in ("doc_id", "groups")}
        values = {"slice": number, **lists, **joined, "entry": entry.astype(np.int32), "pairs": pairs, "docs": docs.astype(np.int32)}
        kinds = {"doc_id": pa.int64(), "groups": pa.string()}
        arrays = [pa.array([values[c]], pa.int64()) if c == "slice" else _listed([pa.array(values[c], kinds.get(c))]) for c in SLICE_COLUMNS]
        return pa.record_batch(arrays, names=SLICE_COLUMNS)

    def segments(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, doc_id, start, last, text) of each text: parts of at least `chunk` bytes from cut to cut, each without its blank."""
        cuttable = self.opened().cuttable
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = f" {text.as_py()}".encode()
                at = cuts(np.frombuffer(raw, np.uint8)) if cuttable else np.zeros(0, np.int64)
                starts = [0]
                while (n := int(np.searchsorted(at, starts[-1] + self.chunk))) < len(at):
                    starts.append(int(at[n]))
                for s, e in zip(starts, [*starts[1:], len(raw)]):
                    columns = [pa.array([row]), doc_id.as_py(), pa.array([s]), pa.array([len(raw) - 1]), pa.array([raw[s + 1 : e].decode()])]
                    columns[1] = pa.array([columns[1]], pa.int64())
                    yield pa.record_batch(columns, names=["row", "doc_id", "start", "last", "text"])
                row += 1

    def fragments(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The byte ranges of segments: their open ends, their closed groups, and whether bytes and tokens agree."""
        self.opened()
        for batch in batches:
            for begin, end, data, offsets in self.streams(batch.column(batch.schema.get_field_index("text"))):
                units, first = self.tokenizers.units(data, offsets)
                for i in range(end - begin):
                    row, doc_id, start = (batch.column(c)[begin + i].as_py() for c in range(3))
                    own = units[first[i] : first[i + 1]]
                    for found in self._ranges(own, start):
                        columns = [[row], [doc_id], *([x] for x in found)]
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, _FRAGMENT_KINDS)], names=_FRAGMENT_NAMES)

    def _ranges(self, units: np.ndarray, start: int) -> Iterator[tuple]:
        if not self.tokenizers.good[units].all():
            yield (2 * (start // self.chunk), False, 0, 0, False, 0, [], [], [], [], 0, 0, "", [], [])
            return
        (a, ends_a), (b, ends_b) = (side.of(units) for side in self.tokenizers.sides)
        ends_a, ends_b = ends_a + start, ends_b + start
        for k in np.unique((np.concatenate([ends_a, ends_b]) - 1) // self.chunk).tolist():
            # A range in which a segment begins may have tokens of an earlier segment: those come first.
            idx = 2 * k + int(start // self.chunk == k and start > 0)
            low_a, high_a = np.searchsorted(ends_a, [k * self.chunk, (k + 1) * self.chunk], "right")
            low_b, high_b = np.searchsorted(ends_b, [k * self.chunk, (k + 1) * self.chunk], "right")
            f, groups = split(a[low_a:high_a], ends_a[low_a:high_a], b[low_b:high_b], ends_b[low_b:high_b], idx)
            n_links, text, pairs, times = self.described(groups)
            yield (idx, True, high_a - low_a, high_b - low_b, f.closed, f.first, f.a, f.b, f.a_open, f.b_open, len(groups.ends), n_links, text, pairs, times)

    def described(self, groups: Groups) -> tuple[int, str, np.ndarray, np.ndarray]:
        found = list(groups.links(self.pieces))
        pairs, times = _summed([p for _, p, _ in found], [n for _, _, n in found])
        return int((groups.n_a * groups.n_b).sum()), groups.text(self.digits)[0].tobytes()[:-1].decode(), pairs, times

    def bridges(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups closed between ranges, given by their ids, as closed groups of place 0."""
        self.opened()
        names = [c.split()[0] for c in CLOSED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            for row, at, a, b in zip(*(batch.column(c) for c in range(4))):
                a, b = (np.array(x.values) for x in (a, b))
                # Ends are known for the last tokens only, which is all that one group needs.
                groups = Groups(a, np.arange(1, len(a) + 1) - len(a) + (1 << 40), b, np.concatenate([np.arange(-len(b), -1), [1 << 40]]))
                if len(groups.ends) > 1 or len(groups.a) != len(a):
                    raise ValueError("a bridge is one group")
                n_links, text, pairs, times = self.described(groups)
                values = [[row.as_py()], [at.as_py()], [0], [1], [n_links], [text], [pairs], [times]]
                yield pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    @staticmethod
    def answered(rows: pa.Table, replies: pa.Table) -> pa.Table:
        """The documents of one slice with the sums over their links."""
        counts = np.zeros(len(rows.column("pairs")[0]), np.int64)
        best = np.zeros(len(counts), bool)
        at = replies.column("pos").to_numpy()
        counts[at], best[at] = replies.column("n").to_numpy(), replies.column("best").to_numpy(zero_copy_only=False)
        own = {c: rows.column(c)[0].values for c in SLICE_COLUMNS[1:]}
        entry, times = own["entry"].to_numpy(), own["times"].to_numpy()
        bounds = np.concatenate([[0], np.cumsum(own["entries"].to_numpy())])

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values)])
            return pa.array(total[bounds[1:]] - total[bounds[:-1]])

        n_best, count_sum = summed(times * best[entry]), summed(times * counts[entry])
        names = [*SLICE_COLUMNS[1:6], "n_best", "count_sum", "groups"]
        return pa.table([*(own[c] for c in SLICE_COLUMNS[1:6]), n_best, count_sum, own["groups"]], names=names)


def _listed(parts: list[pa.Array]) -> pa.Array:
    """A list array with one list for each of the arrays."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()), pa.concat_arrays(parts))


def split(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, idx: int) -> tuple[Fragment, Groups]:
    """The fragment of a byte range from its tokens and their ends, and the groups between its first and last common end."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return Fragment(False, idx, a, b, a[:0], b[:0]), Groups(a[:0], ends_a[:0], b[:0], ends_b[:0])
    (pa_, sa), (pb, sb) = (np.searchsorted(e, common[[0, -1]], "right") for e in (ends_a, ends_b))
    return Fragment(True, idx, a[:pa_], b[:pb], a[sa:], b[sb:]), Groups(a[pa_:sa], ends_a[pa_:sa], b[pb:sb], ends_b[pb:sb])


_FRAGMENTS = "row long, doc_id long, idx long, good boolean, n_a long, n_b long, closed boolean, first long, a array<int>, b array<int>, a_open array<int>, b_open array<int>, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_FRAGMENT_NAMES = [c.split()[0] for c in _FRAGMENTS.split(", ")]
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_FRAGMENT_KINDS = [_KINDS[c.split()[1]] for c in _FRAGMENTS.split(", ")]


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One fragment for each run of rows of one (row, node), sorted by idx, and the groups closed inside the run."""
    bridge = pa.list_(pa.struct([("at", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), *[pa.list_(pa.int32())] * 4, bridge]
    names = ["row", "idx", "closed", "first", "a", "b", "a_open", "b_open", "bridges"]
    key, own, found = None, None, []

    def out() -> pa.RecordBatch:
        values = [key[0], key[1], own.closed, own.first, own.a, own.b, own.a_open, own.b_open, [dict(zip(("at", "a", "b"), g)) for g in found]]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        for r in range(batch.num_rows):
            row, node, closed, first = (batch.column(c)[r].as_py() for c in range(4))
            fragment = Fragment(closed, first, *(np.array(batch.column(c)[r].values, np.int32) for c in range(4, 8)))
            if key == (row, node):
                own, group = compose(own, fragment)
                found += [group] if group else []
            else:
                if key is not None:
                    yield out()
                key, own, found = (row, node), fragment, []
    if key is not None:
        yield out()


def _long(docs: DataFrame, aligner: Aligner) -> DataFrame:
    """Slices of one document each, for texts over the chunk size: fragments of byte ranges, composed level by level."""
    segments = settled(docs.mapInArrow(aligner.segments, "row long, doc_id long, start long, last long, text string"), file_rows=RANGES_A_FILE)
    ranges = settled(segments.repartition("row", "start").mapInArrow(aligner.fragments, _FRAGMENTS), file_rows=RANGES_A_FILE)
    whole = ranges.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.min("good").alias("good"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    good = whole.where("good").select("row")
    level = ranges.join(good, "row", "left_semi").select(*[c.split()[0] for c in FRAGMENT.split(", ")])
    top = segments.agg(F.max("last")).first()[0]
    top, groups = 2 * ((top or 0) // aligner.chunk) + 1, []
    while top:
        node = level.withColumn("_node", F.floor(F.col("idx") / FAN).cast("long"))
        ordered = node.repartition("row", "_node").sortWithinPartitions("row", "_node", "idx").select("row", "_node", *level.columns[2:])
        level = settled(ordered.mapInArrow(_composed, f"{FRAGMENT}, bridges array<struct<at:long,a:array<int>,b:array<int>>>"))
        groups.append(level.select("row", F.inline("bridges")))
        level, top = level.drop("bridges"), top // FAN
    # What is left of a document is one fragment; its prefix is the document's first group, and nothing is open behind it.
    bridges = level.select("row", F.col("first").alias("at"), "a", "b")
    for more in groups:
        bridges = bridges.union(more)
    closed = ranges.where("n_groups > 0").join(good, "row", "left_semi")
    closed = closed.select("row", F.col("idx").alias("at"), F.lit(1).alias("place"), "n_groups", "n_links", "groups", "pairs", "times")
    closed = settled(closed.union(bridges.mapInArrow(aligner.bridges, CLOSED)), file_rows=RANGES_A_FILE)
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "place", "groups"))), lambda g: g["groups"]), ";")
    shown = F.sha2(parts.cast("binary"), 256) if aligner.digest else parts
    sums = closed.groupBy("row").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"), shown.alias("groups"))
    linked = closed.select("row", F.inline(F.arrays_zip("pairs", "times"))).groupBy("row", "pairs").agg(F.sum("times").alias("times"))
    linked = linked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pairs", "times"))).alias("_l"))
    out = whole.join(sums, "row", "left").join(linked, "row", "left")
    found = F.coalesce(F.size("_l"), F.lit(0))
    found = F.when(found > 0, found).otherwise(0)

    def one(value: str) -> Column:
        return F.array(F.when(F.col("good"), F.col(value)).otherwise(0).cast("long"))

    return out.select(
        (-F.col("row") - 1).alias("slice"),
        F.array("doc_id").alias("doc_id"),
        *[one(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
        F.array(F.coalesce("groups", F.lit(""))).alias("groups"),
        F.array(found.cast("long")).alias("entries"),
        F.when(found > 0, F.transform(F.sequence(F.lit(1), found), lambda i: i - 1)).otherwise(F.array().cast("array<int>")).alias("entry"),
        F.coalesce(F.col("_l.times"), F.array().cast("array<long>")).alias("times"),
        F.coalesce(F.col("_l.pairs"), F.array().cast("array<long>")).alias("pairs"),
        F.array_repeat(F.lit(1), found).alias("docs"),
    )


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, chunk: int = CHUNK, slice_bytes: int = SLICE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for each row of `docs` (columns doc_id, text; others are ignored).

    `path_a` is a byte-level tokenizers file, `path_b` a sentencepiece model with byte fallback that puts a blank before a text;
    workers open both. groups is `a1,a2|b1;a3|b2,b3`, the ids of each group in order, or with `digest` its SHA-256. Links are all
    occurrence pairs of a group. count_sum adds up, over a text's links, in how many rows of `docs` their pair of ids is
    linked; n_best counts the links whose pair has the highest such count of its first id. Null and empty texts, and those
    whose tokens do not spell the stream (U+2581 in the text), have no tokens: zeros, '', and no part in counts.
    Rows that repeat a doc_id, and rows without one, are documents of their own. An empty table gives an empty table.
    """
    aligner = Aligner(path_a, path_b, chunk, slice_bytes, digest)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    slices = rows.where(size <= chunk).mapInArrow(aligner.short, SLICES)
    slices = settled(slices.unionByName(_long(rows.where(size > chunk), aligner)), file_rows=SLICES_A_FILE)
    places = F.arrays_zip("pairs", "docs", F.sequence(F.lit(0), F.size("pairs") - 1).alias("pos"))
    asked = slices.where(F.size("pairs") > 0).select("slice", F.inline(places)).toDF("slice", "pair", "docs", "pos")
    counts = settled(asked.groupBy("pair").agg(F.sum("docs").alias("n")))
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    first = F.floor(F.col("pair") / pieces)
    # One row for each id of the first tokenizer: bounded by its vocabulary.
    highest = counts.groupBy(first.alias("_a")).agg(F.max("n").alias("_most"))
    marked = counts.withColumn("_a", first).join(F.broadcast(highest), "_a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))
    replies = asked.select("slice", "pair", "pos").join(marked.hint("merge"), "pair").select("slice", "pos", "n", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return slices.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(aligner.answered, schema)
