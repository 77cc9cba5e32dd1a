"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(docs):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {i: shingles(lower(t)) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def matches(docs, items, width=10):
    """{doc_id: (n_words, n_hit, items)}"""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[i] = (len(w), len(hit), found)
    return out


def shared_lines(docs, least_chars=40, least_docs=5):
    """{doc_id: (n_lines, n_dropped, kept text)}"""
    key = lambda line: lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    holders = collections.defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    """[(kind, start, end)]"""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(value):
    return zlib.crc32(value if isinstance(value, bytes) else str(value).encode())


def fingerprint(text):
    """The 64 bits that over half of the hashes of 3-word shingles have set."""
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def close_fingerprints(rows, near=2):
    """Component by smallest id of [(id, fingerprint)], by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= near:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return [smallest[find(i)] for i in range(len(rows))]


def resampled(docs, target, buckets=10_000, percent=25, least_words=20, seed=7):
    """[(doc_id, n_features, weight, score, rank)]"""

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(w), [crc(f.encode()) % buckets for f in [*w, *(f"{x} {y}" for x, y in zip(w, w[1:]))]]

    own = [(i, *features(t)) for i, t in docs]
    s = collections.Counter(f for _, _, fs in own for f in fs)
    t = collections.Counter(f for text in target for f in features(text)[1])
    in_all, in_target = s.total() + buckets, t.total() + buckets
    gain = [math.floor(1000 * math.log((t[k] + 1) * in_all / ((s[k] + 1) * in_target))) for k in range(buckets)]
    rows = []
    for i, n, fs in own:
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        h = int(sha(f"{seed}:{i}")[:8], 16)
        rows.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(order[: percent * len(order) // 100], 1)}
    return [(i, n, weight, score, rank.get(i)) for i, _, n, weight, score in rows]


class Tokenizers:
    """Both tokenizers over whole texts, one by one."""

    def __init__(self, path_a, path_b):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
        self.bytes_a = {i: bytes(letter[c] for c in t) for t, i in self.a.get_vocab().items() if set(t) <= set(letter)}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("\u2581", " ").encode()

    def tokens(self, text):
        """[(id, end)] of both, or two empty lists."""
        if not text:
            return [], []
        out = []
        for ids, of in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a.get), (self.b.encode(text), self.bytes_b)):
            raw = [of(i) for i in ids]
            if b"".join(raw) != (" " + text).encode():
                return [], []
            out.append(list(zip(ids, itertools.accumulate(map(len, raw)))))
        return out

    def aligned(self, docs):
        """[(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)]"""
        rows, held = [], collections.Counter()
        for i, text in docs:
            a, b = self.tokens(text)
            groups, low = [], 0
            for end in sorted({e for _, e in a} & {e for _, e in b}):
                groups.append([[t for t, e in side if low < e <= end] for side in (a, b)])
                low = end
            links = [(x, y) for g in groups for x in g[0] for y in g[1]]
            rows.append((i, len(a), len(b), groups, links))
            held.update(set(links))
        most = collections.Counter()
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        shown = lambda groups: ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        return [
            (i, a, b, len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), shown(groups))
            for i, a, b, groups, links in rows
        ]
