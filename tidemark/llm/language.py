"""Language identification: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

A text is read in windows of WINDOW bytes; in each the network runs forwards and backwards, labels every byte from
both states, and a document's probabilities are the mean over all its bytes. Windows are independent, so a task reads
many at once as matrices, and a long text is no more than many windows. Gates are clipped lines and the candidate
state is x / (1 + |x|), which cost a fraction of exponentials.

The network is a few thousand numbers. It is fitted on the driver on at most `sample` windows (in expectation), drawn
evenly over the languages from all labelled rows by a hash of doc_id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm import textbytes as tb

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 64
HIDDEN = 8
SAMPLE = 8192
STEPS = 240
BATCH = 256
RATE = 0.02
UNKNOWN = "und"
#: Windows read at a time.
ROWS = 1024

Weights = dict[str, np.ndarray]


def start_weights(labels: int, hidden: int = HIDDEN, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    out = {}
    for way in ("f", "b"):
        out[f"{way}_in"] = rng.normal(0, 0.4, (256, 3 * hidden)).astype(np.float32)
        out[f"{way}_state"] = rng.normal(0, 0.4, (hidden, 3 * hidden)).astype(np.float32)
    out["out"] = rng.normal(0, 0.4, (2 * hidden, labels)).astype(np.float32)
    out["bias"] = np.zeros(labels, np.float32)
    return out


def _run(letters: np.ndarray, w_in: np.ndarray, w_state: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States [step, row, hidden] over letters [step, row]; `trace` gathers what the way back needs."""
    steps, rows = letters.shape
    n = w_state.shape[0]
    h = np.zeros((rows, n), np.float32)
    out = np.empty((steps, rows, n), np.float32)
    for t in range(steps):
        given = w_in[letters[t]]
        held = h @ w_state
        gates = given[:, : 2 * n] + held[:, : 2 * n]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0, 1, out=gates)
        z, r = gates[:, :n], gates[:, n:]
        new = r * held[:, 2 * n :]
        new += given[:, 2 * n :]
        scale = np.abs(new)
        scale += 1
        new /= scale
        if trace is not None:
            trace.append((h, z, r, new, held[:, 2 * n :]))
        h = h - new
        h *= z
        h += new
        out[t] = h
    return out


def _back(letters: np.ndarray, trace: list, d_out: np.ndarray, w_state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and the state weights from those of the states."""
    n = w_state.shape[0]
    d_state = np.zeros_like(w_state)
    d_given = np.empty((*letters.shape, 3 * n), np.float32)
    dh = np.zeros_like(d_out[0])
    for t in range(len(letters) - 1, -1, -1):
        h, z, r, new, held = trace[t]
        dh = dh + d_out[t]
        d_new = dh * (1 - z) * (1 - np.abs(new)) ** 2
        d_z = dh * (h - new) * 0.25 * ((z > 0) & (z < 1))
        d_r = d_new * held * 0.25 * ((r > 0) & (r < 1))
        d_given[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_held = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_state += h.T @ d_held
        dh = dh * z + d_held @ w_state.T
    flat = letters.ravel()
    d_in = np.stack([np.bincount(flat, d_given[:, :, c].ravel(), 256) for c in range(3 * n)], axis=1)
    return d_in.astype(np.float32), d_state


def _probabilities(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(axis=-1, keepdims=True)


def fit(windows: np.ndarray, there: np.ndarray, labels: np.ndarray, count: int, steps: int = STEPS, seed: int = 9) -> Weights:
    """Weights from windows [row, step] of bytes, which of them are there, and each row's label."""
    weights = start_weights(count)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    rng = np.random.default_rng(seed)
    for step in range(1, steps + 1 if len(windows) else 1):
        own = rng.integers(0, len(windows), BATCH)
        letters, mask = windows[own].T, there[own].T
        f_trace, b_trace = [], []
        forward = _run(letters, weights["f_in"], weights["f_state"], f_trace)
        backward = _run(letters[::-1], weights["b_in"], weights["b_state"], b_trace)[::-1]
        both = np.concatenate([forward, backward], axis=2)
        p = _probabilities(both @ weights["out"] + weights["bias"])
        p[:, np.arange(len(own)), labels[own]] -= 1
        p *= (mask / max(1, mask.sum()))[:, :, None]
        n = forward.shape[2]
        d_both = p @ weights["out"].T
        grads = {"out": np.einsum("tbh,tbl->hl", both, p), "bias": p.sum(axis=(0, 1))}
        grads["f_in"], grads["f_state"] = _back(letters, f_trace, d_both[:, :, :n], weights["f_state"])
        grads["b_in"], grads["b_state"] = _back(letters[::-1], b_trace, d_both[::-1, :, n:], weights["b_state"])
        rate = RATE * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            weights[k] = (weights[k] - rate * move).astype(np.float32)
    return weights


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the windows of the texts of a slice, and the text of each; the line feed behind a text is left out."""
    sizes = np.diff(offsets) - 1
    counts = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), counts)
    inner = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * WINDOW
    return offsets[:-1][text] + inner, np.minimum(WINDOW, sizes[text] - inner), text


def letters_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    there = np.arange(WINDOW)[None, :] < lengths[:, None]
    at = np.minimum(starts[:, None] + np.arange(WINDOW)[None, :], max(0, len(data) - 1))
    return np.where(there, data[at], 0).astype(np.uint8), there


def _states(letters: np.ndarray, w_in: np.ndarray, w_state: np.ndarray) -> np.ndarray:
    """As `_run`, for reading only: states [step, hidden, row], the gates' slope worked into the weights."""
    n = w_state.shape[0]
    slope = np.concatenate([np.full(2 * n, 0.25), np.ones(n)]).astype(np.float32)
    shift = np.concatenate([np.full(2 * n, 0.5), np.zeros(n)]).astype(np.float32)
    w_in, w_state = w_in * slope + shift, np.ascontiguousarray((w_state * slope).T)
    steps, rows = letters.shape
    out = np.empty((steps, n, rows), np.float32)
    given, held = (np.empty((3 * n, rows), np.float32) for _ in range(2))
    scale = np.empty((n, rows), np.float32)
    h = np.zeros((n, rows), np.float32)
    for t in range(steps):
        np.copyto(given, w_in[letters[t]].T)
        np.matmul(w_state, h, out=held)
        gates, new = given[: 2 * n], given[2 * n :]
        gates += held[: 2 * n]
        np.maximum(gates, 0, out=gates)
        np.minimum(gates, 1, out=gates)
        held[2 * n :] *= gates[n:]
        new += held[2 * n :]
        np.abs(new, out=scale)
        scale += 1
        new /= scale
        np.subtract(h, new, out=out[t])
        h = out[t]
        h *= gates[:n]
        h += new
    return out


def pooled(data: np.ndarray, offsets: np.ndarray, weights: Weights) -> np.ndarray:
    """Mean probability of each label over the bytes of each text; zeros for an empty one."""
    starts, lengths, text = cut(data, offsets)
    labels, n = len(weights["bias"]), weights["f_state"].shape[0]
    out = np.zeros((len(offsets) - 1, labels))
    forth, back = (np.ascontiguousarray(w.T) for w in (weights["out"][:n], weights["out"][n:]))
    for s in range(0, len(starts), ROWS):
        letters, there = letters_of(data, starts[s : s + ROWS], lengths[s : s + ROWS])
        letters = np.ascontiguousarray(letters.T)
        p = np.matmul(forth, _states(letters, weights["f_in"], weights["f_state"]))
        p += np.matmul(back, _states(letters[::-1], weights["b_in"], weights["b_state"]))[::-1]
        p += weights["bias"][:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p *= (there.T / p.sum(axis=1))[:, None, :]
        each = p.sum(axis=0)
        for c in range(labels):
            out[:, c] += np.bincount(text[s : s + ROWS], each[c], len(out))
    return out / np.maximum(1, np.diff(offsets) - 1)[:, None]


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a letter of any script."""
    ascii_ = np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])
    some = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
    for i in np.flatnonzero(~some).tolist():
        some[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
    return some


ASCII_LETTER = np.zeros(256, dtype=np.int64)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = 1


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As many windows of each row (key, label, text, times) as it says, their places in the text chosen by the key."""
    for batch in batches:
        for begin, end, data, offsets in tb.slices(batch.column(2)):
            starts, lengths, text = cut(data, offsets)
            counts = np.bincount(text, minlength=end - begin)
            first = np.cumsum(counts) - counts
            keys = batch.column(0).slice(begin, end - begin).to_numpy().astype(np.uint64)
            times = batch.column(3).slice(begin, end - begin).to_numpy()
            some = np.repeat(np.arange(end - begin), np.where(counts > 0, times, 0))
            with np.errstate(over="ignore"):
                draws = tb.mix(keys[some] + np.arange(len(some), dtype=np.uint64))
            pick = first[some] + (draws % np.maximum(1, counts[some]).astype(np.uint64)).astype(np.int64)
            blobs = [data[s : s + n].tobytes() for s, n in zip(starts[pick].tolist(), lengths[pick].tolist())]
            yield pa.record_batch([batch.column(1).slice(begin, end - begin).take(pa.array(some)), pa.array(blobs, pa.binary())], names=["label", "window"])


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[Weights, list[str]]:
    """Weights and languages from the rows of `docs` (doc_id, text, lang) that have a text and a lang."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return start_weights(0), []
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, sample / len(languages) / sizes[lang]).otherwise(share)
    key = F.xxhash64("doc_id", F.lit("window"))
    drawn = rows.withColumn("key", key).where(F.pmod(F.col("key"), F.lit(1_000_003)) / 1_000_003 < share)
    got = drawn.select("key", "lang", "text", F.ceil(share).cast("int").alias("times")).mapInArrow(_drawn, "label string, window binary").collect()
    got = sorted((r["label"], bytes(r["window"])) for r in got)
    windows = np.array([np.frombuffer(w.ljust(WINDOW, b"\0"), np.uint8) for _, w in got]).reshape(-1, WINDOW)
    there = np.arange(WINDOW)[None, :] < np.array([len(w) for _, w in got]).reshape(-1, 1)
    labels = np.array([languages.index(lang) for lang, _ in got], dtype=np.int64)
    weights = fit(windows, there, labels, len(languages))
    tb.give_back()
    return weights, languages


def identified(docs: DataFrame, weights: Weights, languages: list[str]) -> DataFrame:
    """`docs` with all its columns and `lang_pred`, `score`, which replace columns of these names.

    lang_pred is the language of the largest pooled probability (ties: the first by name), score that probability;
    a text that is null or has no letter, or any text if no language was learned, is `und` with score 0.
    """
    docs = docs.drop("lang_pred", "score")
    place = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast((weights, languages))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, languages = sent.value
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in batches:
            for begin, end, data, offsets in tb.slices(batch.column(place)):
                known = has_letter(data, offsets) & (len(languages) > 0)
                p = pooled(data, offsets, weights) if len(languages) else np.zeros((end - begin, 1))
                best = np.where(known, p.argmax(axis=1), len(languages))
                score = np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0)
                part = batch.slice(begin, end - begin)
                yield pa.record_batch([*part.columns, pa.array(names[best], pa.string()), pa.array(score)], names=[*part.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(tasks, schema)


def predict(docs: DataFrame, held_out: Column, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row; learns from text and lang of the rows not held out.

    lang, source and doc_id are no inputs of a prediction. Rows that repeat are answered each; an empty table gives
    an empty table; other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text", "lang")
    weights, languages = train(rows.where("NOT held_out"), sample)
    return identified(rows.select("doc_id", "held_out", "text"), weights, languages).select("doc_id", "held_out", "lang_pred", "score")
