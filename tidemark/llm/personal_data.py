"""Personal data in texts: fixed patterns, and further spans by weak supervision. DataFrame functions only.

Fixed patterns give the base spans. Tokens with a digit outside of them are candidates for secrets (keys,
passwords, access tokens): regex, gazetteer and context labelers vote on each. Expectation maximisation over the
counted vote patterns estimates how reliable each labeler is and how likely each pattern means a secret; a
logistic classifier over features of the span, fitted to those posteriors, decides. The votes and the features of
a candidate are a few bits, so the tables that EM and the classifier see have at most 3^7 * 2^7 rows whatever the
size of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
#: Written so that no start inside a run is tried again; they find what the plain forms find.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must have for a pattern to be worth trying.
NEEDS = {"email": "@", "phone": "+"}

CANDIDATE = r"(?<![^\x20\x09-\x0D\"'=:,;()])(?=[A-Za-z_./+-]*[0-9])[A-Za-z0-9_./+-]{6,}"
BEFORE = 24
SECRET_WORDS = ["password", "passwd", "pwd", "passphrase", "secret", "token", "key", "apikey", "credential", "auth", "bearer"]
PUBLIC_WORDS = ["version", "license", "licence", "page", "chapter", "figure", "table", "section", "no", "year", "since", "isbn", "copyright"]


def found(text: Column, pattern: str, needs: str | None = None) -> Column:
    """Leftmost non-overlapping matches: structs of start, end (code points), m, before (the text right before)."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    pieces = F.filter(pieces, lambda p: p["m"].isNotNull())
    nothing = F.array().cast("array<struct<start:int,end:int,m:string,before:string>>")

    def add(state: Column, p: Column) -> Column:
        start = state["at"] + F.char_length(p["gap"])
        end = start + F.char_length(p["m"])
        before = F.substring(p["gap"], F.greatest(F.lit(1), F.char_length(p["gap"]) - (BEFORE - 1)), F.lit(BEFORE))
        one = F.struct(start.alias("start"), end.alias("end"), p["m"].alias("m"), before.alias("before"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), nothing.alias("out")), add, lambda s: s["out"])
    worth = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    return F.when(worth, spans).otherwise(nothing)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    digits = F.transform(F.filter(F.split(F.reverse(_digits(m)), ""), lambda d: d != ""), lambda d: d.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _byte(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.char_length(plain) <= 3) & (F.coalesce(F.try_to_number(F.when(plain == "", "0").otherwise(plain), F.lit("99999")), F.lit(999)) <= 255)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _byte)
    if kind == "card":
        return _luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(found(text, PATTERNS[kind], NEEDS.get(kind)), lambda s: _valid(kind, s["m"]))


def _word_before(before: Column) -> Column:
    """The last word before the span, without what joins it to the span."""
    return F.regexp_extract(F.lower(before), r"([a-z_-]+)[^a-z]*$", 1)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def labelers(m: Column, before: Column) -> list[Column]:
    """Votes 1 (secret), -1 (not), 0 (none) of each labeler."""
    word = _word_before(before)
    named = F.lit(False)
    for w in SECRET_WORDS:
        named = named | F.endswith(word, F.lit(w))
    joined = before.rlike(r"[A-Za-z]\s*[=:]\s*[\"']?$")
    letters, digits = m.rlike("[A-Za-z]"), F.length(_digits(m))
    return [
        _vote(m.rlike("^[0-9a-f]{16,}$") & letters, m.rlike(r"^[0-9]+([./-][0-9]+)*[.]?$")),
        _vote(m.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$|^(ghp|gho|sk|pk|xox[a-z])[_-][0-9A-Za-z]{16,}$")),
        _vote(named, word.isin(PUBLIC_WORDS)),
        _vote(joined, before.rlike(r"[a-z,.]\s$")),
        _vote(letters & (digits >= 4) & (F.char_length(m) >= 16) & ~m.rlike("[./]"), (F.char_length(m) < 10) | (digits < 2)),
        _vote(m.rlike("^[0-9A-Z]{12,}$") & letters, m.rlike("^[A-Za-z]+[-_]?[0-9]{1,2}[.]?$")),
        _vote(before.rlike("[\"']$") & joined, m.rlike("^(https?|www)|/|[.][a-z]{2,4}$")),
    ]


def features(m: Column, before: Column) -> list[Column]:
    """0 or 1 each; the classifier sees these, not the votes."""
    digits = F.length(_digits(m))
    return [
        F.char_length(m) >= 16,
        F.char_length(m) >= 12,
        m.rlike("[A-Za-z]") & (digits >= 3),
        ~m.rlike("[^0-9a-f]") | ~m.rlike("[^0-9A-Z]"),
        before.rlike("[=:]\\s*[\"']?$"),
        m.rlike("[./+-]"),
        _word_before(before).rlike("(pass|pwd|secret|token|key|auth|cred)"),
    ]


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each vote pattern, log-likelihood table [labeler, class, vote + 1], prior: EM over two classes."""
    n, m = votes.shape
    if n == 0:
        return np.zeros(0), np.zeros((m, 2, 3)), 0.5
    # The start: labelers are right more often than not; patterns without a vote are not secrets.
    post = 1 / (1 + np.exp(-votes.sum(axis=1) * 1.0 + 0.5))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        table = np.stack([[[(weight[c] * (votes[:, j] == v)).sum() + 1 for v in (-1, 0, 1)] for c in (0, 1)] for j in range(m)])
        table = np.log(table / table.sum(axis=2, keepdims=True))
        gain = sum(table[j, 1, votes[:, j] + 1] - table[j, 0, votes[:, j] + 1] for j in range(m))
        post = 1 / (1 + np.exp(-np.clip(gain + np.log(prior / (1 - prior)), -40, 40)))
    return post, table, float(prior)


def fitted(x: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic classifier (bias last) for soft targets, by gradient steps on counted rows."""
    x = np.column_stack([x, np.ones(len(x))]).astype(float)
    w, share = np.zeros(x.shape[1]), weight / max(1.0, weight.sum())
    balance = np.where(target > 0.5, 0.5 / max(1e-9, (share * (target > 0.5)).sum()), 0.5 / max(1e-9, (share * (target <= 0.5)).sum()))
    share = share * balance
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (share * (p - target)) + ridge * w)
    return w


def _outside(cands: Column, taken: Column) -> Column:
    return F.filter(cands, lambda c: ~F.exists(taken, lambda t: (t["start"] < c["end"]) & (c["start"] < t["end"])))


def candidates(text: Column, base: Column) -> Column:
    return _outside(found(text, CANDIDATE), base)


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the span classifier, and the labelers' reliabilities, from the candidates of all texts."""
    spans = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("base", _all_base(F.col("text")))
    spans = spans.select(F.explode(candidates(F.col("text"), F.col("base"))).alias("c"))
    m, before = F.col("c.m"), F.col("c.before")
    seen = spans.select(F.array(*labelers(m, before)).alias("votes"), F.array(*[f.cast("int") for f in features(m, before)]).alias("x"))
    rows = seen.groupBy("votes", "x").count().collect()
    rows = sorted(rows, key=lambda r: (r["votes"], r["x"]))
    if not rows:
        return np.zeros(8), np.zeros((7, 2, 3))
    votes, x = np.array([r["votes"] for r in rows]), np.array([r["x"] for r in rows])
    counts = np.array([r["count"] for r in rows], dtype=float)
    post, table, _ = reliabilities(votes, counts)
    return fitted(x, post, counts), table


def _named(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _all_base(text: Column) -> Column:
    return F.concat(*[_named(base_spans(text, kind), kind) for kind in KINDS])


def personal_data(docs: DataFrame, weights: Sequence[float] | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, base, spans) for each row of `docs` (doc_id, text): arrays of (kind, start, end), code points, end exclusive.

    `base` are the valid matches of the fixed patterns, `spans` these and the added ones, of kind "secret", that
    overlap none of them; both are ordered by kind as in KINDS, then start. `weights` come from `train`, by
    default on `docs` itself. A null or empty text has no spans; rows that repeat are answered each; other columns
    are ignored; with no candidate in the corpus nothing is added.
    """
    weights = list(train(docs)[0] if weights is None else weights)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("base", _all_base(F.col("text")))

    def secret(c: Column) -> Column:
        total = F.lit(float(weights[-1]))
        for w, f in zip(weights, features(c["m"], c["before"])):
            total = total + F.when(f, float(w)).otherwise(0.0)
        return 1 / (1 + F.exp(-total)) > threshold

    added = _named(F.filter(candidates(F.col("text"), F.col("base")), secret), "secret")
    return rows.select("doc_id", "base", F.concat("base", added).alias("spans"))
