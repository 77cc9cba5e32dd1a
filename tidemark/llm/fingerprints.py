"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A sketch holds every shingle hash in the lowest 1 / SCALE of the hash space, so it grows with its text and
sketches of very unequal texts can be compared and merged. A text with fewer than LEAST such hashes holds its
LEAST smallest ones instead, or all: its threshold is higher. Two sketches are compared below the lower of
their thresholds, where both are complete.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 5
SCALE = 16
LEAST = 32
LOWEST = -(2**63)
LIMIT = LOWEST + 2**64 // SCALE
HIGHEST = 2**63 - 1
BUCKET_BYTES = 16 << 20
CUTS = 256


def _bound(value: Column, use) -> Column:
    """`use` of a value that is worked out once, also where `use` names it inside a function of array elements."""
    return F.transform(F.array(value), use)[0]


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs of `width` words, with repeats; fewer words are one run, none are an empty array."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        full = F.transform(F.slice(h, 1, F.size(h) - (width - 1)), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, width)]))
        return F.when(F.size(h) >= width, full).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))

    return _bound(hashes, runs)


def sketch(text: Column) -> Column:
    """Sorted hashes of a text's sketch. Words are what white space parts, as they are written; null is empty."""

    def kept(all_: Column) -> Column:
        low = F.array_distinct(F.filter(all_, lambda x: x < F.lit(LIMIT)))
        fewest = F.slice(F.sort_array(F.array_distinct(all_)), 1, LEAST)
        return _bound(low, lambda some: F.when(F.size(some) >= LEAST, F.sort_array(some)).otherwise(fewest))

    return _bound(shingles(F.coalesce(text, F.lit(""))), kept)


def reach(own: Column) -> Column:
    """Up to where a sketch is complete: all of it, the highest of the smallest, or the common limit."""
    return F.when(F.size(own) < LEAST, F.lit(HIGHEST)).otherwise(F.greatest(F.lit(LIMIT - 1), F.element_at(own, -1)))


def _below(own: Column, limit: Column) -> Column:
    return F.filter(own, lambda x: x <= limit)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among those of either text; 1 for two texts without any."""
    limit = F.least(reach(a), reach(b))
    pair = F.struct(_below(a, limit).alias("a"), _below(b, limit).alias("b"))

    def share(p: Column) -> Column:
        both = F.size(F.array_intersect(p["a"], p["b"]))
        either = F.size(p["a"]) + F.size(p["b"]) - both
        return F.when(either == 0, F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(0.0)).otherwise(both / either)

    return _bound(pair, share)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 for a text without any."""
    limit = F.least(reach(a), reach(b))
    own = _below(a, limit)
    return F.when(F.size(a) == 0, 1.0).when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, b)) / F.size(own))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles together, as far as both are complete."""
    limit = F.least(reach(a), reach(b))
    return F.sort_array(F.array_union(_below(a, limit), _below(b, limit)))


def as_text(own: Column) -> Column:
    return F.array_join(F.transform(own, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _bucket(docs: DataFrame) -> tuple[Column, int]:
    """A number that rises with doc_id and parts the texts into pieces of about BUCKET_BYTES, and how many there are.

    Quantiles of the ids, at most CUTS, are cut further by equal steps of the id; null ids are bucket -1.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    wanted = max(1, math.ceil(size / BUCKET_BYTES))
    cuts = min(CUTS, wanted)
    probabilities = [i / cuts for i in range(cuts + 1)]
    points = docs.select(F.col("doc_id").cast("long").alias("doc_id")).agg(F.percentile_approx("doc_id", probabilities, 100_000)).first()[0]
    points = sorted(set(points or [0]))
    steps = math.ceil(wanted / cuts)
    bounds = F.array(*[F.lit(p).cast("long") for p in points])

    def inside(at: Column) -> Column:
        low, high = F.get(bounds, at - 1), F.coalesce(F.get(bounds, at), F.get(bounds, at - 1) + 1)
        step = F.floor((F.col("doc_id") - low).cast("double") / (high - low).cast("double") * steps)
        return at * steps + F.greatest(F.lit(0), F.least(F.lit(steps - 1), step))

    at = F.size(F.filter(bounds, lambda p: p <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(inside(at) if steps > 1 else at).cast("long"), wanted


def with_next(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`docs` (doc_id, text) with `columns` and, as next_*, all of these of the next row in descending doc_id.

    After the last row comes the first. Rows go once to their bucket of ids; the first row of each bucket goes
    to the bucket before it as well, and the very first to the last bucket, so no bucket looks into another.
    Rows that share an id stand in the order of their text's hash; null ids come last.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bucket, _ = _bucket(docs)
    # One row for each bucket.
    tops = docs.select(bucket.alias("_b"), "doc_id").groupBy("_b").agg(F.max("doc_id").alias("_top"))
    down = Window.orderBy("_b")
    tops = tops.withColumn("_guest", F.coalesce(F.lead("_b").over(down), F.first("_b").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    rows = docs.select("*", bucket.alias("_b"), *[c.alias(n) for n, c in columns.items()])
    guests = tops.select(F.col("_b").alias("_of"), "_top", "_guest")
    rows = rows.join(F.broadcast(guests), (F.col("_b") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_top")), "left")
    places = F.filter(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("g")), F.struct(F.col("_guest").alias("b"), F.lit(1).alias("g"))), lambda p: p["b"].isNotNull())
    names = ["doc_id", "text", *columns]
    rows = rows.select(*names, F.explode(places).alias("_p")).select(*names, F.col("_p.b").alias("_b"), F.col("_p.g").alias("_g"))
    order = Window.partitionBy("_b").orderBy("_g", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    rows = rows.select(*names, "_g", *[F.lead(n).over(order).alias(f"next_{n}") for n in names])
    return rows.where("_g = 0").drop("_g")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of `docs`.

    `docs` has doc_id and text; other columns are ignored. The edited text has its last floor(n_chars / 2) code
    points replaced by as many first ones of the next text (descending doc_id, after the last the first; a
    single document follows itself). A null text is empty; an empty table gives an empty table.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, {"own": sketch(F.col("text"))})
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "own", "next_own", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "own", "next_own", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_own"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
