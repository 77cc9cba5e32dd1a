"""Join of a large table to a per-group summary without sending a hot group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "inner", salts: int | None = None
) -> DataFrame:
    """Equi join on `keys` with the rows of each key spread over `salts` tasks by the `spread` columns.

    By default a key can fill as many tasks as the session has shuffle partitions. The summary is
    repeated `salts` times. An aggregate that follows on the same keys then gets its own exchange behind a
    map-side combine, where a plain join would leave the group in one task.
    """
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Never null, so no filter is derived from the join that would tell this use of `big` from others.
    salt = F.coalesce(F.pmod(F.xxhash64(*spread), F.lit(salts)), F.lit(0).cast("long"))
    left = big.withColumn("_salt", salt)
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


#: Share of all rows from which on a key counts as hot: there are at most so many hot keys.
HOT_KEYS = 1000


def hot_join(big: DataFrame, small: DataFrame, keys: Sequence[str], count: str, total: int) -> DataFrame:
    """Inner join of rows to one summary row a key, with the hot keys joined in place.

    `small` has in `count` how many rows of `big` each key has, and `total` is the sum. Keys with more than one of
    HOT_KEYS of all rows, at most HOT_KEYS keys, are broadcast; their rows are not shuffled. No key is null.
    """
    share = F.col(count).cast("double") * HOT_KEYS
    hot = F.broadcast(small.where(share > total).drop(count))
    rest = small.where(share <= total).drop(count)
    return big.join(hot, list(keys)).unionByName(big.join(hot.select(*keys), list(keys), "left_anti").join(rest, list(keys)))
