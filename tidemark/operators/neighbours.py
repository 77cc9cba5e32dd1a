"""Missing numbers from the k nearest rows that have them: exact, for any number of columns and any gaps.

Distance between two rows: sqrt(m/p * sum of squared differences) over the p of m columns both have.

1. equal donors are cut to the k smallest keys, equal receivers become one point;
2. a tree grown on a bounded sample of the donors cuts them into at most LEAVES leaves, by values and by which columns are
   missing; every donor then goes to its leaf, and the leaf's ranges and counts are taken over all of them;
3. a receiver first meets the leaf that can be nearest, for each column it lacks; the k-th distance there is its reach;
4. of the other leaves it meets those whose least possible distance is within reach. That bound holds for every
   set of columns the receiver may share with a donor of the leaf, so gaps need no patterns in pairs;
5. the k best donors by (distance, key) give the value, the column mean where no donor is comparable.

Receivers meet donors in cells of a bounded number of both, whatever the size of a leaf, each cell with array arithmetic.
A task takes a bounded number of meetings, and donors beyond a receiver's reach do not leave their cell.
Only the sample, the tree and the leaves' ranges pass through the driver.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tidemark.session import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Donors the tree is grown on.
SAMPLE = 1 << 17
#: Donors a leaf should have, and the most leaves there are.
LEAF = 512
LEAVES = 16384
#: Share of rows with a column times that of rows without it, from which on a node is cut by presence.
MIXED = 0.04
#: Donors and receivers of one cell, as powers of two.
CELL_BITS = 12
#: Receivers of all cells of a task, about, and the fewest tasks.
TASK_ROWS, TASKS = 1 << 17, 8
#: Bounds and distances worked out at a time.
AT_A_TIME, DISTANCES = 1 << 21, 1 << 18
#: Pairs of patterns of missing columns up to which distances are worked out pattern by pattern.
FEW_PATTERNS = 64
SLACK = 1e-9


def _matrix(columns: Sequence[pa.Array | pa.ChunkedArray]) -> np.ndarray:
    """Rows by columns; missing values are NaN."""
    return np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in map(_whole, columns)])


def _whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


@dataclass(frozen=True)
class Tree:
    """Cuts of the space: a row goes left when the node's column is missing or at most the threshold. Leaves have column -1."""

    column: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def over(cls, points: np.ndarray, leaves: int) -> Tree:
        """The largest node is cut until there are `leaves`: by presence where neither side is rare, else at the median of the widest column."""
        nodes = [(-1, 0.0, -1, -1)]
        heap = [(-len(points), 0, points)]
        while heap and (len(nodes) + 1) // 2 < leaves:
            _, node, own = heapq.heappop(heap)
            cut = _cut(own)
            if cut is None:
                continue
            column, threshold = cut
            goes_left = ~(own[:, column] > threshold)
            nodes[node] = (column, threshold, len(nodes), len(nodes) + 1)
            for part in (own[goes_left], own[~goes_left]):
                heapq.heappush(heap, (-len(part), len(nodes), part))
                nodes.append((-1, 0.0, -1, -1))
        return cls(*(np.array(x) for x in zip(*nodes)))

    def leaf(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        inner = np.flatnonzero(self.column[at] >= 0)
        while len(inner):
            node = at[inner]
            goes_right = points[inner, self.column[node]] > self.threshold[node]
            at[inner] = np.where(goes_right, self.right[node], self.left[node])
            inner = inner[self.column[at[inner]] >= 0]
        return at


def _cut(own: np.ndarray) -> tuple[int, float] | None:
    if len(own) < 2:
        return None
    share = np.isnan(own).mean(axis=0)
    even = share * (1 - share)
    # Leaves of one pattern have no columns that may or may not be shared, which loosen their bound.
    if even.max() > MIXED:
        return int(even.argmax()), -np.inf
    best = None
    for c in range(own.shape[1]):
        values = own[~np.isnan(own[:, c]), c]
        if len(values) and values.min() < values.max():
            spread = float(values.std())
            if best is None or spread > best[0]:
                best = spread, c, values
    if best is None:
        return (int(even.argmax()), -np.inf) if even.max() > 0 else None
    middle = np.partition(best[2], (len(best[2]) - 1) // 2)[(len(best[2]) - 1) // 2]
    if middle == best[2].max():
        middle = best[2][best[2] < middle].max()
    return best[1], float(middle)


@dataclass(frozen=True)
class Leaves:
    """Ranges and counts of the donors of each leaf, by column."""

    number: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray

    def least(self, points: np.ndarray) -> np.ndarray:
        """Squared distance, points by leaves, below which no donor of the leaf can be; infinite where none is comparable.

        A column all donors of the leaf have is shared for sure. The others can only add to the shared ones; of those, the
        smallest gaps give the least mean, taken in one by one.
        """
        m = points.shape[1]
        has = ~np.isnan(points)
        total, shared = np.zeros((len(points), len(self.rows))), np.zeros((len(points), len(self.rows)), np.int64)
        optional = []
        for c in range(m):
            x = points[:, c, None]
            gap = np.maximum(np.maximum(self.low[:, c] - x, x - self.high[:, c]), 0.0) ** 2
            sure = has[:, c, None] & (self.count[:, c] == self.rows)
            total += np.where(sure, gap, 0.0)
            shared += sure
            maybe = has[:, c, None] & (self.count[:, c] > 0) & ~sure
            if maybe.any():
                optional.append(np.where(maybe, gap, np.inf))
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(shared > 0, total / shared, np.inf)
            for gap in np.sort(np.stack(optional), axis=0) if optional else ():
                shared = shared + np.isfinite(gap)
                total = total + np.where(np.isfinite(gap), gap, 0.0)
                least = np.where(shared > 0, np.minimum(least, total / shared), np.inf)
        return least * m * (1 - SLACK)

    def homes(self, points: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
        """Points by leaves: for each column a point lacks, the nearest leaf with k donors that have it."""
        chosen = np.zeros(least.shape, dtype=bool)
        for c in range(points.shape[1]):
            rows = np.flatnonzero(np.isnan(points[:, c]))
            usable = np.where(self.count[:, c] >= k, least[rows], np.inf)
            at = usable.argmin(axis=1)
            fits = np.isfinite(usable[np.arange(len(rows)), at])
            chosen[rows[fits], at[fits]] = True
        return chosen

    def within(self, points: np.ndarray, least: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Points by leaves: whether the leaf may hold a donor within reach of a column that the point lacks."""
        chosen = np.zeros(least.shape, dtype=bool)
        for c in range(points.shape[1]):
            rows = np.flatnonzero(np.isnan(points[:, c]))
            near = np.isfinite(least[rows]) & (least[rows] <= (reach[rows, c] ** 2)[:, None])
            chosen[rows] |= near & (self.count[:, c] > 0)
        return chosen


def _met(receivers: DataFrame, leaves: Leaves, m: int, k: int, with_reach: bool) -> DataFrame:
    """(_leaf, receiver): the home leaves of each receiver, or with reaches (kept) the other leaves that it has to meet."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, AT_A_TIME // (len(leaves.rows) * m))
        for batch in (whole.slice(s, step) for whole in batches for s in range(0, whole.num_rows, step)):
            points = _matrix(batch.columns[1 : m + 1])
            least = leaves.least(points)
            chosen = leaves.homes(points, least, k)
            if with_reach:
                chosen = leaves.within(points, least, _matrix(batch.columns[m + 1 :])) & ~chosen
            row, leaf = np.nonzero(chosen)
            yield pa.record_batch([pa.array(leaves.number[leaf]), *(c.take(pa.array(row)) for c in batch.columns)], names=names)

    fields = [StructField("_leaf", LongType()), *receivers.schema.fields]
    names = [f.name for f in fields]
    return receivers.mapInArrow(tasks, StructType(fields))


def _patterns(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(which columns are there, rows) for each pattern of missing columns."""
    there = ~np.isnan(points)
    _, first, back = np.unique(np.packbits(there, axis=1).astype(np.int64) @ (1 << 8 * np.arange(-(-points.shape[1] // 8))), return_index=True, return_inverse=True)
    return [(there[one], np.flatnonzero(back == i)) for i, one in enumerate(first.tolist())]


def _distances(own: np.ndarray, donors: np.ndarray, there: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Distance of each point to each donor, whose patterns are given if they are of use; infinite where they share no column.

    Rows of one pattern share the same columns with donors of one pattern: where few patterns meet, only those columns are
    worked out, with the same sums. Infinite values are no difference of each other, as a missing one.
    """
    m = own.shape[1]
    here = _patterns(own) if there and not np.isinf(own).any() else []
    if here and len(here) * len(there) <= FEW_PATTERNS:
        distance = np.full((len(own), len(donors)), np.inf)
        for has, rows in here:
            for having, columns in there:
                total, shared = None, np.flatnonzero(has & having)
                for c in shared.tolist():
                    apart = np.subtract.outer(own[rows, c], donors[columns, c])
                    apart *= apart
                    total = apart if total is None else np.add(total, apart, out=total)
                if total is not None:
                    total *= m / float(len(shared))
                    distance[np.ix_(rows, columns)] = np.sqrt(total, out=total)
        return distance
    total, shared = np.zeros((len(own), len(donors))), np.zeros((len(own), len(donors)))
    for c in range(m):
        apart = own[:, c, None] - donors[None, :, c]
        both = ~np.isnan(apart)
        total += np.where(both, apart * apart, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, np.sqrt(m / shared * total), np.inf)


def _nearest(points: np.ndarray, reach: np.ndarray, donors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(column, point, donor, distance): for each column a point lacks its k nearest donors within reach that have it; ties go to the earlier donor."""
    m = points.shape[1]
    step = max(1, DISTANCES // max(1, len(donors)))
    # As many columns as fit the bits of a number.
    there = _patterns(donors) if m <= 56 and not np.isinf(donors).any() else []
    for s in range(0, len(points), step):
        own = points[s : s + step]
        distance = _distances(own, donors, there)
        for c in range(m):
            rows, having = np.flatnonzero(np.isnan(own[:, c])), np.flatnonzero(~np.isnan(donors[:, c]))
            if not len(rows) or not len(having):
                continue
            sub = distance[np.ix_(rows, having)]
            limit = reach[s + rows, c]
            some = sub.min(axis=1) <= limit
            rows, sub, limit = rows[some], sub[some], limit[some]
            last = min(k, len(having)) - 1
            near = (sub <= np.minimum(np.partition(sub, last, axis=1)[:, last], limit)[:, None]) & np.isfinite(sub)
            r, d = np.nonzero(near)
            order = np.lexsort((d, sub[r, d], r))
            r, d = r[order], d[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            r, d = r[place < k], d[place < k]
            yield c, rows[r] + s, having[d], sub[r, d]


def _found(met: DataFrame, donors: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """(_rid, _c, _d, _donor, _v): for each receiver, cell and lacking column the nearest donors of that cell, within reach if `met` has it."""
    m = len(columns)
    reaches = [f"_r{i}" for i in range(m) if f"_r{i}" in met.columns]
    blocks = donors.select("_leaf", "_block").distinct()
    visits = settled(met.join(blocks, "_leaf"))
    sizes = visits.groupBy("_leaf", "_block").agg(F.ceil(F.count(F.lit(1)) / (1 << CELL_BITS)).cast("int").alias("_parts"))
    # One row for 2 ** CELL_BITS donors or a leaf.
    sizes = F.broadcast(settled(sizes))
    tasks = max(TASKS, -(-visits.count() // TASK_ROWS))
    visits = visits.join(sizes, ["_leaf", "_block"]).withColumn("_part", F.pmod(F.xxhash64("_rid", F.lit(1)), F.col("_parts")).cast("int"))
    there = donors.join(sizes, ["_leaf", "_block"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    cell = ["_leaf", "_block", "_part"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("_order")
        points, values = _matrix([left.column(c) for c in columns]), _matrix([right.column(c) for c in columns])
        reach = _matrix([left.column(c) for c in reaches]) if reaches else np.full(points.shape, np.inf)
        out = [pa.table({"_rid": [], "_c": [], "_d": [], "_donor": [], "_v": []}, schema=arrow_schema(right))]
        for c, p, d, distance in _nearest(points, reach, values, k):
            arrays = [left.column("_rid").take(pa.array(p)), pa.array(np.full(len(p), c, np.int32)), pa.array(distance), right.column("_donor").take(pa.array(d)), pa.array(values[d, c])]
            out.append(pa.table(arrays, schema=out[0].schema))
        return pa.concat_tables(out)

    def arrow_schema(right: pa.Table) -> pa.Schema:
        return pa.schema([("_rid", pa.int64()), ("_c", pa.int32()), ("_d", pa.float64()), ("_donor", right.schema.field("_donor").type), ("_v", pa.float64())])

    schema = StructType(
        [StructField("_rid", LongType()), StructField("_c", IntegerType()), StructField("_d", DoubleType()), donors.schema["_donor"], StructField("_v", DoubleType())]
    )
    left = visits.select(*cell, "_rid", *columns, *reaches).repartition(tasks, *cell).groupBy(*cell)
    right = there.select(*cell, "_order", "_donor", *columns).repartition(tasks, *cell).groupBy(*cell)
    return left.cogroup(right).applyInArrow(meet, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("_rid", "_c").orderBy("_d", "_donor")
    return found.withColumn("_row", F.row_number().over(nearest)).where(F.col("_row") <= k)


def _donors(base: DataFrame, columns: Sequence[str], k: int) -> tuple[DataFrame, Leaves | None]:
    """Donors with leaf, block and their place in the block by key; the leaves."""
    m = len(columns)
    same = Window.partitionBy(*columns).orderBy("_donor")
    some = settled(base.withColumn("_row", F.row_number().over(same)).where(F.col("_row") <= k).drop("_row"))
    n = some.count()
    if not n:
        return some, None
    sample = some.orderBy(F.xxhash64("_donor", *columns)).limit(SAMPLE).select(*columns).toArrow()
    tree = Tree.over(_matrix(sample.columns), min(LEAVES, -(-n // LEAF)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.columns[1:])
            first = np.where(np.isnan(points[:, 0]), -np.inf, points[:, 0])
            yield pa.record_batch([*batch.columns, pa.array(tree.leaf(points)), pa.array(first)], names=[*batch.schema.names, "_leaf", "_first"])

    located = some.select("_donor", *columns).mapInArrow(place, StructType([some.schema["_donor"], *(some.schema[c] for c in columns), StructField("_leaf", LongType()), StructField("_first", DoubleType())]))
    ranged = located.repartitionByRange("_leaf", "_first").sortWithinPartitions("_leaf", "_first")
    placed = settled(ranged.withColumn("_block", F.shiftrightunsigned(F.monotonically_increasing_id(), CELL_BITS)).drop("_first"))
    parts = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        parts += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.count(c).alias(f"n{i}")]
    seen = placed.groupBy("_leaf").agg(*parts).toArrow()
    low, high, count = (_matrix([seen.column(f"{p}{i}") for i in range(m)]) for p in ("lo", "hi", "n"))
    leaves = Leaves(seen.column("_leaf").to_numpy(), seen.column("n").to_numpy(), low, high, count.astype(np.int64))
    in_block = Window.partitionBy("_leaf", "_block").orderBy("_donor")
    return placed.withColumn("_order", F.row_number().over(in_block)), leaves


def _any(columns: Sequence[str], missing: bool) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | (F.col(c).isNull() if missing else F.col(c).isNotNull())
    return found


def knn_impute(df: DataFrame, key: str, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Fill null numbers in `columns`; `key` breaks ties of the distance. NaN counts as null, rows without any number take the means.

    Runs jobs when called: donors, receivers and what they meet are kept in the shared folder.
    """
    columns = list(columns)
    own = [f"_z{i}" for i in range(len(columns))]
    typed = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns})
    means = typed.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    mean_of = [F.lit(x).cast("double") for x in means]
    # Zeros of both signs are one point.
    base = typed.select(F.col(key).alias("_donor"), *[(F.col(c) + F.lit(0.0)).alias(z) for c, z in zip(columns, own)])
    distinct = base.where(_any(own, True) & _any(own, False)).select(*own).distinct()
    receivers = settled(distinct.select(F.monotonically_increasing_id().alias("_rid"), *own))
    donors, leaves = _donors(base.where(_any(own, False)), own, k)
    if leaves is None or receivers.isEmpty():
        return typed.withColumns({c: F.coalesce(F.col(c), mean_of[i]) for i, c in enumerate(columns)})

    m = len(columns)
    first = settled(_best(_found(_met(receivers, leaves, m, k, False), donors, own, k), k))
    reach = first.where(F.col("_row") == k).groupBy("_rid").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_d"))).alias("_reach"))
    reaching = receivers.join(reach, "_rid", "left")
    reaching = reaching.select("_rid", *own, *[F.coalesce(F.element_at("_reach", F.lit(i)), F.lit(float("inf"))).alias(f"_r{i}") for i in range(m)])
    second = _found(_met(reaching, leaves, m, k, True), donors, own, k)
    best = _best(first.drop("_row").unionByName(second), k)
    values = best.groupBy("_rid", "_c").agg(F.avg("_v").alias("_f"))
    values = values.groupBy("_rid").agg(*[F.max(F.when(F.col("_c") == i, F.col("_f"))).alias(f"_f{i}") for i in range(m)])

    def point(names: Sequence[str]) -> list[Column]:
        return [F.struct(F.col(c).isNull(), F.coalesce(F.col(c), F.lit(0.0)) + F.lit(0.0)).alias(f"_p{i}") for i, c in enumerate(names)]

    found = receivers.join(values, "_rid").select(*point(own), *[f"_f{i}" for i in range(m)])
    gaps = _any(columns, True)
    filled = typed.where(gaps).select("*", *point(columns)).join(found, [f"_p{i}" for i in range(m)], "left")
    filled = filled.withColumns({c: F.coalesce(F.col(c), F.col(f"_f{i}"), mean_of[i]) for i, c in enumerate(columns)})
    return typed.where(~gaps).unionByName(filled.select(*typed.columns))
