"""Tables in versions: new rows are written beside the old ones, and one new manifest makes them current.

A store is a folder of data folders and manifests. A manifest names, for each table of the store, its schema and the folder of
each of its chunks; a chunk is the rows of one value of a column, such as a month. A change writes the folders of the
chunks that it replaces and then one manifest, by renaming a finished file. Readers take the manifest with the highest
number: before the rename they see all of the old rows, after it all of the new ones, in all tables of the change.
What a failed change left behind is named by no manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.calendar import within_period

CHUNK = "_chunk"


@dataclass(frozen=True)
class Staged:
    """Written chunks of a table that no manifest names yet; `dropped` are chunks that end empty."""

    schema: str
    folders: Mapping[str, str]
    dropped: Sequence[str] = ()


class Store:
    """A folder of tables; every change of any of them is one new version of all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self) -> Any:
        """The file system of the path: any that Spark can write to."""
        return self._at("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str) -> Any:
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def version(self) -> int:
        """The current version; 0 before the first change."""
        files, folder = self._files(), self._at("manifests")
        if not files.exists(folder):
            return 0
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict[str, dict]:
        version = self.version() if version is None else version
        if not version:
            return {}
        text = self.spark.read.text(f"{self.path}/manifests/{version:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def chunks(self, table: str) -> list[str]:
        return sorted(self.manifest().get(table, {"folders": {}})["folders"])

    def read(self, table: str, chunks: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a table, or those of some chunks; other chunks are not opened. `version` reads an earlier state."""
        entry = self.manifest(version)[table]
        schema = StructType.fromJson(json.loads(entry["schema"]))
        folders = [f for c, f in sorted(entry["folders"].items()) if chunks is None or c in chunks]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def stage(self, df: DataFrame, chunk: Any, dropped: Sequence[str] = ()) -> Staged:
        """Write the rows by chunk (a column of text); adaptive execution splits a large chunk and joins small ones by size."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.withColumn(CHUNK, chunk).hint("rebalance", F.col(CHUNK))
        rows.write.partitionBy(CHUNK).parquet(f"{self.path}/{folder}")
        found = [s.getPath().getName() for s in self._files().listStatus(self._at(folder)) if s.isDirectory()]
        named = {n.split("=", 1)[1]: f"{folder}/{n}" for n in found if n.startswith(f"{CHUNK}=")}
        return Staged(df.schema.json(), named, list(dropped))

    def commit(self, changes: Mapping[str, Staged], based_on: int) -> int:
        """Make staged chunks current in place of those of the same name; an error if another change came between."""
        if self.version() != based_on:
            raise RuntimeError(f"{self.path}: version {self.version()} came after {based_on}")
        tables = self.manifest(based_on)
        for name, staged in changes.items():
            folders = dict(tables.get(name, {"folders": {}})["folders"])
            for chunk in staged.dropped:
                folders.pop(chunk, None)
            tables[name] = {"schema": staged.schema, "folders": folders | dict(staged.folders)}
        self._publish(based_on + 1, json.dumps(tables))
        return based_on + 1

    def _publish(self, version: int, text: str) -> None:
        files = self._files()
        files.mkdirs(self._at("manifests"))
        unfinished, final = self._at(f"manifests/_{uuid.uuid4().hex}"), self._at(f"manifests/{version:012d}.json")
        out = files.create(unfinished, False)
        out.write(bytearray(text.encode()))
        out.close()
        if files.exists(final) or not files.rename(unfinished, final):
            raise RuntimeError(f"{self.path}: version {version} exists")

    def recover(self) -> list[str]:
        """Remove data folders that the current version does not name; returns them. Not for use beside a running change."""
        files, folder = self._files(), self._at("data")
        used = {f.split("/")[1] for t in self.manifest().values() for f in t["folders"].values()}
        found = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        gone = [n for n in found if n not in used]
        for n in gone:
            files.delete(self._at(f"data/{n}"), True)
        return gone


def months_of(start: date, end: date) -> list[str]:
    """First days of the months that a half-open period touches."""
    months, at = [], start.replace(day=1)
    while at < end:
        months.append(at.isoformat())
        at = date(at.year + at.month // 12, at.month % 12 + 1, 1)
    return months


def month_chunk(day: str) -> Any:
    return F.trunc(day, "month").cast("string")


def period_staged(store: Store, table: str, fresh: DataFrame, start: date, end: date, day: str) -> Staged:
    """The months of a period with its rows replaced; days of these months outside of the period keep theirs. A fresh row outside
    the period is an error."""
    inside = F.coalesce(within_period(day, start, end), F.lit(False))
    stray = F.raise_error(F.concat(F.lit(f"outside [{start}, {end}): "), F.coalesce(F.col(day).cast("string"), F.lit("null"))))
    rows, months = [fresh.withColumn(day, F.when(inside, F.col(day)).otherwise(stray))], months_of(start, end)
    if table in store.manifest():
        edges = [m for m in {months[0], months[-1]} if m in store.chunks(table)] if months else []
        rows.append(store.read(table, edges).where(~inside).select(*fresh.columns))
    return store.stage(reduce(DataFrame.unionByName, rows), month_chunk(day), months)


def reload_version(store: Store, table: str, fresh: DataFrame, start: date, end: date, day: str = "snap_date") -> int:
    """Reload a period of a table as one new version. Months outside of the period are neither read nor written."""
    based_on = store.version()
    return store.commit({table: period_staged(store, table, fresh, start, end, day)}, based_on)
