"""Readers: delimited files, warehouse tables, the segment list and dictionary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, ArrayType, StringType, StructType

from tidemark.functions.scalars import text_null


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, form: str | None = None) -> DataFrame:
    """A table of the form "parquet" or "csv", by default told by the end of the path.

    Delimited files have a header, and the usual texts for a missing value become null.
    A schema avoids the extra pass over the file that inferring types takes.
    """
    form = form or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if form == "parquet":
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    reader = spark.read.option("header", True).option("nullValue", "").option("nanValue", "nan")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    texts = {f.name: text_null(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)}
    numbers = {
        f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float")
    }
    return df.withColumns({**texts, **numbers}) if texts or numbers else df


def read_warehouse(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalogued table, or a parquet folder when `name` is a path."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def read_database(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """An external database table read in parallel ranges of `partition_column`."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def read_segment_list(spark: SparkSession, path: str) -> DataFrame:
    """(segment): one name per line, blanks around it and empty lines left out."""
    names = spark.read.text(path).select(F.trim("value").alias("segment"))
    return names.where(F.col("segment") != "")


def listed_segments(df: DataFrame, names: DataFrame) -> list[str]:
    """The columns of `df` that the list `names` (segment) has, sorted: the segments of a preparation, detector or report."""
    return sorted(r["segment"] for r in names.where(F.col("segment").isin(df.columns)).distinct().collect())


def read_segment_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(segment, position, value) from a JSON object of name -> list of values."""
    text = spark.read.text(path, wholetext=True)
    return explode_dictionary(text.select(F.from_json("value", MapType(StringType(), ArrayType(StringType()))).alias("m")))


def explode_dictionary(df: DataFrame, column: str = "m") -> DataFrame:
    lists = df.select(F.explode(column).alias("segment", "_values"))
    return lists.select("segment", F.posexplode("_values").alias("position", "value"))


def outside_dictionary(long: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(segment, group, n): groups of listed segments whose value the dictionary does not know.

    Groups are counted first, so the join sees one row per group and not one per table row.
    """
    listed = dictionary.select("segment").distinct()
    known = dictionary.select("segment", F.col("value").alias("group")).distinct()
    found = long.groupBy("segment", "group").agg(F.count(F.lit(1)).alias("n"))
    return found.join(listed, "segment", "left_semi").join(known, ["segment", "group"], "left_anti")
