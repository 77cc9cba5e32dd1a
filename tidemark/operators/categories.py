"""Missing categories: placeholder, most frequent value, or a prediction from the other columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import placeholder
from tidemark.operators.profile import columns_of_type
from tidemark.operators.ranking import category_codes, encode
from tidemark.operators.salting import salted_join
from tidemark.session import settled


def placeholder_impute(df: DataFrame, columns: Sequence[str], text: str = "missing") -> DataFrame:
    return df.withColumns({c: placeholder(c, text) for c in columns})


def mode_impute(df: DataFrame, c: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent category, of the row's group when `by` is given; ties to the smallest name.

    A row without a group, or of a group without any category, keeps its gap.
    """
    by = list(by)
    modes = (
        df.where(F.col(c).isNotNull())
        .groupBy(*by, c)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*by)
        .agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v")))["v"].alias("_mode"))
    )
    if by:
        # A large group's rows are dealt out by their content.
        filled = salted_join(df, modes, by, df.columns, "left")
    else:
        row = modes.head()
        filled = df.withColumn("_mode", F.lit(row["_mode"] if row else None).cast("string"))
    return filled.withColumn(c, F.coalesce(c, "_mode")).select(*df.columns)


def category_impute(
    df: DataFrame, target: str, features: Sequence[str], trees: int = 100, depth: int = 8, seed: int = 42
) -> DataFrame:
    """Predict the missing values of `target` with a random forest fitted on the rows that have it.

    Text features enter as integer codes in sorted order, -1 for missing; numbers with gaps get their mean.
    """
    features = list(features)
    coded = df
    for c in columns_of_type(df.select(*features), "text"):
        coded = encode(coded, c, category_codes(df, c), f"_x_{c}")
        coded = coded.withColumn(f"_x_{c}", F.coalesce(F.col(f"_x_{c}").cast("double"), F.lit(-1.0)))
    numbers = columns_of_type(df.select(*features), "numeric")
    coded = coded.withColumns({f"_n_{c}": F.col(c).cast("double") for c in numbers})
    if numbers:
        imputer = Imputer(inputCols=[f"_n_{c}" for c in numbers], outputCols=[f"_x_{c}" for c in numbers])
        coded = imputer.fit(coded).transform(coded)
    # Fitting reads the rows many times; the joins behind the codes run once.
    assembled = VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol="_x").transform(settled(coded))

    known = assembled.where(F.col(target).isNotNull())
    unknown = assembled.where(F.col(target).isNull())
    indexer = StringIndexer(inputCol=target, outputCol="_y", stringOrderType="alphabetAsc").fit(known)
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="_y", predictionCol="_py", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(indexer.transform(known))
    # A copy has no training summary; that one holds the session, which does not travel to tasks once the session has observed a table.
    forest = forest.copy()
    back = IndexToString(inputCol="_py", outputCol="_predicted", labels=indexer.labels)
    predicted = back.transform(forest.transform(unknown)).withColumn(target, F.col("_predicted"))
    return known.select(*df.columns).unionByName(predicted.select(*df.columns))
