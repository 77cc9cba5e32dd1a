"""Preparation of the survey and inquiry tables for analysis."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_key
from tidemark.functions.scalars import age_band, as_category, clipped_ratio
from tidemark.operators.categories import category_impute, mode_impute, placeholder_impute
from tidemark.operators.columns import select_required
from tidemark.operators.neighbours import knn_impute
from tidemark.operators.profile import columns_of_type

# Columns of the processed tables.
SURVEY_SEGMENTS = (
    "survey_gender",
    "filial_id",
    "survey_arpu_group",
    "survey_city_size",
    "product_tariff_change",
    "network_prostoi",
    "network_volte",
    "network_vowifi",
    "network_overload",
    "network_sqi_voice",
    "network_speed_lte",
    "network_duration_2g",
    "network_duration_4g",
    "network_spd_lower_than_2000",
    "product_pereplaty",
    "profile_kinopoisk",
    "profile_device_type",
    "profile_device_os",
    "profile_device_price",
    "product_eva_type",
    "network_sqi_data",
    "product_name_line_tp",
    "product_group_tariff",
    "network_4g_share",
    "region_filial",
)
INQUIRY_SEGMENTS = (
    "filial_id",
    "description",
    "subcat_pyramid_name",
    "full_name",
    "cat_pyramid_name",
    "flag_local_general",
)
ROW_KEY = ("sk_subs_id", "snap_date")
AGE_COLUMNS = {"survey_age": "survey_age_group", "survey_operator_age": "survey_operator_age_group"}


def with_satisfaction(df: DataFrame, a: str = "value_1", b: str = "value_2", out: str = "nps") -> DataFrame:
    return df.withColumn(out, clipped_ratio(a, b))


def fill_missing(
    df: DataFrame,
    key: str,
    exclude: Sequence[str] = (),
    k: int = 5,
    placeholder: str | None = None,
    predict: Sequence[str] = (),
    mode: Sequence[str] = (),
) -> DataFrame:
    """Numbers from the k nearest rows. Null categories stay null unless one of the options names them."""
    skip = {key, *exclude}
    numbers = [c for c in columns_of_type(df, "numeric") if c not in skip]
    filled = knn_impute(df, key, numbers, k) if numbers else df
    for c in mode:
        filled = mode_impute(filled, c)
    for c in predict:
        features = [f for f in filled.columns if f not in {c, *skip} and f in _modelled(filled)]
        filled = category_impute(filled, c, features)
    if placeholder is not None:
        texts = [c for c in columns_of_type(filled, "text") if c not in skip]
        filled = placeholder_impute(filled, texts, placeholder)
    return filled


def _modelled(df: DataFrame) -> set[str]:
    return {*columns_of_type(df, "numeric"), *columns_of_type(df, "text")}


def _prepare(df: DataFrame, columns: Sequence[str], key: Sequence[str], ts: str, options: dict) -> DataFrame:
    dated = df.withColumns({"snap_date_day": day_key(ts), "_key": F.struct(*key)})
    if "filial_id" in columns:
        dated = dated.withColumn("filial_id", as_category("filial_id"))
    chosen = select_required(dated, {*columns, "snap_date_day", "_key"})
    return select_required(fill_missing(chosen, "_key", **options), {*columns, "snap_date_day"})


def prepare_survey(
    df: DataFrame,
    key: Sequence[str] = ROW_KEY,
    ts: str = "snap_date",
    segments: Sequence[str] = SURVEY_SEGMENTS,
    ages: dict[str, str] | None = None,
    **options,
) -> DataFrame:
    """Metric, age bands, day, selection and imputation. Identifiers are text and stay out of the distance.

    `key` orders rows at equal distance in the imputation; `options` are those of `fill_missing`.
    """
    ages = AGE_COLUMNS if ages is None else ages
    banded = with_satisfaction(df).withColumns({out: age_band(c) for c, out in ages.items()})
    return _prepare(banded, [*segments, *ages.values(), "nps"], key, ts, options)


def prepare_inquiry(
    df: DataFrame,
    key: Sequence[str] = ROW_KEY,
    ts: str = "snap_date",
    segments: Sequence[str] = INQUIRY_SEGMENTS,
    **options,
) -> DataFrame:
    """Day, selection and imputation of the inquiry table."""
    return _prepare(df, list(segments), key, ts, options)


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with its rows and gaps counted on the way of the next action."""
    found = Observation(name)
    return df.observe(found, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)]), found


def write_prepared(df: DataFrame, prepare: Callable[[DataFrame], DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """Write what `prepare` makes of a table; the stored result, and (stage, column, n_rows, n_null, n_columns) before and after.

    The counts are gathered while the table is read and written, so they cost no scan of their own.
    """
    spark = df.sparkSession
    source, before = _observed(df, "before")
    result, after = _observed(prepare(source), "after")
    result.write.mode("overwrite").parquet(path)
    rows = []
    for stage, seen, columns in (("before", before.get, df.columns), ("after", after.get, result.columns)):
        rows += [(stage, c, seen["n_rows"], seen[f"_{i}"], len(columns)) for i, c in enumerate(columns)]
    report = spark.createDataFrame(rows, "stage string, column string, n_rows long, n_null long, n_columns long")
    return spark.read.schema(result.schema).parquet(path), report
