"""Schemas of the fact, dimension and result tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LONG, INT, TEXT, DAY, MOMENT, DOUBLE = (
    LongType(),
    IntegerType(),
    StringType(),
    DateType(),
    TimestampType(),
    DoubleType(),
)
AMOUNT, DEGREES, WEIGHT = DecimalType(38, 10), DecimalType(13, 10), DecimalType(4, 2)


def _table(required: str = "", **columns: DataType) -> StructType:
    return StructType([StructField(n, t, n != required) for n, t in columns.items()])


SURVEY_FIXED = _table(
    required="snap_date",
    sk_subs_id=LONG,
    mnco_group_id=LONG,
    os_os_id=LONG,
    filial_id=LONG,
    snap_date=MOMENT,
    snap_week=INT,
    snap_month=INT,
    snap_quarter=INT,
    survey_day=INT,
    survey_time_group=TEXT,
    survey_weekday=TEXT,
    survey_weekday_type=TEXT,
    survey_age=INT,
    survey_operator_age=INT,
    survey_gender=TEXT,
    survey_operator_gender=TEXT,
    survey_arpu_group=TEXT,
    survey_city_size=TEXT,
    ans=INT,
    value_1=DOUBLE,
    value_2=DOUBLE,
    value_3=DOUBLE,
    value_4=DOUBLE,
)


def survey_raw(segments: Iterable[str]) -> StructType:
    """Survey fact: the fixed columns and one text column per further segment."""
    more = [StructField(s, TEXT) for s in segments if s not in SURVEY_FIXED.fieldNames()]
    return StructType([*SURVEY_FIXED.fields, *more])


INQUIRY_SOURCE = _table(
    required="create_date",
    create_date=MOMENT,
    comp_os_id=LONG,
    billing_filial_id=LONG,
    itpc_itpc_id=LONG,
    sk_subs_id=LONG,
    sk_bmt_id=LONG,
    subs_os_os_id=LONG,
    cr_os_os_id=LONG,
    inqr_id=LONG,
    lat=DEGREES,
    lon=DEGREES,
    description=TEXT,
    crcat_crcat_id=LONG,
    cr_weight=WEIGHT,
)
TOPIC_HISTORY = _table(
    itpc_id=LONG,
    billing_filial_id=LONG,
    start_date=DAY,
    end_date=DAY,
    code_level_1=TEXT,
    code_level_2=TEXT,
    code_level_3=TEXT,
    code_level_4=TEXT,
    full_name=TEXT,
)
SUBSCRIBER_SNAPSHOT = _table(
    sk_subs_id=LONG, snap_date=DAY, filial_id=LONG, subs_subs_id=LONG, subcat_pyramid_id_3m=LONG
)
PYRAMID_CATEGORY = _table(subcat_pyramid_id=LONG, subcat_pyramid_name=TEXT, cat_pyramid_name=TEXT)
CELLS = _table(sk_bmt_id=LONG, os_os_id=LONG, end_date=MOMENT)
ORGANISATIONS = _table(os_os_id=LONG, ro=TEXT, end_date=MOMENT)
CHARGES = _table(
    sk_subs_id=LONG,
    billing_filial_id=LONG,
    start_date=DAY,
    detg_detg_id=LONG,
    lcal_lcal_id=LONG,
    vas_vas_id=LONG,
    amount=AMOUNT,
    revenue=AMOUNT,
)
INQUIRY_DAILY = _table(
    required="snap_date",
    comp_os_id=LONG,
    billing_filial_id=LONG,
    itpc_itpc_id=LONG,
    sk_subs_id=LONG,
    snap_date=DAY,
    snap_week=DAY,
    snap_month=DAY,
    snap_quarter=DAY,
    sk_bmt_id=LONG,
    subs_os_os_id=LONG,
    cr_os_os_id=LONG,
    inqr_id=LONG,
    lat=DEGREES,
    lon=DEGREES,
    description=TEXT,
    crcat_crcat_id=LONG,
    cr_weight=WEIGHT,
    code_level_1=TEXT,
    code_level_2=TEXT,
    code_level_3=TEXT,
    code_level_4=TEXT,
    full_name=TEXT,
    flag_local_general=LONG,
    filial_id=LONG,
    subcat_pyramid_name=TEXT,
    cat_pyramid_name=TEXT,
    subs_subs_id=LONG,
)
VAS_MEASURES = (
    "product_perepl_mn",
    "product_perepl_gor",
    "product_perepl_oper",
    "product_perepl_sms",
    "product_uderzh",
    "product_kz",
    "product_gpya",
    "product_zkz",
)
VAS_USAGE = _table(
    required="snap_date", sk_subs_id=LONG, snap_date=DAY, snap_month=DAY, **{m: AMOUNT for m in VAS_MEASURES}
)
SIGNIFICANT = _table(
    required="day",
    day=DAY,
    metric=DOUBLE,
    total_count=LONG,
    delta_all=DOUBLE,
    segment=TEXT,
    ml_group=TEXT,
    z_group=TEXT,
    group=TEXT,
)
SCORED = _table(
    required="day",
    day=DAY,
    segment=TEXT,
    group=TEXT,
    metric=DOUBLE,
    n_values=LONG,
    delta=DOUBLE,
    z_score=DOUBLE,
    depth=DOUBLE,
    ml_anomaly=BooleanType(),
    contribution=DOUBLE,
)

# Period tables are partitioned by this column, so a period reload touches its own days only.
PARTITION_DAY = "snap_date"
