"""Profiles taken before judging a source: schema, domains, cohorts, money residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs, rounded
from tripgauge.functions.scales import banded, text
from tripgauge.operators.quantiles import distribution
from tripgauge.operators.rules import MONEY_PARTS, money_parts, parse_trip

# fixed values: the names under which column types are reported
TYPE_NAMES: dict[str, str] = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_name(dtype: T.DataType) -> str:
    name = dtype.simpleString()
    return TYPE_NAMES.get(name, name.upper())


def describe_columns(df: DataFrame) -> DataFrame:
    """Column, type, rows and missing cells; all columns are counted in one pass."""
    fields = list(enumerate(df.schema.fields))
    one = df.selectExpr("count(1) AS rows", *[f"count(`{f.name}`) AS have_{i}" for i, f in fields])
    rows = ", ".join(
        f"named_struct('column_name', {text(f.name)}, 'column_type', '{type_name(f.dataType)}', "
        f"'rows', rows, 'nulls', rows - have_{i})" for i, f in fields)
    return one.selectExpr(f"inline(array({rows}))")


def domain_profile(df: DataFrame, columns: Sequence[str] = ("ratecodeid", "vendorid",
                                                            "payment_type"),
                   k: int = 12) -> DataFrame:
    """The k most frequent combinations; equal counts go by the values themselves."""
    return (
        df.groupBy(*columns).agg(*exprs("count(1) AS trips"))
        .orderBy(F.desc("trips"), *[F.asc_nulls_first(c) for c in columns]).limit(k)
    )


def missing_metadata_cohort(df: DataFrame) -> DataFrame:
    """Rows without a rate code: how many there are and whether they look like trips."""
    cohort = parse_trip(df).where("t_ratecode IS NULL").selectExpr(
        "1 AS _all", "t_seconds / 60D AS _minutes", "t_distance", "t_fare", "t_airport_fee",
        "t_congestion")
    p50 = distribution(cohort, ["_all"], "_minutes", {"p50": 0.5}).select("_all", "p50")
    sums = cohort.selectExpr(
        "1 AS _all", "count(1) AS rows",
        f"{rounded('avg(t_distance)', 2)} AS avg_distance_mi",
        f"{rounded('avg(t_fare)', 2)} AS avg_fare",
        "count_if(t_airport_fee IS NULL) AS null_airport_fee",
        "count_if(t_congestion IS NULL) AS null_congestion_fee")
    return sums.join(p50, "_all", "left").selectExpr(
        "rows", "avg_distance_mi", f"{rounded('p50', 1)} AS p50_min", "avg_fare",
        "null_airport_fee", "null_congestion_fee")


def residual_bands(df: DataFrame, contract: Contract) -> DataFrame:
    """How far totals are from their parts. Here every missing part counts as 0."""
    gap = f"abs(t_total - {money_parts(set(MONEY_PARTS))})"
    return (
        parse_trip(df).selectExpr(f"{banded(gap, contract.residual_bands)} AS residual_band")
        .groupBy("residual_band").agg(*exprs("count(1) AS trips"))
    )
