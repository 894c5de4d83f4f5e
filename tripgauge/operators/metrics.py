"""The published metrics per period: M1 to M5, wide, long and pivoted."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs, rounded, rounded_decimal, share
from tripgauge.operators.quality import period_coverage
from tripgauge.operators.quantiles import distribution
from tripgauge.operators.ruler import score, slow

P50_P90 = {"duration_p50_min": 0.50, "duration_p90_min": 0.90}

# metric register: field of the wide table -> id, name, grain, formula, link to the KPI
# fixed values: fields, ids, names and grains
METRIC_REGISTER: tuple[tuple[str, str, str, str, str, str], ...] = (
    ("valid_trip_rate", "M1", "valid_trip_rate", "month",
     "valid rows / raw rows", "gates the KPI"),
    ("trip_time_reliability", "M2", "trip_time_reliability", "month",
     "share of valid trips within the expected minutes of their cell", "is the KPI"),
    ("duration_p50_min", "M3", "trip_duration_typical", "month (detail by hour)",
     "median and 90th percentile of minutes", "explains the KPI"),
    ("duration_p90_min", "M3b", "trip_duration_typical_p90", "month (detail by hour)",
     "median and 90th percentile of minutes", "explains the KPI"),
    ("invalid_trip_rate", "M4", "invalid_trip_rate", "month",
     "quarantined rows / raw rows", "protects the denominator of the KPI"),
    ("slow_trip_share", "M5", "slow_trip_share", "month (detail by hour)",
     "share of valid trips slower than the slow speed", "drives the KPI"),
)
_INVALID = rounded_decimal("1D - coverage", 6)


def rounded_quantiles(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"{rounded(c, 2)} AS {c}" if c in P50_P90 else f"`{c}`"
                           for c in df.columns])


def valid_rate(counts: DataFrame) -> DataFrame:
    return period_coverage(counts).selectExpr("month", "coverage AS valid_trip_rate")


def invalid_rate(counts: DataFrame) -> DataFrame:
    return period_coverage(counts).selectExpr("month", f"{_INVALID} AS invalid_trip_rate")


def duration_typical(facts: DataFrame) -> DataFrame:
    """M3 and M3b: every valid trip counts, whether or not the ruler has its cell."""
    return rounded_quantiles(
        distribution(facts, ["month"], "duration_min", P50_P90).select("month", *P50_P90))


def slow_share(facts: DataFrame, contract: Contract) -> DataFrame:
    return facts.groupBy("month").agg(*exprs(f"{share(slow(contract))} AS slow_trip_share"))


def monthly_facts(facts: DataFrame, ruler: DataFrame, contract: Contract) -> DataFrame:
    """M2, M3, M3b and M5 in one pass over the facts.

    The ruler is joined from the left, so unscored trips still count for M3 and M5; a period
    without a single scored trip has no M2 and is left out.
    """
    per_month = distribution(
        score(facts, ruler, "left"), ["month"], "duration_min", P50_P90,
        {"slow_trip_share": slow(contract), "trip_time_reliability": "on_time"})
    return rounded_quantiles(
        per_month.where("trip_time_reliability IS NOT NULL").drop("trips"))


def metrics_wide(counts: DataFrame, facts: DataFrame, ruler: DataFrame, contract: Contract
                 ) -> DataFrame:
    return wide_of(counts, monthly_facts(facts, ruler, contract))


def wide_of(counts: DataFrame, monthly: DataFrame) -> DataFrame:
    """Rates from the contract's counts beside the metrics of the facts, a row per period of both."""
    rates = period_coverage(counts).selectExpr(
        "month", "coverage AS valid_trip_rate", f"{_INVALID} AS invalid_trip_rate",
        "total_rows AS raw_rows", "valid_rows", "quarantined_rows")
    return rates.join(monthly, "month")


def metrics_long(wide: DataFrame) -> DataFrame:
    """One row per period and metric, with the register's description.

    The register is a handful of literals: unfolded beside each row it needs no join.
    """
    entries = ", ".join(
        f"named_struct('metric_id', '{mid}', 'metric_name', '{name}', "
        f"'value', {rounded_decimal(field, 6)}, 'grain', '{grain}', 'formula', '{formula}', "
        f"'kpi_link', '{link}')"
        for field, mid, name, grain, formula, link in METRIC_REGISTER)
    return wide.selectExpr("month", f"inline(array({entries}))")


def metrics_pivot(long: DataFrame) -> DataFrame:
    names = [m[2] for m in METRIC_REGISTER]
    return long.groupBy("month").pivot("metric_name", names).avg("value")
