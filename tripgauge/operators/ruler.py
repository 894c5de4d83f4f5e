"""The expected-duration ruler and scoring against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs, rounded, share
from tripgauge.functions.scales import number
from tripgauge.operators.quantiles import distribution
from tripgauge.operators.rules import passes

CELL = ["distance_band", "time_bucket"]


def build_ruler(facts: DataFrame, baseline: str, contract: Contract, weight: str = "1L") -> DataFrame:
    """Expected minutes per distance band and time of day, learnt on the baseline period.

    A row stands for ``weight`` trips, so the facts may be a histogram of durations.

    Scoring compares with the published value, which has two decimals.
    """
    cells = distribution(
        facts.where(F.col("month") == baseline), CELL, "duration_min",
        {"expected_duration_min": contract.ruler_percentile}, rows="baseline_trips", weight=weight)
    return cells.selectExpr(
        *CELL, f"{rounded('expected_duration_min', 2)} AS expected_duration_min",
        "baseline_trips")


def score(facts: DataFrame, ruler: DataFrame, how: str = "inner") -> DataFrame:
    """Facts with the expected minutes of their cell and ``on_time``.

    With ``how='inner'`` trips of a cell the baseline has no trip in are dropped; with
    ``'left'`` they stay, with ``on_time`` unknown. The ruler has at most
    ``contract.ruler_cells`` rows, so it is broadcast whatever the size of the facts.
    """
    on_time = passes("duration_min <= expected_duration_min")
    return facts.join(
        F.broadcast(ruler.select(*CELL, "expected_duration_min")), CELL, how
    ).selectExpr("*", f"CASE WHEN expected_duration_min IS NOT NULL THEN {on_time} END AS on_time")


def slow(contract: Contract) -> str:
    return passes(f"speed_mph < {number(contract.slow_speed_mph)}")


def unscored(facts: DataFrame, ruler: DataFrame) -> DataFrame:
    """Per period, the trips no cell of the ruler applies to."""
    return (
        facts.join(F.broadcast(ruler.select(*CELL)), CELL, "left_anti")
        .groupBy("month").agg(*exprs("count(1) AS unscored_trips"))
    )


def reliability(scored: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    return scored.groupBy(*by).agg(*exprs(f"{share('on_time')} AS trip_time_reliability"))


def ruler_grid(ruler: DataFrame, contract: Contract) -> DataFrame:
    """Band by bucket grid; the buckets are known, so no extra pass looks for them."""
    buckets = [label for _, label in contract.time_buckets]
    return ruler.groupBy("distance_band").pivot("time_bucket", buckets).agg(
        F.first("expected_duration_min"))


def fairness(scored: DataFrame, baseline: str, contract: Contract) -> DataFrame:
    """The baseline period must score about its own percentile."""
    rate = share("on_time")
    return scored.where(F.col("month") == baseline).selectExpr(
        f"'{baseline}' AS month", "count(1) AS trips", f"{rate} AS trip_time_reliability",
        f"abs({rate} - {number(contract.ruler_percentile)}) <= "
        f"{number(contract.fairness_tolerance)} AS fair")
