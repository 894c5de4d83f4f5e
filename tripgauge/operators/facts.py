"""The trip fact table: valid rows with every derived field computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs
from tripgauge.functions.scales import distance_band, time_bucket
from tripgauge.operators.rules import parse_trip, valid

# fact column -> rule outcome that travels with the row
CARRIED_FLAGS = {
    "passenger_plausible": "r07_ok",
    "money_non_negative": "r08_ok",
    "total_matches_components": "r09_ok",
    "ratecode_known": "r10_ok",
    "payment_known": "r13_ok",
    "pickup_zone_resolved": "r14_ok",
}


def fact_trips(staged: DataFrame, contract: Contract) -> DataFrame:
    """One row per valid trip of the staged table."""
    return facts_of(parse_trip(valid(staged)), contract)


def facts_of(rows: DataFrame, contract: Contract) -> DataFrame:
    """Facts of rows known to be valid that carry the parsed columns and rule outcomes."""
    hour = "CAST(hour(t_pickup) AS BIGINT)"
    dow = "CAST(dayofweek(t_pickup) - 1 AS BIGINT)"  # Sunday is 0
    return rows.selectExpr(
        "month",
        "t_pickup AS pickup_ts",
        "t_dropoff AS dropoff_ts",
        "t_seconds / 60D AS duration_min",
        "t_distance AS distance_mi",
        "t_passengers AS passenger_count",
        "t_ratecode AS ratecode_id",
        "t_payment AS payment_type",
        "t_vendor AS vendor_id",
        "t_flag AS store_and_fwd",
        "t_fare AS fare_amount",
        "t_tip AS tip_amount",
        "t_total AS total_amount",
        "t_airport_fee AS airport_fee",
        "t_congestion AS congestion_surcharge",
        "t_pickup_zone AS pickup_zone_id",
        "t_dropoff_zone AS dropoff_zone_id",
        f"{hour} AS hour",
        f"{dow} AS day_of_week",
        "try_divide(t_distance, t_seconds / 3600D) AS speed_mph",
        f"{distance_band('t_distance', contract)} AS distance_band",
        f"{dow} IN (0, 6) AS is_weekend",
        *[f"{ok} AS {name}" for name, ok in CARRIED_FLAGS.items()],
        f"{time_bucket(hour, contract)} AS time_bucket",
    )


def scoped_to(facts: DataFrame, months: DataFrame) -> DataFrame:
    """Facts of the validated months only, so a stale partition never reaches a number.

    A semi join on the partition column: the scan is pruned to those months at run time.
    """
    return facts.join(months.select("month").distinct(), "month", "left_semi")


def period_extent(facts: DataFrame) -> DataFrame:
    return facts.groupBy("month").agg(*exprs(
        "count(1) AS fact_rows", "min(pickup_ts) AS first_pickup", "max(pickup_ts) AS last_pickup"
    ))
