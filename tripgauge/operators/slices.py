"""Where the time goes: hours, zones, segments, exemplars and the mix adjustment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs, rounded
from tripgauge.functions.scales import id_list, number, segment
from tripgauge.operators.metrics import P50_P90, rounded_quantiles
from tripgauge.operators.quantiles import distribution
from tripgauge.operators.ruler import score, slow


def _slice(scored: DataFrame, keys: list[str], contract: Contract, slow_name: str) -> DataFrame:
    return rounded_quantiles(distribution(
        scored, keys, "duration_min", P50_P90,
        {slow_name: slow(contract), "trip_time_reliability": "on_time"}))


def hourly_detail(scored: DataFrame, contract: Contract) -> DataFrame:
    return _slice(scored, ["month", "hour"], contract, "slow_share")


def zone_detail(scored: DataFrame, lookup: DataFrame, contract: Contract) -> DataFrame:
    """Per period and pickup zone, named from ``lookup(pickup_zone_id, pickup_zone, borough)``."""
    zones = _slice(scored.where("pickup_zone_id >= 1"), ["month", "pickup_zone_id"], contract,
                   "slow_trip_share")
    return _named_zones(zones, lookup, contract)


def _named_zones(zones: DataFrame, lookup: DataFrame, contract: Contract) -> DataFrame:
    """Names are joined after the aggregation, when a period has one row per zone."""
    return zones.join(lookup, "pickup_zone_id", "left").selectExpr(
        "month", "pickup_zone_id", "pickup_zone", "borough",
        f"pickup_zone_id IN ({id_list(contract.airport_zone_ids)}) AS airport_zone",
        "trips", *P50_P90, "slow_trip_share", "trip_time_reliability",
        f"trips >= {int(contract.min_zone_trips)} AS rankable")


def segments(scored: DataFrame, contract: Contract) -> DataFrame:
    labelled = scored.selectExpr("*", f"{segment('pickup_zone_id', contract)} AS segment")
    return _with_share(_slice(labelled, ["month", "segment"], contract, "slow_trip_share"))


def _with_share(segments_of: DataFrame) -> DataFrame:
    return segments_of.selectExpr(
        "*", "CAST(trips AS DOUBLE) / CAST(sum(trips) OVER (PARTITION BY month) AS DOUBLE) "
             "AS share_of_trips")


def all_slices(facts: DataFrame, ruler: DataFrame, contract: Contract) -> DataFrame:
    """(slice, month, key, trips, quantiles, slow_trip_share, trip_time_reliability) of periods,
    hours, zones and segments together.

    Each trip stands once per slice it belongs to, as in grouping sets, and equal trips of a slice
    meet before the shuffle, so all tables come from one exchange of the facts. Trips without a cell
    of the ruler count for their period only.
    """
    known = "expected_duration_min IS NOT NULL"
    places = ", ".join([
        "named_struct('slice', 'month', 'key', CAST(NULL AS STRING))",
        f"CASE WHEN {known} THEN named_struct('slice', 'hour', 'key', CAST(hour AS STRING)) END",
        f"CASE WHEN {known} AND pickup_zone_id >= 1 THEN named_struct('slice', 'zone', 'key', CAST(pickup_zone_id AS STRING)) END",
        f"CASE WHEN {known} THEN named_struct('slice', 'segment', 'key', {segment('pickup_zone_id', contract)}) END"])
    rows = score(facts, ruler, "left").selectExpr(
        "month", "duration_min", "speed_mph", "on_time", f"explode(array_compact(array({places}))) AS place").selectExpr(
        "place.slice AS slice", "month", "place.key AS key", "duration_min", "speed_mph", "on_time")
    return _slice(rows, ["slice", "month", "key"], contract, "slow_trip_share")


def slice_tables(slices_of: DataFrame, lookup: DataFrame, contract: Contract) -> dict[str, DataFrame]:
    """The monthly, hourly, zone and segment tables out of ``all_slices``."""
    def part(name: str, key: str, *more: str) -> DataFrame:
        return slices_of.where(F.col("slice") == name).selectExpr("month", key, *more)

    measures = [*P50_P90, "slow_trip_share", "trip_time_reliability"]
    monthly = slices_of.where("slice = 'month' AND trip_time_reliability IS NOT NULL").select("month", *measures)
    zones = part("zone", "CAST(key AS BIGINT) AS pickup_zone_id", "trips", *measures)
    return {
        "monthly": monthly,
        "hourly": part("hour", "CAST(key AS BIGINT) AS hour", "trips", *P50_P90, "slow_trip_share AS slow_share", "trip_time_reliability"),
        "zones": _named_zones(zones, lookup, contract),
        "segments": _with_share(part("segment", "key AS segment", "trips", *measures)),
    }


def _top_of_last_period(table: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of the last period of a result table.

    Sorted by period first, the k leading rows hold every row wanted; rows of an earlier
    period are among them only when the last one has fewer than k, and are dropped.
    """
    top = table.orderBy(F.desc("month"), *order).limit(k)
    return top.selectExpr("*", "max(month) OVER () AS _last").where("month = _last").drop("_last")


def worst_hours(hourly: DataFrame, k: int = 3) -> DataFrame:
    """The k hours of the last period with the highest slow share; equal shares go by hour."""
    return _top_of_last_period(hourly, k, F.desc("slow_share"), F.asc("hour"))


def worst_zones(zones: DataFrame, k: int = 5) -> DataFrame:
    """The k rankable zones of the last period with the lowest reliability, ties by zone id."""
    return _top_of_last_period(
        zones, k, F.desc("rankable"), F.asc("trip_time_reliability"), F.asc("pickup_zone_id")
    ).where("rankable")


def zone_map_feed(zones: DataFrame) -> DataFrame:
    """Zone and reliability for the map; zones with too few trips stay blank."""
    return zones.where("rankable").select("month", "pickup_zone_id", "trip_time_reliability")


def latest(df: DataFrame) -> DataFrame:
    """Rows of the last period that there is. Periods sort as text."""
    last = df.select(F.max("month").alias("last_month"))
    return df.join(last, F.col("month") == F.col("last_month"), "left_semi")


def exemplar_trips(facts: DataFrame, typical_min: float = 13.0) -> DataFrame:
    """The fastest, a typical and the slowest trip: three running extremes, no sort.

    Ties are decided by the remaining fields, and a trip that earns two titles keeps the first.
    """
    trip = ("struct(pickup_zone_id, pickup_ts, dropoff_ts, duration_min, distance_mi, speed_mph, "
            "distance_band, time_bucket)")
    ties = "pickup_ts, dropoff_ts, pickup_zone_id, dropoff_zone_id, distance_mi"
    titles = {
        "fastest": "duration_min",
        "typical": f"abs(duration_min - {number(typical_min)})",
        "slowest": "-duration_min",
    }
    picks = facts.selectExpr(*[f"min_by({trip}, struct({by}, {ties})) AS {title}"
                               for title, by in titles.items()])
    rows = ", ".join(f"named_struct('ord', {i}, 'pick', '{title}', 'trip', {title})"
                     for i, title in enumerate(titles))
    return (
        picks.selectExpr(f"inline(array({rows}))").where("trip IS NOT NULL")
        .groupBy("trip").agg(*exprs("min(struct(ord, pick)).pick AS pick"))
        .selectExpr(
            "trip.pickup_zone_id", "trip.pickup_ts", "trip.dropoff_ts",
            f"{rounded('trip.duration_min', 1)} AS duration_min", "trip.distance_mi",
            f"{rounded('trip.speed_mph', 1)} AS speed_mph", "trip.distance_band",
            "trip.time_bucket", "pick")
    )


def mix_adjusted(facts: DataFrame, scored: DataFrame, baseline: str) -> DataFrame:
    """Each period's reliability with the baseline's mix of distance bands, and the gap.

    Period and band rates are one small table; the published rate is rolled up from it. A
    band that a period has no trip in adds nothing.
    """
    per_band = scored.groupBy("month", "distance_band").agg(*exprs(
        "count(1) AS n", "count_if(on_time) AS hits"))
    # a row per distance band of the contract, whatever the number of trips
    mix = facts.where(F.col("month") == baseline).groupBy("distance_band").agg(
        *exprs("count(1) AS base_n"))
    weight = mix.selectExpr("distance_band", "base_n / sum(base_n) OVER () AS weight")
    return (
        per_band.join(F.broadcast(weight), "distance_band", "left")
        .groupBy("month").agg(*exprs(
            "coalesce(sum(hits / n * weight), 0D) AS adjusted",
            "sum(hits) / sum(n) AS trip_time_reliability"))
        .selectExpr(
            "month", f"{rounded('adjusted', 9)} AS mix_adjusted", "trip_time_reliability",
            # adding zero turns a gap of -0.0 into 0.0
            f"{rounded('(trip_time_reliability - adjusted) * 100D', 6)} + 0D AS gap_pts")
    )


def largest_gap(adjusted: DataFrame) -> DataFrame:
    return adjusted.selectExpr("max(abs(gap_pts)) AS largest_gap_pts")
