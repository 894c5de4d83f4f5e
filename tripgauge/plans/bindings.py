"""The driver tables seen as trips, in the 19 source columns the contract knows.

``Events``: one event is one trip, its period the ISO week, its minutes the event value.
``Fulfilment``: one order line is one trip from customer to supplier nation, picked up at the
order date and dropped off at the ship date, with unreadable and missing cells as a real
source has them.

Every step is a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs, period_label
from tripgauge.operators import facts as facts_op
from tripgauge.operators import integrity, quality, ruler, rules
from tripgauge.sources.tables import FOLDER, MONTH_OF_FOLDER, in_month_order

EVENTS_CONTRACT = Contract(
    period_unit="week",
    distance_max_miles=97.0,
    slow_speed_mph=6.0,
    min_zone_trips=5,
    distance_bands=((20.0, "a_0-20"), (40.0, "b_20-40"), (60.0, "c_40-60"), (80.0, "d_60-80"),
                    (None, "e_80_plus")),
)
EVENTS_BASELINE = "2024-01-01"

FULFILMENT_CONTRACT = Contract(
    max_zone_id=24,
    unresolved_zone_ids=(23, 24),
    airport_zone_ids=(1, 13),
    duration_max_seconds=1500 * 86_400,
    distance_max_miles=45.0,
)

# what all lines of an order share and takes long to format: the month that they claim and the pickup cell
OF_ORDER = (
    "date_format(CASE WHEN o_orderkey % 50 = 0 THEN add_months(CAST(o_orderdate AS DATE), 1) "
    "ELSE CAST(o_orderdate AS DATE) END, 'yyyy-MM') AS claimed_month",
    "CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-timestamp' ELSE CAST(o_orderdate AS STRING) END AS pickup_cell",
)

# order lines that one task joins with their orders, some 100 to 200 MB in a sort and a hash table
LINES_PER_TASK = 500_000


class Events:
    contract = EVENTS_CONTRACT
    baseline = EVENTS_BASELINE

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def as_trips(events: DataFrame) -> DataFrame:
        """Events in the source columns. All money columns are plain, all ids derived."""
        seconds = "make_dt_interval(0, 0, 0, CAST(value * 60D AS DECIMAL(18,6)))"
        return events.selectExpr(
            f"{period_label('ts', 'week')} AS month",
            "event_id % 2 + 1 AS vendorid",
            "ts AS tpep_pickup_datetime",
            f"ts + {seconds} AS tpep_dropoff_datetime",
            "event_id % 6 + 1 AS passenger_count",
            "CAST(get_json_object(props, '$.k') AS DOUBLE) AS trip_distance",
            "event_id % 6 + 1 AS ratecodeid",
            "'N' AS store_and_fwd_flag",
            "CASE event_type WHEN 'click' THEN 1L WHEN 'view' THEN 2L WHEN 'purchase' THEN 3L "
            "WHEN 'signup' THEN 4L ELSE 5L END AS payment_type",
            "value AS fare_amount",
            "0.5D AS extra",
            "0.5D AS mta_tax",
            "0D AS tip_amount",
            "0D AS tolls_amount",
            "1D AS improvement_surcharge",
            "0D AS airport_fee",
            "2.5D AS congestion_surcharge",
            "value + 4.5D AS total_amount",
            "user_id % 265 + 1 AS pulocationid",
            "event_id % 265 + 1 AS dolocationid",
        )

    @cached_property
    def raw(self) -> DataFrame:
        return self.as_trips(self.table("events"))

    @cached_property
    def staged(self) -> DataFrame:
        return rules.stage(self.raw, self.contract)

    @cached_property
    def counts(self) -> DataFrame:
        return quality.period_counts(self.staged)

    @cached_property
    def facts(self) -> DataFrame:
        return facts_op.facts_of(rules.passing(self.raw, self.contract), self.contract)

    @cached_property
    def ruler(self) -> DataFrame:
        return ruler.build_ruler(self.facts, self.baseline, self.contract)

    @cached_property
    def scored(self) -> DataFrame:
        return ruler.score(self.facts, self.ruler)

    @cached_property
    def manifest(self) -> DataFrame:
        """Rows per period counted on the source itself, before any rule."""
        return self.raw.groupBy("month").agg(*exprs("count(1) AS row_count"))

    @property
    def provenance(self) -> DataFrame:
        return self.provenance_of(self.raw)

    def provenance_of(self, raw: DataFrame) -> DataFrame:
        return integrity.duplicate_audit(raw).selectExpr(
            "month", "rows AS api_count", "duplicates AS composite_key_duplicates")

    def zone_lookup(self) -> DataFrame:
        """Nations stand in for zone names, their regions for boroughs."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "CAST(n_nationkey + 1 AS BIGINT) AS pickup_zone_id", "n_name AS pickup_zone",
            "r_name AS borough")


class Fulfilment:
    contract = FULFILMENT_CONTRACT

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def parts(self) -> int | None:
        """Partitions in which lines and orders meet, by the lines that the files' footers count.

        None where Spark's own partitions, at least one per core, hold no more lines. Past that they
        would grow with the input up to Spark's advised bytes, and a line takes many times the bytes
        in a sort or a hash table that it takes in a shuffle.
        """
        parts = -(-self.table("lineitem").count() // LINES_PER_TASK)
        return parts if parts > self.spark.sparkContext.defaultParallelism else None

    @staticmethod
    def _with_order(lines: DataFrame, orders: DataFrame, parts: int | None) -> DataFrame:
        """Lines and orders both grow with the data, so they always meet by a shuffle on the order key.
        With ``parts``, what a task holds of them does not grow; Spark's shuffle partitions are taken
        where they are more."""
        if parts:
            lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
        return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    def _lines(self, parts: int | None) -> DataFrame:
        """Order lines with their order and both nations.

        The shuffle of lines and orders also spreads the rules over all tasks, however few files the
        lines lie in. Customers join the orders before that, so that lines are never shuffled by
        customer. Customers and suppliers are Spark's call.
        """
        orders = self.table("orders").join(
            self.table("customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey")).selectExpr("*", *OF_ORDER)
        return self._with_order(self.table("lineitem"), orders, parts).join(
            self.table("supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"))

    @cached_property
    def lines(self) -> DataFrame:
        return self._lines(self.parts)

    @cached_property
    def raw(self) -> DataFrame:
        return self.as_trips(self.lines)

    @cached_property
    def raw_by_folder(self) -> DataFrame:
        """The same rows in as few partitions as Spark advises, for tables by month: each task that
        writes one leaves a file for every month that it met. They come in the order of their folders,
        sorted as lines, which are a fraction of a staged row."""
        return self.as_trips(in_month_order(self._lines(None), "claimed_month"), MONTH_OF_FOLDER, FOLDER)

    @cached_property
    def raw_for_months(self) -> DataFrame:
        return self.raw_by_folder.drop(FOLDER)

    @staticmethod
    def as_trips(lines: DataFrame, month: str = "claimed_month", *kept: str) -> DataFrame:
        bare = "l_partkey % 31 = 0"  # the cohort without metadata
        fare = "CASE WHEN l_partkey % 41 = 0 THEN -l_extendedprice ELSE l_extendedprice END"
        airport = f"CASE WHEN NOT {bare} THEN l_discount * 10D END"
        congestion = f"CASE WHEN NOT {bare} THEN 2.5D END"
        gap = "CASE l_linenumber WHEN 5 THEN 1.75D WHEN 6 THEN 3.25D WHEN 7 THEN 7.5D ELSE 0D END"
        total = (f"{fare} + l_discount + 0.5D + l_tax + 0D + 1D + coalesce({airport}, 0D) "
                 f"+ coalesce({congestion}, 0D) + {gap}")
        line = "CAST(l_linenumber AS BIGINT)"
        return lines.selectExpr(
            *kept,
            f"{month} AS month",
            "l_orderkey AS order_key",
            f"{line} AS line_number",
            f"{line} AS vendorid",
            "pickup_cell AS tpep_pickup_datetime",
            "CAST(l_shipdate AS STRING) AS tpep_dropoff_datetime",
            f"CASE WHEN NOT {bare} THEN concat(CAST(l_linenumber AS STRING), '.0') END "
            "AS passenger_count",
            "l_quantity AS trip_distance",
            f"CASE WHEN {bare} THEN NULL WHEN l_suppkey % 13 = 0 THEN 99L ELSE {line} END "
            "AS ratecodeid",
            f"CASE WHEN {bare} THEN NULL WHEN l_returnflag = 'A' THEN 'y' ELSE l_returnflag END "
            "AS store_and_fwd_flag",
            f"CASE WHEN {bare} THEN '0' ELSE substring(o_orderpriority, 1, 1) END "
            "AS payment_type",
            f"{fare} AS fare_amount",
            "l_discount AS extra",
            "0.5D AS mta_tax",
            "CASE WHEN l_partkey % 53 <> 0 THEN l_tax END AS tip_amount",
            "0D AS tolls_amount",
            "1D AS improvement_surcharge",
            f"{airport} AS airport_fee",
            f"{congestion} AS congestion_surcharge",
            f"{total} AS total_amount",
            "CAST(c_nationkey AS BIGINT) AS pulocationid",
            "CAST(s_nationkey AS BIGINT) AS dolocationid",
        )

    @cached_property
    def staged(self) -> DataFrame:
        return rules.stage(self.raw, self.contract)

    @cached_property
    def counts(self) -> DataFrame:
        return quality.period_counts(self.staged)

    @cached_property
    def rule_results(self) -> DataFrame:
        return quality.rule_results(self.counts, self.contract)

    @cached_property
    def facts(self) -> DataFrame:
        return facts_op.facts_of(rules.passing(self.raw, self.contract), self.contract)

    @cached_property
    def manifest(self) -> DataFrame:
        """Rows, and bytes of the time cells as they were landed."""
        landed = "octet_length(tpep_pickup_datetime) + octet_length(tpep_dropoff_datetime)"
        return self.raw.groupBy("month").agg(*exprs(
            "count(1) AS row_count", f"sum({landed}) AS bytes"))

    @property
    def provenance(self) -> DataFrame:
        return self.provenance_of(self.raw)

    def provenance_of(self, raw: DataFrame) -> DataFrame:
        """What a source would have promised: rows per true order month, next to the duplicates
        found among the rows that claim the month."""
        dated = self._with_order(self.table("lineitem").select("l_orderkey"),
                                 self.table("orders").select("o_orderkey", "o_orderdate"), self.parts)
        promised = dated.groupBy(
            F.expr(f"{period_label('o_orderdate', 'month')} AS month")
        ).agg(*exprs("count(1) AS api_count"))
        audit = integrity.duplicate_audit(
            raw, ("tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid",
                       "dolocationid"))
        return audit.selectExpr("month", "duplicates AS composite_key_duplicates").join(
            promised, "month", "left")

    @cached_property
    def order_windows(self) -> DataFrame:
        return integrity.month_windows(self.table("orders").selectExpr(
            "min(o_orderdate) AS first", "max(o_orderdate) AS last"))
