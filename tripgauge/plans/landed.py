"""Queries that write the driver tables in the formats of a source, and read them back.

Each writes a whole table below the shared scratch folder as pages, files or reports, then gives what
the package's own readers, sinks and landing streams make of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.functions.casts import exprs
from tripgauge.operators import quality, slices
from tripgauge.plans.bindings import Events, Fulfilment
from tripgauge.session import scratch_dir
from tripgauge.sources import files, pages, reports, tables
from tripgauge.streaming import landing

# orders by the year of their date, labelled as its first month
YEAR = "date_format(trunc(CAST(o_orderdate AS DATE), 'year'), 'yyyy-MM') AS month"
FILLERS = 65


def _orders(b: Fulfilment) -> DataFrame:
    return b.table("orders").selectExpr("*", YEAR)


def _quoted(expr: str) -> str:
    return f"""concat('"', replace({expr}, '"', '""'), '"')"""


def _write_pages(rows: DataFrame, path: str) -> None:
    """(month, page, value): one compressed text file per page."""
    rows.write.option("compression", "gzip").partitionBy("month", "page").text(path)


def paged_csv_scan(b: Fulfilment) -> DataFrame:
    """Orders as CSV pages: quoted cells with commas, quotes and line breaks, 69 columns on even pages
    and 3 in another order on odd ones."""
    note = "concat('said \"', o_orderpriority, '\",\n', 'then left\r\n', o_orderstatus)"
    price = "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING)"
    fillers = ", ".join(f"concat('f{i}-', o_orderkey)" for i in range(FILLERS))
    cells = _orders(b).selectExpr("month", "o_orderkey DIV 20000 AS page", f"""
        CASE WHEN (o_orderkey DIV 20000) % 2 = 0 THEN concat_ws(',', {fillers}, {_quoted(note)}, '', o_orderkey, {price})
        ELSE concat_ws(',', {price}, {_quoted(note)}, {_quoted('CAST(o_orderkey AS STRING)')}) END AS record""")
    names = [f"filler_{i}" for i in range(FILLERS)]
    wide, narrow = ",".join([*names, "note", "nothing", "order_key", "price"]), '"PRICE","note","Order_Key"'
    # a page is bounded by the keys that it spans
    texts = cells.groupBy("month", "page").agg(F.array_join(F.collect_list("record"), "\n").alias("body")).selectExpr(
        "month", "page", f"concat(CASE WHEN page % 2 = 0 THEN '{wide}' ELSE '{narrow}' END, '\r\n', body) AS value")
    path = scratch_dir(b.spark, "csv-pages")
    _write_pages(texts, path)
    return pages.read_pages(b.spark, path, ["order_key", "note", "price", "nothing", names[-1]]).withColumnRenamed(names[-1], "last_filler")


def zone_lookup_scan(b: Events) -> DataFrame:
    """Nations as a zone lookup; the text N/A in a cell means missing."""
    zones = b.zone_lookup().selectExpr(
        "pickup_zone_id AS LocationID", "CASE WHEN pickup_zone_id % 7 = 0 THEN 'N/A' ELSE borough END AS Borough",
        "CASE WHEN pickup_zone_id % 5 = 0 THEN 'N/A' ELSE concat(pickup_zone, ', \"old\"') END AS Zone", "'N/A' AS service_zone")
    path = scratch_dir(b.spark, "zones")
    zones.coalesce(1).write.option("escape", '"').csv(path, header=True)
    return pages.read_zone_lookup(b.spark, path)


def zone_pages_scan(b: Fulfilment) -> DataFrame:
    """Customers as pages of JSON records; an id that is no number is missing."""
    records = b.table("customer").selectExpr(
        "'2023-01' AS month", "c_custkey DIV 500 AS page", "named_struct('locationid', CASE WHEN c_custkey % 11 = 0 THEN 'none' "
        "ELSE CAST(c_custkey AS STRING) END, 'zone', concat('zone ', c_custkey), 'borough', CAST(c_nationkey AS STRING)) AS r")
    path = scratch_dir(b.spark, "zone-pages")
    _write_pages(records.groupBy("month", "page").agg(F.to_json(F.collect_list("r")).alias("value")), path)
    return pages.read_zone_pages(b.spark, path).select("locationid", "zone", "borough")


def _through_report(b: Fulfilment) -> DataFrame:
    """The provenance written as a nested retrieval report, a block per year, and read back.

    A report has an entry per month, so it is one small document.
    """
    entries = b.provenance.selectExpr(
        "concat('trips:', substring(month, 1, 4)) AS key", "named_struct('month', month, 'dataset', 'trips', 'where', 'all', 'count_query', "
        "named_struct('count', api_count, 'status', IF(api_count IS NULL, 'UNKNOWN', 'OK'), 'seconds', 0.5D), 'rows', api_count, "
        "'match', api_count IS NOT NULL, 'composite_key_duplicates', composite_key_duplicates, "
        "'retrieval', named_struct('page_count', 1L, 'page_size', 50000L, 'raw_dir', month)) AS entry")
    blocks = entries.groupBy("key").agg(F.struct(F.collect_list("entry").alias("results")).alias("block"))
    document = blocks.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("key", "block"))).alias("trips"))).alias("value"))
    path = scratch_dir(b.spark, "report")
    document.coalesce(1).write.text(path)
    return reports.one_per_month(reports.read_retrieval_report(b.spark, path))


def integrity_from_report(b: Fulfilment) -> DataFrame:
    return quality.integrity_checks(b.counts, _through_report(b), b.contract)


def retrieval_report_scan(b: Fulfilment) -> DataFrame:
    return _through_report(b).select("dataset_year", "month", "api_count", "count_status", "count_reconciled", "composite_key_duplicates", "page_size")


def reports_as_data(b: Fulfilment) -> DataFrame:
    """The rule results as a run writes them, read back."""
    path = scratch_dir(b.spark, "rule-results")
    b.rule_results.repartition(1).write.parquet(path)
    return b.spark.read.parquet(path)


def report_csvs(b: Events) -> DataFrame:
    """Trips per period and hour as a sorted CSV, read back."""
    path = scratch_dir(b.spark, "csv")
    tables.write_report_csv(b.facts.groupBy("month", "hour").agg(*exprs("count(1) AS trips")), path, "month", "hour")
    return b.spark.read.csv(path, header=True, schema="month string, hour bigint, trips bigint")


def sorted_months_pruned(b: Fulfilment) -> DataFrame:
    """Orders in key order; files of a month do not overlap, and a range opens only files that can hold it."""
    path, key = scratch_dir(b.spark, "sorted"), "o_orderdate"
    tables.write_sorted_months(_orders(b), path, (key, "o_orderkey"))
    ranges = files.key_ranges(files.describe_files(b.spark, path, key=key), "timestamp_ntz")
    low, high = "timestamp_ntz'1995-03-01 00:00:00'", "timestamp_ntz'1996-06-15 00:00:00'"
    inside = tables.read_files(b.spark, path, files.files_in_range(ranges, low, high)).where(f"{key} BETWEEN {low} AND {high}")
    per_month = ranges.groupBy("month").agg(*exprs("sum(row_count) AS rows"))
    crossing = files.overlaps(ranges).groupBy("month").agg(*exprs("count(1) AS overlapping_files"))
    found = inside.groupBy("month").agg(*exprs("count(1) AS rows_in_range"))
    return per_month.join(crossing, "month", "left").join(found, "month", "left").na.fill(0)


def schema_by_file(b: Fulfilment) -> DataFrame:
    """Two files per year, one without a wanted column and with one that nobody asked for."""
    path, orders = scratch_dir(b.spark, "schemas"), _orders(b).select("month", "o_orderkey", "o_custkey", "o_totalprice")
    orders.where("o_orderkey % 2 = 0").repartition("month").write.partitionBy("month").parquet(path)
    short = orders.where("o_orderkey % 2 = 1").selectExpr("month", "o_orderkey AS O_ORDERKEY", "o_custkey", "1 AS surprise")
    short.repartition("month").write.mode("append").partitionBy("month").parquet(path)
    told = files.schema_by_file(files.describe_files(b.spark, path), ("o_orderkey", "o_custkey", "o_totalprice"))
    return told.selectExpr("month", "status", "row_count", "column_count", "array_join(missing_columns, ',') AS missing_columns",
                           "array_join(unexpected_columns, ',') AS unexpected_columns")


def manifest_files(b: Fulfilment) -> DataFrame:
    """The digests and sizes that stream through each file against those of the files read whole."""
    path = scratch_dir(b.spark, "digests")
    tables.write_months(_orders(b).repartition("month"), path)
    told = files.describe_files(b.spark, path, hashed=True)
    whole = b.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(
        F.col("path").alias("whole_path"), F.sha2("content", 256).alias("whole_sha256"), F.octet_length("content").alias("whole_bytes"))
    both = told.join(whole, F.col("path") == F.col("whole_path"), "full")
    return both.groupBy("month").agg(*exprs(
        "sum(row_count) AS row_count", "max(array_join(header, ',')) AS header", "bool_and(sha256 <=> whole_sha256) AS digests_agree",
        "bool_and(bytes <=> whole_bytes) AS sizes_agree"))


def month_replacement(b: Fulfilment) -> DataFrame:
    """Two years of orders are replaced, one by half of its rows and one by none, beside rows of a job that died."""
    path, orders = scratch_dir(b.spark, "versions"), _orders(b)
    years = [r.month for r in orders.select("month").distinct().collect()]
    tables.replace_months(orders, path, years)
    orders.withColumn(tables.VERSION, F.lit("unfinished")).write.mode("append").partitionBy("month", tables.VERSION).parquet(path)
    tables.replace_months(orders.where("month = '1995-01' AND o_orderkey % 2 = 0"), path, ["1995-01", "1996-01"])
    return tables.read_months(b.spark, path).groupBy("month").agg(*exprs(
        "count(1) AS rows", "sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total"))


def _landed_events(b: Events) -> str:
    """The events as files, landed in five goes that each bring the contract's state up to date."""
    base, events = scratch_dir(b.spark, "landing"), b.table("events")
    for number in range(5):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == number).write.mode("append").parquet(f"{base}/in")
        landing.land_with_state(b.spark, f"{base}/in", events.schema, b.as_trips, b.contract, base)
    return base


def incremental_gate(b: Events) -> DataFrame:
    """The gate from the state alone, against rows counted in the footers of the landed files."""
    base = _landed_events(b)
    manifest = files.describe_files(b.spark, f"{base}/raw").groupBy("month").agg(*exprs("sum(row_count) AS row_count"))
    return quality.publish_gate(landing.state_counts(b.spark, base), manifest, b.provenance, b.contract)


def incremental_ruler(b: Events) -> DataFrame:
    return landing.state_ruler(b.spark, _landed_events(b), b.baseline, b.contract)


def slices_in_one_pass(b: Events) -> DataFrame:
    """Periods, hours, zones and segments from one exchange of the facts."""
    found = slices.slice_tables(slices.all_slices(b.facts, b.ruler, b.contract), b.zone_lookup(), b.contract)
    parts = [("month", "monthly", "''", "slow_trip_share"), ("hour", "hourly", "CAST(hour AS STRING)", "slow_share"),
             ("zone", "zones", "CAST(pickup_zone_id AS STRING)", "slow_trip_share"), ("segment", "segments", "segment", "slow_trip_share")]
    out = None
    for name, table, key, slow in parts:
        one = found[table].selectExpr(f"'{name}' AS slice", "month", f"{key} AS key", "duration_p50_min", "duration_p90_min",
                                      f"{slow} AS slow_trip_share", "trip_time_reliability")
        out = one if out is None else out.union(one)
    return out
