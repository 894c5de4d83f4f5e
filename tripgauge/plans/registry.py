"""Name -> query over the driver tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.functions import scales
from tripgauge.functions.casts import exprs, period_label, rounded, rounded_decimal
from tripgauge.operators import (
    facts as facts_op,
    integrity,
    metrics,
    profiles,
    quality,
    quantiles,
    ruler,
    rules,
    slices,
)
from tripgauge.plans import landed
from tripgauge.plans.bindings import Events, Fulfilment
from tripgauge.plans.pipeline import together
from tripgauge.session import scratch_dir
from tripgauge.sources.fingerprint import content_fingerprint
from tripgauge.sources.pages import retype
from tripgauge.sources.tables import read_months, write_months
from tripgauge.streaming.landing import stage_new_files

Query = Callable[[SparkSession, str], DataFrame]

OK_COLUMNS = [r.ok_column for r in rules.RULES]
ROW_ID = ["month", "order_key", "line_number"]


# the bindings hold plans, not data: queries of one session share them
_events = lru_cache(maxsize=4)(Events)
_fulfilment = lru_cache(maxsize=4)(Fulfilment)


def _on_events(fn: Callable[[Events], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_events(spark, sf_dir))


def _on_fulfilment(fn: Callable[[Fulfilment], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_fulfilment(spark, sf_dir))


# --- sources -----------------------------------------------------------------------------
def _retype_try_cast(b: Fulfilment) -> DataFrame:
    """Text as pages deliver it: integers with a fraction, exponents, words, bare years."""
    number = (
        "CASE l_linenumber WHEN 1 THEN concat(CAST(l_partkey AS STRING), '.0') "
        "WHEN 2 THEN concat(CAST(l_partkey AS STRING), '.5') "
        "WHEN 3 THEN concat(CAST(l_partkey AS STRING), 'e2') WHEN 4 THEN 'n/a' WHEN 5 THEN '' "
        "ELSE CAST(l_partkey AS STRING) END")
    stamp = (
        "CASE l_linenumber WHEN 1 THEN date_format(l_shipdate, 'yyyy') WHEN 2 THEN 'unknown' "
        "WHEN 3 THEN date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") "
        "ELSE CAST(l_shipdate AS STRING) END")
    pages = b.table("lineitem").selectExpr(
        "l_orderkey AS order_key", f"{number} AS passenger_count", f"{number} AS trip_distance",
        f"{stamp} AS tpep_pickup_datetime", "l_linestatus AS unmapped")
    return _texts(retype(pages), "tpep_pickup_datetime")


def _json_props(b: Events) -> DataFrame:
    return b.table("events").selectExpr(
        "event_id", "try_cast(get_json_object(props, '$.k') AS BIGINT) AS k")


def _facts_scoped(b: Fulfilment) -> DataFrame:
    """Facts of the validated months."""
    return facts_op.scoped_to(b.facts, b.counts).groupBy("month").agg(
        *exprs("count(1) AS fact_rows"))


def _manifest_totals(b: Fulfilment) -> DataFrame:
    entries = b.manifest.join(b.provenance, "month", "left").selectExpr(
        "month", "row_count", "bytes",
        f"{rules.passes('api_count = row_count')} AS count_reconciled")
    return integrity.manifest_totals(entries)


def _month_windows(b: Fulfilment) -> DataFrame:
    return _texts(integrity.rows_per_window(b.order_windows, b.table("orders"), "o_orderdate"),
                  "window_start", "window_end")


def _months_to_process(b: Fulfilment) -> DataFrame:
    """Months that have shipments but no orders yet."""
    ships = b.table("lineitem").selectExpr("min(l_shipdate) AS first", "max(l_shipdate) AS last")
    landed = b.table("orders").selectExpr(f"{period_label('o_orderdate', 'month')} AS month")
    return _texts(integrity.months_to_process(integrity.month_windows(ships), landed),
                  "window_start", "window_end")


def _fingerprint(b: Fulfilment) -> DataFrame:
    """Content of three tables. Amounts are read as exact decimals, which any engine writes alike."""
    out = None
    for name in ("lineitem", "orders", "events"):
        df = b.table(name)
        exact = df.selectExpr(*[
            f"CAST({c} AS DECIMAL(28,8)) AS {c}" if kind == "double" else
            f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {c}" if kind.startswith("timestamp") else c
            for c, kind in df.dtypes], "_metadata")
        one = content_fingerprint(exact, df.columns)
        out = one if out is None else out.unionByName(one)
    return out.drop("bytes")


def _incremental_counts(b: Events) -> DataFrame:
    """The events file taken by the landing stream, staged, then counted from the table."""
    base = scratch_dir(b.spark, "incremental")
    events = b.table("events")
    # a file stream watches folders or patterns, so the one file is given as a pattern
    stage_new_files(b.spark, f"{b.dir}/event[s].parquet", events.schema, b.as_trips, b.contract,
                    f"{base}/staged", f"{base}/checkpoint")
    staged = b.spark.read.parquet(f"{base}/staged").withColumn(
        "month", F.col("month").cast("string"))
    return quality.period_coverage(quality.period_counts(staged))


# --- contract ----------------------------------------------------------------------------
def _conservation_of_outputs(b: Fulfilment) -> DataFrame:
    """Staged, quarantine and fact tables as written and read back, counted each on its own."""
    base = scratch_dir(b.spark, "outputs")
    write_months(rules.stage(b.raw_by_folder, b.contract), f"{base}/staged")
    staged = read_months(b.spark, f"{base}/staged")
    together([
        lambda: write_months(rules.quarantined(staged), f"{base}/quarantine"),
        lambda: write_months(facts_op.fact_trips(staged, b.contract), f"{base}/facts")])
    return quality.conservation_of_outputs(
        staged, read_months(b.spark, f"{base}/quarantine"), read_months(b.spark, f"{base}/facts"))


def _publish_gate(b: Fulfilment) -> DataFrame:
    """The joined rows are landed once; rules, duplicates and the manifest read what was landed."""
    path = scratch_dir(b.spark, "landed")
    b.raw.write.parquet(path)
    raw = b.spark.read.schema(b.raw.schema).parquet(path)
    counts = quality.period_counts(rules.stage(raw, b.contract))
    manifest = raw.groupBy("month").agg(*exprs("count(1) AS row_count"))
    return quality.publish_gate(counts, manifest, b.provenance_of(raw), b.contract)


def _duplicate_audit(b: Fulfilment) -> DataFrame:
    return integrity.duplicate_audit(b.table("lineitem"), ("l_orderkey", "l_linenumber"), by=())


def _duplicate_audit_by_digest(b: Events) -> DataFrame:
    """Visitors folded to 50, so that tuples do repeat; the property text makes them wide."""
    rows = b.table("events").selectExpr(f"{period_label('ts', 'month')} AS month", "user_id % 50 AS visitor", "event_type", "props")
    return integrity.duplicate_audit_by_digest(rows, ("visitor", "event_type", "props"))


def _decimal_rounding(b: Fulfilment) -> DataFrame:
    """Rates that end half way between two decimals, exactly or as near as a double gets."""
    k = b.table("lineitem").where("l_partkey % 1000 > 0").groupBy(F.expr("l_partkey % 1000 AS k")).agg(*exprs("count(1) AS lines"))
    return k.selectExpr("k", "lines", f"{rounded_decimal('k / 128D', 6)} AS ties", f"{rounded_decimal('k * 0.005D', 2)} AS near_ties",
                        f"{rounded_decimal('-k / 4D', 1)} AS negative")


def _count_reconciliation(b: Fulfilment) -> DataFrame:
    """Orders the header table promises per month against orders that have a line."""
    orders = b.table("orders").selectExpr(
        f"{period_label('o_orderdate', 'month')} AS month", "o_orderkey")
    expected = orders.groupBy("month").agg(*exprs("count(1) AS expected_rows"))
    with_lines = orders.join(b.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"),
                             "left_semi")
    stored = with_lines.groupBy("month").agg(*exprs("count(1) AS rows"))
    return integrity.count_reconciliation(expected, stored)


def _custom_rule(b: Fulfilment) -> DataFrame:
    """A user's own rule, run beside the built-in ones and allowed to quarantine."""
    own = rules.Rule(
        "R90", "tip_below_distance", "semantic", rules.FLAG, "client", "set aside",
        predicate=lambda c: F.col("t_tip") * F.lit(100.0) < F.col("t_distance"))
    contract = b.contract.with_(
        quarantine=(*b.contract.quarantine, "R90"),
        tolerances={**b.contract.tolerances, "R90": (0.01, 0.05)})
    used = (*rules.RULES, own)
    counts = quality.period_counts(rules.stage(b.raw, contract, used), used)
    return counts.select("month", "total_rows", "valid_rows", quality.fails_column(own))


def _rule_query(rule: rules.Rule) -> Query:
    return _on_fulfilment(lambda b: rules.rule_outcomes(b.raw, b.contract, rule))


# --- facts -------------------------------------------------------------------------------
def _texts(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text with microseconds, the same on every client."""
    return df.selectExpr(*[
        f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {c}" if c in names else f"`{c}`"
        for c in df.columns])


def _label_counts(label: str) -> Callable[[Events], DataFrame]:
    return lambda b: b.facts.groupBy(label).agg(*exprs(
        "count(1) AS trips", "min(distance_mi) AS min_distance",
        "max(distance_mi) AS max_distance", "min(hour) AS min_hour", "max(hour) AS max_hour"))


def _segment_label(b: Events) -> DataFrame:
    label = scales.segment("pickup_zone_id", b.contract)
    return b.facts.groupBy(F.expr(f"{label} AS segment")).agg(*exprs("count(1) AS trips"))


# --- metrics -----------------------------------------------------------------------------
def _unscored(b: Events) -> DataFrame:
    """Trips of cells that the baseline period has no trip in."""
    return ruler.unscored(b.facts, b.ruler)


def _score_rows(b: Events) -> DataFrame:
    return b.scored.select("month", "pickup_zone_id", "dropoff_zone_id", "distance_band",
                           "time_bucket", "duration_min", "expected_duration_min", "on_time")


def _quantiles_by_scans(b: Events) -> DataFrame:
    """The same steps as on a large table: a bin is parted again while it holds more than ten rows."""
    rows = b.table("events").selectExpr(f"{period_label('ts', 'month')} AS month", "event_type", "value + event_id / 1000003 AS v", "user_id")
    q = quantiles.distribution_by_scans(rows, ["month", "event_type"], "v", {"p50": 0.5, "p80": 0.8, "largest": 1.0},
                                        {"share": "user_id % 3 = 0"}, rows="n", most_values=10)
    return q.selectExpr("month", "event_type", "n", "share", f"{rounded('p50', 2)} AS p50", f"{rounded('p80', 2)} AS p80", "largest")


def _quantiles_by_type(b: Events) -> DataFrame:
    wanted = {"p50": 0.5, "p80": 0.8, "p90": 0.9}
    q = quantiles.distribution(b.table("events"), ["event_type"], "value", wanted, rows="n")
    return q.selectExpr("event_type", "n", *[f"{rounded(c, 2)} AS {c}" for c in wanted])


def _wide(b: Events) -> DataFrame:
    return metrics.metrics_wide(b.counts, b.facts, b.ruler, b.contract)


def _zones(b: Events, last_only: bool = False) -> DataFrame:
    scored = slices.latest(b.scored) if last_only else b.scored
    return slices.zone_detail(scored, b.zone_lookup(), b.contract)


def _hours(b: Events) -> DataFrame:
    return slices.hourly_detail(b.scored, b.contract)


def _mix(b: Events) -> DataFrame:
    return slices.mix_adjusted(b.facts, b.scored, b.baseline)


def _id_diff(b: Fulfilment) -> DataFrame:
    """Order ids of the header table against those the lines carry, in both directions."""
    header = b.table("orders").selectExpr("o_orderkey AS id")
    lines = b.table("lineitem").selectExpr("l_orderkey AS id")
    return integrity.reference_id_diff(header, lines, "orders", "lineitem")


def build() -> dict[str, Query]:
    ev, fu = _on_events, _on_fulfilment
    out: dict[str, Query] = {
        # sources
        "retype_try_cast": fu(_retype_try_cast),
        "facts_scoped_to_validated": fu(_facts_scoped),
        "json_props_extract": ev(_json_props),
        "table_fingerprint": fu(_fingerprint),
        "manifest_totals": fu(_manifest_totals),
        "month_windows": fu(_month_windows),
        "months_to_process": fu(_months_to_process),
        "incremental_counts": ev(_incremental_counts),
        "conservation_of_outputs": fu(_conservation_of_outputs),
        "paged_csv_scan": fu(landed.paged_csv_scan),
        "zone_lookup_scan": ev(landed.zone_lookup_scan),
        "zone_pages_scan": fu(landed.zone_pages_scan),
        "retrieval_report_scan": fu(landed.retrieval_report_scan),
        "integrity_from_report": fu(landed.integrity_from_report),
        "reports_as_data": fu(landed.reports_as_data),
        "report_csvs": ev(landed.report_csvs),
        "sorted_months_pruned": fu(landed.sorted_months_pruned),
        "schema_by_file": fu(landed.schema_by_file),
        "manifest_files": fu(landed.manifest_files),
        "month_replacement": fu(landed.month_replacement),
        "incremental_gate": ev(landed.incremental_gate),
        "incremental_ruler": ev(landed.incremental_ruler),
        "describe_schema": fu(lambda b: profiles.describe_columns(b.table("lineitem"))),
    }
    # rules
    out.update({f"rule_{r.id.lower()}": _rule_query(r) for r in rules.RULES})
    out.update({
        "custom_rule": fu(_custom_rule),
        # contract
        "staged_rules": fu(lambda b: b.staged.select(*ROW_ID, *OK_COLUMNS)),
        "fail_reasons": fu(lambda b: b.staged.groupBy("fail_reasons").agg(
            *exprs("count(1) AS rows"))),
        "quarantine_rows": fu(lambda b: rules.quarantined(b.staged).select(
            *ROW_ID, "fail_reasons")),
        "valid_rows": fu(lambda b: rules.valid(b.staged).select(*ROW_ID)),
        "month_rule_counts": fu(lambda b: b.counts),
        "month_coverage": fu(lambda b: quality.period_coverage(b.counts)),
        "contract_totals": fu(lambda b: quality.contract_totals(b.counts)),
        "rule_results": fu(lambda b: b.rule_results),
        "rule_status_tally": fu(lambda b: quality.status_tally(b.rule_results)),
        "rule_disclosures": fu(lambda b: quality.disclosures(b.rule_results, b.contract)),
        "row_conservation": fu(lambda b: quality.row_conservation(b.counts, b.manifest)),
        "integrity_checks": fu(lambda b: quality.integrity_checks(
            b.counts, b.provenance, b.contract)),
        "duplicate_audit": fu(_duplicate_audit),
        "duplicate_audit_by_digest": ev(_duplicate_audit_by_digest),
        "decimal_rounding": fu(_decimal_rounding),
        "count_reconciliation": fu(_count_reconciliation),
        "reconciliation_totals": fu(lambda b: integrity.reconciliation_totals(
            _count_reconciliation(b))),
        "publish_gate": fu(_publish_gate),
        "publish_gate_events": ev(lambda b: quality.publish_gate(
            b.counts, b.manifest, b.provenance, b.contract)),
        # facts and scalars
        "fact_projection": ev(lambda b: _texts(b.facts, "pickup_ts", "dropoff_ts")),
        "fact_projection_text": fu(lambda b: _texts(b.facts, "pickup_ts", "dropoff_ts")),
        "distance_band": ev(_label_counts("distance_band")),
        "time_bucket": ev(_label_counts("time_bucket")),
        "segment_label": ev(_segment_label),
        "residual_bands": fu(lambda b: profiles.residual_bands(b.raw, b.contract)),
        "fact_month_extent": ev(lambda b: _texts(
            facts_op.period_extent(b.facts), "first_pickup", "last_pickup")),
        "missing_metadata_cohort": fu(lambda b: profiles.missing_metadata_cohort(b.raw)),
        "domain_profile": fu(lambda b: profiles.domain_profile(b.raw)),
        "reference_id_diff": fu(_id_diff),
        # quantiles
        "duration_quantiles": ev(_quantiles_by_type),
        "quantiles_by_scans": ev(_quantiles_by_scans),
        "quantile_histogram": ev(lambda b: quantiles.value_histogram(
            b.table("events"), ["event_type"], "value")),
        # KPI
        "ruler_p80": ev(lambda b: b.ruler),
        "ruler_grid": ev(lambda b: ruler.ruler_grid(b.ruler, b.contract)),
        "ruler_fairness": ev(lambda b: ruler.fairness(b.scored, b.baseline, b.contract)),
        "score_against_ruler": ev(_score_rows),
        "unscored_rows": ev(_unscored),
        "reliability_monthly": ev(lambda b: ruler.reliability(b.scored, ("month", "distance_band"))),
        "slow_share_monthly": ev(lambda b: metrics.slow_share(b.facts, b.contract)),
        "monthly_facts": ev(lambda b: metrics.monthly_facts(b.facts, b.ruler, b.contract)),
        "m1_valid_rate": fu(lambda b: metrics.valid_rate(b.counts)),
        "m2_reliability": ev(lambda b: ruler.reliability(b.scored)),
        "m3_duration": ev(lambda b: metrics.duration_typical(b.facts)),
        "m4_invalid_rate": fu(lambda b: metrics.invalid_rate(b.counts)),
        "m5_slow_share": ev(lambda b: metrics.slow_share(b.facts, b.contract)),
        "metrics_monthly_wide": ev(_wide),
        "metrics_long": ev(lambda b: metrics.metrics_long(_wide(b))),
        "metrics_pivot": ev(lambda b: metrics.metrics_pivot(metrics.metrics_long(_wide(b)))),
        # slices
        "hourly_detail": ev(_hours),
        "zone_detail": ev(_zones),
        "segments": ev(lambda b: slices.segments(b.scored, b.contract)),
        "slices_in_one_pass": ev(landed.slices_in_one_pass),
        "worst_hours": ev(lambda b: slices.worst_hours(_hours(b))),
        "worst_zones": ev(lambda b: slices.worst_zones(_zones(b))),
        "zone_map_feed": ev(lambda b: slices.zone_map_feed(_zones(b, last_only=True))),
        "exemplar_trips": ev(lambda b: _texts(
            slices.exemplar_trips(slices.latest(b.facts)), "pickup_ts", "dropoff_ts")),
        "mix_adjusted_reliability": ev(_mix),
        "mix_largest_gap": ev(lambda b: slices.largest_gap(_mix(b))),
    })
    return out
