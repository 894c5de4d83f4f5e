"""Metric semantics the end-to-end run cannot show, and the plans behind them."""

import pytest

from tripgauge.contract import Contract
from tripgauge.operators import facts as facts_op
from tripgauge.operators import metrics, ruler, slices
from tripgauge.plans.bindings import Events, Fulfilment
from tripgauge.sources.tables import read_months

SF = "/root/testdata/sf0.001"
C = Contract()


def _facts(spark, *rows):
    return spark.createDataFrame(list(rows), """month string, distance_band string,
        time_bucket string, duration_min double, speed_mph double, hour bigint,
        pickup_zone_id bigint""")


@pytest.fixture(scope="module")
def facts(spark):
    base = [("2023-01", "a", "x", float(d), 10.0, 8, 1) for d in range(1, 12)]
    later = [("2023-02", "a", "x", 5.0, 5.0, 8, 5), ("2023-02", "a", "x", 20.0, None, 9, 264),
             ("2023-02", "b", "x", 99.0, 6.0, 9, 0)]
    only_unknown = [("2023-03", "b", "x", 7.0, 1.0, 1, 2)]
    return _facts(spark, *base, *later, *only_unknown)


@pytest.fixture(scope="module")
def cells(facts):
    return ruler.build_ruler(facts, "2023-01", C)


def test_ruler_is_the_80th_percentile_of_the_baseline(cells):
    assert [tuple(r) for r in cells.collect()] == [("a", "x", 9.0, 11)]


def test_trips_outside_the_ruler_are_dropped_and_reported(facts, cells):
    scored = ruler.score(facts, cells)
    assert scored.count() == 13
    assert {r.month: r.unscored_trips for r in ruler.unscored(facts, cells).collect()} == {
        "2023-02": 1, "2023-03": 1}


def test_one_pass_month_metrics(facts, cells):
    got = {r.month: r for r in metrics.monthly_facts(facts, cells, C).collect()}
    assert set(got) == {"2023-01", "2023-02"}  # no scored trip, no M2, no month
    assert got["2023-02"].trip_time_reliability == 0.5   # scored trips only
    assert got["2023-02"].duration_p50_min == 20.0       # every valid trip
    assert got["2023-02"].slow_trip_share == pytest.approx(1 / 3)  # 6.0 and NULL are not slow


def test_segments_and_zone_names(spark, facts, cells):
    scored = ruler.score(facts, cells)
    seg = {(r.month, r.segment): r.trips for r in slices.segments(scored, C).collect()}
    assert seg == {("2023-01", "airport_zone"): 11, ("2023-02", "city_zone"): 1,
                   ("2023-02", "zone_unknown"): 1}
    lookup = spark.createDataFrame([(1, "n", "b")],
                                   "pickup_zone_id bigint, pickup_zone string, borough string")
    zones = {r.pickup_zone_id: r for r in slices.zone_detail(
        scored, lookup, C.with_(min_zone_trips=11)).collect()}
    assert zones[1].rankable and zones[1].airport_zone and zones[1].pickup_zone == "n"
    assert not zones[5].rankable and zones[5].pickup_zone is None


def test_worst_rows_come_from_the_last_period_only(spark):
    hourly = spark.createDataFrame(
        [("2023-01", 1, 0.9), ("2023-02", 5, 0.2), ("2023-02", 3, 0.2), ("2023-02", 4, 0.1)],
        "month string, hour int, slow_share double")
    assert [r.hour for r in slices.worst_hours(hourly, 2).collect()] == [3, 5]
    assert slices.worst_hours(hourly, 9).count() == 3
    zones = spark.createDataFrame(
        [("2023-01", 1, 0.1, True), ("2023-02", 2, 0.9, False), ("2023-02", 3, 0.8, True)],
        "month string, pickup_zone_id int, trip_time_reliability double, rankable boolean")
    assert [r.pickup_zone_id for r in slices.worst_zones(zones).collect()] == [3]
    assert slices.worst_zones(zones.where("pickup_zone_id < 3")).count() == 0


def test_mix_adjustment_undoes_a_changed_mix(spark):
    base = [("2023-01", b, "x", float(d), 9.0, 1, 1) for b in "ab" for d in range(1, 11)]
    # the same rates per band, but nearly all trips in band a
    later = [("2023-02", "a", "x", float(d), 9.0, 1, 1) for d in range(1, 11)] * 9
    later += [("2023-02", "b", "x", float(d), 9.0, 1, 1) for d in range(1, 11)]
    facts = _facts(spark, *base, *later)
    scored = ruler.score(facts, ruler.build_ruler(facts, "2023-01", C))
    got = {r.month: r for r in slices.mix_adjusted(facts, scored, "2023-01").collect()}
    assert got["2023-02"].mix_adjusted == got["2023-01"].mix_adjusted == 0.8
    assert slices.largest_gap(slices.mix_adjusted(
        facts, scored, "2023-01")).first().largest_gap_pts == 0.0


def test_exemplar_with_two_titles_is_listed_once(spark):
    facts = Events(spark, SF).facts.where("month = '2024-01-22'").limit(1)
    rows = slices.exemplar_trips(facts).collect()
    assert [r.pick for r in rows] == ["fastest"]


def test_stale_months_do_not_leak(spark, facts):
    months = spark.createDataFrame([("2023-01",)], "month string")
    assert {r.month for r in facts_op.scoped_to(facts, months).select("month").distinct()
            .collect()} == {"2023-01"}


def test_invariants_on_events(spark):
    b = Events(spark, SF)
    scored = b.scored.count()
    for table in (slices.hourly_detail(b.scored, b.contract),
                  slices.zone_detail(b.scored, b.zone_lookup(), b.contract),
                  slices.segments(b.scored, b.contract)):
        assert table.agg({"trips": "sum"}).first()[0] == scored
    counts = b.counts.agg({"total_rows": "sum", "valid_rows": "sum", "quarantined_rows": "sum"})
    row = counts.first()
    assert row["sum(valid_rows)"] + row["sum(quarantined_rows)"] == row["sum(total_rows)"] == 1000


# --- plans ---------------------------------------------------------------------------------
def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_ruler_is_broadcast_and_facts_are_read_once(spark):
    b = Events(spark, SF)
    plan = _plan(slices.hourly_detail(b.scored, b.contract))
    assert "BroadcastHashJoin [distance_band" in plan and "SortMergeJoin" not in plan
    assert plan.count("FileScan parquet") == 2  # baseline for the ruler, all periods once
    assert "ReusedExchange" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(metrics.slow_share(Events(spark, SF).facts, Events.contract))
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "event_type" not in schema and "ts" in schema


def test_baseline_reads_only_its_partition(spark, tmp_path):
    from tripgauge.sources.tables import write_months
    b = Events(spark, SF)
    write_months(b.facts, str(tmp_path / "facts"))
    stored = read_months(spark, str(tmp_path / "facts"))
    plan = _plan(ruler.build_ruler(stored, b.baseline, b.contract))
    assert "PartitionFilters: [isnotnull(month" in plan and b.baseline in plan


def test_duplicate_audit_combines_before_the_shuffle(spark):
    from tripgauge.operators.integrity import duplicate_audit
    plan = _plan(duplicate_audit(Fulfilment(spark, SF).table("lineitem"),
                                 ("l_orderkey", "l_linenumber"), by=()))
    assert "partial_count" in plan and "Window" not in plan
