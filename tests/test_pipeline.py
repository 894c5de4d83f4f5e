"""Small months through the whole run: landing tables, gate, metrics, slices, reruns."""

import csv
from pathlib import Path

import pytest

from fixtures import MINUTES, MONTHS, PER_MONTH, crafted_frame, sample_months
from tripgauge.contract import Contract, ContractAbort
from tripgauge.plans import pipeline
from tripgauge.sources.tables import pointers, read_months, write_months

CSVS = ("expected_duration_baseline", "metrics_monthly_wide", "metrics_monthly",
        "metrics_hourly_detail", "metrics_zone_detail", "metrics_segments")


def _provenance(spark, rows=PER_MONTH):
    return spark.createDataFrame(
        [(m, rows, rows, True, 1, 0) for m in MONTHS],
        "month string, api_count bigint, rows_stored bigint, count_reconciled boolean, "
        "pages bigint, composite_key_duplicates bigint")


def _lookup(spark):
    return spark.range(1, 266).selectExpr(
        "id AS pickup_zone_id", "concat('zone ', id) AS pickup_zone", "'b' AS borough")


def _csv(out, name):
    (file,) = Path(out, "csv", name).glob("part-*.csv")
    with open(file) as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    write_months(sample_months(spark), str(base / "raw"))
    before = {p: p.stat().st_mtime_ns for p in (base / "raw").rglob("*.parquet")}
    results = []
    for name in ("first", "second"):
        results.append(pipeline.run(
            spark, str(base / "raw"), _provenance(spark), _lookup(spark), str(base / name),
            MONTHS[0], publish_required=True))
    after = {p: p.stat().st_mtime_ns for p in (base / "raw").rglob("*.parquet")}
    return {"base": base, "out": str(base / "first"), "results": results,
            "untouched": before == after}


def test_published_with_all_rows(run):
    for result in run["results"]:
        assert (result.gate_status, result.raw_rows, result.valid_rows) == ("PUBLISH", 2 * PER_MONTH, 2 * PER_MONTH)


def test_inputs_are_never_written(run):
    assert run["untouched"]


def test_layers_hold_the_same_rows(spark, run):
    staged = read_months(spark, run["out"] + "/staged")
    facts = read_months(spark, run["out"] + "/facts")
    assert staged.count() == facts.count() == 2 * PER_MONTH
    assert len(facts.columns) == 30 - 1  # the fact table's 29 columns
    assert not [c for c in facts.columns if "longitude" in c or "latitude" in c]


def test_reliability_of_equal_trips_is_one(run):
    wide = _csv(run["out"], "metrics_monthly_wide")
    assert [r["month"] for r in wide] == list(MONTHS)
    for r in wide:
        assert float(r["trip_time_reliability"]) == 1.0
        assert float(r["duration_p50_min"]) == float(r["duration_p90_min"]) == MINUTES
        assert float(r["valid_trip_rate"]) + float(r["invalid_trip_rate"]) == 1.0


def test_long_form_has_every_metric(run):
    long = _csv(run["out"], "metrics_monthly")
    assert {r["metric_id"] for r in long} == {"M1", "M2", "M3", "M3b", "M4", "M5"}
    assert len(long) == 12 and list(long[0]) == [
        "month", "metric_id", "metric_name", "value", "grain", "formula", "kpi_link"]


def test_hours_zones_and_segments_hold_the_same_trips(run):
    hourly, zones, segments = (_csv(run["out"], f"metrics_{n}") for n in
                               ("hourly_detail", "zone_detail", "segments"))
    for rows in (hourly, zones, segments):
        assert sum(int(r["trips"]) for r in rows) == 2 * PER_MONTH
    assert {r["segment"] for r in segments} == {"airport_zone", "city_zone"}
    for m in MONTHS:
        assert sum(float(r["share_of_trips"]) for r in segments
                   if r["month"] == m) == pytest.approx(1.0)
    assert all(r["rankable"] == "false" and int(r["trips"]) == 1 for r in zones)
    assert zones[0]["pickup_zone"] == "zone 1" and zones[0]["airport_zone"] == "true"


def test_second_run_gives_the_same_bytes(run):
    for name in CSVS:
        one, two = (next(Path(run["base"], r, "csv", name).glob("part-*.csv")).read_bytes()
                    for r in ("first", "second"))
        assert one == two


def test_months_subset(spark, run, tmp_path):
    result = pipeline.run(spark, str(run["base"] / "raw"), _provenance(spark), _lookup(spark),
                          str(tmp_path), MONTHS[1], months=[MONTHS[1]])
    assert result.raw_rows == PER_MONTH
    assert [r["month"] for r in _csv(str(tmp_path), "metrics_monthly_wide")] == [MONTHS[1]]


def test_hold_stops_a_required_publish(spark, run, tmp_path):
    with pytest.raises(ContractAbort, match="HOLD"):
        pipeline.run(spark, str(run["base"] / "raw"), _provenance(spark, PER_MONTH + 1), _lookup(spark),
                     str(tmp_path), MONTHS[0], publish_required=True)


def test_missing_column_aborts(spark, tmp_path):
    write_months(sample_months(spark).drop("extra"), str(tmp_path / "raw"))
    with pytest.raises(ContractAbort, match="extra"):
        pipeline.run(spark, str(tmp_path / "raw"), _provenance(spark), _lookup(spark),
                     str(tmp_path / "out"), MONTHS[0])
    assert not (tmp_path / "out").exists()


def test_quarantine_keeps_rows_with_reasons(spark, tmp_path):
    write_months(crafted_frame(spark), str(tmp_path / "raw"))
    pipeline.validate(spark, read_months(spark, str(tmp_path / "raw")),
                      _provenance(spark), str(tmp_path / "out"), Contract())
    staged = read_months(spark, str(tmp_path / "out/staged"))
    kept = read_months(spark, str(tmp_path / "out/quarantine"))
    assert kept.where("fail_reasons IS NULL").count() == 0
    assert kept.count() == staged.where("fail_reasons IS NOT NULL").count() > 0


def _rows(spark, path):
    df = read_months(spark, path)
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("first,second", [("broken", "whole"), ("whole", "broken")])
def test_a_rerun_equals_a_fresh_folder(spark, tmp_path, first, second):
    """A month loses all its valid rows, or all its quarantined ones."""
    whole = sample_months(spark)
    broken = whole.selectExpr("* EXCEPT (trip_distance)", f"IF(month = '{MONTHS[1]}', 0D, trip_distance) AS trip_distance")
    for name, df in (("whole", whole), ("broken", broken)):
        write_months(df, str(tmp_path / name))
    go = lambda data, out: pipeline.run(
        spark, str(tmp_path / data), _provenance(spark), _lookup(spark), str(tmp_path / out), MONTHS[0])
    go(first, "again")
    assert go(second, "again") == go(second, "fresh")
    for layer in ("staged", "quarantine", "facts"):
        old, new = tmp_path / "again" / layer, tmp_path / "fresh" / layer
        held = [{r.month: r.rows for r in pointers(spark, str(p)).collect()} for p in (old, new)]
        assert held[0] == held[1] and set(held[0]) == set(MONTHS)
        if list(new.glob("month=*")):
            assert _rows(spark, str(old)) == _rows(spark, str(new))
    for name in CSVS:
        assert _csv(str(tmp_path / "again"), name) == _csv(str(tmp_path / "fresh"), name)


def test_baseline_outside_the_subset(spark, run, tmp_path):
    pipeline.run(spark, str(run["base"] / "raw"), _provenance(spark), _lookup(spark), str(tmp_path), MONTHS[0], months=[MONTHS[1]])
    for name in CSVS[1:]:
        assert _csv(str(tmp_path), name) == [r for r in _csv(run["out"], name) if r["month"] == MONTHS[1]]
    assert _csv(str(tmp_path), CSVS[0]) == _csv(run["out"], CSVS[0])


def test_empty_ruler_aborts(spark, run, tmp_path):
    with pytest.raises(ContractAbort, match="baseline"):
        pipeline.run(spark, str(run["base"] / "raw"), _provenance(spark), _lookup(spark), str(tmp_path), "2019-01")


def test_a_month_without_a_column_aborts(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_months(sample_months(spark), raw)
    write_months(sample_months(spark, MONTHS[1:]).drop("congestion_surcharge"), raw)
    with pytest.raises(ContractAbort, match="congestion_surcharge"):
        pipeline.run(spark, raw, _provenance(spark), _lookup(spark), str(tmp_path / "out"), MONTHS[0])


def test_repeated_provenance_counts_once(spark, run, tmp_path):
    twice = _provenance(spark).union(_provenance(spark))
    result = pipeline.run(spark, str(run["base"] / "raw"), twice, _lookup(spark), str(tmp_path / "a"), MONTHS[0])
    assert (result.gate_status, result.raw_rows) == ("PUBLISH", 2 * PER_MONTH)
    with pytest.raises(ContractAbort, match="contradicts"):
        pipeline.run(spark, str(run["base"] / "raw"), twice.union(_provenance(spark, 7)), _lookup(spark), str(tmp_path / "b"), MONTHS[0])


def test_one_short_file_of_a_month_aborts(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_months(sample_months(spark).coalesce(1), raw)
    sample_months(spark, MONTHS[:1]).drop("airport_fee").coalesce(1).write.mode("append").partitionBy("month").parquet(raw)
    for _ in range(3):
        with pytest.raises(ContractAbort, match="airport_fee"):
            pipeline.run(spark, raw, _provenance(spark), _lookup(spark), str(tmp_path / "out"), MONTHS[0])


def test_landed_pages_go_through_the_run(spark, run, tmp_path):
    """Pages landed in two goes give what the same rows as a month table give."""
    import gzip

    from tripgauge.streaming.landing import land_new_pages

    names = [c for c in sample_months(spark).columns if c != "month"]
    for go, month in enumerate(MONTHS):
        folder = tmp_path / "pages" / month
        folder.mkdir(parents=True)
        rows = sample_months(spark, (month,)).select(names).collect()
        for number in (1, 2):
            body = [",".join(names)] + [",".join("" if v is None else f'"{v}"' for v in r) for r in rows[number - 1::2]]
            (folder / f"page_{number}.csv.gz").write_bytes(gzip.compress("\n".join(body).encode()))
        land_new_pages(spark, str(tmp_path / "pages"), str(tmp_path / "raw"), str(tmp_path / "checkpoint"))
    result = pipeline.run(spark, str(tmp_path / "raw"), _provenance(spark), _lookup(spark), str(tmp_path / "out"), MONTHS[0])
    assert result == run["results"][0]
    for name in CSVS:
        assert _csv(str(tmp_path / "out"), name) == _csv(run["out"], name)


def test_state_of_batches_equals_one_scan(spark, tmp_path):
    from tripgauge.operators import facts as facts_op
    from tripgauge.operators import quality, rules
    from tripgauge.operators.ruler import build_ruler
    from tripgauge.streaming import landing

    texts = sample_months(spark)
    texts = texts.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in texts.columns])
    whole, contract = crafted_frame(spark).unionByName(texts, allowMissingColumns=True), Contract()
    whole.repartition(5).write.parquet(str(tmp_path / "in"))
    whole = spark.read.parquet(str(tmp_path / "in"))
    base = str(tmp_path / "state")
    for _ in range(2):  # nothing new the second time
        landing.land_with_state(spark, str(tmp_path / "in"), whole.schema, lambda df: df, contract, base, files_per_batch=1)
    assert landing.read_landed(spark, f"{base}/raw", whole.schema).select("landed_batch").distinct().count() >= 2
    staged = rules.stage(whole, contract)
    want = quality.period_counts(staged)
    facts = facts_op.fact_trips(staged, contract)
    as_rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert as_rows(landing.state_counts(spark, base)) == as_rows(want)
    assert as_rows(landing.state_extent(spark, base)) == as_rows(facts_op.period_extent(facts))
    assert as_rows(landing.state_ruler(spark, base, MONTHS[0], contract)) == as_rows(build_ruler(facts, MONTHS[0], contract))
