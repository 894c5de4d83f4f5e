import pytest

from fixtures import MONTHS, PER_MONTH, crafted_frame, sample_months
from tripgauge.contract import Contract, ContractAbort
from tripgauge.operators import integrity, quality, rules

CONTRACT = Contract()


def _counts(spark, df):
    return quality.period_counts(rules.stage(df, CONTRACT))


def _manifest(spark, *rows):
    return spark.createDataFrame(list(rows), "month string, row_count bigint")


def _provenance(spark, *rows):
    return spark.createDataFrame(
        list(rows), "month string, api_count bigint, composite_key_duplicates bigint")


N, (ONE, TWO) = PER_MONTH, MONTHS
GOOD_MANIFEST = ((ONE, N), (TWO, N))
GOOD_PROVENANCE = ((ONE, N, 0), (TWO, N, None))


def _gate(spark, manifest=GOOD_MANIFEST, provenance=GOOD_PROVENANCE, df=None, **kw):
    counts = _counts(spark, df if df is not None else sample_months(spark))
    return quality.publish_gate(counts, _manifest(spark, *manifest),
                                _provenance(spark, *provenance), CONTRACT, **kw).first()


def test_clean_months_are_published(spark):
    gate = _gate(spark)
    assert (gate.status, gate.reasons, gate.raw_rows, gate.valid_rows) == ("PUBLISH", "", 2 * N, 2 * N)


@pytest.mark.parametrize("change,reason", [
    ({"schema_ok": False}, "schema conformance FAIL"),
    ({"manifest": ((ONE, N), (TWO, N + 1))}, "row conservation broken"),
    ({"manifest": ((ONE, N),)}, "row conservation broken"),
    ({"manifest": (*GOOD_MANIFEST, ("2021-08", 5))}, "row conservation broken"),
    ({"provenance": ((ONE, N, 0), (TWO, N - 1, 0))}, "retrieval integrity"),
    ({"provenance": ((ONE, N, 2), (TWO, N, 0))}, "retrieval integrity"),
    ({"provenance": ((ONE, None, 0), (TWO, N, 0))}, "retrieval integrity"),
    ({"provenance": ()}, "retrieval integrity"),
])
def test_each_broken_proof_holds(spark, change, reason):
    gate = _gate(spark, **change)
    assert gate.status == "HOLD" and gate.n_reasons == 1 and reason in gate.reasons


def test_one_duplicate_is_tolerated(spark):
    assert _gate(spark, provenance=((ONE, N, 1), (TWO, N, 0))).status == "PUBLISH"


def test_failing_rules_hold_with_rate(spark):
    df = crafted_frame(spark)
    n = df.count()
    gate = _gate(spark, ((ONE, n),), ((ONE, n, 0),), df)
    assert gate.status == "HOLD" and "valid coverage 0." in gate.reasons
    assert "rule R06 (distance_in_range) FAIL rate=0." in gate.reasons


def test_empty_input_has_zero_coverage(spark):
    empty = _counts(spark, sample_months(spark).where("false"))
    assert quality.contract_totals(empty).first().coverage == 0.0
    results = quality.rule_results(empty, CONTRACT).collect()
    assert all(r.status in ("PASS", "UNKNOWN") for r in results)


def test_conservation_abort(spark):
    counts = _counts(spark, sample_months(spark))
    quality.require_conservation(quality.row_conservation(
        counts, _manifest(spark, *GOOD_MANIFEST)))
    with pytest.raises(ContractAbort):
        quality.require_conservation(quality.row_conservation(
            counts, _manifest(spark, (ONE, N), (TWO, N - 1))))


def test_outputs_are_counted_on_their_own(spark):
    staged = rules.stage(crafted_frame(spark), CONTRACT)
    bad, good = rules.quarantined(staged), rules.valid(staged)
    assert quality.conservation_of_outputs(staged, bad, good).first().ok
    lost = quality.conservation_of_outputs(staged, bad, good.where("i > 0"))
    with pytest.raises(ContractAbort):
        quality.require_conservation(lost)
    stale = good.union(good.limit(1).withColumn("month", rules.F.lit("2020-01")))
    assert {r.month: r.ok for r in quality.conservation_of_outputs(staged, bad, stale).collect()} == {ONE: True, "2020-01": False}


def test_results_tally_and_disclosures(spark):
    results = quality.rule_results(_counts(spark, crafted_frame(spark)), CONTRACT)
    rows = {r.id: r for r in results.collect()}
    assert len(rows) == 22 and rows["U1"].failures is None and rows["U1"].status == "UNKNOWN"
    tally = {r.status: r.rules for r in quality.status_tally(results).collect()}
    assert sum(tally.values()) == 22 and tally["UNKNOWN"] == 6
    assert {r.status for r in quality.disclosures(results, CONTRACT).collect()} <= {"WARN", "PASS"}


def test_valid_and_invalid_rate_sum_to_one(spark):
    from tripgauge.operators import metrics
    counts = _counts(spark, crafted_frame(spark))
    one = metrics.valid_rate(counts).join(metrics.invalid_rate(counts), "month").first()
    assert round(one.valid_trip_rate + one.invalid_trip_rate, 6) == 1.0


def test_duplicates_count_null_as_a_value(spark):
    df = spark.createDataFrame(
        [("m", None, 1), ("m", None, 1), ("m", "a", 1), ("m", "a", 2), ("n", "a", 1)],
        "month string, k string, extra int")
    got = {r.month: (r.rows, r.duplicates) for r in integrity.duplicate_audit(df, ("k",)).collect()}
    assert got == {"m": (4, 2), "n": (1, 0)}


def test_identical_rows_and_missing_key_columns(spark):
    df = spark.createDataFrame([("m", 3.5)] * 5, "month string, trip_distance double")
    row = integrity.duplicate_audit(df).first()
    assert (row.rows, row.duplicates) == (5, 4)
    bare = spark.createDataFrame([("m", 1)] * 3, "month string, x int")
    row = integrity.duplicate_audit(bare).first()
    assert (row.rows, row.duplicates) == (3, 0)


def test_reconciliation_never_reads_a_missing_count_as_zero(spark):
    expected = spark.createDataFrame([("a", 3), ("b", 4), ("c", None), ("d", 0)],
                                     "month string, expected_rows bigint")
    stored = spark.createDataFrame([("a", 3), ("b", 5), ("c", 1), ("e", 2)],
                                   "month string, rows bigint")
    out = integrity.count_reconciliation(expected, stored)
    assert {r.month: r.verdict for r in out.collect()} == {
        "a": "COMPLETE", "b": "INCOMPLETE", "c": "UNKNOWN", "d": "COMPLETE", "e": "UNKNOWN"}
    totals = integrity.reconciliation_totals(out).first()
    assert (totals.months, totals.months_reconciled, totals.all_reconciled) == (5, 2, False)


def test_month_windows_roll_over_the_year(spark):
    bounds = spark.sql("SELECT TIMESTAMP_NTZ'2023-11-15 10:00:00' AS first, "
                       "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last")
    rows = integrity.month_windows(bounds).orderBy("month").collect()
    assert [r.month for r in rows] == ["2023-11", "2023-12", "2024-01"]
    assert str(rows[1].window_end) == "2024-01-01 00:00:00"
    landed = spark.createDataFrame([("2023-12",)], "month string")
    left = integrity.months_to_process(integrity.month_windows(bounds), landed).collect()
    assert {r.month for r in left} == {"2023-11", "2024-01"}


def test_manifest_totals_and_empty_manifest(spark):
    m = spark.createDataFrame([(10, 5, True), (20, 6, None), (30, 7, False)],
                              "bytes bigint, row_count bigint, count_reconciled boolean")
    assert tuple(integrity.manifest_totals(m).first()) == (3, 60, 18, 1)
    with pytest.raises(ContractAbort):
        integrity.require_files(m.where("false"))


def test_reference_ids_in_both_directions(spark):
    a = spark.createDataFrame([(i,) for i in (1, 2, 264, 265)], "id int")
    b = spark.createDataFrame([(i,) for i in (1, 2, 300)], "id int")
    out = integrity.reference_id_diff(a, b, "csv", "api").collect()
    assert {(r.id, r.only_in) for r in out} == {(264, "csv"), (265, "csv"), (300, "api")}


def test_audit_by_digest_equals_the_plain_one(spark):
    rows = [(m, a, b) for i in range(400) for m, a, b in [(f"m{i % 3}", f"text {i % 37}", i % 5 if i % 7 else None)]]
    rows += [("m0", None, 1), ("m0", None, 1), ("m0", None, None), (None, "x", None), (None, "x", None)] + [("m1", "hot", 1)] * 500
    df = spark.createDataFrame(rows, "month string, a string, b long")
    as_set = lambda found: sorted((r.month or "", r.rows, r.duplicates) for r in found.collect())
    want = as_set(integrity.duplicate_audit(df, ("a", "b")))
    assert as_set(integrity.duplicate_audit_by_digest(df, ("a", "b", "absent"))) == want
    # planted collisions: every tuple shares its digest with others, or with all
    for weak in (("1L AS _high", "2L AS _low"), ("length(a) AS _high", "b AS _low")):
        assert as_set(integrity.duplicate_audit_by_digest(df, ("a", "b"), digest=weak)) == want
    whole = integrity.duplicate_audit_by_digest(df, ("a", "b"), by=()).first()
    assert whole == integrity.duplicate_audit(df, ("a", "b"), by=()).first()
    assert integrity.duplicate_audit_by_digest(df.limit(0), ("a",), by=()).first().rows == 0


def test_audit_by_digest_tells_where_the_null_is(spark):
    df = spark.createDataFrame([("m", None, "a"), ("m", "a", None)], "month string, a string, b string")
    assert integrity.duplicate_audit_by_digest(df, ("a", "b")).first().duplicates == 0
