import gzip
import hashlib
import json

from fixtures import MONTHS, PER_MONTH, sample_months
from pyspark.sql import functions as F

from tripgauge.operators.integrity import duplicate_audit
from tripgauge.sources import files, fingerprint, pages, reports, tables
from tripgauge.streaming.landing import land_new_pages


def _page(folder, number, header, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    body = "\n".join([",".join(f'"{h}"' for h in header), *rows]) + "\n"
    (folder / f"page_{number:04d}.csv.gz").write_bytes(gzip.compress(body.encode()))


def test_pages_are_typed(spark, tmp_path):
    lines = ['"2021-06-05 06:30:00",17.5,"4, maybe",9.75', '"soon",0.4,40,', '"2021-06-06 21:15:09",n/a,7,"1e2"']
    _page(tmp_path / "2021-06", 3, ["TPEP_Pickup_Datetime", "trip_distance", "DOLocationID", "tip_amount"], *lines)
    df = pages.retype(pages.read_pages(spark, str(tmp_path / "2021-06")))
    kinds = dict(df.dtypes)
    assert {k: kinds[k] for k in ("tpep_pickup_datetime", "trip_distance", "dolocationid", "month")} == {
        "tpep_pickup_datetime": "timestamp_ntz", "trip_distance": "double", "dolocationid": "bigint", "month": "string"}
    rows = sorted((str(r.tpep_pickup_datetime), r.trip_distance, r.dolocationid, r.tip_amount, r.vendorid, r.month) for r in df.collect())
    assert rows == [("2021-06-05 06:30:00", 17.5, None, 9.75, None, "2021-06"),
                    ("2021-06-06 21:15:09", None, 7, 100.0, None, "2021-06"), ("None", 0.4, 40, None, None, "2021-06")]
    assert duplicate_audit(df).first().duplicates == 0


def test_repeated_page_rows_are_duplicates(spark, tmp_path):
    first, second = "88,2021-07-04 00:00:01,12.00", "13,2021-07-04 00:00:01,12.00"
    header = ["pulocationid", "tpep_pickup_datetime", "total_amount"]
    _page(tmp_path / "2021-07", 1, header, first, second, first)
    _page(tmp_path / "2021-07", 2, header, second, second, first, "")
    df = pages.retype(pages.read_pages(spark, str(tmp_path / "2021-07")))
    audit = duplicate_audit(df).first()
    assert (audit.month, audit.rows, audit.duplicates) == ("2021-07", 6, 4)


def test_pages_are_read_once_and_without_lists(spark, tmp_path):
    _page(tmp_path / "2021-07", 1, ["vendorid"], "1")
    plan = pages.read_pages(spark, str(tmp_path / "2021-07"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_pages_with_other_column_orders_bind_by_name(spark, tmp_path):
    _page(tmp_path / "2021-06", 1, ["trip_distance", "vendorid"], "1.5,2")
    _page(tmp_path / "2021-06", 2, ["vendorid", "trip_distance"], "6,2.5")
    _page(tmp_path / "2021-07", 1, ["vendorid"], "1", "1")
    df = pages.retype(pages.read_pages(
        spark, [str(tmp_path / "2021-06"), str(tmp_path / "2021-07")]))
    got = sorted((r.month, r.vendorid, r.trip_distance) for r in
                 df.na.fill(-1.0, ["trip_distance"]).collect())
    assert got == [("2021-06", 2, 1.5), ("2021-06", 6, 2.5), ("2021-07", 1, -1.0),
                   ("2021-07", 1, -1.0)]


def test_quoted_cells_hold_breaks_commas_and_quotes(spark, tmp_path):
    wide = [f"extra_{i}" for i in range(70)]
    _page(tmp_path / "2021-08", 1, [*wide, "store_and_fwd_flag", "vendorid", "trip_distance"],
          ",".join(map(str, range(70))) + ',"a\nb, ""c""\r\n",1,2.5', "x" + "," * 70 + '"""",2,"3"', "," * 70 + '"",6,')
    got = pages.read_pages(spark, str(tmp_path / "2021-08"), ["vendorid", "store_and_fwd_flag", "trip_distance", "extra_0", "extra_69", "gone"])
    assert sorted((tuple(r)[:-1] for r in got.collect()), key=str) == sorted([
        ("1", 'a\nb, "c"\r\n', "2.5", "0", "69", None), ("2", '"', "3", "x", None, None), ("6", None, None, None, None, None)], key=str)
    whole = pages.read_pages(spark, str(tmp_path / "2021-08"), None)
    assert len(whole.columns) == 74 and whole.where("extra_42 = '42'").count() == 1


def test_crafted_pages(spark):
    def rows(text, columns=("a", "b")):
        page = spark.createDataFrame([("/x/2021-08/page_1.csv", text)], "path string, value string")
        return [tuple(r) for r in pages.rows_of_pages(page, columns).collect()]

    m = "2021-08"
    assert rows('a,b\r\n1,2\r\n\r\n"3\r\n","4"\r\n') == [("1", "2", m), ("3\r\n", "4", m)]
    assert rows('\ufeff"b","A"\n"x,y","\x01\x1e\x1e1"') == [("\x01\x1e\x1e1", "x,y", m)]
    assert rows('a,b\n5" pipe,1\n6,2') == [('5" pipe', "1", m), ("6", "2", m)]  # a stray quote swallows nothing
    assert rows('a,b\n"open,1\n6,2') == [('"open', "1", m), ("6", "2", m)]
    assert rows('a,b\n1\n1,2,3') == [("1", None, m), ("1", "2", m)]
    assert rows("a,b") == rows("") == []
    many = '""' * 20_000
    assert rows(f'a,b\n"{many}\n",1') == [('"' * 20_000 + "\n", "1", m)]


def test_landing_takes_each_page_once(spark, tmp_path):
    source, out = tmp_path / "landing", str(tmp_path / "raw")
    checkpoint = str(tmp_path / "checkpoint")
    _page(source / "2021-06", 1, ["vendorid", "trip_distance"], "1,1.0", "2,2.0")
    land_new_pages(spark, str(source), out, checkpoint)
    assert spark.read.parquet(out).count() == 2
    land_new_pages(spark, str(source), out, checkpoint)
    assert spark.read.parquet(out).count() == 2
    _page(source / "2021-07", 1, ["trip_distance", "vendorid"], "3.0,6")
    land_new_pages(spark, str(source), out, checkpoint)
    rows = sorted((str(r.month), r.vendorid, r.trip_distance)
                  for r in tables.read_months(spark, out).collect())
    assert rows == [("2021-06", 1, 1.0), ("2021-06", 2, 2.0), ("2021-07", 6, 3.0)]


def test_zone_lookup_reads_na_as_missing(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n9,"North","Old Mill","x"\n'
                    '31,"South","N/A","N/A"\n32,"N/A","Harbour","N/A"\n')
    rows = {r.pickup_zone_id: r for r in pages.read_zone_lookup(spark, str(path)).collect()}
    assert rows[31].pickup_zone is None and rows[32].borough is None
    assert rows[9].pickup_zone == "Old Mill"


def test_zone_pages(spark, tmp_path):
    (tmp_path / "page_0001.json").write_text(json.dumps(
        [{"locationid": "1", "zone": "a", "borough": "x"}, {"locationid": "2", "zone": "b"}]))
    (tmp_path / "page_0002.json").write_text(json.dumps([{"locationid": "3"}]))
    ids = {r.locationid for r in pages.read_zone_pages(spark, str(tmp_path)).collect()}
    assert ids == {1, 2, 3}


def _report(path):
    results = [
        {"month": m, "dataset": "d", "where": "w", "count_query": {"count": n, "status": s},
         "rows": PER_MONTH, "match": n == PER_MONTH, "composite_key_duplicates": 0,
         "retrieval": {"page_count": 1, "raw_dir": "r"}}
        for m, n, s in ((MONTHS[0], PER_MONTH, "OK"), (MONTHS[1], None, "UNKNOWN (Timeout)"))]
    path.write_text(json.dumps({"retrieved_at": "t", "trips": {
        "trips:2021": {"results": results, "totals": {}}}}, indent=1))


def test_nested_report_is_flattened(spark, tmp_path):
    path = tmp_path / "report.json"
    _report(path)
    rows = {r.month: r for r in reports.read_retrieval_report(spark, str(path)).collect()}
    assert rows[MONTHS[0]].api_count == PER_MONTH and rows[MONTHS[0]].count_reconciled
    assert rows[MONTHS[1]].api_count is None and rows[MONTHS[1]].count_status.startswith("UNKNOWN")


def test_provenance_is_one_row_per_month(spark):
    import pytest

    from tripgauge.contract import ContractAbort
    schema = "month string, api_count bigint"
    same = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], schema)
    assert reports.one_per_month(same).count() == 2
    with pytest.raises(ContractAbort, match="contradicts"):
        reports.one_per_month(same.union(spark.createDataFrame([("b", 5)], schema)))


def test_a_cell_that_moves_past_a_missing_one_changes_the_fingerprint(spark):
    def of(*row):
        return spark.createDataFrame([row], "a string, b string, c string").selectExpr(fingerprint.rendered_row(["a", "b", "c"])).first()[0]

    rows = [(None, "x", "y"), ("x", None, "y"), ("x", "y", None), ("", "x", "y"), ("x,1:y", None, None), ("-", "x", "y")]
    assert len({of(*r) for r in rows}) == len(rows)


def test_months_are_replaced_by_nothing_too(spark, tmp_path):
    base, df = str(tmp_path / "t"), sample_months(spark)
    tables.replace_months(df, base, MONTHS)
    left = tables.replace_months(df.where("false"), base, [MONTHS[1]])
    assert left.count() == 0 and left.columns[-1] == "month"
    assert {r.month: r["count"] for r in tables.read_months(spark, base).groupBy("month").count().collect()} == {MONTHS[0]: PER_MONTH}
    assert tables.replace_months(df.where("false"), str(tmp_path / "none"), MONTHS).count() == 0


def test_a_killed_replacement_leaves_the_months_readable(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    base, df = str(tmp_path / "t"), sample_months(spark)
    tables.replace_months(df, base, MONTHS)
    doomed = df.withColumn("trip_distance", F.when(F.col("pulocationid") % 7 == 3, F.raise_error("killed")).otherwise(F.lit(1.0)))
    with pytest.raises(PySparkException):
        tables.replace_months(doomed, base, MONTHS)
    # a job that dies after the rows and before the pointers has written whole files of a version that nobody reads
    df.limit(3).withColumn("version", F.lit("dead")).write.mode("append").partitionBy("month", "version").parquet(base)
    assert tables.read_months(spark, base).count() == 2 * PER_MONTH
    after = tables.replace_months(df.where(f"month = '{MONTHS[1]}'").limit(5), base, [MONTHS[1]])
    assert after.count() == 5 and tables.read_months(spark, base).count() == PER_MONTH + 5
    assert tables.read_months(spark, base, [MONTHS[1]]).count() == 5
    tables.replace_months(df, base, MONTHS)
    assert not list(tmp_path.glob("t/month=*/version=dead")) and tables.read_months(spark, base).count() == 2 * PER_MONTH
    assert "version" not in tables.read_months(spark, base).columns
    assert {r.month: r.rows for r in tables.pointers(spark, base).collect()} == dict.fromkeys(MONTHS, PER_MONTH)


def test_files_describe_themselves(spark, tmp_path):
    base = tmp_path / "t"
    tables.write_sorted_months(sample_months(spark).repartition(3), str(base))
    found = {r.path.rsplit(":", 1)[-1].lstrip("/"): r for r in files.describe_files(spark, str(base), hashed=True, key="tpep_pickup_datetime").collect()}
    for path in base.rglob("*.parquet"):
        row = found[str(path).lstrip("/")]
        assert row.sha256 == hashlib.sha256(path.read_bytes()).hexdigest() and row.bytes == path.stat().st_size
        assert f"month={row.month}" in row.path and len(row.header) == 19
    assert sum(r.row_count for r in found.values()) == 2 * PER_MONTH
    ranges = files.key_ranges(files.describe_files(spark, str(base), key="tpep_pickup_datetime"), "timestamp_ntz")
    assert files.overlaps(ranges).count() == 0
    first = min(r.low for r in ranges.collect())
    assert 0 < files.files_in_range(ranges, f"timestamp_ntz'{first}'", f"timestamp_ntz'{first}'").count() < len(found) or len(found) == 1
    assert files.overlaps(ranges.union(ranges)).count() > 0


def test_every_file_must_have_the_contract_columns(spark, tmp_path):
    import pytest

    from tripgauge.contract import ContractAbort

    base = str(tmp_path / "t")
    tables.write_months(sample_months(spark).coalesce(1), base)
    short = sample_months(spark, MONTHS[1:]).drop("congestion_surcharge").withColumn("new_one", F.lit(1))
    short.coalesce(1).write.mode("append").partitionBy("month").parquet(base)
    schemas = files.schema_by_file(files.describe_files(spark, base))
    assert sorted((r.month, r.status, r.missing_columns, r.unexpected_columns) for r in schemas.collect()) == [
        (MONTHS[0], "PASS", [], []), (MONTHS[1], "FAIL", ["congestion_surcharge"], ["new_one"]), (MONTHS[1], "PASS", [], [])]
    for _ in range(5):
        with pytest.raises(ContractAbort, match=f"month={MONTHS[1]}.*congestion_surcharge"):
            files.require_file_schemas(schemas)


def test_missing_report_is_empty(spark, tmp_path):
    df = reports.read_retrieval_report(spark, str(tmp_path / "absent.json"))
    assert df.count() == 0 and "api_count" in df.columns


def test_written_months_replace_only_themselves(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.write_months(sample_months(spark), base)
    tables.write_months(sample_months(spark, (MONTHS[1],)).limit(7), base)
    got = {r.month: r["count"] for r in
           tables.read_months(spark, base).groupBy("month").count().collect()}
    assert got == {MONTHS[0]: PER_MONTH, MONTHS[1]: 7}


def test_month_subset_prunes_folders(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.write_months(sample_months(spark), base)
    df = tables.read_months(spark, base, [MONTHS[1]])
    assert df.count() == PER_MONTH
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and MONTHS[1] in plan


def test_sorted_months_are_in_key_order_and_zstd(spark, tmp_path):
    base = tmp_path / "t"
    tables.write_sorted_months(sample_months(spark).repartition(5), str(base))
    import pyarrow.parquet as pq
    files = list(base.glob("month=*/*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    for f in files:
        times = pq.ParquetFile(f).read()["tpep_pickup_datetime"].to_pylist()
        assert times == sorted(times)


def test_report_csv_is_one_sorted_file(spark, tmp_path):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "a int, b int")
    texts = []
    for name in ("x", "y"):
        tables.write_report_csv(df.repartition(3), str(tmp_path / name), "a", "b")
        files = list((tmp_path / name).glob("part-*.csv"))
        assert len(files) == 1
        texts.append(files[0].read_text())
    assert texts[0] == texts[1] and texts[0].splitlines()[0] == "a,b"
    rows = [tuple(map(int, line.split(","))) for line in texts[0].splitlines()[1:]]
    assert rows == sorted(rows)


def test_fingerprints(spark, tmp_path):
    base = tmp_path / "f"
    sample_months(spark).coalesce(1).write.parquet(str(base))
    file = next(base.glob("part-*.parquet"))
    row = fingerprint.byte_fingerprint(spark, str(file)).first()
    assert row.sha256 == hashlib.sha256(file.read_bytes()).hexdigest()
    assert row.bytes == file.stat().st_size
    one = fingerprint.content_fingerprint(spark.read.parquet(str(base))).first()
    assert (one["name"], one.row_count, one.header_column_count) == (file.name, 2 * PER_MONTH, 20)
    other = tmp_path / "g"
    sample_months(spark).orderBy("pulocationid").coalesce(1).write.parquet(
        str(other))
    two = fingerprint.content_fingerprint(spark.read.parquet(str(other))).first()
    assert one.content_hash == two.content_hash


def test_manifest_joins_provenance(spark, tmp_path):
    base, path = str(tmp_path / "raw"), tmp_path / "report.json"
    tables.write_months(sample_months(spark), base)
    _report(path)
    manifest = fingerprint.build_manifest(
        files.describe_files(spark, base, hashed=True), reports.read_retrieval_report(spark, str(path)))
    rows = {r.month: r for r in manifest.collect()}
    assert rows[MONTHS[0]].header_column_count == 19 and len(rows[MONTHS[0]].sha256) == 64
    assert rows[MONTHS[0]].row_count == PER_MONTH and rows[MONTHS[0]].count_reconciled is True
    assert rows[MONTHS[0]].bytes > 0 and rows[MONTHS[1]].api_count is None
