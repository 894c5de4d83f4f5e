import hashlib

import pytest

from tripgauge.llm import warc

RECORD = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
BIG = "x" * 3000
PAGES = [
    (1, "u1", RECORD * 3), (2, "u2", "ab" + RECORD), (3, "u3", RECORD + "\r\n"), (4, None, None), (5, "u\r\nX: 1", "WARC/1.0\r\n"),
    (6, "u6", BIG), (7, "u7", BIG), (8, "u8", BIG), (None, "n", BIG), (9, "u9", "\r\n\r\nWARC/1.0\r\nContent-Length: 999\r\n\r\n"),
    (10, "u10", "é" * 700 + "WARC/1.0\r\n" * 5), (11, "small", "y" * 999), (12, "small", "y" * 999), (13, "twice", "z"), (13, "twice", "z"),
    (14, "", ""), *((100 + i, f"v{i}", RECORD * i + "t") for i in range(30)),
]
SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("split", ["128m", "1000", "300"])
def test_round_trip_whatever_the_splits(spark, tmp_path, split):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(2), path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archives(spark, path, with_payload=True).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)
    want = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        again = data == BIG.encode() and page_id != 8
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 8 if again else None))
    assert got == sorted(want, key=repr)
    by_id = {p: (h or "").encode() for p, _, h in PAGES}
    assert all(bytes(r.payload) == by_id[r.page_id] for r in rows if r.record_type == "response")
    assert {r.page_id: r.url for r in rows}[5] == "u%0D%0AX: 1" and {r.page_id: r.url for r in rows}[4] is None


def test_foreign_and_broken_files(spark, tmp_path):
    good = RECORD.replace("WARC-Type", "warc-type")
    (tmp_path / "a.warc").write_bytes((good * 2 + "WARC/1.0\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n" + good).encode())
    (tmp_path / "b.warc").write_bytes(("noise " + good).encode())
    (tmp_path / "c.warc").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.file.rsplit("/", 1)[1] for r in rows if r.record_type == "response"] == ["a.warc"] * 2


def test_empty_and_whole_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    pages = {r.page_id: r.html.encode() for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = warc.op5_warc(spark, "/root/testdata/sf0.001").collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {k: (len(v), hashlib.sha1(v).hexdigest()) for k, v in pages.items()}
    assert len(rows) == len(pages)


def test_pages_equal_sql(spark, tmp_path, monkeypatch):
    """The query's SQL over crafted pages and over the small table."""
    import duckdb

    from tripgauge.llm.oracle import WARC

    spark.createDataFrame(PAGES, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    for folder, files in ((str(tmp_path), "pages.parquet/*.parquet"), ("/root/testdata/sf0.001", "pages.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/{files}'")
        want = con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({WARC})").fetchall()
        assert sorted(map(repr, map(tuple, warc.op5_warc(spark, folder).collect()))) == sorted(map(repr, want))
