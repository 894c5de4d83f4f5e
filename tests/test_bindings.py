"""The order lines as trips, over rows of the test's own."""

import os

from tripgauge.operators import rules
from tripgauge.plans import bindings
from tripgauge.plans.bindings import Fulfilment
from tripgauge.sources.tables import FOLDER, in_month_order, read_months, write_months


def _tables(spark, path):
    """Orders that repeat, lines without an order or a key, and equal lines."""
    day = "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval({})"
    number, keyed = "CAST(id AS BIGINT)", "IF(id % 17 = 0, NULL, id % 40)"
    made = {
        "lineitem": spark.range(300).selectExpr(
            f"{keyed} AS l_orderkey", f"{number} AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
            "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "0.1D AS l_discount", "0.2D AS l_tax",
            "'A' AS l_returnflag", "'O' AS l_linestatus", f"{day.format('CAST(id % 3 + 40 AS INT)')} AS l_shipdate"),
        "orders": spark.range(38).selectExpr(
            "IF(id = 37, NULL, id % 35) AS o_orderkey", "id % 6 AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
            f"{day.format('CAST(id AS INT)')} AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "customer": spark.range(5).selectExpr("id AS c_custkey", "CAST(id AS INT) AS c_nationkey"),
        "supplier": spark.range(5).selectExpr("id AS s_suppkey", "CAST(id AS INT) AS s_nationkey"),
    }
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lines_a_task_joins_do_not_grow(spark, tmp_path, monkeypatch):
    """300 lines, at most 20 a task: 15 partitions for the lines and for the promised counts."""
    path = _tables(spark, tmp_path)
    plain = Fulfilment(spark, path)
    assert plain.parts is None
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 20)
    sized = Fulfilment(spark, path)
    assert sized.parts == 15 and sized.lines.rdd.getNumPartitions() == 15
    plan = sized.provenance._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 15), REPARTITION_BY_NUM") == 4
    assert _rows(sized.lines) == _rows(plain.lines) and len(_rows(plain.lines)) > 200
    assert _rows(sized.provenance) == _rows(plain.provenance)


def test_rows_for_month_tables_keep_sparks_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 20)
    b = Fulfilment(spark, _tables(spark, tmp_path))
    assert "REPARTITION_BY_NUM" not in b.raw_for_months._jdf.queryExecution().executedPlan().toString()
    assert _rows(b.raw_for_months) == _rows(b.raw)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def _below(plan, wanted):
    """The subtree of the first node that has this text."""
    at = next(i for i, line in enumerate(plan) if wanted in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    end = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    return "\n".join(plan[at:end])


def test_customers_meet_orders_and_never_shuffle_lines(spark, tmp_path):
    b = Fulfilment(spark, _tables(spark, tmp_path))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = _below(_plan(b.lines), "hashpartitioning(o_custkey")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "o_orderkey" in moved and "l_orderkey" not in moved


def test_month_tables_sort_lines_and_not_staged_rows(spark, tmp_path):
    b = Fulfilment(spark, _tables(spark, tmp_path))
    staged = rules.stage(b.raw_by_folder, b.contract)
    assert not staged.schema[FOLDER].nullable
    below = _below(_plan(staged), f"Sort [{FOLDER}")
    assert "SortMergeJoin" in below and "fail_reasons" not in below and "t_seconds" not in below
    write_months(staged, f"{tmp_path}/by-folder")
    write_months(rules.stage(b.raw, b.contract), f"{tmp_path}/plain")
    found = read_months(spark, f"{tmp_path}/by-folder")
    assert _rows(found) == _rows(read_months(spark, f"{tmp_path}/plain").select(found.columns)) and FOLDER not in found.columns


def test_months_that_are_null_or_empty_keep_their_folder(spark, tmp_path):
    rows = spark.createDataFrame([(i, m) for i, m in enumerate([None, "2020-02", "", "2020-01", None, "2020-02", ""])], "id long, month string")
    write_months(in_month_order(rows.coalesce(1), "month"), f"{tmp_path}/sorted")
    write_months(rows.coalesce(1), f"{tmp_path}/plain")
    assert _rows(read_months(spark, f"{tmp_path}/sorted")) == _rows(read_months(spark, f"{tmp_path}/plain"))
    folders = [sorted(f for f in os.listdir(f"{tmp_path}/{name}") if f.startswith("month")) for name in ("sorted", "plain")]
    assert folders[0] == folders[1] and len(folders[0]) == 3
