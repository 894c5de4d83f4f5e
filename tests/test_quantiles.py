"""The distributed quantile against a plain sort, on shapes that hurt."""

import math
import random
from collections import defaultdict

import pytest

from tripgauge.operators.quantiles import REFINEMENTS, distribution, distribution_by_scans, value_bin, value_histogram

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p80": 0.8, "p90": 0.9, "p100": 1.0}


def _interpolated(values, p):
    values = sorted(values)
    pos = p * (len(values) - 1)
    low, high = math.floor(pos), math.ceil(pos)
    w = pos - low
    if w == 0:
        return values[low]
    return math.fma(values[low], 1 - w, values[high] * w)


def _check(spark, rows, way=distribution, **options):
    df = spark.createDataFrame(rows, "g string, v double, ok boolean")
    got = {r.g: r for r in way(df, ["g"], "v", PROBS, {"share": "ok"}, **options).collect()}
    groups = defaultdict(list)
    for g, v, ok in rows:
        groups[g].append((v, ok))
    assert set(got) == set(groups)
    for g, members in groups.items():
        values = [v for v, _ in members if v is not None]
        known = [ok for _, ok in members if ok is not None]
        assert got[g].trips == len(members)
        assert got[g].share == (sum(known) / len(known) if known else None)
        for name, p in PROBS.items():
            assert got[g][name] == (_interpolated(values, p) if values else None), (g, name)


def test_one_hot_group_and_small_ones(spark):
    rng = random.Random(1)
    rows = [("hot", round(rng.lognormvariate(2, 1), 2), rng.random() < 0.3) for _ in range(4000)]
    rows += [(f"g{i}", round(rng.uniform(0, 50), 2), None) for i in range(7) for _ in range(i + 1)]
    rng.shuffle(rows)
    _check(spark, rows)


def test_ties_signs_zero_and_tiny_values(spark):
    values = [-5.5, -5.5, -0.0, 0.0, 0.0, 1e-300, 1e-300, 3.0, 3.0, 3.0, 1e300, -1e300]
    _check(spark, [("a", v, i % 2 == 0) for i, v in enumerate(values * 3)])


def test_one_value_repeated(spark):
    _check(spark, [("a", 7.25, i % 3 == 0) for i in range(500)])


def test_null_group_and_null_values(spark):
    rows = [(None, 1.0, True), (None, 3.0, False), ("x", None, None), ("x", None, True),
            ("y", None, False), ("y", 2.0, None)]
    _check(spark, rows)


def test_values_in_one_bin(spark):
    base = 1000.0
    _check(spark, [("a", base + i * 1e-9, None) for i in range(300)])


def test_bins_keep_the_order(spark):
    rng = random.Random(2)
    values = sorted([rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(3000)]
                    + [0.0, 1.0, 2.0, math.nextafter(2.0, 1), math.inf, -math.inf])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    by_value = [r.b for r in df.selectExpr("v", f"{value_bin('v')} AS b").orderBy("v").collect()]
    assert by_value == sorted(by_value)


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "g string, v double")
    got = {(r.g, r.value): r.n for r in value_histogram(df, ["g"], "v").collect()}
    assert got == {("a", 1.0): 2, ("b", 2.0): 1}


@pytest.mark.parametrize("parts", [1, 3])
def test_row_order_and_partitions_do_not_matter(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.uniform(0, 9)) for _ in range(400)]
    want = None
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
        got = sorted(map(tuple, distribution(df, ["g"], "v", {"p": 0.8}).collect()))
        want = want or got
        assert got == want


def test_without_any_broadcast(spark):
    """The way a large cluster takes: every join shuffled, AQE free to split it."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rng = random.Random(4)
        rows = [(rng.choice(["hot", "hot", "a", None]), round(rng.uniform(-9, 9), 1),
                 rng.choice([True, False, None])) for _ in range(2000)]
        _check(spark, rows)
        df = spark.createDataFrame(rows, "g string, v double, ok boolean")
        plan = distribution(df, ["g"], "v", PROBS)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("most", [1, 1000])
def test_by_scans(spark, most):
    rng = random.Random(5)
    rows = [("hot", rng.lognormvariate(2, 1), rng.random() < 0.3) for _ in range(3000)] + [("hot", 7.25, None)] * 900
    rows += [("dense", 1000 + i * 1e-9, True) for i in range(300)] + [(None, v, None) for v in (-5.5, -5.5, -0.0, 0.0, 1e-300, -1e300)]
    rows += [("none", None, True), ("none", None, None), ("some", None, False), ("some", 2.0, None)]
    rng.shuffle(rows)
    _check(spark, rows, distribution_by_scans, most_values=most)


def test_scans_shuffle_bins_and_not_values(spark):
    """All values differ, yet what the last step orders are the values of a few narrow bins."""
    df = spark.range(200_000).selectExpr("'g' AS g", "10D + rand(3) AS v")
    df.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/distinct-doubles")
    df = spark.read.parquet(path)
    got = distribution_by_scans(df, ["g"], "v", {"p80": 0.8}, most_values=100).first()
    values = sorted(r.v for r in df.collect())
    assert got.p80 == _interpolated(values, 0.8)
    inside = df.groupBy(*[value_bin_of(b) for b in REFINEMENTS[:2]]).count()
    largest = [inside.groupBy(f"b{b}").sum("count").agg({"sum(count)": "max"}).first()[0] for b in REFINEMENTS[:2]]
    assert largest[0] > 500 and largest[1] <= 10


def value_bin_of(bits):
    from pyspark.sql import functions as F

    return F.expr(f"{value_bin('v', 1 << bits)} AS b{bits}")


def test_finer_bins_lie_inside_coarser_ones(spark):
    rng = random.Random(6)
    values = sorted(rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(3000))
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[value_bin_of(b) for b in REFINEMENTS]).orderBy("v")
    rows = df.collect()
    for coarse, fine in zip(REFINEMENTS, REFINEMENTS[1:]):
        pairs = {(r[f"b{fine}"], r[f"b{coarse}"]) for r in rows}
        assert len(pairs) == len({f for f, _ in pairs})
        assert [r[f"b{fine}"] for r in rows] == sorted(r[f"b{fine}"] for r in rows)
