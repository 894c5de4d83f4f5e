from collections import Counter
from fractions import Fraction

import numpy as np
from helpers import docs, empty
from pyspark.sql import functions as F

from tripgauge.llm import mixing
from tripgauge.llm.common import word_count

SF = "/root/testdata/sf0.001"


def test_targets_stop_at_twice_the_size_and_share_the_rest():
    got = mixing.target_words({"a": 100, "b": 100, "c": 100, None: 100})
    # weights 3 1 2 3 of 600: a and null hit 200, the rest goes 1 to 2 to b and c
    assert got == {"a": 200, "b": Fraction(200, 3), "c": Fraction(400, 3), None: 200}
    assert sum(mixing.target_words({"x": 7, "y": 0, "é": 1000, "z": 3}).values()) == Fraction(3, 2) * 1010
    assert mixing.target_words({}) == {} and mixing.target_words({None: 0}) == {None: 0}


def test_targets_follow_code_points():
    order = ["Z", "a", "é", "￿", "\U0001F600"]
    got = mixing.target_words({s: 10**6 for s in reversed(order)}, weights=(1, 2, 3, 4, 5), share=Fraction(1, 2))
    assert sorted(order, key=got.get) == order


def test_splitting_tree_deals_everything_once():
    quotas = [1000, 0, 17, 333]
    dealt = mixing.splitting_tree(quotas, 7, 3)
    assert dealt.sum(axis=0).tolist() == quotas and (dealt >= 0).all()
    assert abs(dealt.sum(axis=1) - sum(quotas) / 7).max() < 3
    assert np.array_equal(dealt, mixing.splitting_tree(quotas, 7, 3))
    shares = np.array([mixing.splitting_tree([600, 300], 2, s)[0] for s in range(200)])
    assert abs(shares[:, 0].mean() - 300) < 3 and 5 < shares[:, 0].std() < 9  # hypergeometric: 7.1


def test_mix_is_near_its_targets_and_repeats(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan_mix(table, block_words=200)
    rows = mixing.assign(table.withColumn("w", word_count(F.col("text"))), plan).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.w
        taken[r.source] += r.w * r.mix_copies
        target[r.source] = r.mix_target
        assert r.mix_copies == len(r.mix_shards) <= 2 and all(0 <= s < plan.shards for s in r.mix_shards)
    want = mixing.target_words(dict(sizes))
    largest = max(r.w for r in rows)
    assert all(abs(float(want[s]) - target[s]) < 1e-6 and abs(taken[s] - target[s]) <= largest for s in sizes)
    again = mixing.assign(table, mixing.plan_mix(table, block_words=200)).collect()
    assert sorted((r.doc_id, r.mix_copies, r.mix_shards) for r in rows) == sorted((r.doc_id, r.mix_copies, r.mix_shards) for r in again)


def test_shards_share_no_block(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan_mix(table, block_words=100)
    rows = mixing.mix(table, plan).collect()
    assert len(rows) == sum(r.mix_copies for r in mixing.assign(table, plan).collect())
    assert len({(r.doc_id, r.mix_copy) for r in rows}) == len(rows)
    assert len({r.mix_shard for r in rows}) == plan.shards


def test_written_shards_hold_the_mix(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan_mix(table, min_shards=3)
    mixing.write_mix(table, plan, str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.count() == mixing.mix(table, plan).count()


def test_awkward_rows(spark):
    table = docs(spark)
    plan = mixing.plan_mix(table)
    rows = mixing.assign(table, plan).collect()
    assert len(rows) == table.count() and rows[0]["size"] in ("x", None)
    assert all(r.mix_source_size == 0 or r.mix_copies <= 2 for r in rows)
    assert mixing.mix(table, plan).columns[:7] == table.columns
    none = mixing.plan_mix(empty(spark))
    assert none.sources == [] and mixing.assign(empty(spark), none).count() == 0


def _sources_with_one_huge_document(spark):
    """Six sources of 401 documents, one of them nearly half of its source."""
    sizes, rows = np.random.default_rng(5).integers(40, 460, 400).tolist(), []
    for source in "abcdef":
        rows += [(len(rows) + i, n, source) for i, n in enumerate([*sizes, sum(sizes) * 9 // 10])]
    return spark.createDataFrame(rows, "doc_id long, n int, source string").selectExpr("doc_id", "repeat('w ', n) AS text", "source")


def test_a_huge_document_stops_nothing(spark):
    table = _sources_with_one_huge_document(spark)
    plan = mixing.plan_mix(table, weights=(1,), block_words=2000)
    hashed = table.withColumn("w", word_count(F.col("text"))).withColumn("h", mixing._hash(plan.seed))
    taken = {r.doc_id: r for r in mixing.assign(hashed, plan).collect()}
    for p in plan.sources:
        rows = sorted((r for r in taken.values() if r.source == p.source), key=lambda r: r.h)
        left, once_more = p.target - p.passes * p.size, set()
        for r in rows:  # the order gone through one by one
            if r.w <= left:
                left -= r.w
                once_more.add(r.doc_id)
        got = {r.doc_id for r in rows if r.mix_copies > p.passes}
        assert once_more <= got and len(got - once_more) <= 1
        assert abs(sum(r.w * r.mix_copies for r in rows) - p.target) <= 0.001 * p.target
        assert all(len(r.mix_shards) == r.mix_copies and max(r.mix_shards) < plan.shards for r in rows)
    assert plan.dealt.sum(axis=0).tolist() == [p.quota for p in plan.sources]


def test_rows_that_share_an_id_are_parted(spark):
    table = _sources_with_one_huge_document(spark).where("source < 'c'")
    twice = table.union(table.where("length(text) < 500"))
    plan = mixing.plan_mix(twice, weights=(1,), block_words=2000)
    rows = mixing.assign(twice.withColumn("w", word_count(F.col("text"))), plan).collect()
    for p in plan.sources:
        own = [r for r in rows if r.source == p.source]
        assert abs(sum(r.w * r.mix_copies for r in own) - p.target) <= 0.002 * p.target


def test_a_source_of_copies_meets_its_target(spark):
    """Forty equal rows of ten words, 600 words wanted; and a source whose copies lie in many tasks."""
    rows = [(1, "w " * 10, "a", i % 3) for i in range(40)] + [(2 + i % 4, f"t{i % 4} " + "w " * 9, "b", i) for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").repartition(7)
    plan = mixing.plan_mix(table, weights=(1,), block_words=200)
    got = mixing.assign(table.withColumn("w", word_count(F.col("text"))), plan).collect()
    assert Counter((r.doc_id, r.extra) for r in got) == Counter((r[0], r[3]) for r in rows)
    for p in plan.sources:
        own = [r for r in got if r.source == p.source]
        assert abs(sum(r.w * r.mix_copies for r in own) - p.target) <= 10
        assert all(r.mix_copies in (1, 2) and len(r.mix_shards) == r.mix_copies for r in own)
    again = mixing.assign(table.withColumn("w", word_count(F.col("text"))).repartition(3), mixing.plan_mix(table, weights=(1,), block_words=200)).collect()
    assert Counter((r.doc_id, r.mix_copies) for r in again) == Counter((r.doc_id, r.mix_copies) for r in got)


def test_long_runs_of_copies_unfold_whole(spark):
    units = spark.createDataFrame([("a", 5, 70, 7), ("a", 6, 4, 1), (None, 5, 0, 3)], "source string, hash long, size long, n long")
    got = Counter((r.source, r["size"]) for r in mixing._one_by_one(units, chunk=3).collect())
    assert got == {("a", 10): 7, ("a", 4): 1, (None, 0): 3}
    assert mixing._one_by_one(units, chunk=3).select("source", "hash").distinct().count() == 11


def test_columns_named_like_the_mix_pass_through(spark):
    table = spark.createDataFrame([(i, "w " * 30, "a", f"n{i}") for i in range(9)], "doc_id long, text string, source string, mix_note string")
    rows = mixing.mix(table, mixing.plan_mix(table)).collect()
    assert {r.mix_note for r in rows} <= {f"n{i}" for i in range(9)} and all(r.mix_note == f"n{r.doc_id}" for r in rows)


def test_rows_with_a_null_id_are_parted(spark):
    n = np.random.default_rng(6).integers(40, 460, 900).tolist()
    rows = [(None if i % 3 == 0 else i, f"number{i} " + "w " * k, "ab"[i % 2]) for i, k in enumerate(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(table, weights=(1,), block_words=2000)
    got = mixing.assign(table.withColumn("w", word_count(F.col("text"))), plan).collect()
    for p in plan.sources:
        own = [r for r in got if r.source == p.source]
        assert abs(sum(r.w * r.mix_copies for r in own) - p.target) <= 0.002 * p.target
        assert 0.3 < np.mean([r.mix_copies > p.passes for r in own if r.doc_id is None]) < 0.7
