import corpus_pipeline
import pytest
from helpers import docs, empty

import __spark_entry__ as entry
from tripgauge.llm import oracle, queries

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = set(queries.build())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert names | {"pipeline"} <= set(entry.queries()) and set(oracle.build()) <= names and oracle.build().items() <= entry.oracle_sql().items()


def test_stages_one_after_the_other(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    now = table
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == table.columns
        out.write.parquet(str(tmp_path / name))
        before, now = now, spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in now.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name in ("language", "quality", "near_duplicates"):
            assert len(ids) == now.count()
        if name == "near_duplicates":
            texts = [r.text for r in now.collect()]
            assert len(set(texts)) == len(texts)
    assert now.where("NOT round_trip").count() == 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(str(tmp_path / "quality")).collect()}
    marked = [d for d, q in labels.items() if q == 1]
    assert sum(d in good for d in marked) >= 0.97 * len(marked)


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_take_awkward_and_empty_tables(spark, stage):
    assert stage[1](spark, empty(spark), SF).count() == 0
    rows = stage[1](spark, docs(spark), SF).collect()
    assert rows and (stage[0] != "language" or all(r.text and r.text.strip() for r in rows))


def test_mix_stage_lays_rows_out_by_shard(spark):
    from tripgauge.llm import mixing

    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r.mix_shard, r.mix_key, r.doc_id) for r in mixing.mix(table, mixing.plan_mix(table)).collect())
    got = corpus_pipeline.mixed(spark, table, SF)
    assert got.columns == table.columns and [r.doc_id for r in got.collect()] == [d for *_, d in want]


CLASHING = ["doc", "own_id", "hash", "size", "score", "lang_pred", "lang_score", "quality_score", "print", "first_id", "root", "component_id", "text_hash",
            "mix_note", "mix_shard", "mix_key", "mix_copies", "_doc", "_hash", "place", "row", "pieces", "ids", "round_trip"]


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_give_back_columns_named_like_their_own(spark, stage):
    from pyspark.sql import functions as F

    table = docs(spark).select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))).alias(c) for c in CLASHING])
    rows = stage[1](spark, table, SF)
    if stage is not corpus_pipeline.STAGES[-1]:
        assert rows.columns == table.columns
        assert all(r[c] == f"{c}{r.doc_id or 0}" for r in rows.collect() for c in CLASHING)
    assert rows.count()
