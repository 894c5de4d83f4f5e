"""Nested retrieval reports, flattened to one row per month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import ContractAbort

_RESULT = (
    "struct<month: string, dataset: string, `where`: string, "
    "count_query: struct<count: bigint, status: string, seconds: double>, rows: bigint, "
    "match: boolean, composite_key_duplicates: bigint, "
    "retrieval: struct<page_count: bigint, page_size: bigint, raw_dir: string>>"
)
_REPORT = f"trips map<string, struct<results: array<{_RESULT}>>>"


def one_per_month(provenance: DataFrame) -> DataFrame:
    """One row per month. A month told twice in the same words counts once; a contradiction aborts."""
    told = provenance.distinct()
    twice = [r.month for r in told.groupBy("month").count().where("count > 1").select("month").limit(10).collect()]
    if twice:
        raise ContractAbort(f"provenance contradicts itself for {twice}")
    return told


def read_retrieval_report(spark: SparkSession, path: str) -> DataFrame:
    """month, dataset, api_count, rows_stored, count_reconciled, pages, duplicates.

    A report that is not there means no provenance: an empty table with the same columns.
    """
    try:
        report = spark.read.schema(_REPORT).json(path, multiLine=True)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        report = spark.createDataFrame([], _REPORT)
    blocks = report.select(F.explode("trips").alias("key", "block"))
    r = blocks.select("key", F.explode("block.results").alias("r"))
    return r.where(F.col("r.month").isNotNull()).select(
        F.col("key").alias("dataset_year"),
        "r.month",
        "r.dataset",
        "r.where",
        F.col("r.count_query.count").alias("api_count"),
        F.col("r.count_query.status").alias("count_status"),
        F.col("r.rows").alias("rows_stored"),
        F.col("r.match").alias("count_reconciled"),
        F.col("r.retrieval.page_count").alias("pages"),
        F.col("r.retrieval.page_size").alias("page_size"),
        F.col("r.retrieval.raw_dir").alias("raw_pages_dir"),
        "r.composite_key_duplicates",
    )
