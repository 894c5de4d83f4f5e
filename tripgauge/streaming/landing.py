"""Incremental landing: new files go through the batch functions, each exactly once.

A checkpoint remembers which files were taken. Every micro-batch replaces its own partitions,
``month=<m>/landed_batch=<id>``, so a batch that is run again after a failure leaves no second copy,
and the landed table is a month table like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.contract import Contract
from tripgauge.functions.casts import exprs
from tripgauge.operators import quality
from tripgauge.operators.facts import fact_trips
from tripgauge.operators.ruler import CELL, build_ruler
from tripgauge.operators.rules import stage
from tripgauge.sources.pages import retype, rows_of_pages
from tripgauge.sources.tables import LANDED


def _replace_batch(df: DataFrame, batch_id: int, out: str) -> None:
    """The batch's rows below their months, where the readers of month tables look for them.

    Rows of a month meet in few files: partitions are rebalanced by size, a large month over several.
    """
    (
        df.hint("rebalance", "month").withColumn(LANDED, F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("month", LANDED).parquet(out)
    )


def _drained(stream: DataFrame, one_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (
        stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def stage_new_files(spark: SparkSession, source: str, schema: str, to_raw: Callable[
        [DataFrame], DataFrame], contract: Contract, out: str, checkpoint: str) -> None:
    """Stage the rows of parquet files not seen before, then stop."""
    _drained(spark.readStream.schema(schema).parquet(source),
             lambda batch, number: _replace_batch(stage(to_raw(batch), contract), number, out), checkpoint)


def land_new_pages(spark: SparkSession, source: str, out: str, checkpoint: str) -> None:
    """Re-type CSV pages not seen before into the raw month table, then stop.

    The stream delivers whole pages, so each is read once, by the function of the batch reader. What
    it writes is a month table that the whole run reads.
    """
    pages = (
        spark.readStream.format("text").option("wholetext", "true")
        .option("recursiveFileLookup", "true").load(source)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    _drained(pages, lambda batch, number: _replace_batch(retype(rows_of_pages(batch)), number, out), checkpoint)


# --- a contract kept up to date by every batch ---------------------------------------------
def land_with_state(spark: SparkSession, source: str, schema: str, to_raw: Callable[[DataFrame], DataFrame],
                    contract: Contract, base: str, files_per_batch: int = 1000) -> None:
    """Land parquet files not seen before and bring the contract's state up to date, then stop.

    A batch adds its rows to ``base/raw`` and, per month, its counts, rule failures and extent to
    ``base/state/counts`` and its durations per cell of the ruler to ``base/state/durations``. Each
    has a partition per batch that a replay overwrites, so a batch counts once however often it runs.
    The gate and the ruler are then sums over these small tables: no landed row is read again.
    """
    def one_batch(batch: DataFrame, number: int) -> None:
        rows = to_raw(batch)
        _replace_batch(rows, number, f"{base}/raw")
        # read back: what counts is what was landed
        landed = read_landed(spark, f"{base}/raw", rows.schema).where(F.col(LANDED) == number)
        staged = stage(landed.drop(LANDED), contract)
        _add_state(quality.period_counts(staged), number, f"{base}/state/counts")
        facts = fact_trips(staged, contract)
        _add_state(facts.groupBy("month", *CELL, "duration_min").agg(*exprs(
            "count(1) AS n", "min(pickup_ts) AS first_pickup", "max(pickup_ts) AS last_pickup")), number, f"{base}/state/durations")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    _drained(stream, one_batch, f"{base}/checkpoint")


def read_landed(spark: SparkSession, raw: str, schema: T.StructType) -> DataFrame:
    """The landed table with the batch that each row came in."""
    names = [f.name for f in schema.fields if f.name != "month"]
    whole = T.StructType([schema[n] for n in names] + [T.StructField("month", T.StringType()), T.StructField(LANDED, T.LongType())])
    return spark.read.schema(whole).parquet(raw)


def _add_state(df: DataFrame, number: int, path: str) -> None:
    """One partition per batch, replaced as a whole; it is small, so few files."""
    df.coalesce(8).write.mode("overwrite").parquet(f"{path}/{LANDED}={number}")


def state_counts(spark: SparkSession, base: str) -> DataFrame:
    """Counts per month over all batches, as ``period_counts`` of all landed rows would give them."""
    state = spark.read.parquet(f"{base}/state/counts").drop(LANDED)
    return state.groupBy("month").agg(*[F.sum(c).alias(c) for c in state.columns if c != "month"])


def state_extent(spark: SparkSession, base: str) -> DataFrame:
    """Valid rows and first and last pickup per month over all batches."""
    return spark.read.parquet(f"{base}/state/durations").groupBy("month").agg(*exprs(
        "sum(n) AS fact_rows", "min(first_pickup) AS first_pickup", "max(last_pickup) AS last_pickup"))


def state_ruler(spark: SparkSession, base: str, baseline: str, contract: Contract) -> DataFrame:
    """The ruler from the batches' histograms of durations: the one that all facts together give."""
    return build_ruler(spark.read.parquet(f"{base}/state/durations"), baseline, contract, weight="n")
