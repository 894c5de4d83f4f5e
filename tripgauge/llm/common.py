"""What several operators share: input tables, written intermediates, the fold of a document."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.session import scratch_dir

#: A word is a run of anything but these six characters of white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """df written to the shared scratch folder and read again.

    Cuts the lineage: what follows reads files that every executor sees, so a lost executor costs
    its tasks and nothing before them.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that no model learns from. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def kept_by_worker(name: str, make):
    """What make() gives, made once per Python worker and used by all its tasks."""
    held = sys.modules.setdefault("tripgauge_worker", types.ModuleType("tripgauge_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
