"""Month tables: pruned reads, versioned replacement of months and small sorted exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import COMPOSITE_KEY
from tripgauge.sources.files import opened


# partition columns that tell how rows came in; they are no columns of the table
LANDED, VERSION = "landed_batch", "version"
# the folder's name of a row's month, which is never null, in rows that are sorted by it
FOLDER, NO_MONTH = "month_folder", "__HIVE_DEFAULT_PARTITION__"
MONTH_OF_FOLDER = f"nullif({FOLDER}, '{NO_MONTH}')"
# a column with more values than this holds in a file gains nothing by a dictionary, and filling one takes long
DICTIONARY_BYTES = 16_384
_POINTERS = "month string, version string, rows bigint, seq bigint"


def pointers(spark: SparkSession, base: str) -> DataFrame:
    """(month, version, rows, seq): the version each month of a versioned table is at, and its rows.

    Every replacement adds one file to the pointers, its last step; the newest entry of a month counts.
    """
    try:
        told = spark.read.schema(_POINTERS).json(f"{base}/_pointers")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        told = spark.createDataFrame([], _POINTERS)
    newest = told.groupBy("month").agg(F.max_by(F.struct("version", "rows", "seq"), "seq").alias("p"))
    return newest.selectExpr("month", "p.version", "p.rows", "p.seq")


def read_months(spark: SparkSession, base: str, months: Sequence[str] | None = None) -> DataFrame:
    """A table partitioned by ``month``; only the asked months' folders are opened.

    Of a versioned table the versions that the pointers name are read, and nothing else below it.
    """
    now = {r.month: r for r in pointers(spark, base).collect()}  # bounded by the calendar
    wanted = None if months is None else set(months)
    if now:
        paths = [f"{base}/month={m}/{VERSION}={r.version}" for m, r in sorted(now.items()) if r.rows and (wanted is None or m in wanted)]
        # the folder says what the columns are where no wanted month has a row
        df = spark.read.option("basePath", base).parquet(*paths) if paths else spark.read.parquet(base).where("false")
    else:
        df = spark.read.parquet(base)
    df = df.withColumn("month", F.col("month").cast("string")).drop(LANDED, VERSION)
    return df if wanted is None else df.where(F.col("month").isin(*wanted))


def read_files(spark: SparkSession, base: str, found: DataFrame) -> DataFrame:
    """The rows of these files (path) of a month table; nothing else of it is opened."""
    paths = [r.path for r in found.select("path").collect()]  # a row per file
    whole = spark.read.parquet(base)
    if not paths:
        return whole.where("false")
    df = spark.read.schema(whole.schema).option("basePath", base).parquet(*paths)
    return df.withColumn("month", F.col("month").cast("string")).drop(LANDED, VERSION)


def in_month_order(df: DataFrame, month: str) -> DataFrame:
    """The rows with their ``FOLDER``, each partition sorted by it.

    For rows that grow wider before ``write_months``, which sorts them no more while the folder is
    carried along. A null or empty month has Spark's own folder for it: Spark would sort a column that
    may be null again.
    """
    return df.selectExpr("*", f"coalesce(nullif({month}, ''), '{NO_MONTH}') AS {FOLDER}").sortWithinPartitions(FOLDER)


def write_months(df: DataFrame, base: str) -> None:
    """Replace the months that ``df`` holds; the other months of the table stay."""
    if FOLDER in df.columns:
        df = df.drop("month").withColumnRenamed(FOLDER, "month")
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .partitionBy("month").parquet(base)
    )


def clear_versions(base: str, months: Sequence[str], named: Mapping[str, str]) -> None:
    """Remove every version of these months but the one that is named: failed ones and those of runs before."""
    for month in months:
        store, place = opened(f"{base}/month={month}")
        for found in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
            if found.type == fs.FileType.Directory and found.base_name.startswith(f"{VERSION}=") and found.base_name != f"{VERSION}={named.get(month)}":
                store.delete_dir(found.path)


def replace_months(df: DataFrame, base: str, months: Sequence[str]) -> DataFrame:
    """Write ``df`` as these months of a versioned table and read them back.

    The rows go into folders of a new version, which nobody reads before the pointers name it. They
    are written last, in one file, so every month changes at once or not at all: a job that dies
    leaves the months as they were. A month without rows in ``df`` is left without rows. The version
    before stays until the next replacement, for readers that planned with it. One writer at a time.
    """
    spark = df.sparkSession
    now = pointers(spark, base).collect()  # bounded by the calendar
    clear_versions(base, months, {r.month: r.version for r in now})
    version, seq = uuid.uuid4().hex, max((r.seq for r in now), default=0) + 1
    rows = df.where(F.col("month").isin(*months)).withColumn(VERSION, F.lit(version))
    rows.write.mode("append").option("compression", "zstd").partitionBy("month", VERSION).parquet(base)
    names = [f.name for f in df.schema.fields if f.name != "month"]
    schema = df.select(*names, F.col("month").cast("string")).schema
    try:
        fresh = spark.read.schema(schema).option("basePath", base).parquet(f"{base}/month=*/{VERSION}={version}").drop(VERSION)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        fresh = spark.createDataFrame([], schema)  # no row was written
    # counted on what was written, by the files' own row counts
    written = {r.month: r["count"] for r in fresh.groupBy("month").count().collect()}
    entries = spark.createDataFrame([(m, version, written.get(m, 0), seq) for m in months], _POINTERS)
    entries.coalesce(1).write.mode("append").json(f"{base}/_pointers")
    return fresh


def write_sorted_months(df: DataFrame, base: str, key: Sequence[str] = COMPOSITE_KEY) -> None:
    """Month files in key order. Range partitions keep a large month in several sorted files."""
    have = {c.lower() for c in df.columns}
    order = [c for c in key if c.lower() in have] or [df.columns[0]]
    ranged = df.repartitionByRange("month", *order).sortWithinPartitions("month", *order)
    write_months(ranged, base)


def write_report_csv(df: DataFrame, path: str, *keys: str) -> None:
    """One CSV in key order. For the small result tables only."""
    one = df.repartition(1).sortWithinPartitions(*keys)
    one.write.mode("overwrite").csv(path, header=True)
