"""What the files of a month table say about themselves: size, sha256, columns, rows, key ranges.

One row per Parquet file, read from its footer by the tasks, so the cost follows the number of files
and not of rows. The sha256, when asked for, streams through the file in pieces of a few megabytes: a
file of any size takes one task and no more memory than a small one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import TRIP_COLUMNS, ContractAbort
from tripgauge.functions.casts import exprs
from tripgauge.functions.scales import text

PIECE = 4 << 20
#: A range is NULL where the file keeps none for the column.
FILE_COLUMNS = (
    "path string, name string, month string, bytes bigint, sha256 string, row_count bigint, row_groups bigint, header array<string>, "
    "types array<string>, ranges array<struct<row_group: bigint, rows: bigint, low: string, high: string>>"
)

NAMES = ["path", "name", "month", "bytes", "sha256", "row_count", "row_groups", "header", "types", "ranges"]


def opened(path: str):
    """The file system and place of a path as Spark names it; local, HDFS, S3 and GCS paths."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _described(row, hashed: bool, key: str | None) -> tuple:
    import hashlib

    import pyarrow.parquet as pq

    store, place = opened(row.path)
    digest = None
    if hashed:
        sha = hashlib.sha256()
        with store.open_input_stream(place) as stream:
            while piece := stream.read(PIECE):
                sha.update(piece)
        digest = sha.hexdigest()
    with store.open_input_file(place) as file:
        footer = pq.read_metadata(file)
    schema = footer.schema.to_arrow_schema()
    at = next((i for i, n in enumerate(schema.names) if key and n.lower() == key.lower()), None)
    ranges = []
    for number in range(footer.num_row_groups):
        group = footer.row_group(number)
        kept = None if at is None else group.column(at).statistics
        low, high = (str(kept.min), str(kept.max)) if kept is not None and kept.has_min_max else (None, None)
        ranges.append({"row_group": number, "rows": group.num_rows, "low": low, "high": high})
    return (row.path, place.rsplit("/", 1)[-1], row.month, int(row.bytes), digest, footer.num_rows, footer.num_row_groups,
            schema.names, [str(t) for t in schema.types], ranges)


def describe_files(spark: SparkSession, paths: str | Sequence[str], hashed: bool = False, key: str | None = None,
                   months: Sequence[str] | None = None) -> DataFrame:
    """FILE_COLUMNS of every Parquet file below the paths; ranges are those of the column `key`.

    Only names and sizes are listed beforehand. The month is that of the file's folder; with `months`
    the files of other months are not opened.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(paths if isinstance(paths, str) else list(paths))
    files = listed.select("path", F.nullif(F.regexp_extract("path", "/month=([^/]+)/", 1), F.lit("")).alias("month"), F.col("length").alias("bytes"))
    if months is not None:
        files = files.where(F.col("month").isin(*months))

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([_described(row, hashed, key) for row in frame.itertuples()], columns=NAMES)

    return files.repartition("path").mapInPandas(describe, FILE_COLUMNS)


def schema_by_file(files: DataFrame, wanted: Sequence[str] = tuple(TRIP_COLUMNS)) -> DataFrame:
    """Per file: PASS or FAIL, the contract columns it lacks and the columns the contract has not.

    Names are compared without regard to case; what partition folders say is no column of a file.
    """
    want = f"array({', '.join(text(c.lower()) for c in wanted)})"
    have = "transform(header, c -> lower(c))"
    return files.selectExpr(
        "path", "month", "name", "row_count", "row_groups", "CAST(size(header) AS BIGINT) AS column_count",
        f"array_sort(array_except({want}, {have})) AS missing_columns", f"array_sort(array_except({have}, {want})) AS unexpected_columns",
    ).selectExpr("CASE WHEN size(missing_columns) > 0 THEN 'FAIL' ELSE 'PASS' END AS status", "*")


def require_file_schemas(schemas: DataFrame) -> None:
    """Abort when any file of any month lacks a contract column; the message names the first ten."""
    short = schemas.where("status = 'FAIL'").orderBy("path").select("path", "missing_columns").limit(10).collect()
    if short:
        raise ContractAbort("columns missing from files: " + "; ".join(f"{r.path}: {', '.join(r.missing_columns)}" for r in short))


def key_ranges(files: DataFrame, kind: str) -> DataFrame:
    """Per file: the smallest and largest key, read as `kind`. A file with a row group of unknown range has none."""
    groups = files.selectExpr("path", "month", "row_count", "explode(ranges) AS g").selectExpr(
        "path", "month", "row_count", f"CAST(g.low AS {kind}) AS low", f"CAST(g.high AS {kind}) AS high")
    return groups.groupBy("path", "month", "row_count").agg(*exprs(
        "CASE WHEN bool_and(low IS NOT NULL) THEN min(low) END AS low", "CASE WHEN bool_and(high IS NOT NULL) THEN max(high) END AS high"))


def overlaps(ranges: DataFrame) -> DataFrame:
    """Neighbours in key order, month by month, whose ranges meet in more than one value: none in a sorted table.

    A row per file is sorted, and a month's files in one task.
    """
    return ranges.selectExpr(
        "month", "path", "low", "high", "max(high) OVER (PARTITION BY month ORDER BY low, high, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before"
    ).where("before > low")


def files_in_range(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """The files that can hold a key from low to high, given as SQL; files of unknown range are among them."""
    return ranges.where(f"low IS NULL OR high IS NULL OR (low <= {high} AND high >= {low})")
