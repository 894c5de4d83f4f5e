"""Fingerprints of landed files and the manifest built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.sources.files import describe_files


def rendered_row(names: list[str]) -> str:
    """A row as text: every cell as its length and its value, a missing cell as ``-``.

    Lengths make the text unambiguous: no two different rows render alike.
    """
    cell = "coalesce(concat(length(CAST(`{0}` AS STRING)), ':', CAST(`{0}` AS STRING)), '-')"
    return f"concat_ws(',', {', '.join(cell.format(n) for n in names)})"


def _row_number(names: list[str]) -> str:
    """The first 15 hexadecimal digits of the row's md5, as a number whose sums stay exact."""
    return f"CAST(conv(substring(md5({rendered_row(names)}), 1, 15), 16, 10) AS DECIMAL(38, 0))"


def content_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per file: bytes, rows, columns and a hash of its rows that does not depend on their order.

    Works on file splits, so the size of a file does not matter.
    """
    names = columns or df.columns
    return (
        df.select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes"),
                  F.expr(_row_number(names)).alias("h"))
        .groupBy("name", "bytes")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("h").cast("string").alias("content_hash"))
        .withColumns({"header": F.lit(",".join(names)),
                      "header_column_count": F.lit(len(names)).cast("bigint")})
    )


def byte_fingerprint(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per Parquet file: bytes and the sha256 of its bytes, whatever its size."""
    return describe_files(spark, paths, hashed=True).select("name", "bytes", "sha256")


def build_manifest(files: DataFrame, provenance: DataFrame) -> DataFrame:
    """One row per month: files, bytes, rows, columns and digests beside what retrieval recorded.

    ``files`` describes the files of the month table (see ``describe_files``), a row each; rows are
    those that the footers count. A month's header is that of its first file by name.
    """
    months = files.groupBy("month").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("row_count").alias("row_count"),
        F.sum("row_groups").alias("row_groups"), F.min_by("header", "path").alias("header"),
        # of fixed size however many files a month has
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("sha256"))).cast("binary"), 256).alias("sha256"))
    return months.withColumn("header_column_count", F.size("header").cast("bigint")).join(
        provenance.select("month", "api_count", "rows_stored", "count_reconciled", "pages", "composite_key_duplicates"),
        "month", "left")
