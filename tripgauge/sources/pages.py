"""Landed pages: CSV pages of text, JSON record pages, and the zone lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import LEGACY_COLUMNS, TRIP_COLUMNS
from tripgauge.functions.casts import read_as
from tripgauge.functions.scales import text

# the folder a page lies in names the month it was requested for: .../2023-01/page_0001.csv.gz
_MONTH_FOLDER_SQL = "^.*[/=]([0-9]{4}-[0-9]{2})/"

# columns that pages may carry, for callers that do not ask for others
PAGE_COLUMNS: tuple[str, ...] = (*TRIP_COLUMNS, *LEGACY_COLUMNS)

# A quoted cell starts where a cell starts and ends before a comma, a line break or the end; inside,
# two quotes stand for one. The possessive repeats make the match one forward pass.
_QUOTED = r'(^|[,\n])"([^"]*+(?:""[^"]*+)*+)"(?=[,\r\n]|\z)'
# stand-ins inside quoted cells, an escape character and a digit: what they stand for, in the order of decoding
_ESCAPE, _FENCE = "\x1e", "\x01"
_STAND_INS = (("1", "\n"), ("2", "\r"), ("3", _FENCE), ("4", ","), ("0", _ESCAPE))


def _replaced(expr: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {text(old)}, {text(new)})"
    return expr


def _records(value: str) -> str:
    """A page as an array of records whose commas and line breaks are all separators.

    The outer quotes of quoted cells become fences. Between fences number 2k + 1 and 2k + 2 lies
    quoted text, whose separators are replaced by stand-ins; a quote that opens no cell is an
    ordinary character and can not swallow what follows it.
    """
    plain = _replaced(f"regexp_replace({value}, '^\ufeff', '')", (_ESCAPE, _ESCAPE + "0"), (_FENCE, _ESCAPE + "3"))
    fenced = f"regexp_replace({plain}, {text(_QUOTED)}, {text('$1' + _FENCE + '$2' + _FENCE)})"
    quoted = _replaced("part", ("\n", _ESCAPE + "1"), ("\r", _ESCAPE + "2"), (",", _ESCAPE + "4"), ('""', '"'))
    joined = f"array_join(transform(split({fenced}, {text(_FENCE)}), (part, i) -> CASE WHEN i % 2 = 1 THEN {quoted} ELSE part END), '')"
    return f"split({joined}, '\r?\n')"


def _cell(expr: str) -> str:
    """The text of a cell; an empty one is missing, quoted or not."""
    decoded = _replaced(expr, *[(_ESCAPE + digit, what) for digit, what in _STAND_INS])
    return f"nullif(CASE WHEN contains({expr}, {text(_ESCAPE)}) THEN {decoded} ELSE {expr} END, '')"


def _headed(pages: DataFrame) -> DataFrame:
    """(month, records, names) of whole pages (path, value); names are those of the page's own header."""
    cut = pages.selectExpr(f"regexp_extract(path, '{_MONTH_FOLDER_SQL}', 1) AS month", f"{_records('value')} AS _records")
    return cut.selectExpr("month", "_records", f"transform(split(_records[0], ','), c -> lower(trim({_cell('c')}))) AS _names")


def columns_of_pages(pages: DataFrame) -> list[str]:
    """Every column name that a page's header has, sorted: as many as the source has columns."""
    return sorted(r[0] for r in _headed(pages).selectExpr("explode(_names) AS n").where("n IS NOT NULL").distinct().collect())


def rows_of_pages(pages: DataFrame, columns: Sequence[str] | None = PAGE_COLUMNS) -> DataFrame:
    """Rows of whole pages (path, value) as text, bound by the name in their page's own header.

    Quoted cells may hold commas, line breaks and doubled quotes; a page may have any number of
    columns, in any order. A page is one value, so its header is at hand where its records are:
    nothing is listed or joined, and the text is read once. A column that a page lacks is NULL, a
    short record's last cells are too, and a name met twice binds its first place; ``month`` comes
    from the page's folder. With ``columns`` None the headers are looked through first and every
    column is kept.
    """
    if columns is None:
        columns = columns_of_pages(pages)
    at = [f"_at{i}" for i in range(len(columns))]
    places = [f"CAST(array_position(_names, {text(c.lower())}) AS INT) AS {a}" for a, c in zip(at, columns)]
    headed = _headed(pages).selectExpr("month", "_records", *places)
    rows = headed.selectExpr("month", *at, "explode(slice(_records, 2, greatest(size(_records) - 1, 0))) AS _record").where("_record <> ''")
    cells = rows.selectExpr("month", *at, "split(_record, ',') AS _row")
    bound = cells.selectExpr("month", *[f"CASE WHEN {a} > 0 THEN get(_row, {a} - 1) END AS {a}" for a in at])
    return bound.selectExpr(*[f"{_cell(a)} AS `{c}`" for a, c in zip(at, columns)], "month")


def read_pages(spark: SparkSession, paths: str | list[str], columns: Sequence[str] | None = PAGE_COLUMNS) -> DataFrame:
    """All pages as text, bound by column name even where pages order their columns differently."""
    pages = spark.read.text(paths, wholetext=True)
    return rows_of_pages(pages.select(F.col("_metadata.file_path").alias("path"), "value"), columns)


def retype(df: DataFrame, types: Mapping[str, str] = {**TRIP_COLUMNS, **LEGACY_COLUMNS}
           ) -> DataFrame:
    """Cast the mapped columns, NULL where a cell cannot be read; others pass as they are."""
    known = {name.lower(): kind for name, kind in types.items()}
    return df.selectExpr(*[
        f"{read_as(df, c, known[c.lower()])} AS `{c}`" if c.lower() in known else f"`{c}`"
        for c in df.columns
    ])


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone names; the text N/A means missing."""
    schema = "pickup_zone_id int, borough string, pickup_zone string, service_zone string"
    lookup = spark.read.csv(path, header=True, schema=schema, nullValue="N/A", escape='"', multiLine=True)
    return lookup.withColumn("pickup_zone_id", F.col("pickup_zone_id").cast("bigint"))


def read_zone_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON pages, each an array of zone records."""
    schema = "locationid string, zone string, borough string"
    records = spark.read.schema(schema).json(paths, multiLine=True)
    return records.withColumn("locationid", F.col("locationid").try_cast("int"))
