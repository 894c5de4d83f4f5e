"""Retrieval proofs: duplicate audit, count reconciliation, period windows, manifest totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.contract import COMPOSITE_KEY, ContractAbort
from tripgauge.functions.casts import exprs, period_label


def duplicate_audit(df: DataFrame, key: Sequence[str] = COMPOSITE_KEY,
                    by: Sequence[str] = ("month",)) -> DataFrame:
    """Rows and surplus rows per key tuple. NULL is a value; absent key columns are left out.

    Equal rows meet in the map-side half of the first grouping, so a tuple repeated any
    number of times costs one shuffled row per task.
    """
    have = {c.lower() for c in df.columns}
    present = [c for c in key if c.lower() in have and c not in by]
    if not present:
        return df.groupBy(*by).agg(*exprs("count(1) AS rows", "0L AS duplicates"))
    tuples = df.groupBy(*by, *present).agg(*exprs("count(1) AS n"))
    return tuples.groupBy(*by).agg(*exprs(
        "coalesce(sum(n), 0) AS rows", "coalesce(sum(n - 1), 0) AS duplicates"))


# two hashes with different seeds: 128 bits that stand for a tuple of any width
_DIGEST = ("xxhash64({key}, 1L) AS _high", "xxhash64({key}, 2L) AS _low")


def duplicate_audit_by_digest(df: DataFrame, key: Sequence[str] = COMPOSITE_KEY, by: Sequence[str] = ("month",),
                              digest: Sequence[str] = _DIGEST) -> DataFrame:
    """``duplicate_audit`` for wide tuples: two longs are shuffled for a tuple instead of its cells.

    A digest met once is a tuple met once. Only rows whose digest was met again are read a second
    time, and their cells compared: different tuples that share a digest stay different. Both scans
    combine before they shuffle. ``digest`` are expressions over ``{key}``; weaker ones cost time and
    no correctness. Keys of a few numbers are narrower than their digest: use ``duplicate_audit``.
    """
    have = {c.lower() for c in df.columns}
    present = [c for c in key if c.lower() in have and c not in by]
    if not present:
        return duplicate_audit(df, key, by)
    # a NULL is skipped by the hash: the mask tells (NULL, 'a') from ('a', NULL)
    nulls = "concat(" + ", ".join(f"CAST(`{c}` IS NULL AS STRING)" for c in present) + ")"
    cells = ", ".join([*(f"`{c}`" for c in present), nulls])
    marks = [f"_by{i}" for i in range(len(by))]
    rows = df.selectExpr(*[f"`{c}` AS {m}" for c, m in zip(by, marks)], *[f"`{c}` AS _cell{i}" for i, c in enumerate(present)],
                         *[d.format(key=cells) for d in digest])
    short = [*marks, "_high", "_low"]
    met = rows.groupBy(*short).agg(*exprs("count(1) AS n"))
    match = " AND ".join(f"r.{c} <=> m.{c}" for c in short)
    again = rows.alias("r").join(met.where("n > 1").select(*short).alias("m"), F.expr(match), "left_semi")
    tuples = again.groupBy(*marks, *[f"_cell{i}" for i in range(len(present))]).agg(*exprs("count(1) AS n"))
    per_tuple = met.selectExpr(*marks, "n AS rows", "0L AS surplus").unionByName(tuples.selectExpr(*marks, "0L AS rows", "n - 1 AS surplus"))
    return per_tuple.groupBy(*marks).agg(*exprs("coalesce(sum(rows), 0L) AS rows", "coalesce(sum(surplus), 0L) AS duplicates")).selectExpr(
        *[f"{m} AS `{c}`" for c, m in zip(by, marks)], "rows", "duplicates")


def count_reconciliation(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """``expected(month, expected_rows)`` against ``stored(month, rows)``.

    A count that could not be obtained stays NULL and is UNKNOWN, never 0.
    """
    return stored.join(expected, "month", "full").selectExpr(
        "month", "expected_rows", "coalesce(rows, 0) AS rows",
        "CASE WHEN expected_rows IS NULL THEN 'UNKNOWN' "
        "WHEN expected_rows = coalesce(rows, 0) THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS verdict")


def reconciliation_totals(reconciled: DataFrame) -> DataFrame:
    """The all-months verdict: how many months agree, over how many rows."""
    return reconciled.selectExpr(
        "count(1) AS months", "coalesce(sum(rows), 0) AS rows",
        "count_if(verdict = 'COMPLETE') AS months_reconciled",
        "coalesce(bool_and(verdict = 'COMPLETE'), false) AS all_reconciled")


def month_windows(bounds: DataFrame) -> DataFrame:
    """Half-open month windows ``[window_start, window_end)`` covering ``bounds(first, last)``."""
    first, last = (f"trunc(CAST({c} AS DATE), 'month')" for c in ("first", "last"))
    return bounds.selectExpr(
        f"explode(sequence({first}, {last}, interval 1 month)) AS d"
    ).selectExpr(
        "date_format(d, 'yyyy-MM') AS month", "CAST(d AS TIMESTAMP_NTZ) AS window_start",
        "CAST(add_months(d, 1) AS TIMESTAMP_NTZ) AS window_end")


def rows_per_window(windows: DataFrame, df: DataFrame, ts: str) -> DataFrame:
    """Rows whose time falls in each window. Rows are grouped by month before the join, so the
    half-open test becomes an equality and no row meets more than one window."""
    per_month = df.groupBy(F.expr(f"{period_label(ts, 'month')} AS month")).agg(
        *exprs("count(1) AS n"))
    return windows.join(per_month, "month", "left").selectExpr(
        "month", "window_start", "window_end", "coalesce(n, 0) AS rows_in_window")


def months_to_process(windows: DataFrame, landed: DataFrame) -> DataFrame:
    """Windows that have not been landed yet: what a resumed job still has to do."""
    return windows.join(landed.select("month").distinct(), "month", "left_anti")


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Files, bytes, rows and reconciled months of a manifest."""
    return manifest.selectExpr(
        "count(1) AS file_count", "coalesce(sum(bytes), 0) AS bytes",
        "coalesce(sum(row_count), 0) AS rows",
        "count_if(count_reconciled) AS months_reconciled")


def require_files(manifest: DataFrame) -> DataFrame:
    if manifest.isEmpty():
        raise ContractAbort("no input files: retrieve the pages first")
    return manifest


def reference_id_diff(left: DataFrame, right: DataFrame, left_name: str, right_name: str
                      ) -> DataFrame:
    """Ids found on one side only (both inputs have one ``id`` column)."""
    a, b = left.select("id").distinct(), right.select("id").distinct()
    return a.join(b, "id", "left_anti").selectExpr("id", f"'{left_name}' AS only_in").unionByName(
        b.join(a, "id", "left_anti").selectExpr("id", f"'{right_name}' AS only_in"))
