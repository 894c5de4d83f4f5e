"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import settled


def usable(name: str) -> Column:
    """True for a vector that is there and has only finite components."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(name).isNotNull() & finite, F.lit(False))


def drawn(df: DataFrame, by: list, rows: int, seed: int) -> DataFrame:
    """At most `rows` rows of df, the same at every run: those with the smallest hash of `by`."""
    return df.orderBy(F.xxhash64(*by, F.lit(seed)), *by).limit(rows)


def drawn_wide(df: DataFrame, by: list, rows: int, seed: int) -> DataFrame:
    """The rows that drawn gives, written, for wide rows: there each task sends `rows` rows to the driver or to one task.

    Here hashes are counted in ranges first, and only the ranges that hold the rows are sorted. The driver
    gets 16,384 counts at most.
    """
    of_range, held = F.shiftright(F.xxhash64(*by, F.lit(seed)), 50), 0
    for found, count in sorted(df.groupBy(of_range).count().collect()):
        held += count
        if held >= rows:
            df = df.where(of_range <= found)
            break
    return settled(drawn(df, by, rows, seed), "drawn")


def stacked(column) -> np.ndarray:
    """A pandas column of equally long arrays as a matrix of doubles."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of all links (a, b) the smaller label, in place, until nothing changes."""
    while True:
        x, y = label[a], label[b]
        other = x != y
        if not other.any():
            return
        a, b, x, y = a[other], b[other], x[other], y[other]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jumped := label[label], label):
            label[:] = jumped
