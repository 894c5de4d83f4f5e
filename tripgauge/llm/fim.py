"""Fill-in-middle: a text is cut at two of its unit boundaries and put together in another order.

The boundaries of a text are a set of byte offsets into its UTF-8 form, held the Roaring way: the
offsets of one stretch of 65,536 bytes share a container, which is a sorted array, a bitmap or a list
of runs, whichever is smallest (a plain ASCII stretch is one run). Beside the containers stand their
cumulative cardinalities. The offset of the k-th boundary is found by a search among these and a
select inside one container, so both cuts of a text come from two lookups, and the parts are sliced
as bytes.

Hashes, markers, slices and digests are Spark expressions; Python sees the text once and gives back
three numbers per row. Every row is worked on by itself: there is no shuffle, and a task holds one
batch of texts.

Defined results: a null text is empty; an empty text is plain; a null id is hashed as an empty one;
rows that share an id are cut by the same numbers, each over its own length; an empty table gives an
empty one. Input columns come back untouched inside the struct `doc`, so no name can clash.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that one container covers.
STRETCH = 1 << 16
#: Markers before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class RunContainer:
    def __init__(self, low: np.ndarray):
        first = np.concatenate(([0], np.flatnonzero(np.diff(low) != 1) + 1))
        self.start, self.before = low[first].astype(np.uint16), first.astype(np.uint16)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(STRETCH, dtype=bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        inside = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(inside)[k - int(self.before[word])])


def container(low: np.ndarray):
    """The smallest container for sorted, distinct offsets below STRETCH: 2 bytes a member, 4 a run, or a bit each."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    if 2 + 4 * runs <= min(2 * len(low), STRETCH // 8):
        return RunContainer(low)
    return ArrayContainer(low) if 2 * len(low) <= STRETCH // 8 else BitmapContainer(low)


class BoundarySet:
    """A sorted set of offsets given by stretches (number, sorted offsets inside), in order."""

    def __init__(self, stretches: Iterable[tuple[int, np.ndarray]]):
        self.high: list[int] = []
        self.containers: list = []
        self.before: list[int] = []  # members of all earlier containers
        self.size = 0
        for number, low in stretches:
            if len(low):
                self.high.append(number)
                self.containers.append(container(low))
                self.before.append(self.size)
                self.size += len(low)

    def __len__(self) -> int:
        return self.size

    def select(self, k: int) -> int:
        """The k-th smallest member, from 0."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = bisect_right(self.before, k) - 1
        return self.high[at] * STRETCH + self.containers[at].select(k - self.before[at])


def code_point_boundaries(data: np.ndarray) -> BoundarySet:
    """Where code points begin in UTF-8 bytes, and the end. One stretch is looked at at a time."""

    def stretches() -> Iterator[tuple[int, np.ndarray]]:
        for number in range(len(data) // STRETCH + 1):
            part = data[number * STRETCH:(number + 1) * STRETCH]
            low = np.flatnonzero((part & 0xC0) != 0x80)
            yield number, np.append(low, len(part)) if len(part) < STRETCH else low

    return BoundarySet(stretches())


def match_boundaries(data: np.ndarray, unit: str) -> BoundarySet:
    """0 and the ends of the matches of `unit`, left to right; what follows the last one belongs to it."""
    raw = data.tobytes()
    ends = [m.end() for m in re.finditer(unit.encode(), raw) if m.end()]
    if raw and (not ends or ends[-1] < len(raw)):
        ends[-1:] = [len(raw)]
    places = np.unique(np.array([0, *ends], dtype=np.int64))
    numbers, first = np.unique(places // STRETCH, return_index=True)
    return BoundarySet(zip(numbers.tolist(), np.split(places % STRETCH, first[1:])))


def boundary_cuts(unit: str | None):
    """A UDF: text and two hashes to the number of units and the byte offsets of the two cuts."""

    def cut(text: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        wide = text.cast(pa.large_binary())
        offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
        data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)
        n, first, last = (np.zeros(len(wide), np.int64) for _ in range(3))
        for i, (a, b) in enumerate(zip(one.to_pylist(), other.to_pylist())):
            own = data[offsets[i]:offsets[i + 1]]
            marks = code_point_boundaries(own) if unit is None else match_boundaries(own, unit)
            n[i] = len(marks) - 1
            low, high = sorted((a % len(marks), b % len(marks)))
            first[i], last[i] = marks.select(low), marks.select(high)
        return pa.StructArray.from_arrays([pa.array(x) for x in (n, first, last)], names=["n", "first", "last"])

    return F.arrow_udf(cut, "n long, first long, last long")


def _hash_part(digest: Column, number: int) -> Column:
    """The number-th group of 8 hexadecimal digits as an unsigned integer, from 1."""
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, unit: str | None = None) -> DataFrame:
    """(doc, n, form, prefix_chars, middle_chars, output) for every row of docs (doc_id, text, ...).

    A text has n units (code points, or the matches of the pattern `unit` over its UTF-8 bytes). Of
    the rows, `rate` in a hundred are rearranged, of these `spm` in a hundred with the suffix first;
    the rest, empty texts and texts that hold a marker stay plain.
    """
    p, s, m = MARKS
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    rows = rows.select("doc", "text", *[_hash_part(F.col("digest"), i).alias(f"h{i}") for i in range(1, 5)])
    rows = rows.withColumn("cut", boundary_cuts(unit)("text", "h1", "h2"))
    stays = (F.col("text") == "") | F.greatest(*[F.contains("text", F.lit(x)) for x in MARKS]) | (F.col("h3") % 100 >= rate)
    rows = rows.select(
        "doc", "text", F.col("cut.n").alias("n"), F.col("cut.first").cast("int").alias("first"), F.col("cut.last").cast("int").alias("last"),
        F.when(stays, PLAIN).when(F.col("h4") % 100 < spm, SPM).otherwise(PSM).alias("form"))
    rows = rows.selectExpr(
        "doc", "text", "n", "form",
        "CAST(substring(CAST(text AS BINARY), 1, first) AS STRING) AS prefix",
        "CAST(substring(CAST(text AS BINARY), first + 1, last - first) AS STRING) AS middle",
        "CAST(substring(CAST(text AS BINARY), last + 1) AS STRING) AS suffix")
    moved = F.col("form") != PLAIN
    output = F.when(F.col("form") == PSM, F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle")).when(
        F.col("form") == SPM, F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")).otherwise(F.col("text"))
    return rows.select(
        "doc", "n", "form", F.when(moved, F.char_length("prefix")).cast("long").alias("prefix_chars"),
        F.when(moved, F.char_length("middle")).cast("long").alias("middle_chars"), output.alias("output"))


def restored(rows: DataFrame) -> DataFrame:
    """rows with `restored`, the text rebuilt from the columns form and output alone.

    A rearranged text holds no marker, and no marker can arise where a part meets one, so the first
    marker found is always the one that was set.
    """
    p, s, m = MARKS
    body = f"CASE form WHEN '{PSM}' THEN substring(output, {len(p) + 1}) WHEN '{SPM}' THEN substring(output, {len(s) + 1}) END"
    between = f"CASE form WHEN '{PSM}' THEN '{s}' ELSE '{p}' END"
    cut = rows.selectExpr("*", f"{body} AS _body", f"{between} AS _between").selectExpr("*", "substring_index(_body, _between, 1) AS _first")
    cut = cut.selectExpr("*", "substring(_body, char_length(_first) + char_length(_between) + 1) AS _rest")
    cut = cut.selectExpr("*", f"substring_index(_rest, '{m}', 1) AS _second")
    cut = cut.selectExpr("*", f"substring(_rest, char_length(_second) + {len(m) + 1}) AS _middle")
    text = f"""CASE form WHEN '{PSM}' THEN concat(_first, _middle, _second)
        WHEN '{SPM}' THEN concat(_second, _middle, _first) ELSE output END"""
    return cut.selectExpr(*rows.columns, f"{text} AS restored")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    rows = restored(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return rows.select(
        "doc.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
