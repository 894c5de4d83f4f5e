"""Importance resampling: documents drawn so that their words resemble a target's.

A regular-expression Split of the tokenizers library (nothing is trained) cuts the text, A-Z
lower-cased, into words with offsets. Windows of consecutive offset pairs are the features, and the
CRC-32 of a feature picks one of `buckets`. The documents and the target each give a histogram of
buckets; the logarithm of their smoothed ratio is a bucket's gain; a document's weight is the mean
gain of its features. A keyed Gumbel number is added to the weight, and the highest sums are drawn,
which samples without replacement in proportion to the weights' exponentials.

Texts are cut once: the buckets of every document are written to the shared folder, and both the
histograms and the sums of gains read them from there. Histograms are combined inside tasks before a
shuffle of at most `buckets` rows a task; that many numbers reach the driver. Ranks come from a global
sort of narrow rows: a row's place in its partition plus the rows of the partitions before it.

Long texts are cut into pieces at separators before they are split, so a task holds one piece's words
at a time. Defined results: null and empty texts have no features and weight 0; a null id is hashed as
an empty one and comes last among ties; rows sharing an id draw one Gumbel number; with an empty target
or no documents every count is 0. Input columns named in `keep` come back in the struct `doc`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm.common import kept_by_worker, settled

#: Words are runs of ASCII digits, lower-case letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Code points of one piece of a long text, more where no separator follows.
PIECE = 1 << 17


class Buckets(dict):
    """Feature -> bucket; at most `room` features are kept."""

    def __init__(self, buckets: int, room: int = 200_000):
        self.buckets, self.room = buckets, room

    def __missing__(self, feature: str) -> int:
        if len(self) >= self.room:
            self.clear()
        found = self[feature] = zlib.crc32(feature.encode()) % self.buckets
        return found


def pieces(text: str) -> Iterator[str]:
    """The text cut at separators, so that no word is parted."""
    start = 0
    while len(text) - start > PIECE:
        at = SEPARATOR.search(text, start + PIECE)
        if at is None:
            break
        yield text[start:at.start()]
        start = at.start()
    yield text[start:]


def text_features(text: str, split, buckets: Buckets, least: int, most: int) -> tuple[int, list[int]]:
    """Words of a text, and the buckets of its windows of `least` to `most` consecutive words."""
    lowered = text.encode().lower().decode()  # bytes know upper case in ASCII only
    words, found, before = 0, [], []
    for piece in pieces(lowered):
        spans = [span for _, span in split.pre_tokenize_str(piece)]
        words += len(spans)
        if most == 1:
            found.extend([buckets[piece[a:b]] for a, b in spans])
            continue
        known = before + [piece[a:b] for a, b in spans]
        for size in range(least, most + 1):
            ends = range(max(len(before) + 1, size), len(known) + 1)
            found.extend([buckets[" ".join(known[end - size:end])] for end in ends])
        before = known[-(most - 1):]
    return words, found


def bucketed(docs: DataFrame, least: int, most: int, buckets: int, keep: Sequence[str]) -> DataFrame:
    """(doc, n_words, at): the bucket of every feature of every row."""

    def cut(text: pa.Array) -> pa.Array:
        from tokenizers import Regex, pre_tokenizers

        split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        held = kept_by_worker(f"buckets {buckets}", lambda: Buckets(buckets))
        words, at, ends = [], [], [0]
        for one in text:
            n, found = text_features(one.as_py() or "", split, held, least, most)
            words.append(n)
            at.append(np.array(found, np.int32))
            ends.append(ends[-1] + len(found))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *at])))
        return pa.StructArray.from_arrays([pa.array(words, pa.int64()), lists], names=["n_words", "at"])

    if not 1 <= least <= most:
        raise ValueError("windows take at least one word")
    cutter = F.arrow_udf(cut, "n_words long, at array<int>")
    rows = docs.select(F.struct(*keep).alias("doc"), cutter("text").alias("cut"))
    return rows.select("doc", "cut.n_words", "cut.at")


def histogram(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): the features of all rows in each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], names=["bucket", "n"])

    return rows.select("at").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, in order."""
    spark = source.sparkSession
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(
        source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    rows = both.select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t")).toPandas()
    rows = rows.sort_values("bucket")
    s, t = rows["s"].to_numpy(), rows["t"].to_numpy()
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """rows with n_features and weight, the floored mean of the gains of a row's features (none: 0)."""

    def mean(at: pa.Array) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))))
        sums = np.concatenate(([0], np.cumsum(gains[at.flatten().to_numpy(zero_copy_only=False)])))
        n = np.diff(ends)
        return pa.array((sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1), pa.int64())

    return rows.select("doc", "n_words", F.size("at").cast("long").alias("n_features"), F.arrow_udf(mean, "long")("at").alias("weight"))


def ranked(scored: DataFrame, min_words: int, percent: int) -> DataFrame:
    """scored (doc, doc_id, n_words, score, ...) with rank: 1, 2, 3 ... for the rows drawn, else null.

    One global sort puts the rows that may be drawn first, by score and id. Every row's place is its
    place in its partition, which its row number tells, after the rows of the partitions before.
    """
    order = [F.desc(F.col("n_words") >= min_words), F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = settled(scored.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "resampling-order")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n_words") >= min_words).alias("able"))
    # a row per partition of the sort
    before = counts.selectExpr("part", "sum(rows) OVER (ORDER BY part) - rows AS before", "sum(able) OVER () AS able")
    rank = F.col("before") + inside + 1
    drawn = F.expr(f"{int(percent)} * able DIV 100")
    joined = placed.withColumn("part", part).join(F.broadcast(before), "part")
    return joined.withColumn("rank", F.when(rank <= drawn, rank)).drop("part", "place", "before", "able")


def resample(docs: DataFrame, target: DataFrame, seed: int = 2024, least: int = 1, most: int = 1, buckets: int = 10_000,
             min_words: int = 20, percent: int = 10, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(doc, doc_id, n_words, n_features, weight, score, rank) for every row of docs (doc_id, text, ...).

    `target` has a column text. Of the N rows with at least min_words words, the floor of `percent` in
    a hundred with the highest scores are drawn, ties to the smaller id. Choose docs.where(...) by
    rank, or keep further columns in `doc`.
    """
    own = settled(bucketed(docs, least, most, buckets, list(dict.fromkeys(["doc_id", *keep]))), "resampling-buckets")
    gains = bucket_gains(histogram(own, buckets), histogram(bucketed(target, least, most, buckets, ["text"]), buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc.doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("long") + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = settled(weighed(own, gains).select("*", F.col("doc.doc_id").alias("doc_id"), (F.col("weight") + gumbel).alias("score")), "resampling-scores")
    return ranked(scored, min_words, percent)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
