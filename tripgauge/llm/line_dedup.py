"""Lines that many documents share are dropped from all of them but the last.

The index of lines is a log-structured one. A run is a table of line hashes, each once, dealt into
buckets by hash and sorted inside them, with the number of documents that held the line and the
largest of their ids. A batch of documents is first grouped into a sorted table of its own. A merge
anti join of that table with every run leaves the lines never met before, which become a run of the
first level; what was met before goes to the tallies. So a hash lies in one run only, and runs need
no counting when they are merged: once a level holds `fanout` runs, they are compacted into one run of
the next level. Batches, runs and joins share the buckets, so that no run is shuffled again to be
joined, and the number of runs grows with the logarithm of the number of batches.

A line's hash is 128 bits of XXH64 with two seeds. Runs, batches and tallies lie in a database of their
own in the shared folder and are dropped with it; what a query needs later is written apart.

Hot lines: counts are combined before every shuffle, a line in a third of all documents is one row per
task and batch. Drops come from a join with the shared lines alone, which Spark broadcasts when they
are few and splits by their hottest line when they are not. Rows dropped travel as positions; the text
is cut once more where it lies and filtered by them.

Defined results: every row is a document, rows sharing an id included. Null and empty texts are one
empty line. Null ids are smaller than all others; a line whose holders all lack an id is kept in all
of them. Repeated lines of a document count once and go or stay together. An empty table gives an
empty one. Input columns come back untouched inside the struct `doc`, so no name can clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm.common import settled
from tripgauge.session import scratch_dir

#: White space that is stripped from both ends of a line.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Texts of ASCII alone, the most, take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _hashed(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit("second seed"), key).alias("k2")]


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, k1, k2): a row per document and distinct line of at least min_chars code points."""
    lines = F.split(ascii_lower(F.coalesce("text", F.lit(""))), "\n")
    keys = F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(SPACE))), lambda x: F.char_length(x) >= min_chars)
    return docs.select("doc_id", F.explode(F.array_distinct(keys)).alias("key")).select("doc_id", *_hashed("key"))


class LineIndex:
    """Levelled sorted runs of line hashes, in a database of their own below the shared folder."""

    def __init__(self, spark: SparkSession, id_type: str = "bigint", fanout: int = 3):
        self.spark, self.fanout, self.id_type = spark, fanout, id_type
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_index_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.tallies: list[str] = []
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{scratch_dir(spark, 'line-index')}'")

    def _write(self, rows: DataFrame, *partitions: str) -> str:
        """rows as a table of sorted buckets. They must be dealt by KEY into the index's buckets."""
        table = f"{self.name}.t_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)
        return table

    def _drop(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE {table}")

    @property
    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def batches(self, keys: DataFrame, batch: Column) -> str:
        """keys (doc_id, k1, k2) grouped per batch and hash, as one table with a partition per batch."""
        grouped = keys.groupBy(batch.alias("batch"), *KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        return self._write(grouped.repartition(self.buckets, *KEY), "batch")

    def add(self, batch: DataFrame) -> None:
        """Take in (k1, k2, docs, last), each hash once: what no run holds becomes a run, the rest is tallied."""
        new = batch
        for run in self.runs:
            new = new.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        known = [batch.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_semi") for run in self.runs]
        added = self._write(new)
        for rows in known:
            self.tallies.append(self._write(rows))
        self.levels[0].append(added)
        self._compact()

    def _compact(self) -> None:
        """Merge the runs of every level that is full into one run of the next."""
        for level, runs in enumerate(self.levels):
            if len(runs) < self.fanout:
                return
            merged = self.spark.table(runs[0])
            for run in runs[1:]:
                merged = merged.union(self.spark.table(run))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(merged.repartition(self.buckets, *KEY)))
            self.levels[level] = []
            self._drop(runs)

    def shared(self, min_docs: int) -> DataFrame:
        """(k1, k2, last) of the lines held by at least min_docs documents."""
        out = self.spark.createDataFrame([], f"k1 bigint, k2 bigint, last {self.id_type}")
        tallied = None
        for table in self.tallies:
            rows = self.spark.table(table)
            tallied = rows if tallied is None else tallied.union(rows)
        if tallied is not None:
            tallied = tallied.groupBy(*KEY).agg(F.sum("docs").alias("more"), F.max("last").alias("later"))
        for run in self.runs:
            rows = self.spark.table(run)
            rows = rows.join(tallied, KEY, "left") if tallied is not None else rows.selectExpr("*", "0L AS more", "last AS later")
            enough = rows.where(F.col("docs") + F.coalesce("more", F.lit(0)) >= min_docs)
            out = out.union(enough.select(*KEY, F.greatest("last", "later").alias("last")))
        return out

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")


def shared_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int, fanout: int) -> DataFrame:
    """(k1, k2, last) of lines that at least min_docs rows hold, found batch by batch through the index."""
    index = LineIndex(docs.sparkSession, dict(docs.dtypes)["doc_id"], fanout)
    keys = line_keys(docs, min_chars)
    table = index.batches(keys, F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    for number in range(batches):
        index.add(docs.sparkSession.table(table).where(F.col("batch") == number).drop("batch"))
    found = settled(index.shared(min_docs), "shared-lines")
    index.close()
    return found


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 6, fanout: int = 3) -> DataFrame:
    """(doc, n_lines, n_dropped, text): every row of docs (doc_id, text, ...) with the lines it keeps."""
    shared = shared_lines(docs.select("doc_id", "text"), min_chars, min_docs, batches, fanout)
    text = F.coalesce("text", F.lit(""))
    # two hashes stand for the text, so that rows sharing an id keep their own positions
    row = [F.col("doc_id").alias("row_id"), F.xxhash64(text).alias("r1"), F.xxhash64(F.lit("second seed"), text).alias("r2")]
    lines = docs.select(*row, F.posexplode(F.split(ascii_lower(text), "\n")).alias("pos", "line"))
    keyed = lines.withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.char_length("key") >= min_chars).select("row_id", "r1", "r2", "pos", *_hashed("key"))
    hits = keyed.join(shared, KEY).where(~F.col("row_id").eqNullSafe(F.col("last")))
    drops = settled(hits.groupBy("row_id", "r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("at")), "dropped-lines")
    packed = docs.select(F.struct("*").alias("doc"), text.alias("text"), *[c.alias(f"own_{n}") for c, n in zip(row, ("id", "r1", "r2"))])
    same = packed.own_id.eqNullSafe(drops.row_id) & (packed.own_r1 == drops.r1) & (packed.own_r2 == drops.r2)
    found = packed.join(drops, same, "left")
    # one byte per line up to the last that goes: looking a line up costs the same wherever it stands
    marks = "array_join(transform(at, (p, j) -> concat(repeat('0', p - if(j = 0, -1, at[j - 1]) - 1), '1')), '')"
    kept = "filter(lines, (line, i) -> coalesce(substring(marks, i + 1, 1) <> X'31', true))"
    return found.selectExpr("doc", "split(text, '\n') AS lines", f"CAST({marks} AS BINARY) AS marks", "coalesce(size(at), 0) AS gone").selectExpr(
        "doc", "CAST(size(lines) AS BIGINT) AS n_lines", "CAST(gone AS BIGINT) AS n_dropped", f"array_join({kept}, '\n') AS text")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    rows = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
