"""Web archives: written by Spark, read back by following the chain of record lengths.

Writing. One WARC record per row, as text files whose line end is the blank line that ends a
record. Rows with equal payloads of at least `revisit_bytes` bytes are stored once, by the largest
id; the others are revisit records that point to it. Only groups of two and more are joined back.

Reading. A reader that looks for the magic would also take one inside a payload for a record. Here
tasks split the files at every magic and give, for each, where its record would end. Inside a split
pointer jumping (each step doubles the distance) turns that into where the chain leaves the split;
between splits the same is done with joins, so a file of any length takes a logarithmic number of
rounds. What the chain from a file's start does not reach lies inside a payload; a record whose
payload holds magics is read once more, by its place in the file. Offsets come from the lengths
read, so splits may begin anywhere.

Defined results: a null payload is empty; a null id or address leaves its header out and reads back
as null; line breaks in an address are percent-encoded; rows repeated with one id are each their
own record of the same type; an empty table writes no record; a file that does not begin with a
record gives none, and a broken chain gives the records before the break.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripgauge.llm.common import settled
from tripgauge.session import scratch_dir

MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CONTENT = "record_type string, page_id long, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"
CANDIDATE = f"file string, block long, offset long, length long, successor long, leaves long, {CONTENT}"
RECORD = f"file string, offset long, {CONTENT}"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> None:
    """page_id, url and html of every row as WARC records below path."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"))
    copies = rows.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n"))
    copies = settled(copies.where("n > 1").select(F.col("digest").alias("copied"), "kept_id"), "warc-copies")
    joined = rows.join(copies, F.col("digest") == F.col("copied"), "left")
    # a null id in a group that has others points to the largest of them
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    optional = lambda *parts: F.coalesce(F.concat(*parts, F.lit("\r\n")), F.lit(""))  # noqa: E731 — empty when a part is null
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.lit(f"\r\nWARC-Date: {date}\r\n"),
        optional(F.lit("WARC-Record-ID: <urn:x-page:"), F.col("page_id").cast("string"), F.lit(">")),
        optional(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"), F.col("kept_id").cast("string"), F.lit(">\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    joined.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


_HEADERS = {name: re.compile(pattern, re.I | re.M) for name, pattern in {
    "length": rb"^Content-Length:[ \t]*(\d+)[ \t]*\r?$", "type": rb"^WARC-Type:[ \t]*(\S+)", "url": rb"^WARC-Target-URI:[ \t]*(.*?)\r?$",
    "id": rb"^WARC-Record-ID:[ \t]*<urn:x-page:(-?\d+)>", "refers": rb"^WARC-Refers-To:[ \t]*<urn:x-page:(-?\d+)>",
    "digest": rb"^WARC-Payload-Digest:[ \t]*sha1:([0-9a-f]{40})"}.items()}


def _header(head: bytes, name: str) -> bytes | None:
    found = _HEADERS[name].search(head)
    return found[1] if found else None


def _number(value: bytes | None) -> int | None:
    return None if value is None else int(value)


def _content(record: bytes, with_payload: bool) -> tuple:
    """The fields of CONTENT for a record without its magic and final blank line."""
    head, _, block = record.partition(b"\r\n\r\n")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = (_header(head, "type") or b"").decode("utf-8", "replace")
    if kind == "revisit":  # the payload is elsewhere; the record's own headers tell size and digest
        size, digest, payload = _number(_header(http, "length")), (_header(head, "digest") or b"").decode() or None, None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    url = _header(head, "url")
    return (kind, _number(_header(head, "id")), _number(_header(head, "refers")), None if url is None else url.decode("utf-8", "replace"),
            size, digest, payload if with_payload else None)


def _typed(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes")})


def _leaves(offset: np.ndarray, successor: np.ndarray, end: int) -> np.ndarray:
    """For each candidate of a split, where the chain that starts there leaves the split; -1 if it breaks."""
    if not len(offset):
        return successor
    place = np.minimum(np.searchsorted(offset, successor), len(offset) - 1)
    inside = (successor >= 0) & (successor < end)
    follows = np.where(inside & (offset[place] == successor), place, np.arange(len(offset)))
    while not np.array_equal(further := follows[follows], follows):
        follows = further
    last = successor[follows]
    return np.where(last >= end, last, -1)


def _candidates(with_payload: bool):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per magic. The rows of a split come in order and together; offsets count from the split's first row."""
        rows, at, where = [], 0, None

        def finish() -> Iterator[pd.DataFrame]:
            if rows:
                frame = pd.DataFrame(rows, columns=_names(CANDIDATE))
                frame["leaves"] = _leaves(frame["offset"].to_numpy(np.int64), frame["successor"].to_numpy(np.int64), at)
                yield _typed(frame)

        for frame in frames:
            for file, block, value in zip(frame["file"], frame["block"], frame["value"]):
                if (file, block) != where:
                    yield from finish()
                    rows, at, where = [], 0, (file, block)
                    if block == 0:  # what stands before a file's first magic belongs to no record
                        at = len(value)
                        if at:
                            rows.append((file, block, -1, at, -1, -1, *[None] * 7))
                        continue
                head = value.find(b"\r\n\r\n")
                length = _number(_header(value[:head], "length")) if head >= 0 else None
                size = len(MAGIC) + len(value)
                ends = -1 if length is None else len(MAGIC) + head + 4 + length + 4
                rows.append((file, block, at, size, at + ends if ends >= 0 else -1, -1,
                             *(_content(value[:-4], with_payload) if ends == size else [None] * 7)))
                at += size
        yield from finish()

    return read


def _walk(key, frame):
    """The candidates of one split that the chain through its entry meets; numbers only, no payload."""
    frame = frame.sort_values("offset")
    offset, successor = frame["offset"].to_numpy(), frame["successor"].to_numpy()
    met, i = np.zeros(len(frame), bool), int(np.searchsorted(offset, frame["entry"].iloc[0]))
    while i < len(offset):
        met[i] = True
        j = int(np.searchsorted(offset, successor[i]))
        if successor[i] < 0 or j < len(offset) and offset[j] != successor[i]:
            break
        i = j
    return frame.loc[met, ["file", "block", "offset"]]


def _read_again(with_payload: bool):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole records by file, place and end."""
        from pyarrow import fs

        for frame in frames:
            rows = []
            for file, offset, upto in zip(frame["file"], frame["offset"], frame["upto"]):
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as stream:
                    stream.seek(offset + len(MAGIC))
                    record = stream.read(upto - offset - len(MAGIC) - 4)
                rows.append((file, offset, *_content(record, with_payload)))
            yield _typed(pd.DataFrame(rows, columns=_names(RECORD)))

    return read


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records below path, with the columns of RECORD; payload is null unless asked for, and for revisits.

    Records whose payload holds the magic are read by place, through a file system that pyarrow opens.
    """
    text = spark.read.option("lineSep", MAGIC).text(path)
    parts = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").cast("binary").alias("value"))
    local = settled(parts.mapInPandas(_candidates(with_payload), CANDIDATE), "warc-candidates")
    in_file = Window.partitionBy("file")
    spans = local.groupBy("file", "block").agg(F.sum("length").alias("span"))
    bases = settled(spans.select("file", "block", (F.sum("span").over(in_file.orderBy("block")) - F.col("span")).alias("base"),
                                 F.count(F.lit(1)).over(in_file).alias("blocks")), "warc-bases")
    placed = local.where("offset >= 0").join(bases, ["file", "block"])
    start = F.col("base") + F.col("offset")
    leaves = F.when(F.col("leaves") >= 0, F.col("base") + F.col("leaves"))

    # the chain from split to split: each round doubles how many splits a jump passes
    blocks = bases.agg(F.max("blocks")).first()[0] or 0
    reached = placed.select("file", start.alias("at")).where("at = 0")
    if blocks > 1:
        jumps = settled(placed.select("file", start.alias("at"), leaves.alias("to")).where("to IS NOT NULL"), "warc-jumps")
        for _ in range((blocks - 1).bit_length()):
            new = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
            reached = settled(reached.union(new).distinct(), "warc-reached")
            onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
            jumps = settled(jumps.join(onward, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "warc-jumps")
    entries = reached.join(placed.select("file", "block", start.alias("at"), F.col("offset").alias("entry")), ["file", "at"])
    chain = settled(placed.select("file", "block", "offset", "successor").join(entries.select("file", "block", "entry"), ["file", "block"])
                    .groupBy("file", "block").applyInPandas(_walk, "file string, block long, offset long"), "warc-chain")
    met = placed.join(chain, ["file", "block", "offset"])
    plain = met.where("record_type IS NOT NULL").select("file", start.alias("offset"), *_names(CONTENT))
    cut = met.where("record_type IS NULL AND successor >= 0").select("file", start.alias("offset"), (F.col("base") + F.col("successor")).alias("upto"))
    return plain.union(cut.mapInPandas(_read_again(with_payload), RECORD))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
