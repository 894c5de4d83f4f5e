"""Token ids of whole documents in length-delimited binary files, with an index for shuffled reads.

A record file is a run of frames. A frame is

    length of the data      8 bytes, little-endian unsigned
    masked checksum of it   4 bytes
    data                    length bytes
    masked checksum of it   4 bytes

The checksum is CRC-32, masked by rotating it 15 bits to the right and adding 0xa282ead8, so that
checksums of data that holds checksums stay good. The data are the document's id (8 bytes, signed),
whether it has one (1 byte), the width of a token id (1 byte: 2 or 4) and the token ids.

Beside each record file lies an index: per frame, in order, its place in the file and the number of
ids before it in the file (8 bytes each). A reader may seek to any frame.

Files hold ascending ranges of doc_id. Each is written by one task under a name of its own, and the
manifest, written last, names the files of the tasks that succeeded; a task that is run again leaves
at most a file that no manifest names.

Defined results: null texts are empty and give the end id alone; null ids come first; rows with one
id are ordered by text; an empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripgauge.llm.common import kept_by_worker
from tripgauge.session import scratch_dir

HEAD, CHECK, DATA, ENTRY = "<Q", "<I", "<qBB", "<QQ"
MANIFEST = "part int, path string, index_path string, docs long, ids long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame_bytes(data: bytes) -> bytes:
    head = struct.pack(HEAD, len(data))
    return b"".join((head, struct.pack(CHECK, masked_crc(head)), data, struct.pack(CHECK, masked_crc(data))))


def read_frame(stream) -> bytes:
    """The data of the frame at the stream's place. Raises ValueError when a checksum is wrong."""
    head, check = stream.read(8), stream.read(4)
    if len(check) < 4 or masked_crc(head) != struct.unpack(CHECK, check)[0]:
        raise ValueError("damaged frame length")
    data = stream.read(struct.unpack(HEAD, head)[0])
    if masked_crc(data) != struct.unpack(CHECK, stream.read(4))[0]:
        raise ValueError("damaged frame data")
    return data


class WordIds(dict):
    """Token ids of a word as little-endian bytes; words not met before go through the tokenizer.

    The tokenizer folds case, drops white space and never joins across it, nor a full stop or comma
    to the ASCII letter or digit before it, so a text's ids are those of its words. At most `room`
    words are kept.
    """

    def __init__(self, tokenizer, kind: str, room: int = 800_000):
        self.tokenizer, self.kind, self.room, self.merges = tokenizer, kind, room, tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.room:
            self.clear()
        if word[-1:] in (b".", b",") and word[-2:-1].isalnum():
            found = self[word] = self[word[:-1]] + self[word[-1:]]
            return found
        if word.isalpha() and word.islower():  # one pre-token as it stands: spares the steps before the merges
            ids = [token.id for token in self.merges(word.decode())]
        else:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        found = self[word] = np.array(ids, dtype=self.kind).tobytes()
        return found

    def of(self, text: str | None) -> bytes:
        data = (text or "").encode()
        if b"<|" not in data:  # special tokens are told apart by case
            data = data.lower()
        return b"".join(map(self.__getitem__, data.split()))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Encode doc_id and text of every row into record files below path; returns the manifest.

    The manifest has a row per file, written below path too, and is read from there.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        store, base = fs.FileSystem.from_uri(path)
        part = TaskContext.get().partitionId()
        name = f"{base}/ids/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        def word_ids() -> WordIds:
            tokenizer = Tokenizer.from_file(tokenizer_path)
            return WordIds(tokenizer, "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")

        out = index = words = None
        docs_done = ids_done = place = 0
        for frame in frames:
            if out is None:
                store.create_dir(f"{base}/ids", recursive=True)
                words = kept_by_worker(f"words {tokenizer_path} {end_id}", word_ids)
                width = int(words.kind[-1])
                end = np.array([end_id], dtype=words.kind).tobytes()
                out, index = store.open_output_stream(f"{name}.rec"), store.open_output_stream(f"{name}.idx")
            for doc, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                missing = doc is pd.NA
                ids = words.of(text) + end
                framed = frame_bytes(struct.pack(DATA, 0 if missing else int(doc), not missing, width) + ids)
                out.write(framed)
                index.write(struct.pack(ENTRY, place, ids_done))
                place += len(framed)
                docs_done += 1
                ids_done += len(ids) // width
        if out is not None:
            out.close()
            index.close()
            yield pd.DataFrame([(part, f"{name}.rec", f"{name}.idx", docs_done, ids_done)], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    ordered = texts.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    ordered.select("doc_id", "text").mapInPandas(write, MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(manifest: DataFrame, path: str, rows: int = 500) -> DataFrame:
    """(doc_id, start, ids): start counts the ids of all documents before; ids are little-endian unsigned 32-bit."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(path)
        for frame in frames:
            for file in frame.itertuples():
                with store.open_input_stream(file.index_path) as stream:
                    index = np.frombuffer(stream.read(), dtype="<u8").reshape(-1, 2)
                got = []
                with store.open_input_stream(file.path, buffer_size=1 << 20) as stream:
                    for before in index[:, 1].tolist():
                        data = read_frame(stream)
                        doc, known, width = struct.unpack_from(DATA, data)
                        ids = np.frombuffer(data, dtype=f"<u{width}", offset=struct.calcsize(DATA))
                        got.append((doc if known else None, file.base + before, ids.astype("<u4").tobytes()))
                        if len(got) == rows:
                            yield pd.DataFrame(got, columns=["doc_id", "start", "ids"]).astype({"doc_id": "Int64"})
                            got = []
                if got:
                    yield pd.DataFrame(got, columns=["doc_id", "start", "ids"]).astype({"doc_id": "Int64"})

    # one row per file, so this window holds as many rows as there were tasks
    before = F.sum("ids").over(Window.orderBy("part")) - F.col("ids")
    files = manifest.select("part", "path", "index_path", before.alias("base"))
    spread = files.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "part")
    return spread.mapInPandas(read, "doc_id long, start long, ids binary")


def read_frame_at(store, path: str, index_path: str, number: int) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of one frame of a file, found through the index."""
    with store.open_input_file(index_path) as stream:
        stream.seek(16 * number)
        place = struct.unpack(ENTRY, stream.read(16))[0]
    with store.open_input_file(path) as stream:
        stream.seek(place)
        data = read_frame(stream)
    doc, known, width = struct.unpack_from(DATA, data)
    return doc if known else None, np.frombuffer(data, dtype=f"<u{width}", offset=struct.calcsize(DATA))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tripgauge.llm.common import table

    path = scratch_dir(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
