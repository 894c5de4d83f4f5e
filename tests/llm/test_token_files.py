import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import docs, empty
from tokenizers import Tokenizer

from tripgauge.llm import token_files as tf

MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(MODEL)


def test_words_make_up_texts(tokenizer):
    rnd, words = random.Random(1), tf.WordIds(tokenizer, "<u4", room=500)
    parts = ["a", "B", "é", "é", "́", " ", "\t", "\n", "\r", ".", ",", "\x1c", "\x85", " ", "'s", "'T", "1", "23", "!", "<|endoftext|>",
             "<|STARTOFTEXT|>", "<|startoftext|>", "Σ", "ς", "İ", "中", "\u0000", "😀", "_", "-", "…", "٣"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        assert words.of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_frames_and_damage(tmp_path):
    import io

    assert tf.read_frame(io.BytesIO(tf.frame_bytes(b"abc"))) == b"abc" and tf.read_frame(io.BytesIO(tf.frame_bytes(b""))) == b""
    whole = bytearray(tf.frame_bytes(b"some data"))
    for at in range(len(whole)):
        bad = bytearray(whole)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            tf.read_frame(io.BytesIO(bytes(bad)))


def test_files_against_whole_encoding(spark, tmp_path, tokenizer):
    path, table = str(tmp_path / "ids"), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    manifest = tf.write_token_files(table.repartition(5), path, MODEL)
    got = sorted((r.doc_id, r.start, bytes(r.ids)) for r in tf.read_token_files(manifest, path).collect())
    want, start = [], 0
    for r in sorted(table.collect(), key=lambda r: r.doc_id):
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, start, ids.tobytes()))
        start += len(ids)
    assert got == want
    from pyarrow import fs

    first = min(manifest.collect(), key=lambda r: r.part)
    doc, ids = tf.read_frame_at(fs.LocalFileSystem(), first.path, first.index_path, first.docs - 1)
    assert (doc, ids.astype("<u4").tobytes()) == (want[first.docs - 1][0], want[first.docs - 1][2])


def test_query_and_awkward_rows(spark, tmp_path):
    rows = tf.op6_token_files(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    manifest = tf.write_token_files(docs(spark), str(tmp_path / "odd"), MODEL)
    got = tf.read_token_files(manifest, str(tmp_path / "odd")).collect()
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, None, 1, 2, 3, 4, 5, 5, 9, 10]
    assert all(b.start == a.start + len(a.ids) // 4 for a, b in zip(order, order[1:]))
    end = np.array([2], "<u4").tobytes()
    assert all(bytes(r.ids) == end for r in got if r.doc_id in (2, 3, 9)) and zlib.crc32(end)
    none = tf.write_token_files(empty(spark), str(tmp_path / "none"), MODEL)
    assert none.count() == 0 and tf.read_token_files(none, str(tmp_path / "none")).count() == 0
