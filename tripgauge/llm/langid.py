"""Language of a text by a bidirectional recurrent network over its bytes.

The network (see `gru`) labels every byte of the text with a probability per language; a document's
probabilities are the mean over all its bytes. Texts are read whole, in windows of `window` bytes.

It learns from a bounded sample: at most `per_language` documents of each language in the training
folds, chosen by a hash of id and text, however often a row or an id is repeated, and `windows`
windows from places spread over each. Everything else reads all rows.

Defined results: a null text or one without any letter (str.isalpha) is `und` with score 0; so is
every text when there is nothing to learn from; of languages with equal probability the one that
sorts first is given; null ids count as held out; equal rows count once in training and are kept one
by one in the result; texts of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.llm import gru
from tripgauge.llm.common import held_out

UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: dict | None
    window: int = 64


def _windows(data: bytes, size: int, count: int) -> list[bytes]:
    """Up to `count` windows spread evenly over the data."""
    last = max(0, len(data) - size)
    places = sorted({last * i // max(1, count - 1) for i in range(count)})
    return [data[p : p + size] for p in places] if data else []


def train(docs: DataFrame, per_language: int = 600, windows: int = 6, window: int = 64, seed: int = 7, **fit) -> LanguageModel:
    """Learn from doc_id, text and lang of the training folds."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in known.groupBy(F.col("lang").cast("string").alias("lang")).count().collect()}
    if not counts:
        return LanguageModel([], None, window)
    languages = sorted(counts)
    # documents whose hash lies below twice their language's share, of these the first per_language
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, 2 * per_language / counts[lang]))])
    chance = F.shiftrightunsigned("hash", 1).cast("double") / float(2**63)
    rows = known.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text",
                        F.xxhash64("doc_id", "text", F.lit(seed)).alias("hash")).where(chance < share[F.col("lang")])
    # equal rows count once, and meet before they are shuffled
    rows = rows.groupBy("lang", "hash").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    picked = rows.withColumn("place", place).where(F.col("place") <= per_language).select("row.doc_id", "lang", "row.text")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(d, i, lang, w) for d, lang, text in zip(frame["doc_id"], frame["lang"], frame["text"])
                    for i, w in enumerate(_windows(text.encode(), window, windows))]
            yield pd.DataFrame(rows, columns=["doc_id", "place", "lang", "bytes"])

    rows = picked.mapInPandas(cut, "doc_id string, place int, lang string, bytes binary").collect()
    if not rows:
        return LanguageModel([], None, window)
    rows.sort(key=lambda r: (r.doc_id, r.place, bytes(r.bytes)))  # the same model at every run
    data = np.frombuffer(b"".join(bytes(r.bytes).ljust(window, b"\0") for r in rows), np.uint8).reshape(-1, window)
    labels = np.array([languages.index(r.lang) for r in rows])
    weights = gru.fit(data, np.array([len(r.bytes) for r in rows]), labels, len(languages), seed=seed, **fit)
    return LanguageModel(languages, weights, window)


def document_probabilities(model: LanguageModel, texts: list[str], batch: int = 1024) -> np.ndarray:
    """Mean label probabilities over all bytes of each text; a text of any length is read in pieces."""
    size, out = model.window, np.zeros((len(texts), len(model.languages)))
    pieces: list[bytes] = []
    owners: list[np.ndarray] = []
    held = 0

    def run() -> None:
        nonlocal held
        if not held:
            return
        data = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, size)
        owner = np.concatenate(owners)
        for at in range(0, len(data), batch):
            windows = data[at : at + batch]
            p = gru.positions(model.weights, np.ascontiguousarray(windows.T))
            p *= (windows != 0).T[:, None, :]  # zero bytes are padding
            np.add.at(out, owner[at : at + batch], p.sum(axis=0).T)
        pieces.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        data = text.encode()
        for at in range(0, len(data), size * batch):
            piece = data[at : at + size * batch]
            n = -(-len(piece) // size)
            pieces.append(piece.ljust(n * size, b"\0"))
            owners.append(np.full(n, i))
            held += n
            if held >= 4 * batch:
                run()
    run()
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-9)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and lang_score of the column or field `text` added; columns of these names are replaced."""

    @F.pandas_udf("lang_pred string, lang_score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t is not None and model.weights is not None and has_letter(t)]
        if rows:
            p = document_probabilities(model, [texts.iloc[i] for i in rows])
            for i, best, line in zip(rows, p.argmax(axis=1), p):
                lang[i], score[i] = model.languages[best], min(1.0, float(line[best]))
        return pd.DataFrame({"lang_pred": lang, "lang_score": score})

    found = docs.withColumn("_label", label(text))
    kept = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    return found.select(*kept, "_label.lang_pred", "_label.lang_score")


def op9_langid(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
