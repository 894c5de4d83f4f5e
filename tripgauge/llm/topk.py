"""Exact top-k by inner product through a pivot-distance index.

Index. Vectors get one more coordinate that makes all of them equally long, so that a larger inner
product with a query is a smaller distance to it. Pivots come from a bounded sample; a vector's key
is its nearest pivot and its distance to it, and each pivot's distances are cut into rings, so an
annulus (pivot, ring) is a set of vectors whose distance to the pivot lies within known ends. There
are as many pivots as give annuli of about `annulus_rows` vectors, up to `max_pivots`; every vector
is indexed, and a larger annulus is cut into chunks by hash.

Search. By the triangle inequality a query cannot be nearer to an annulus than its own distance to
the pivot lies outside the ends; that bounds the inner product from above. First each query visits
the annuli with the best bounds until they hold `first_rows` vectors; its k-th score there is a
floor. Then it visits those others whose bound reaches the floor, and no more. A task holds one
chunk and one block of the queries that visit it.

The driver holds the sample, the pivots and a few numbers per annulus (pivots x rings of them,
whatever the size of the table).

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id; vectors of different length are not compared; rows with the query's id are its
own, and equal rows of one query id ask once; repeated rows are candidates each, and a vector stored
several times takes as many ranks; fewer than k others give fewer rows; an empty table or no query gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripgauge.llm.common import settled
from tripgauge.llm.vectors import drawn, stacked, usable

FOUND = "query_id long, vec_id long, score long, copies int"


def _pivots(sample: np.ndarray, pivots: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of the sample by a few rounds of k-means; no sample gives none."""
    draw = np.random.default_rng(seed)
    centres = sample[draw.choice(len(sample), min(pivots, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(axis=1)
        for c in np.unique(nearest):
            centres[c] = sample[nearest == c].mean(axis=0)
    return centres


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T
    return np.sqrt(np.maximum(squares, 0))


def _lengthened(rows: np.ndarray, longest: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(longest - (rows**2).sum(axis=1), 0))
    return np.hstack([rows, extra[:, None]])


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles as long as they hold every sum, else in Python's integers."""
    largest = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * max(rows.shape[1], 1)
    if largest < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    return whole(queries) @ whole(rows).T


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, copies: np.ndarray, k: int, block: int = 256) -> list[tuple]:
    """(query, vector, score, copies) of each query's k best among the rows, ties to the smaller id."""
    out = []
    order = ids.argsort(kind="stable")
    ids, rows, copies = ids[order], rows[order], copies[order]
    for at in range(0, len(queries), block):
        scores = _products(queries[at : at + block], rows)
        for q, line in zip(query_ids[at : at + block].tolist(), scores):
            take = np.argsort(-line, kind="stable")[: k + int((ids == q).sum())]
            out += [(q, int(ids[j]), int(line[j]), int(copies[j])) for j in take if ids[j] != q][:k]
    return out


def _same_length(rows: DataFrame, asked: DataFrame, k: int, max_pivots: int, annulus_rows: int, rings: int, sample_rows: int, chunk_rows: int,
                 query_rows: int, first_rows: int, seed: int) -> DataFrame:
    """The search over vectors `v` (array of long) of one length; `asked` holds the queries among them."""
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    total, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    pivots, parts = min(max_pivots, ceil(total / (rings * annulus_rows))), max(1, ceil(asked.count() / query_rows))
    sample = stacked([r.v for r in drawn(rows, ["vec_id"], sample_rows, seed).collect()])
    centres = _pivots(_lengthened(sample, longest), pivots, 5, seed)
    near = _distances(_lengthened(sample, longest), centres)
    cell, ring_at = near.argmin(axis=1), np.zeros((len(centres), rings - 1))
    for c in range(len(centres)):
        own = near[cell == c, c]
        ring_at[c] = np.quantile(own, np.arange(1, rings) / rings) if len(own) else 0

    def place(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = _distances(_lengthened(vectors, longest), centres)
        nearest = away.argmin(axis=1)
        away = away[np.arange(len(away)), nearest]
        ring = np.array([np.searchsorted(ring_at[c], d, side="right") for c, d in zip(nearest, away)], dtype=np.int64)
        return nearest * rings + ring, away

    def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                annulus, away = place(stacked(frame["v"]))
                yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "copies": frame["copies"], "annulus": annulus.astype("int32"), "away": away})

    index = settled(rows.select("vec_id", "v", "copies").mapInPandas(key, "vec_id long, v array<long>, copies int, annulus int, away double"), "pivot-index")
    told = index.groupBy("annulus").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("lo"), F.max("away").alias("hi")).collect()
    annuli = np.array([r.annulus for r in told], dtype=np.int64)
    n, lo, hi = (np.array([r[c] for r in told], dtype=np.float64) for c in ("n", "lo", "hi"))
    chunks = np.ceil(n / chunk_rows).astype(np.int64)
    of_annulus = annuli // rings

    def bounds(queries: np.ndarray) -> np.ndarray:
        """The largest inner product that a query can have in each annulus, with room for rounding."""
        flat = np.hstack([queries, np.zeros((len(queries), 1))])
        away = _distances(flat, centres)[:, of_annulus]
        least = np.maximum(np.maximum(lo[None, :] - away, away - hi[None, :]), 0)
        whole = (queries**2).sum(axis=1)[:, None] + longest
        return (whole - least**2) / 2 + 1e-6 * whole + 1

    def first(bound: np.ndarray) -> np.ndarray:
        """Which annuli a query visits first: the best ones, until they hold first_rows vectors."""
        order = np.argsort(-bound, axis=1, kind="stable")
        before = np.cumsum(n[order], axis=1) - n[order]
        visit = np.zeros(bound.shape, bool)
        np.put_along_axis(visit, order, before < first_rows, axis=1)
        return visit

    def visits(later: bool):
        def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if not len(frame):
                    continue
                queries = stacked(frame["v"])
                bound = bounds(queries)
                visit = first(bound)
                if later:
                    floor = frame["floor"].astype("float64").fillna(-np.inf).to_numpy()
                    visit = ~visit & (bound >= floor[:, None])
                q, a = np.nonzero(visit)
                of = np.repeat(np.arange(len(q)), chunks[a])
                chunk = np.arange(len(of)) - np.repeat(np.cumsum(chunks[a]) - chunks[a], chunks[a])
                ids, vectors, block = frame["vec_id"].to_numpy(), frame["v"].to_numpy(), frame["block"].to_numpy()
                for at in range(0, len(of), 4096):  # keeps what a task holds small
                    some = of[at : at + 4096]
                    yield pd.DataFrame({"annulus": annuli[a[some]].astype("int32"), "chunk": chunk[at : at + 4096].astype("int32"),
                                        "block": block[q[some]], "query_id": ids[q[some]], "q": vectors[q[some]]})
        return go

    def meet(keys, queries, vectors):
        if not len(queries) or not len(vectors):
            return pd.DataFrame([], columns=["query_id", "vec_id", "score", "copies"])
        found = _best(queries["query_id"].to_numpy(), stacked(queries["q"]), vectors["vec_id"].to_numpy(), stacked(vectors["v"]), vectors["copies"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "copies"])

    spark = rows.sparkSession
    counted = spark.createDataFrame([(int(a), int(c)) for a, c in zip(annuli, chunks)], "annulus int, chunks int")
    chunk = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col("chunks")).cast("int")
    held = index.join(counted, "annulus").select("annulus", chunk.alias("chunk"), "vec_id", "v", "copies")
    block = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")

    def search(queries: DataFrame, later: bool) -> DataFrame:
        sent = queries.withColumn("block", block).mapInPandas(visits(later), "annulus int, chunk int, block int, query_id long, q array<long>")
        sent = settled(sent, "pivot-visits")
        key = ["annulus", "chunk", "block"]
        # a vector goes to the blocks of queries that visit its chunk, and nowhere else
        met = held.join(sent.select(key).distinct().toDF(*key), ["annulus", "chunk"])
        return sent.groupBy(key).cogroup(met.groupBy(key)).applyInPandas(meet, FOUND)

    early = settled(search(asked, False), "pivot-early")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = early.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    late = search(asked.join(floors, "vec_id", "left"), True)
    every = early.union(late).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_topk(vectors: DataFrame, is_query: Column, scale: int = 256, k: int = 5, max_pivots: int = 256, annulus_rows: int = 512, rings: int = 8,
               sample_rows: int = 8192, chunk_rows: int = 2048, query_rows: int = 4096, first_rows: int = 2048, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where is_query holds its k best other rows.

    Needs vec_id and embedding; the score is the inner product of floor(scale * x).
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    # equal rows are searched once and counted: a result holds k of them at most
    rows = rows.groupBy("vec_id", "v").agg(F.max("is_query").alias("is_query"), F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    rows = settled(rows, "topk-vectors")
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for (length,) in rows.select(F.size("v")).distinct().collect():  # as a rule one
        same = rows.where(F.size("v") == length)
        out = out.union(_same_length(same, same.where("is_query").select("vec_id", "v"), k, max_pivots, annulus_rows, rings, sample_rows, chunk_rows, query_rows,
                                     first_rows, seed))
    return out


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
