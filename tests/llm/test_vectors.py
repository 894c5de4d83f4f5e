import math
import random

import numpy as np
import pytest
from compare import difference, oracle_connection

from helpers import groups
from tripgauge.llm import common, embedding_dedup, oracle, topk, vectors

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
ODD = [(1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.01], 1, "x"), (3, [0.0, 0.0], 1, "x"), (4, None, 1, "x"), (5, [1.0, None], 1, "x"),
       (6, [NAN, 1.0], 1, "x"), (7, [INF, 1.0], 1, "x"), (8, [1.0, 0.0], None, "x"), (9, [1.0, 0.0, 0.0], 1, "x"), (10, [2.0, 0.0], 1, "x"),
       (None, [1.0, 0.0], 1, "x"), (50, [1.0, 0.0], 2, "x"), (51, [], 1, "x"), (52, [-1.0, -0.5], 2, "x"), (50, [1.0, 0.0], 2, "x")]
SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def test_queries_equal_sql(spark):
    con = oracle_connection(SF)
    assert difference(topk.op8_exact_topk(spark, SF), con, oracle.TOPK) is None
    assert difference(embedding_dedup.op10_embedding_dedup(spark, SF), con, oracle.EMBEDDING_DEDUP) is None


def clustered(count, seed, dims=6):
    rnd, out = random.Random(seed), []
    while len(out) < count:
        centre = [rnd.gauss(0, 1) for _ in range(dims)]
        for _ in range(rnd.choice([1, 3, 40])):
            out.append([x + rnd.gauss(0, rnd.choice([0, 0.05, 0.3])) for x in centre])
    return [(i, v, i % 3, "x") for i, v in enumerate(out[:count])]


@pytest.mark.parametrize("size", [dict(), dict(max_pivots=5, annulus_rows=10, rings=3, chunk_rows=20, query_rows=3, first_rows=10, sample_rows=50)])
def test_topk_against_every_pair(spark, size):
    rows = clustered(400, 2)
    whole = {i: [math.floor(256 * x) for x in v] for i, v, *_ in rows}
    from pyspark.sql import functions as F

    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string"), F.col("vec_id") % 50 == 0, **size)
    for q in range(0, 400, 50):
        want = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        mine = sorted((r["rank"], -r.score, r.vec_id) for r in got.where(f"query_id = {q}").collect())
        assert mine == [(k + 1, s, i) for k, (s, i) in enumerate(want)]


def test_topk_awkward_rows(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(ODD, SCHEMA)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.exact_topk(table, F.col("vec_id") % 50 == 0).collect()}
    one = 256 * 256
    assert got == {(50, 1): (10, 2 * one), (50, 2): (1, one), (50, 3): (2, one), (50, 4): (8, one), (50, 5): (3, 0)}
    assert topk.exact_topk(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.exact_topk(table, F.lit(False)).count() == 0


@pytest.mark.parametrize("size", [dict(), dict(cell_rows=20, block_rows=16, sample_rows=100)])
def test_links_against_every_pair(spark, size):
    rows = clustered(500, 5)
    rows += [(1000 + i, rows[i % 4][1], rows[i % 4][2], "x") for i in range(60)]  # copies
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string"), **size).collect()
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))
    links = [(a[0], b[0]) for i, a in enumerate(rows) for b in rows[:i] if a[2] == b[2] and cosine(a[1], b[1]) >= 0.93]
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert {r.vec_id: r.n_links for r in got} == degree
    assert {r.vec_id: r.component_id for r in got} == groups(degree, links) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_visited_cells_are_not_sent_copies(spark, tmp_path, monkeypatch):
    """Vectors without clusters visit most cells: what is written holds each vector a fixed number of times, whatever the number of cells."""
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(24)], i % 7 // 6, "x") for i in range(1400)]
    rows += [(2000 + i, [x + rnd.gauss(0, 0.02) for x in rows[i % 5][1]], rows[i % 5][2], "x") for i in range(90)]
    purposes = []

    def scratch_dir(_, purpose):
        purposes.append(purpose)
        return str(tmp_path / f"{purpose}-{len(purposes)}")

    for module in (common, embedding_dedup):
        monkeypatch.setattr(module, "scratch_dir", scratch_dir, raising=False)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=16, block_rows=64).collect()
    written = {p.name.rpartition("-")[0]: spark.read.parquet(str(p)).count() for p in tmp_path.iterdir() if p.name.startswith("cosine-")}
    assert written["cosine-cells"] == len(rows) and max(written.values()) == len(rows)
    v = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    v /= np.sqrt((v**2).sum(axis=1))[:, None]
    label = np.array([r[2] for r in rows])
    linked = (v @ v.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(v), dtype=bool)
    ids = [r[0] for r in rows]
    assert linked.sum() > 1000 and {r.vec_id: r.n_links for r in got} == dict(zip(ids, linked.sum(axis=1).tolist()))
    assert {r.vec_id: r.component_id for r in got} == groups(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])


def test_wide_rows_are_drawn_from_few(spark, monkeypatch):
    """The same rows as a sort of the whole table gives; what is sorted for them is little more than them."""
    table = spark.range(40_000).selectExpr("id % 30000 AS node", "id AS v")
    asked, sort = [], vectors.drawn
    monkeypatch.setattr(vectors, "drawn", lambda df, *rest: (asked.append(df.count()), sort(df, *rest))[1])
    for rows in (1, 100, 5000, 40_000, 50_000):
        want = [r.node for r in sort(table, ["node"], rows, 3).collect()]
        assert sorted(r.node for r in vectors.drawn_wide(table, ["node"], rows, 3).collect()) == sorted(want)
    assert len(asked) == 5 and asked[1] < 200 and asked[2] < 5100 and asked[3:] == [40_000, 40_000]
    assert vectors.drawn_wide(table.limit(0), ["node"], 5, 3).count() == 0


def test_cells_send_a_row_once():
    """A task that finds cells gives a row for each it got, and holds no copies of its vectors."""
    import pandas as pd

    draw = np.random.default_rng(4)
    centres = embedding_dedup.unit(draw.normal(size=(300, 16)))
    frame = pd.DataFrame({"node": np.arange(5000), "label": "a", "copies": 1, "v": list(draw.normal(size=(5000, 16)))})
    out = pd.concat(embedding_dedup._homes(centres)(iter([frame, frame.iloc[:0]])))
    assert len(out) == 5000 and (out["cell"].to_numpy() == (np.stack(frame["v"]) @ centres.T).argmax(axis=1)).all()


def test_links_in_many_small_and_one_large_label(spark):
    """Labels of one block and of many, an id with several vectors, rows of one long group, vectors at both sides of a block's end."""
    rnd = random.Random(3)
    rows = [(i, [math.cos(i / 16), math.sin(i / 16), rnd.random() / 50], 0, "x") for i in range(240)]
    rows += [(1000 + i, [1.0, i % 5 / 10, 0.5], 1 + i // 4, "x") for i in range(80)] + [(3, [0.0, 0.0, 5.0], 0, "x"), (7, [0.1, 0.0, 5.0], 0, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string")
    whole = sorted(tuple(r) for r in embedding_dedup.near_duplicates(table).collect())
    for size in (dict(cell_rows=20, block_rows=30, own_blocks=1, read_blocks=3), dict(cell_rows=100, block_rows=20, own_blocks=3, read_blocks=5)):
        assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(table, **size).collect()) == whole
    v = np.array([r[1] for r in rows])
    v /= np.sqrt((v**2).sum(axis=1))[:, None]
    label, ids = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    linked = (v @ v.T >= 0.93) & (label[:, None] == label[None, :]) & (ids[:, None] != ids[None, :])
    degree = {i: 0 for i in ids.tolist()}
    for i, n in zip(ids.tolist(), linked.sum(axis=1).tolist()):
        degree[i] += n
    got = groups(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(linked))])
    assert all(r[1] == degree[r[0]] and r[2] == got[r[0]] for r in whole)


def test_links_awkward_rows(spark):
    table = spark.createDataFrame(ODD, SCHEMA)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(table).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 51, 52)]
    want = [*alone, (1, 2, 1, True), (2, 2, 1, False), (10, 2, 1, False), (None, 0, None, True), (50, 1, 50, True), (50, 1, 50, True)]
    assert got == sorted(want, key=repr)
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_repeated_rows_are_candidates_each(spark, tmp_path):
    """Copies of a vector, of a query and of a row of the query's id, against SQL over the same rows."""
    rows = [(i, [i / 64, 1.0], 1, "x") for i in range(1, 13)] + [(11, [11 / 64, 1.0], 1, "y")] * 3 + [(50, [1.0, 1.0], 2, "x")] + [(9, [9 / 64, 1.0], 2, "x")] * 9
    table = spark.createDataFrame(rows, SCHEMA)
    table.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    import duckdb
    from pyspark.sql import functions as F

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    for size in (dict(), dict(max_pivots=4, annulus_rows=2, rings=2, chunk_rows=3, first_rows=2)):
        assert difference(topk.exact_topk(table, F.col("vec_id") % 50 == 0, **size), con, oracle.TOPK) is None


def test_excluded_annuli_are_not_sent(spark):
    """Clusters far apart: a query's candidates are a small part of the table."""
    rnd = random.Random(8)
    rows = [(i, [30.0 * (i % 20 == c) + rnd.random() for c in range(20)], 1, "x") for i in range(2000)]
    from pyspark.sql import functions as F

    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string"), F.col("vec_id") % 50 == 0,
                          max_pivots=20, annulus_rows=20, rings=4, chunk_rows=50, first_rows=60)
    assert got.count() == 40 * 5
    assert all(r.vec_id % 20 == r.query_id % 20 for r in got.collect())
