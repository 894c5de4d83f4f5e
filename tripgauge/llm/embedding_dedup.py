"""Near-duplicate vectors within a label: spherical k-means cells, blocked cosine products.

Equal vectors of a label are one node with a count, so copies never meet each other. Centres come
from spherical k-means over a bounded sample. A vector lives in the cell of its nearest centre and
visits every cell that could hold a vector within the threshold: if x lives with centre a and y with
b, the arc from y to x crosses the plane between a and b, so y's height above that plane is at most
the sine of the largest angle. So a vector meets all vectors of its own cell and those of the cells
that both visit, and what the cells find is exact.

The vectors of a label, in the order of their cells, are cut into blocks: small cells share a block,
large ones are parted by hash. A label of one block is one group. Of a larger label each block is
written once, as a file of its own, and no vector is sent to the cells it visits: a task holds a few
blocks and reads the blocks behind them one at a time. Of two blocks the rows that visit a cell of the
other meet as a matrix product, in single precision first, with room for its rounding, and again in
double precision where anything came close. So a task holds a few blocks and one product, whatever
the number of vectors, cells and visits. It returns counts and links to one member of each group it
found, never pairs. The driver holds the sample, the centres (at most `max_cells`) and a count of tasks.
Block files are read through a file system that pyarrow opens (local, HDFS, S3).

Defined results: a vector that is null, zero or holds a null or non-finite component, and one whose
label is null, links with nothing and is its own component; vectors of different length do not link;
a null id links with nothing and its component is null; rows that share an id are one vector of the
graph; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType
from pyspark.sql.window import Window

from tripgauge.llm.common import settled
from tripgauge.llm.components import components
from tripgauge.llm.vectors import drawn_wide, merge_labels, stacked, usable
from tripgauge.session import scratch_dir

FOUND = "node long, links long, root long"


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None]


def spherical_kmeans(rows: np.ndarray, cells: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centres: each round sends every unit row to its nearest centre and turns the centre to the rows' sum."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), min(cells, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        for c in np.unique(nearest):
            total = rows[nearest == c].sum(axis=0)
            if (size := np.sqrt(total @ total)) > 0:
                centres[c] = total / size
    return centres


def _homes(centres: np.ndarray, rows: int = 1024):
    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                parts = (stacked(frame["v"].iloc[i : i + rows]) for i in range(0, len(frame), rows))
                yield frame.assign(cell=np.concatenate([(unit(part) @ centres.T).argmax(axis=1) for part in parts]).astype("int32"))

    return route


class _Block:
    """Nodes that live in a few cells: ids, numbers of copies, home cells and unit vectors in both precisions."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, cell: np.ndarray, v: np.ndarray):
        self.nodes, self.copies, self.cell, self.v = nodes, copies, cell, v
        self.cells, self.single = np.unique(cell), v.astype(np.float32)

    def visitors(self, cells: np.ndarray, centres: np.ndarray, sine: float) -> np.ndarray:
        """Numbers of the rows that could link with a vector that lives in one of the cells; among many cells it is taken to be all."""
        if len(cells) > 16:
            return np.arange(len(self.nodes))
        there = centres[cells]
        height = (self.v * centres[self.cell]).sum(axis=1)[:, None] - self.v @ there.T
        apart = np.sqrt(np.maximum(2 - 2 * centres @ there.T, 0))[self.cell]
        return np.flatnonzero((height <= (sine + 1e-9) * apart + 1e-12).any(axis=1))


def _products(a: _Block, x: np.ndarray, b: _Block, y: np.ndarray, least: float, room: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which of a's rows x link with which of b's rows y: row numbers, row numbers, a matrix of truth values; at most `room` at a time."""
    right, slack = b.single[y].T, (a.v.shape[1] + 8) * 2.0**-23  # more than single precision can lose
    step = max(1, room // max(1, len(y)))
    for i in range(0, len(x) if len(y) else 0, step):
        some = x[i : i + step]
        close = a.single[some] @ right >= least - slack
        if not close.any():
            continue
        p, q = some[close.any(axis=1)], y[close.any(axis=0)]
        linked = (a.v[p] @ b.v[q].T >= least) & (a.nodes[p][:, None] != b.nodes[q])
        if linked.any():
            yield p, q, linked


def _join(label: np.ndarray, p: np.ndarray, q: np.ndarray, linked: np.ndarray) -> None:
    """Give the ends of all links the smaller label: first one link of each row and column, then those that still join two groups."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    merge_labels(label, np.concatenate([p[rows], p[linked[:, columns].argmax(axis=0)]]), np.concatenate([q[linked[rows].argmax(axis=1)], q[columns]]))
    x, y = np.nonzero(linked & (label[p][:, None] != label[q]))
    merge_labels(label, p[x], q[y])


def _meet(own: list[_Block], others: Iterable[tuple[int, _Block]], centres: np.ndarray, sine: float, least: float) -> Iterator[pd.DataFrame]:
    """Counts, and links to a member of the group, between the blocks `own` and the others, which come numbered.

    Block i of own meets the others with a number of i or more; the other of number i is the block itself.
    """
    nodes = np.concatenate([b.nodes for b in own])
    at = np.cumsum([0, *(len(b.nodes) for b in own)])
    label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
    for number, block in others:
        both, got = np.concatenate([label, len(nodes) + np.arange(len(block.nodes))]), np.zeros(len(block.nodes), np.int64)
        for i, mine in enumerate(own[: number + 1]):
            same, every = i == number, np.arange(len(mine.nodes))
            visits = (every, every) if same else (mine.visitors(block.cells, centres, sine), block.visitors(mine.cells, centres, sine))
            for x, y, linked in _products(mine, visits[0], block, visits[1], least):
                counted = linked.astype(np.float64)  # sums of copies are exact below 2^53
                links[at[i] + x] += (counted @ block.copies[y]).astype(np.int64)
                if not same:  # a block with itself has every pair both ways
                    got[y] += (mine.copies[x] @ counted).astype(np.int64)
                _join(both, at[i] + x, at[i] + y if same else len(nodes) + y, linked)
        label, some = both[: len(nodes)], got > 0
        if some.any():
            yield pd.DataFrame({"node": block.nodes[some], "links": got[some], "root": nodes[both[len(nodes) :][some]]})
    some = (links > 0) | (label != np.arange(len(nodes)))
    yield pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[label[some]]})


def _within(centres: np.ndarray, sine: float, least: float):
    def within(frame: pd.DataFrame) -> pd.DataFrame:
        block = _Block(frame["node"].to_numpy(), frame["copies"].to_numpy(), frame["cell"].to_numpy(), unit(stacked(frame["v"])))
        return pd.concat(_meet([block], [(0, block)], centres, sine, least))

    return within


def _packed(kind: str):
    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        of = lambda name, kept: frame[name].to_numpy().astype(kept).tobytes()
        return pd.DataFrame([(*key, of("node", "<i8"), of("copies", "<i8"), of("cell", "<i4"), stacked(frame["v"]).astype(kind).tobytes())],
                            columns=["label", "slot", "part", "nodes", "copies", "cells", "vectors"])

    return pack


def _read(file: str, kind: str) -> _Block:
    from pyarrow import fs
    from pyarrow import parquet

    store, path = fs.FileSystem.from_uri(file)
    row = parquet.read_table(path, filesystem=store, use_threads=False, partitioning=None).to_pylist()[0]
    nodes = np.frombuffer(row["nodes"], "<i8")
    v = np.frombuffer(row["vectors"], kind).astype(np.float64).reshape(len(nodes), -1)
    return _Block(nodes, np.frombuffer(row["copies"], "<i8"), np.frombuffer(row["cells"], "<i4"), unit(v))


def _between(kind: str, centres: np.ndarray, sine: float, least: float):
    def between(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, own, begin, others in zip(frame["first"], frame["own"], frame["begin"], frame["others"]):
                blocks = [_read(file, kind) for file in own]
                behind = ((begin + j - first, file) for j, file in enumerate(others) if begin + j >= first)
                read = ((n, blocks[n] if n < len(blocks) else _read(file, kind)) for n, file in behind)
                yield from _meet(blocks, read, centres, sine, least)

    return between


def _linked(nodes: DataFrame, length: int, largest: int, least: float, cell_rows: int, max_cells: int, block_rows: int, sample_rows: int, own_blocks: int,
            read_blocks: int, seed: int) -> DataFrame:
    """(node, links, root) for vectors of one length; a node may have several rows, whose links add up."""
    spark, kind = nodes.sparkSession, "<f4" if isinstance(nodes.schema["v"].dataType.elementType, FloatType) else "<f8"
    sample = stacked([r.v for r in drawn_wide(nodes, ["node"], sample_rows, seed).collect()])
    centres, sine = spherical_kmeans(unit(sample), min(max_cells, ceil(largest / cell_rows)), seed=seed), np.sqrt(1 - least**2)
    most = max(1, min(block_rows, (1 << 20) // max(1, length)))  # rows of a block: 8 MB in double precision at most
    routed = settled(nodes.mapInPandas(_homes(centres), f"{nodes.select('label', 'node', 'copies', 'v').schema.simpleString()[7:-1]}, cell int"), "cosine-cells")
    label = Window.partitionBy("label")
    sizes = routed.groupBy("label", "cell").count().select(
        "label", "cell", F.sum("count").over(label).alias("in_label"), F.when(F.col("count") > most, -1 - F.col("cell")).otherwise(
            F.floor((F.sum("count").over(label.orderBy("cell")) - F.col("count")) / most)).cast("long").alias("slot"), F.ceil(F.col("count") / most).alias("parts"))
    small = routed.join(sizes.where(F.col("in_label") <= most).select("label", "cell"), ["label", "cell"])
    found = small.groupBy("label").applyInPandas(_within(centres, sine, least), FOUND)
    if largest <= most:
        return found
    large = routed.join(sizes.where(F.col("in_label") > most), ["label", "cell"])
    part = F.pmod(F.xxhash64("node", "v", F.lit(1)), F.col("parts")).cast("int")
    blocks = large.withColumn("part", part).groupBy("label", "slot", "part").applyInPandas(
        _packed(kind), "label string, slot long, part int, nodes binary, copies binary, cells binary, vectors binary")
    folder = scratch_dir(spark, "cosine-blocks")
    blocks.write.option("maxRecordsPerFile", 1).option("parquet.enable.dictionary", "false").parquet(folder)  # a block is a file
    number = F.row_number().over(label.orderBy("slot", "part")) - 1
    index = settled(spark.read.schema(blocks.schema).parquet(folder).select(
        "label", number.alias("number"), F.col("_metadata.file_path").alias("file")), "cosine-index")

    def bundled(size: int, first: str, files: str) -> DataFrame:
        start = (F.floor(F.col("number") / size) * size).alias(first)
        listed = F.sort_array(F.collect_list(F.struct("number", "file")))
        return index.groupBy("label", start).agg(F.transform(listed, lambda x: x["file"]).alias(files))

    tasks = bundled(own_blocks, "first", "own").join(bundled(read_blocks, "begin", "others"), "label").where(
        F.col("begin") + F.size("others") > F.col("first")).select("first", "own", "begin", "others")
    tasks = settled(tasks, "cosine-tasks")
    tasks = tasks.repartition(max(1, min(tasks.count(), 20_000)))
    return found.union(tasks.mapInPandas(_between(kind, centres, sine, least), FOUND))


def near_duplicates(vectors: DataFrame, least: float = 0.93, cell_rows: int = 1024, max_cells: int = 1024, block_rows: int = 2048,
                    sample_rows: int = 16_384, own_blocks: int = 4, read_blocks: int = 256, seed: int = 3) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vec_id, embedding and label."""
    spark = vectors.sparkSession
    kept = "float" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "double"  # computed in doubles
    takes_part = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.exists("embedding", lambda x: x != 0)
    rows = settled(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(takes_part, F.col("label").cast("string")).alias("label"),
                                  F.when(takes_part, F.col("embedding").cast(f"array<{kept}>")).alias("v")), "cosine-vectors")
    nodes = settled(rows.where("v IS NOT NULL").groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "cosine-nodes")
    found = spark.createDataFrame([], FOUND)
    lengths = nodes.groupBy(F.size("v").alias("length"), "label").count().groupBy("length").agg(F.max("count").alias("largest"))
    for length, largest in lengths.collect():  # as a rule one length
        found = found.union(_linked(nodes.where(F.size("v") == length), length, largest, least, cell_rows, max_cells, block_rows, sample_rows, own_blocks, read_blocks, seed))
    found = settled(found, "cosine-links")
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = nodes.join(links, "node", "left").join(groups, "node", "left").select(
        F.col("label").alias("node_label"), F.col("v").alias("node_v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"))
    of_node = settled(of_node, "cosine-classes")  # both sides of the join come from files, so a hot vector can be split
    joined = rows.join(of_node, (rows.label == of_node.node_label) & (rows.v == of_node.node_v), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    return near_duplicates(table(spark, sf_dir, "embeddings"))
