"""Near-duplicate groups by SimHash, searched with vantage-point trees.

A fingerprint has a bit where more than half of a text's shingle hashes have it. Two texts link
when their fingerprints differ in at most `max_bits` bits; groups are what links connect.

Search. 64 near-random bits lie about 32 apart from everything, so a tree over whole fingerprints
prunes little at 4 bits. The bits are therefore cut into bands: two fingerprints within `max_bits`
agree to within max_bits // bands bits on one band, and each band has a tree whose Hamming distance
is that band's. The top of a tree is built from a bounded sample and cuts the fingerprints into
shards at a vantage point's median distance; a fingerprint belongs to one shard and is also sent, as
a visitor, to those whose side of a boundary the triangle inequality cannot exclude. Inside a shard
the tree goes on to small leaves, where whole fingerprints are compared, so every pair within
`max_bits` is found and no other.

Equal fingerprints are one node, so exact copies never meet each other, and a shard returns the
groups it found as links to their smallest member, not as pairs. Only the sample (at most
`sample_rows` fingerprints) and tree nodes reach the driver.

Defined results: null and empty texts have no words and fingerprint zero, which links like any
other; null ids never become a component_id unless a group has no other; repeated rows are rows of
one group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import settled
from tripgauge.llm.components import components
from tripgauge.llm.vectors import merge_labels


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42, block: int = 1 << 15) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    # bytes.lower() and bytes.split() know A-Z and the six ASCII blanks only, as wanted
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), block):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + block].tolist(), ends[at : at + block].tolist())],
                          dtype=np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def _differ(values: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(values ^ other)


class Split:
    """An inner node: nearer than or as near as `radius` goes left, the rest right. A leaf is a shard number."""

    def __init__(self, point, radius, left, right):
        self.point, self.radius, self.left, self.right = point, radius, left, right


def _median_split(near: np.ndarray):
    """A radius that parts the distances as evenly as possible, None if all are equal."""
    values = np.unique(near)
    if len(values) < 2:
        return None
    below = np.searchsorted(np.sort(near), values[:-1], side="right")
    return int(values[np.abs(below - len(near) / 2).argmin()])


def _top(sample: np.ndarray, depth: int, draw, shards: list[int]):
    """The upper tree over a sample of band values; leaves number the shards."""
    if depth and len(sample) > 1:
        point = sample[draw.integers(len(sample))]
        near = _differ(sample, point)
        if (radius := _median_split(near)) is not None:
            left = _top(sample[near <= radius], depth - 1, draw, shards)
            return Split(point, radius, left, _top(sample[near > radius], depth - 1, draw, shards))
    shards.append(len(shards))
    return shards[-1]


def _descend(tree, values: np.ndarray, rows: np.ndarray, home: np.ndarray, slack: int) -> Iterator[tuple]:
    """(shard, rows, home) for every shard that a row is of or must visit."""
    if not isinstance(tree, Split):
        yield tree, rows, home
        return
    near = _differ(values[rows], tree.point).astype(np.int64)
    inner = near <= tree.radius
    for side, may, own in ((tree.left, near - slack <= tree.radius, inner), (tree.right, near + slack > tree.radius, ~inner)):
        if may.any():
            yield from _descend(side, values, rows[may], (home & own)[may], slack)


def _link_shard(prints: np.ndarray, band: np.ndarray, home: np.ndarray, slack: int, max_bits: int, label: np.ndarray,
                leaf: int = 64, room: int = 1 << 20) -> None:
    """Merge the labels of every home row and every row within max_bits of it whose band is within slack."""
    todo = [(np.flatnonzero(home), np.arange(len(prints)))]
    while todo:
        own, all_rows = todo.pop()
        if not len(own):
            continue
        radius = None
        if len(own) > leaf:
            point = band[own[len(own) // 2]]
            radius = _median_split(near := _differ(band[own], point).astype(np.int64))
        if radius is not None:
            far = _differ(band[all_rows], point).astype(np.int64)
            todo.append((own[near <= radius], all_rows[far - slack <= radius]))
            todo.append((own[near > radius], all_rows[far + slack > radius]))
            continue
        step = max(1, room // len(all_rows))
        for at in range(0, len(own), step):
            some = own[at : at + step]
            i, j = np.nonzero(_differ(prints[some][:, None], prints[all_rows][None, :]) <= max_bits)
            merge_labels(label, some[i], all_rows[j])


def linked_prints(prints: DataFrame, max_bits: int = 4, bands: int = 3, shard_rows: int = 4096, sample_rows: int = 8192,
                  block_rows: int = 16_384, seed: int = 11) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints `print` (long) within max_bits.

    A shard with more than block_rows visitors, as where many fingerprints share a band, is cut into
    blocks: each block of those that live there meets each block of all that visit, a task a pair.
    """
    spark, slack = prints.sparkSession, max_bits // bands
    n = prints.count()
    drawn = prints.orderBy(F.xxhash64("print", F.lit(seed)), "print").limit(sample_rows).collect()
    sample = np.array([r.print for r in drawn], dtype=np.int64).view(np.uint64)
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    depth = max(0, ceil(log2(max(1, n) / shard_rows)))
    draw, shards, trees = np.random.default_rng(seed), [], []
    first = []
    for mask in masks:
        first.append(len(shards))
        trees.append(_top(sample & np.uint64(mask), depth, draw, shards))
    ends = [*first[1:], len(shards)]
    mask_of = {s: m for m, a, b in zip(masks, first, ends) for s in range(a, b)}

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["print"].to_numpy().view(np.uint64)
            for mask, tree in zip(masks, trees):
                rows = np.arange(len(values))
                for shard, at, home in _descend(tree, values & np.uint64(mask), rows, np.ones(len(rows), bool), slack):
                    yield pd.DataFrame({"shard": shard, "print": values[at].view(np.int64), "home": home})

    def link(key, frame):
        # sorted, so that the smallest label of a group is its smallest fingerprint
        order = frame["print"].to_numpy().argsort(kind="stable")
        signed = frame["print"].to_numpy()[order]
        values, home = signed.view(np.uint64), frame["home"].to_numpy()[order]
        label = np.arange(len(values))
        _link_shard(values, values & np.uint64(mask_of[key[0]]), home, slack, max_bits, label)
        moved = signed != signed[label]  # in a block of a large shard a fingerprint may stand twice
        return pd.DataFrame({"u": signed[moved], "v": signed[label[moved]]})

    routed = settled(prints.mapInPandas(route, "shard int, print long, home boolean"), "simhash-shards")
    blocks = lambda n: F.ceil(n / block_rows).cast("int")
    sizes = routed.groupBy("shard").agg(blocks(F.count_if("home")).alias("homes"), blocks(F.count(F.lit(1))).alias("guests"))
    pairs = F.expr("""inline(CASE WHEN guests = 1 THEN array(named_struct('i', 0, 'j', 0, 'home', home)) ELSE concat(
        transform(filter(sequence(0, guests - 1), x -> home), x -> named_struct('i', int(pmod(xxhash64(print, 1), homes)), 'j', x, 'home', true)),
        transform(sequence(0, homes - 1), x -> named_struct('i', x, 'j', int(pmod(xxhash64(print, 2), guests)), 'home', false))) END)""")
    met = routed.join(sizes.where("homes > 0"), "shard").select("shard", "print", F.col("home").alias("home"), "homes", "guests")
    return met.select("shard", "print", pairs).groupBy("shard", "i", "j").applyInPandas(link, "u long, v long")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, print): print is the fingerprint's 64 bits as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), prints("text").alias("print"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, **search) -> DataFrame:
    """(doc_id, text_hash, print, root, component_id) per row of docs.

    component_id is the smallest doc_id that links reach; root, a fingerprint, names the group too.
    """
    marked = settled(fingerprints(docs, shingle), "simhash-prints")
    prints = settled(marked.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = settled(components(linked_prints(prints.select("print"), max_bits, **search)), "simhash-groups")
    members = groups.join(prints, groups.node == prints.print).select("node", "root", "first_id")
    least = members.groupBy("root").agg(F.min("first_id").alias("least_id"))
    grouped = members.join(least, "root").select("node", "root", "least_id")
    classes = prints.join(grouped, prints.print == grouped.node, "left").select(
        F.col("print").alias("class_print"), F.coalesce("root", "print").alias("root"),
        F.coalesce("least_id", "first_id").alias("component_id"))
    classes = settled(classes, "simhash-classes")  # both sides of the join come from files, so a hot print can be split
    return marked.join(classes, marked.print == classes.class_print).drop("class_print")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, **search) -> DataFrame:
    """docs with one row of each group: the one with the smallest id (of equal ids, the smallest text hash)."""
    found = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits, **search)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best")
    kept = found.groupBy("root").agg(best).select(F.col("best.doc_id").alias("kept_id"), F.col("best.text_hash").alias("kept_hash"))
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    rows = packed.join(kept, packed.own_id.eqNullSafe(kept.kept_id) & (packed.own_hash == kept.kept_hash), "left_semi")
    return rows.dropDuplicates(["own_id", "own_hash"]).select("doc.*")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
