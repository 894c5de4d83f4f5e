"""Mixing sources to target weights.

Every source's documents lie in one fixed random order, the order of a keyed hash, cut into blocks
of about `block_words` words. A source whose target is r times its size gives each of its blocks
floor(r) times; for the rest the order is gone through once and every document taken that still
fits, then the one document that fills the last gap best. A document larger than what is left is
passed over and ends nothing, so a source misses its target by at most half of the smallest document
that is not taken once more.

Going through the order takes rounds. A round takes the documents after the last stop that are no
larger than the gap, up to the first that no longer fits; that one is the next stop. Sums by hash
range find the range of the stop, sums inside this range the stop. A round's result is a stretch of
the hash space and a largest size, so a document's own hash and size tell whether it is taken.

The block quotas are then dealt to output shards by a splitting tree: a node that stands for
several shards divides its vector of quotas between its halves by a multivariate hypergeometric
draw, so every shard gets a random mix with exact totals and no two shards share a block. Which
blocks a shard gets follows from a keyed permutation of the block numbers; inside a shard the rows
are ordered by another hash.

Decisions are per source (a row for each of its rounds on the driver: sources are the components of
the mix) and apply to a document through its hash and size, so texts are never shuffled to decide.
Rows that share id and text are numbered, and each has a hash of its own number: n copies are parted
like n documents. The numbers run over the tasks that met the copies, so no task numbers them all.

Defined results: a null text has size 0; sizes of 0 are taken 0 words; a null source is a source of
its own, last in order; the hash is of doc_id, text and copy, so rows that share an id are parted, and so
are rows that share both, which of them being left open; a null doc_id is an id; an empty table gives an empty mix. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.llm.common import settled, word_count

#: What assign adds and what mix adds to it.
ASSIGNED, MIXED = ("mix_source_size", "mix_target", "mix_copies", "mix_shards"), ("mix_copy", "mix_shard", "mix_key")
HASH_SPAN = float(2**63)
HASH_LAST = 2**63 - 1


def target_words(sizes: dict[str | None, int], weights=(3, 1, 2), share=Fraction(3, 2), most=2) -> dict:
    """Target per source: `share` of all words divided by weight, none above `most` times its source.

    Weights repeat over the sources in code point order, null last. What a source cannot take goes
    to the others by weight, until none is above.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, target, still = Fraction(share) * sum(sizes.values()), {}, list(order)
    while still:
        unit = left / sum(weight[s] for s in still)
        full = [s for s in still if unit * weight[s] > most * sizes[s]]
        if not full:
            target |= {s: unit * weight[s] for s in still}
            break
        target |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        still = [s for s in still if s not in target]
    return target


def splitting_tree(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Quotas dealt to shards: one row per shard, one column per source, column sums exact.

    A node of the tree stands for a run of shards. Each half gets its share of the node's blocks,
    and which sources they come from is a multivariate hypergeometric draw, written as one
    hypergeometric draw per source given what the sources before it took.
    """
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def deal(first: int, last: int, have: np.ndarray) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        total = int(have.sum())
        want, rest = total * (middle - first) // (last - first), total
        draw = np.random.default_rng([seed, first, last])
        left = np.zeros_like(have)
        for i, n in enumerate(have.tolist()):
            rest -= n
            if want and n:
                left[i] = draw.hypergeometric(n, rest, want) if rest else want
                want -= int(left[i])
        deal(first, middle, left)
        deal(middle, last, have - left)

    deal(0, shards, np.array(quotas, dtype=np.int64))
    return out


@dataclass(frozen=True)
class SourcePlan:
    """What the mix does with one source."""

    source: str | None
    size: int
    target: float
    passes: int  # how often every document is taken
    buckets: int  # hash ranges that the search for a stop looks at
    cut_hash: int = -1  # documents up to this hash are taken once more,
    stretches: tuple = ()  # those with first < hash <= last and a size of at most limit,
    extra_hash: int | None = None  # and the document with this hash
    blocks: int = 1
    rest_blocks: int = 0  # blocks that the documents up to cut_hash touch
    late_blocks: int = 0  # blocks for the documents of the stretches

    @property
    def quota(self) -> int:
        return self.passes * self.blocks + self.rest_blocks + self.late_blocks + (self.extra_hash is not None)


@dataclass(frozen=True)
class MixPlan:
    sources: list[SourcePlan]
    shards: int
    seed: int
    dealt: np.ndarray = field(repr=False)  # shards x sources
    repeated: DataFrame | None = field(default=None, repr=False)  # sources and hashes that several rows share

    def frame(self, spark) -> DataFrame:
        rows = [(p.source, i, p.size, float(p.target), p.passes, p.cut_hash, list(p.stretches), p.extra_hash, p.blocks,
                 p.rest_blocks, p.late_blocks) for i, p in enumerate(self.sources)]
        return spark.createDataFrame(rows, "_source string, _index int, _source_size long, _target double, _passes int, _cut_hash long,"
                                           " _stretches array<struct<first: long, last: long, limit: double>>, _extra long, _blocks long,"
                                           " _rest_blocks long, _late_blocks long")


def _hash(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 1)


def _copy_hash(hashed: Column, copy: Column) -> Column:
    """The hash of one of several rows that share `hashed`, by its number from 1."""
    return F.shiftrightunsigned(F.xxhash64(hashed, copy), 1)


def _one_by_one(units: DataFrame, chunk: int = 100_000) -> DataFrame:
    """A row per document: units of n rows become n units. Long runs are dealt out before they unfold."""
    single, many = units.where("n = 1").select("source", "hash", "size"), units.where("n > 1")
    runs = many.select("*", F.explode(F.expr(f"sequence(0L, n - 1, {chunk}L)")).alias("first")).repartition("hash", "first")
    each = runs.select("source", "hash", (F.col("size") / F.col("n")).cast("long").alias("size"),
                       F.explode(F.expr(f"sequence(first + 1, least(first + {chunk}, n))")).alias("copy"))
    return single.unionByName(each.select("source", _copy_hash(F.col("hash"), F.col("copy")).alias("hash"), "size"))


def _numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """rows (_doc, _own, _hash) with a hash for each copy of rows that share one.

    Shared rows are written with the number of the task that met them; a copy's number is its place
    there after all copies of the tasks before, so that n rows get the numbers 1 to n exactly.
    """
    shared = F.col("_own").eqNullSafe(F.col("_unit_source")) & (F.col("_hash") == F.col("_unit_hash"))
    alone = rows.join(repeated, shared, "left_anti")
    met = settled(rows.join(repeated, shared, "left_semi").withColumn("_met", F.spark_partition_id()), "mix-copies")
    unit = ["_own", "_hash"]
    counts = met.groupBy(*unit, "_met").agg(F.count(F.lit(1)).alias("_there"))
    upto = Window.partitionBy(*unit).orderBy("_met").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*(F.col(c).alias(f"{c}_") for c in (*unit, "_met")), F.coalesce(F.sum("_there").over(upto), F.lit(0)).alias("_before"))
    placed = met.withColumn("_place", F.row_number().over(Window.partitionBy(*unit, "_met").orderBy(F.lit(1))))
    same = F.col("_own").eqNullSafe(F.col("_own_")) & (F.col("_hash") == F.col("_hash_")) & (F.col("_met") == F.col("_met_"))
    copy = (F.col("_before") + F.col("_place")).cast("long")
    return alone.unionByName(placed.join(before, same).select("_doc", "_own", _copy_hash(F.col("_hash"), copy).alias("_hash")))


def _part(hashed: Column, parts: Column) -> Column:
    """The equal range of the hash space, of `parts` many, that holds the hash."""
    return F.least(F.floor(hashed.cast("double") / HASH_SPAN * parts), parts - 1).cast("long")


def _in_stretch(hashed: Column, size: Column) -> Column:
    return F.exists("_stretches", lambda s: (hashed > s["first"]) & (hashed <= s["last"]) & (size <= s["limit"]))


def _round(units: DataFrame, state: dict) -> dict:
    """One round for the sources of state (source -> buckets, last stop, gap, largest size).

    Gives source -> (words taken, stop), the stop being the hash of the first unit that no longer
    fits, None when all fit; sources without a unit that fits are left out. With sqrt(n) ranges
    neither step ever holds more than about sqrt(n) rows of a source.
    """
    spark = units.sparkSession
    wanted = spark.createDataFrame([(s, *values) for s, values in state.items()], "s string, buckets long, after long, gap double, limit double")
    ranged = units.join(F.broadcast(wanted), units.source.eqNullSafe(wanted.s)).where("size > 0 AND hash > after AND size <= limit")
    ranged = ranged.withColumn("bucket", _part(F.col("hash"), F.col("buckets")))
    sums = ranged.groupBy("source", "bucket", "gap").agg(F.sum("size").alias("size")).withColumn(
        "upto", F.sum("size").over(Window.partitionBy("source").orderBy("bucket")))
    ends = F.min(F.when(F.expr("upto > gap"), F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"))))
    found = {r.source: r for r in sums.groupBy("source").agg(F.max("upto").alias("total"), ends.alias("end")).collect()}
    out = {s: (r.total, None) for s, r in found.items() if r.end is None}
    stopped = [(s, r.end.bucket, r.end.before) for s, r in found.items() if r.end is not None]
    if stopped:
        ends = spark.createDataFrame(stopped, "s2 string, end_bucket long, before long")
        near = ranged.join(F.broadcast(ends), ranged.source.eqNullSafe(ends.s2) & (ranged.bucket == ends.end_bucket))
        upto = near.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("hash")))
        for r in upto.groupBy("source", "before").agg(F.max(F.when(F.expr("upto <= gap"), F.col("upto"))).alias("taken"),
                                                      F.min(F.when(F.expr("upto > gap"), F.col("hash"))).alias("stop")).collect():
            out[r.source] = (r.before if r.taken is None else r.taken, r.stop)
    return out


def plan_mix(docs: DataFrame, seed: int = 17, block_words: int = 16_384, shard_words: int = 2**28, min_shards: int = 8,
             weights=(3, 1, 2), share=Fraction(3, 2), most: int = 2) -> MixPlan:
    """Sizes, targets, cuts and shards. Needs doc_id, text and source; reads the text once."""
    spark = docs.sparkSession
    sized = docs.select(F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                        _hash(seed).alias("hash"))
    grouped = settled(sized.groupBy("source", "hash").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "mix-sizes")
    repeated, units = None, grouped
    if not grouped.where("n > 1").isEmpty():
        repeated = grouped.where("n > 1").select(F.col("source").alias("_unit_source"), F.col("hash").alias("_unit_hash"))
        units = settled(_one_by_one(grouped), "mix-units")
    totals = units.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {r.source: r["size"] for r in totals}
    targets = target_words(sizes, weights, share, most)
    counted = {r.source: r.n for r in totals}
    plans: dict[str | None, SourcePlan] = {}
    state: dict[str | None, tuple] = {}
    for s, target in targets.items():
        passes = int(target // sizes[s]) if sizes[s] else 0
        rest = float(target - passes * sizes[s])
        plans[s] = SourcePlan(s, sizes[s], float(target), passes, max(1, int(np.ceil(np.sqrt(counted[s])))),
                              blocks=max(1, -(-sizes[s] // block_words)))
        if rest > 0:
            state[s] = (plans[s].buckets, -1, rest, float("inf"))  # the first round stops at any document

    gaps: dict[str | None, float] = {}
    late: dict[str | None, int] = {}
    while state:
        found = _round(units, state)
        for s, (buckets, after, gap, limit) in list(state.items()):
            gaps[s] = gap
            if s not in found:
                del state[s]
                continue
            taken, stop = found[s]
            gaps[s], last = gap - taken, HASH_LAST if stop is None else stop - 1
            if limit == float("inf"):
                plans[s] = replace(plans[s], cut_hash=last)
            else:
                plans[s] = replace(plans[s], stretches=(*plans[s].stretches, (after, last, limit)))
                late[s] = late.get(s, 0) + taken
            if stop is None or gaps[s] < 1:
                del state[s]
            else:
                state[s] = (buckets, stop, gaps[s], gaps[s])

    fillers = {}
    if gaps:
        left = spark.createDataFrame([(s, gap, plans[s].cut_hash, list(plans[s].stretches)) for s, gap in gaps.items()],
                                     "s string, gap double, cut_hash long, _stretches array<struct<first: long, last: long, limit: double>>")
        untaken = units.join(F.broadcast(left), units.source.eqNullSafe(left.s)).where(
            "size > 0 AND hash > cut_hash AND abs(size - gap) < gap").where(~_in_stretch(F.col("hash"), F.col("size")))
        fillers = {r.source: r.best.hash for r in untaken.groupBy("source").agg(
            F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "hash")).alias("best")).collect()}
    for s in gaps:
        p = plans[s]
        touched = min(p.blocks, int(p.cut_hash / HASH_SPAN * p.blocks) + 1) if p.cut_hash >= 0 else 0
        plans[s] = replace(p, extra_hash=fillers.get(s), rest_blocks=touched, late_blocks=-(-late.get(s, 0) // block_words))
    chosen = list(plans.values())
    shards = max(min_shards, -(-int(sum(targets.values())) // shard_words))
    return MixPlan(chosen, shards, seed, splitting_tree([p.quota for p in chosen], shards, seed), repeated)


def _shard_lookup(plan: MixPlan):
    """A function of (source index, block, whole passes, block when taken once more or -1, is the filler) giving shards."""
    quotas = np.array([p.quota for p in plan.sources], dtype=np.int64)
    blocks = np.array([p.blocks for p in plan.sources], dtype=np.int64)
    rest = np.array([p.rest_blocks + p.late_blocks for p in plan.sources], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(quotas)[:-1]]).astype(np.int64)
    ends = (start[None, :] + np.cumsum(plan.dealt, axis=0)).T.reshape(-1)  # per source, end of each shard's run
    shards, draw = plan.shards, np.random.default_rng([plan.seed, 1])
    # x -> (a x + b) mod n permutes 0..n-1 when a and n have no common factor
    keys = {}
    for i, p in enumerate(plan.sources):
        for step in range(p.passes + 1):
            n = int(rest[i]) if step == p.passes else int(blocks[i])
            a = int(draw.integers(1, max(2, n)))
            while n > 1 and np.gcd(a, n) != 1:
                a += 1
            keys[i, step] = (a, int(draw.integers(0, max(1, n))), max(1, n))

    @F.pandas_udf("array<int>")
    def shards_of(index: pd.Series, block: pd.Series, passes: pd.Series, more: pd.Series, filler: pd.Series) -> pd.Series:
        out = []
        for i, b, whole, again, last in zip(index, block, passes, more, filler):
            at = []
            for step, of in enumerate([b] * whole + [again] * (again >= 0)):
                a, shift, n = keys[i, step]
                at.append(step * int(blocks[i]) + (a * of + shift) % n)
            if last:
                at.append(int(quotas[i]) - 1)
            lo, hi = i * shards, (i + 1) * shards
            out.append(np.searchsorted(ends[lo:hi], start[i] + np.array(at, dtype=np.int64), side="right").astype(np.int32))
        return pd.Series(out)

    return shards_of


def _assigned(docs: DataFrame, plan: MixPlan, hashed: Column, size) -> DataFrame:
    """assign for rows whose hash is given and whose size is a function of the row's struct."""
    parts = plan.frame(docs.sparkSession)  # one row per source
    rows = docs.select(F.struct("*").alias("_doc"), F.col("source").cast("string").alias("_own"), hashed.alias("_hash"))
    if plan.repeated is not None:
        rows = _numbered(rows, plan.repeated)
    df = rows.join(parts, F.col("_own").eqNullSafe(F.col("_source")))
    size = size(F.col("_doc"))
    early = F.col("_hash") <= F.col("_cut_hash")
    # the size is looked at only behind the first stop
    late = F.when(early | (F.size("_stretches") == 0), F.lit(False)).otherwise(_in_stretch(F.col("_hash"), size))
    df = df.withColumn("_late", late)
    again = F.when(early, F.least(_part(F.col("_hash"), F.col("_blocks")), F.col("_rest_blocks") - 1)).when(
        F.col("_late"), F.col("_rest_blocks") + F.coalesce(F.try_mod("_hash", "_late_blocks"), F.lit(0))).otherwise(F.lit(-1))
    filler = F.coalesce(F.col("_hash") == F.col("_extra"), F.lit(False)) & ~early & ~F.col("_late")
    df = df.withColumns({"_again": again, "_filler": filler, "_block": _part(F.col("_hash"), F.col("_blocks"))})
    shards = _shard_lookup(plan)("_index", "_block", "_passes", "_again", "_filler")
    added = {"mix_source_size": F.col("_source_size"), "mix_target": F.col("_target"),
             "mix_copies": F.col("_passes") + (F.col("_again") >= 0).cast("int") + F.col("_filler").cast("int"), "mix_shards": shards}
    kept = [F.col("_doc")[c].alias(c) for c in docs.columns if c not in ASSIGNED]
    return df.select(*kept, *(value.alias(name) for name, value in added.items()))


def assign(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """docs with, per row, how often the mix takes it and into which shards.

    Adds mix_source_size, mix_target, mix_copies and mix_shards (one shard per copy); columns that
    have these names are replaced.
    """
    return _assigned(docs, plan, _hash(plan.seed), lambda doc: word_count(doc["text"]))


def packed_mix(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The mix with every row whole in the struct `doc`, beside mix_copy, mix_shard and mix_key.

    A text is carried once: the place of a copy follows from the row's hash.
    """
    rows = docs.select(F.struct("*").alias("doc"), "source", _hash(plan.seed).alias("hash"))
    taken = _assigned(rows, plan, F.col("hash"), lambda row: word_count(row["doc"]["text"]))
    copies = taken.select("doc", "hash", F.posexplode("mix_shards").alias("mix_copy", "mix_shard"))
    return copies.select("doc", "mix_copy", "mix_shard", F.xxhash64("hash", "mix_copy", F.lit(plan.seed + 1)).alias("mix_key"))


def mix(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The mix itself: a row per copy, with its shard and its place key inside the shard.

    Adds mix_copy, mix_shard and mix_key; columns that have these names or those of assign are replaced.
    """
    own = [c for c in docs.columns if c not in (*ASSIGNED, *MIXED)]
    return packed_mix(docs, plan).select(*(F.col("doc")[c].alias(c) for c in own), *MIXED)


def write_mix(docs: DataFrame, plan: MixPlan, path: str) -> None:
    """The mix as Parquet, a folder per shard, its rows in their shuffled order."""
    rows = mix(docs, plan).repartition(plan.shards, "mix_shard").sortWithinPartitions("mix_shard", "mix_key")
    rows.write.partitionBy("mix_shard").parquet(path)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    docs = table(spark, sf_dir, "documents")
    plan = plan_mix(docs)
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash(plan.seed).alias("hash"))
    return _assigned(narrow, plan, F.col("hash"), lambda doc: doc["size"]).select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("size") * F.col("mix_copies")).alias("taken"), F.col("mix_copies").alias("copies"),
        F.col("mix_shards").alias("shards"))
