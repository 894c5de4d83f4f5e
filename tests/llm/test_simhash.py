import random

import numpy as np
import pytest
import xxhash
from helpers import docs, empty, groups

from tripgauge.llm import simhash
from tripgauge.llm.components import components


def plain_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\r\x0b\x0c":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c d", "a b c d e a b c d e", "É é  x\ty z w", "x " * 300, " \n "])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks():
    text = " ".join(f"w{i % 97}" for i in range(2000))
    assert simhash.fingerprint(text, block=64) == plain_fingerprint(text)


def near_prints(count, seed):
    """Fingerprints in clusters: chains of small changes, so that groups reach further than one link."""
    rnd, out = random.Random(seed), []
    while len(out) < count:
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            out.append(x)
            for b in rnd.sample(range(64), rnd.choice([1, 3, 4, 5, 6])):
                x ^= 1 << b
    return np.unique(np.array(out[:count], dtype=np.uint64)).view(np.int64)


@pytest.mark.parametrize("bits,bands,block", [(4, 3, 10_000), (4, 3, 60), (4, 1, 200), (2, 3, 10_000), (7, 4, 90)])
def test_trees_find_every_group(spark, bits, bands, block):
    prints = near_prints(1500, bits)
    df = spark.createDataFrame([(int(p),) for p in prints], "print long")
    links = simhash.linked_prints(df, bits, bands=bands, shard_rows=100, sample_rows=400, block_rows=block)
    got = {r.node: r.root for r in components(links).collect()}
    u = prints.view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= bits)
    want = groups(prints.tolist(), [(int(prints[a]), int(prints[b])) for a, b in zip(i, j) if a < b])
    assert {n: got.get(n, n) for n in want} == want


def test_a_band_that_all_share_is_cut_into_blocks(spark):
    """Fingerprints that differ in their upper bits only: no tree can part the lowest band."""
    rnd = random.Random(4)
    prints = sorted({(rnd.getrandbits(16) << 40) | 12345 for _ in range(900)})
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    links = simhash.linked_prints(df, 4, shard_rows=50, sample_rows=100, block_rows=100)
    assert links.where("u = v").count() == 0
    got = {r.node: r.root for r in components(links).collect()}
    want = groups(prints, [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if (a ^ b).bit_count() <= 4])
    assert {n: got.get(n, n) for n in want} == want


def test_groups_of_documents(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base if i % 3 else base + f" tail{i}", "en", "s", 1, 1.0, "x") for i in range(30)]
    rows += [(100 + i, f"quite another text number {i} " * (i + 1), "en", "s", 1, 1.0, "x") for i in range(20)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert got == groups(list(prints), links)
    kept = simhash.drop_near_duplicates(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert kept.columns == docs(spark).columns


def test_awkward_rows(spark):
    table = docs(spark)
    found = simhash.near_duplicates(table).collect()
    assert len(found) == table.count()
    by = {(r.doc_id, r.text_hash): r for r in found}
    zero = [r for r in found if r.print == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in found if r.doc_id in (1, 5)} == {1}
    assert any(r.doc_id is None and r.component_id is None for r in found) and by
    kept = simhash.drop_near_duplicates(table).collect()
    assert len(kept) == len({r.root for r in found})
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_components_of_long_and_hot_graphs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(500, 501 + i) for i in range(80)] + [(700, 700), (None, 3), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = groups({n for a, b in links for n in (a, b) if n is not None}, [(a, b) for a, b in links if a is not None and b is not None])
    assert got == {n: r for n, r in want.items() if n != 700}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
