import hashlib
import random

import numpy as np
import pytest
from compare import difference, oracle_connection
from conftest import SF_SMALL
from helpers import docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tripgauge.llm import fim, oracle


def brute(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:z], text[z:]
    if not text or any(x in text for x in fim.MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, z - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, z - a, f"<P>{p}<S>{s}<M>{m}"


def told(rows):
    return [(r.doc.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 4 * fim.STRETCH), max_size=300), st.integers(0, 3))
def test_select_finds_every_member(members, runs):
    for r in range(runs):  # long runs and dense, broken stretches
        members |= set(range(r * fim.STRETCH + 100 * r, r * fim.STRETCH + 20_000 * (r + 1), 1 + r))
    want = np.array(sorted(members), dtype=np.int64)
    numbers, first = np.unique(want // fim.STRETCH, return_index=True)
    got = fim.BoundarySet(zip(numbers.tolist(), np.split(want % fim.STRETCH, first[1:])))
    assert len(got) == len(want)
    for k in {0, 1, len(want) // 3, len(want) // 2, len(want) - 2, len(want) - 1}:
        if 0 <= k < len(want):
            assert got.select(k) == want[k]
    with pytest.raises(IndexError):
        got.select(len(want))


def test_containers_are_the_smallest():
    rnd = np.random.default_rng(1)
    assert isinstance(fim.container(np.arange(60_000)), fim.RunContainer)
    assert isinstance(fim.container(np.sort(rnd.choice(65_536, 900, replace=False))), fim.ArrayContainer)
    dense = np.sort(rnd.choice(65_536, 30_000, replace=False))
    assert isinstance(fim.container(dense), fim.BitmapContainer)
    assert [fim.container(dense).select(k) for k in range(0, 30_000, 97)] == dense[::97].tolist()


def test_code_points_of_mixed_texts():
    rnd = random.Random(3)
    for size in (0, 1, 65_535, 65_536, 65_537, 200_000):
        for letters in ("a", "aé", "é中😀a", "中"):
            text = "".join(rnd.choice(letters) for _ in range(size))
            data = np.frombuffer(text.encode(), np.uint8)
            marks = fim.code_point_boundaries(data)
            assert len(marks) == len(text) + 1
            for k in (0, size // 3, size // 2, size):
                assert marks.select(k) == len(text[:k].encode())


def test_units_of_a_pattern():
    data = np.frombuffer("one two  three-four ".encode(), np.uint8)
    marks = fim.match_boundaries(data, r"\S+\s*")
    assert [marks.select(k) for k in range(len(marks))] == [0, 4, 9, 20]
    marks = fim.match_boundaries(data, r"\w+")
    assert [marks.select(k) for k in range(len(marks))] == [0, 3, 7, 14, 20]
    assert len(fim.match_boundaries(np.zeros(0, np.uint8), r"\w+")) == 1
    assert [fim.match_boundaries(np.frombuffer(b"--", np.uint8), r"\w+").select(k) for k in (0, 1)] == [0, 2]


def test_awkward_rows(spark):
    rnd = random.Random(5)
    parts = ["<", "<P", "S>", "M>", "a", "é", "😀", "́", "\u0000", "\n", ">", "中"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(600)]
    rows += [(None, "no id"), (None, None), (7, None), (7, "again"), (7, "again"), (1000, "holds <M> itself"), (1001, "é中" * 70_000)]
    table = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, form string, n int, output string")
    got = fim.restored(fim.fill_in_middle(table)).collect()
    assert sorted(told(got), key=repr) == sorted((brute(*r) for r in rows), key=repr)
    assert all(r.restored == (r.doc.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert all((r.doc.form, r.doc.n, r.doc.output) == ("x", 1, "y") for r in got)
    assert fim.fill_in_middle(empty(spark)).count() == 0
    assert sorted(told(fim.fill_in_middle(docs(spark)).collect()), key=repr) == sorted((brute(r[0], r[1]) for r in docs(spark).collect()), key=repr)


def test_word_units_are_not_parted(spark):
    table = spark.createDataFrame([(i, "alpha beta gamma " * (i % 5 + 1)) for i in range(60)], "doc_id long, text string")
    for r in fim.restored(fim.fill_in_middle(table, rate=100, unit=r"\S+\s*")).collect():
        assert r.restored == r.doc.text and r.n == 3 * (r.doc.doc_id % 5 + 1)
        assert r.prefix_chars in np.cumsum([0] + [6, 5, 6] * 5)


def test_query_equals_sql(spark):
    assert difference(fim.op11_fim(spark, SF_SMALL), oracle_connection(SF_SMALL), oracle.FIM) is None
