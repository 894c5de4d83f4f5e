import random
from collections import defaultdict

import pytest
from compare import difference, oracle_connection
from conftest import SF_SMALL
from helpers import DOCS, docs, empty

from tripgauge.llm import line_dedup as ld
from tripgauge.llm import oracle

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(SPACE).translate(str.maketrans(ld.UPPER, ld.LOWER))


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(doc_id)
    last = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def told(df):
    return sorted([(r.doc.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    lines = [f"Line {i} that ÄÖ {'x' * rnd.randint(0, 60)}" for i in range(60)]
    pad = ["", " ", "\t", "\r", "\x0b ", " "]
    rows = []
    for i in range(300):
        body = [rnd.choice(pad) + (x.upper() if (x := rnd.choice(lines[:8] if i % 3 == 0 else lines)) and rnd.random() < 0.2 else x) + rnd.choice(pad)
                for _ in range(rnd.randint(0, 12))]
        rows.append((i if i % 17 else None, "\n".join(body)))
    hot = "One line that a third of all the documents hold, word for word."
    rows += [(1000 + i, f"{hot}\nown {i}\n{hot}\n") for i in range(150)]
    rows += [(5, "a\n" * 3), (6, None), (None, None), (7, ""), (7, "\n")] + [(8, hot)] * 3
    only = "This line stands only in rows that have no id at all, six of them."
    return rows + [(None, only)] * 6


def test_against_brute_force(spark, rows):
    table = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, marks string, n_lines int")
    assert told(ld.drop_shared_lines(table)) == brute(rows)
    other = ld.drop_shared_lines(table, min_chars=10, min_docs=3, batches=11, fanout=2)
    assert told(other) == brute(rows, 10, 3)
    assert told(ld.drop_shared_lines(table, batches=1)) == brute(rows)
    assert other.first().doc.marks == "a"


def test_runs_are_levelled_and_disjoint(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    index = ld.LineIndex(spark, fanout=2)
    from pyspark.sql import functions as F

    for number in range(7):
        part = table.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(7)) == number)
        batch = index.batches(ld.line_keys(part, 10), F.lit(0))
        index.add(spark.table(batch).drop("batch"))
    assert [len(level) for level in index.levels] == [1, 1, 1]
    held = [(r.k1, r.k2) for run in index.runs for r in spark.table(run).collect()]
    assert len(held) == len(set(held)) == ld.line_keys(table, 10).select(*ld.KEY).distinct().count()
    joined = spark.table(batch).join(spark.table(index.runs[0]).hint("merge"), ld.KEY, "left_anti")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    index.close()
    assert index.name not in {d.name for d in spark.catalog.listDatabases()}


def test_awkward_rows(spark):
    assert ld.drop_shared_lines(empty(spark)).count() == 0
    assert told(ld.drop_shared_lines(docs(spark))) == brute([r[:2] for r in DOCS])
    long = "word " * 20 + "\n"
    texts = [(i, long * 30_000 if i == 0 else long) for i in range(6)]
    assert told(ld.drop_shared_lines(spark.createDataFrame(texts, "doc_id long, text string"))) == brute(texts)


def test_query_equals_sql(spark):
    assert difference(ld.op12_line_dedup(spark, SF_SMALL), oracle_connection(SF_SMALL), oracle.LINE_DEDUP) is None
