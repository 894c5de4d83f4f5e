import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from compare import difference, oracle_connection
from conftest import SF_SMALL
from helpers import DOCS, docs, empty
from tokenizers import Regex, pre_tokenizers

from tripgauge.llm import oracle, resampling as rs

FINDER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, least=1, most=1, buckets=10_000):
    words = FINDER.findall((text or "").translate(LOW))
    runs = [" ".join(words[i:i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in runs]


def brute(rows, target, least=1, most=1, buckets=10_000, min_words=20, percent=10):
    own = [features(t, least, most, buckets) for _, t in rows]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in target for b in features(x, least, most, buckets)[1])
    sa, ta = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sa + buckets) / ((s[b] + 1) * (ta + buckets)))) for b in range(buckets)]
    out = []
    for (doc_id, _), (words, f) in zip(rows, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted([(*r[:4], rank.get(id(r))) for r in out], key=repr)


def told(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=repr)


def test_words_and_windows_of_odd_texts():
    rnd, split = random.Random(2), pre_tokenizers.Split(Regex(rs.WORD), "removed", invert=True)
    parts = ["a", "Z", "é", "É", "中", " ", "\n", "/", ":", "`", "{", "~", "0", "9", "\x7f", "\x80", "\u0000", "😀", "İ", "́"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 15)))
        for least, most in ((1, 1), (1, 2), (2, 3)):
            words, found = rs.text_features(text, split, rs.Buckets(500, room=7), least, most)
            want = features(text, least, most, 500)
            assert (words, sorted(found)) == (want[0], sorted(want[1])), text


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(rs, "PIECE", 10)
    split = pre_tokenizers.Split(Regex(rs.WORD), "removed", invert=True)
    text = "one, two threefourfivesixseven\n" * 7 + "é" * 40
    assert "".join(rs.pieces(text)) == text
    for least, most in ((1, 1), (1, 3), (2, 2)):
        words, found = rs.text_features(text, split, rs.Buckets(900), least, most)
        want = features(text, least, most, 900)
        assert (words, sorted(found)) == (want[0], sorted(want[1]))


@pytest.mark.parametrize("least, most", [(1, 1), (1, 2)])
def test_against_brute_force(spark, least, most):
    rnd = random.Random(least + most)
    vocabulary = [f"w{i}" for i in range(200)] + ["Ärger", "ÉTÉ", "x'y"]
    rows = [(i, " ".join(rnd.choice(vocabulary[:60] if i % 3 else vocabulary) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    same = "the very same words in every copy " * 5
    rows += [(None, same), (None, same), (3, same), (3, same), (500, None), (501, ""), (502, "w1 " * 30_000)]
    target = [" ".join(rnd.choice(vocabulary[:30]) for _ in range(50)) for _ in range(20)] + [None, ""]
    table = spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, rank string")
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    got = rs.resample(table.repartition(7), texts, least=least, most=most, buckets=997, keep=["text", "rank"])
    assert told(got) == brute(rows, target, least, most, 997)
    assert got.first().doc["rank"] == "x"
    few, words = set(vocabulary[:30]), lambda r: (r.doc.text or "").split()
    drawn = [sum(w in few for w in words(r)) / len(words(r)) for r in got.collect() if r["rank"]]
    others = [sum(w in few for w in words(r)) / len(words(r)) for r in got.collect() if not r["rank"] and r.n_words >= 20]
    assert sum(drawn) / len(drawn) > sum(others) / len(others)


def test_awkward_rows(spark):
    nothing = spark.createDataFrame([], "text string")
    assert rs.resample(empty(spark), nothing).count() == 0
    assert told(rs.resample(docs(spark), nothing, min_words=1, percent=50)) == brute([r[:2] for r in DOCS], [], min_words=1, percent=50)
    with pytest.raises(ValueError):
        rs.resample(docs(spark), nothing, least=2, most=1)


def test_query_equals_sql(spark):
    assert difference(rs.op13_resampling(spark, SF_SMALL), oracle_connection(SF_SMALL), oracle.RESAMPLING) is None
