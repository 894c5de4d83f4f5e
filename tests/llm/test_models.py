"""The two trained operators: gradients, held-out accuracy, awkward rows."""

import zlib

import numpy as np
from helpers import LONG, docs, empty
from pyspark.sql import functions as F

from tripgauge.llm import gru, langid, quality
from tripgauge.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_gradient_against_differences():
    draw, model = np.random.default_rng(0), gru.start(3, 3, 0)
    windows, there, labels = draw.integers(0, 6, (5, 4)).astype(np.uint8), np.ones((5, 4), bool), np.array([0, 1, 2, 1])
    there[3:, 1] = False
    _, grad = gru.gradient(model, windows, there, labels)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, loss = model[name][at], []
        for step in (0.01, -0.01):
            model[name][at] = kept + step
            loss.append(gru.gradient(model, windows, there, labels)[0])
        model[name][at] = kept
        assert abs((loss[0] - loss[1]) / 0.02 - g[at]) < 1e-3


def test_fold_is_by_crc(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_language_on_the_held_out_fold(spark):
    found = langid.op9_langid(spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert found.count() == 1000 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.96
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_is_pooled_over_the_whole_text():
    model = langid.LanguageModel(["a", "b"], gru.start(4, 2, 1), 16)
    text = "some bytes of text, é and more. " * 300
    data = text.encode()
    padded = np.frombuffer(data.ljust(-(-len(data) // 16) * 16, b"\0"), np.uint8).reshape(-1, 16)
    p = gru.positions(model.weights, np.ascontiguousarray(padded.T))
    p = (p * (padded != 0).T[:, None, :]).sum(axis=(0, 2))
    got = langid.document_probabilities(model, ["x", text, "", "y"], batch=7)
    assert np.allclose(got[1], p / p.sum()) and np.allclose(got[[0, 1, 3]].sum(axis=1), 1)


def test_language_awkward_rows(spark):
    table = docs(spark)
    model = langid.train(table, epochs=1)
    got = langid.predict(table, model).collect()
    assert len(got) == table.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und" and r.lang_score == 0) if not letters else r.lang_pred in model.languages
    nothing = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.predict(table, nothing).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_class_prior_and_risk_on_known_mixtures():
    draw = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.85):
        good = draw.normal(1.5, 1, (2000, 4))
        n = int(2000 * share)
        other = np.vstack([draw.normal(1.5, 1, (n, 4)), draw.normal(-1.5, 1, (2000 - n, 4))])
        prior = quality.class_prior(good, other, draw)
        assert abs(prior - share) < 0.1
        weights = quality.fit_pu(good, other, prior, draw, epochs=20)
        test_good, test_bad = draw.normal(1.5, 1, (500, 4)), draw.normal(-1.5, 1, (500, 4))
        assert (quality.margin(weights, test_good) > 0).mean() > 0.93 and (quality.margin(weights, test_bad) < 0).mean() > 0.93


def test_quality_on_the_held_out_fold(spark):
    rows = quality.op7_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.97 and sum(r.predicted for r in bad) / len(bad) < 0.25


def test_quality_awkward_rows(spark):
    table = docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, None), (5, 0, 0), (None, 1, 0), (9, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(table, quality.train(table, labels)).collect()
    assert len(got) == table.count() and all(0 <= r.quality_score <= 1 for r in got)
    none = quality.train(table, labels.where("false"))
    assert {r.quality_score for r in quality.score(table, none).collect()} == {0.5}
    assert quality.score(empty(spark), none).count() == 0
    assert len(quality.features(LONG)) == len(quality.features(None)) == len(quality.FEATURES)
    assert np.isfinite(quality.features("\u0000 \x1f ¿")).all()


def test_texts_of_control_characters(spark):
    odd = ["\x00\x01", "\x7f", "\x02 \x03\n\x04"]
    assert all(np.isfinite(quality.features(t)).all() for t in odd)
    rows = [(i, "A plain text about nothing much, with a few words in it, and number %d." % i if i % 3 else odd[i // 3 % 3]) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(60) if i % 3 == 1], "doc_id long, quality int")
    model = quality.train(table, labels)  # the odd texts are among the unlabelled ones
    assert np.isfinite(model.centre).all() and 0 <= model.prior <= 1
    assert all(0 <= r.quality_score <= 1 for r in quality.score(table, model).collect())


def test_only_letters_make_a_language(spark):
    assert not any(map(langid.has_letter, ["", "²³ ½", "①", "12 ___ ́", "٣"])) and all(map(langid.has_letter, ["1a", "中", "ª", "é"]))


def test_repeated_ids_do_not_widen_the_samples(spark):
    hot = [(4, f"text number {i} in plain words, of one id", "en", "a", 1, 1.0, "x") for i in range(1500)]
    hot += [(7, "the very same row a thousand times", "en", "a", 1, 1.0, "x")] * 1000
    rest = [(i, f"some other text {i}", "en" if i % 2 else "de", "a", 1, 1.0, "x") for i in range(100, 400)]
    table, seen = docs(spark, hot + rest), {}

    def fit(data, lengths, labels, classes, **_):
        seen["rows"] = len(data)
        return None

    original = langid.gru.fit
    langid.gru.fit = fit
    try:
        langid.train(table, per_language=50, windows=1)
    finally:
        langid.gru.fit = original
    assert 50 <= seen["rows"] <= 100
    marks = spark.createDataFrame([(i, 1) for i in range(100, 200)] + [(4, 1)], "doc_id long, quality int")
    kept = quality.class_prior
    quality.class_prior = lambda p, u, draw: seen.update(p=len(p), u=len(u)) or kept(p, u, draw)
    try:
        quality.train(table, marks, sample=30)
    finally:
        quality.class_prior = kept
    assert seen["p"] <= 30 and seen["u"] <= 30
