"""Quality of a text, learned from trusted positives and unlabelled web text.

Positive-unlabelled learning: only texts marked good and texts without a mark are used, no text
marked bad. The class prior, the share of good texts among the unlabelled, is estimated first: a
classifier of good against unlabelled is fitted on one half of the sample, and on the other half the
prior is the least ratio, over all thresholds, of unlabelled to good texts that score above
(a threshold above which hardly any bad text lies gives the share itself). Then a small network
minimises the non-negative unbiased risk (Kiryo et al., 2017)

    prior * mean_good loss(f) + max(0, mean_unlabelled loss(-f) - prior * mean_good loss(-f))

and where the second term falls below zero, steps go against it. The features describe the whole text
and are the same in any language: shares of characters, words and lines by their form and repetition.

Fitting uses a bounded sample of the training folds: at most `sample` good and `sample` unlabelled
texts, those with the smallest hash of their id. Every text is scored.

Defined results: null and empty texts are scored as a text without words; when there are no good or no
unlabelled texts every score is 0.5; null ids count as held out; rows are kept one by one; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import held_out, settled
from tripgauge.llm.vectors import drawn

FEATURES = ("log_words", "log_word_length", "upper_letters", "digits", "marks", "rare_marks", "other", "upper_words", "title_words", "bare_marks",
            "odd_ends", "bang_ends", "stops", "short_words", "long_words", "distinct", "repeated", "top_word", "distinct_pairs", "log_line_words",
            "repeated_lines", "ended_lines")
_ASCII = np.zeros((6, 256), np.float64)  # upper, lower, digit, ordinary mark, other ASCII mark, beyond ASCII
_ASCII[0, 65:91] = _ASCII[1, 97:123] = _ASCII[2, 48:58] = _ASCII[5, 128:] = 1
for _c in b".,;:?'\"()-":
    _ASCII[3, _c] = 1
_ASCII[4, 33:127] = 1
_ASCII[4] -= _ASCII[:4].sum(axis=0)
_ODD_END = re.compile(r"[^\w.,;:?!'\"()\-…»”’]$")


def features(text: str | None) -> list[float]:
    """The numbers of FEATURES for one text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    upper, lower, digits, marks, rare, other = _ASCII @ np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1.0, upper + lower + digits + marks + rare + other)  # control characters make words, but are none of these
    counts = Counter(words)
    # properties of a word are looked at once per distinct word
    shouted = titled = bare = odd = bang = stops = short = long = letters = 0
    for w, k in counts.items():
        last, length = w[-1], len(w)
        letters += k * length
        if not last.isalnum():
            stops += k * (last in ".?")
            bang += k * (last == "!")
            odd += k * bool(_ODD_END.search(last))
            bare += k * (length < 4 and not any(map(str.isalnum, w)))
        if length > 1 and w.isupper():
            shouted += k
        elif w[0].isupper():
            titled += k
        short += k * (length <= 3)
        long += k * (length > 20)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(n), np.log(letters / n), upper / max(1.0, upper + lower), digits / size, marks / size, rare / size, other / size,
            shouted / n, titled / n, bare / n, odd / n, bang / n, stops / n, short / n, long / n, len(counts) / n,
            sum(map(str.__eq__, words, words[1:])) / n, max(counts.values()) / n, pairs / max(1, n - 1), np.log1p(n / len(lines)),
            1 - len(set(lines)) / len(lines), sum(x.rstrip()[-1] in ".!?:;" for x in lines) / len(lines)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    def __init__(self, weights: list[np.ndarray], rate: float):
        self.weights, self.rate, self.done = weights, rate, 0
        self.first, self.second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def step(self, grads: list[np.ndarray]) -> None:
        self.done += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.done) / (1 - 0.9**self.done)
        for w, g, a, b in zip(self.weights, grads, self.first, self.second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= rate * a / (np.sqrt(b) + 1e-8)


def _network(width: int, hidden: int, draw) -> list[np.ndarray]:
    return [draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(1)]


def margin(weights: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    a, b, c, d = weights
    return np.tanh(x @ a + b) @ c + d


def _pull_back(weights: list[np.ndarray], x: np.ndarray, by: np.ndarray, decay: float) -> list[np.ndarray]:
    """Gradient of a loss whose derivative by the margin of each row is `by`."""
    a, b, c, _ = weights
    h = np.tanh(x @ a + b)
    dh = by[:, None] * c[None, :] * (1 - h * h)
    return [x.T @ dh + decay * a, dh.sum(axis=0), h.T @ by + decay * c, np.array([by.sum()])]


def class_prior(good: np.ndarray, other: np.ndarray, draw, hidden: int = 4, rounds: int = 200, halvings: int = 5) -> float:
    """Share of good rows among the other rows: the median over several halvings of the sample."""
    found = []
    for _ in range(halvings):
        g, o = draw.permutation(len(good)), draw.permutation(len(other))
        fit_g, fit_o = good[g[::2]], other[o[::2]]
        see_g, see_o = (good[g[1::2]], other[o[1::2]]) if min(len(good), len(other)) > 1 else (good, other)
        weights = _network(good.shape[1], hidden, draw)
        adam, x = Adam(weights, 0.02), np.vstack([fit_g, fit_o])
        y = np.concatenate([np.ones(len(fit_g)), np.zeros(len(fit_o))])
        each = np.where(y == 1, 0.5 / len(fit_g), 0.5 / len(fit_o))
        for _ in range(rounds):
            adam.step(_pull_back(weights, x, (_sigmoid(margin(weights, x)) - y) * each, 0.01))
        p, u = np.sort(margin(weights, see_g)), np.sort(margin(weights, see_o))
        at = np.unique(np.concatenate([p, u]))
        above_p, above_u = 1 - np.searchsorted(p, at) / len(p), 1 - np.searchsorted(u, at) / len(u)
        doubt = np.sqrt(np.log(80) / 2 / len(p)) + np.sqrt(np.log(80) / 2 / len(u))
        seen = above_p > 0
        best = ((above_u + doubt)[seen] / above_p[seen]).argmin()
        found.append((above_u[seen] / above_p[seen])[best])
    return float(np.clip(np.median(found), 0.05, 0.99))


def fit_pu(good: np.ndarray, other: np.ndarray, prior: float, draw, hidden: int = 16, epochs: int = 40, batch: int = 512,
           rate: float = 0.01, decay: float = 1e-4) -> list[np.ndarray]:
    """Weights that minimise the non-negative risk."""
    weights = _network(good.shape[1], hidden, draw)
    adam = Adam(weights, rate)
    steps = max(1, max(len(good), len(other)) // batch)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        g, o = np.array_split(draw.permutation(len(good)), steps), np.array_split(draw.permutation(len(other)), steps)
        for gi, oi in zip(g, o):
            if not len(gi) or not len(oi):
                continue
            p, u = good[gi], other[oi]
            fp, fu = margin(weights, p), margin(weights, u)
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            low = _pull_back(weights, np.vstack([u, p]), np.concatenate([_sigmoid(fu) / len(u), -prior * _sigmoid(fp) / len(p)]), 0)
            if negative < 0:
                adam.step([-x for x in low])
            else:
                up = _pull_back(weights, p, -prior * _sigmoid(-fp) / len(p), decay)
                adam.step([x + y for x, y in zip(low, up)])
    return weights


@dataclass(frozen=True)
class QualityModel:
    weights: list | None
    centre: np.ndarray | None
    scale: np.ndarray | None
    prior: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def score(self, texts) -> np.ndarray:
        if self.weights is None or not len(texts):
            return np.full(len(texts), 0.5)
        return _sigmoid(margin(self.weights, self.scaled(np.array([features(t) for t in texts]))))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8192, seed: int = 9) -> QualityModel:
    """Learn from doc_id and text of docs and from the rows of labels (doc_id, quality) that say 1."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    good = drawn(marked.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select("doc_id").distinct(), ["doc_id"], sample, seed)
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    other = drawn(ids.join(marked.select("doc_id"), "doc_id", "left_anti").distinct(), ["doc_id"], sample, seed)
    chosen = settled(good.withColumn("good", F.lit(True)).union(other.withColumn("good", F.lit(False))), "quality-sample")

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(features, na_action=None)

    # at most twice `sample` short rows, so every task may hold them; rows that share an id count once,
    # with the smallest of their measures, so no more than that comes back
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "good", measured("text").alias("x"))
    rows = rows.groupBy("doc_id", "good").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.good, r.x))  # the same model at every run
    p = np.array([r.x for r in rows if r.good])
    u = np.array([r.x for r in rows if not r.good])
    if not len(p) or not len(u):
        return QualityModel(None, None, None, 0.5)
    every = np.vstack([p, u])
    model = QualityModel(None, every.mean(axis=0), every.std(axis=0) + 1e-3, 0.5)
    draw = np.random.default_rng(seed)
    p, u = model.scaled(p), model.scaled(u)
    prior = class_prior(p, u, draw)
    return QualityModel(fit_pu(p, u, prior, draw), model.centre, model.scale, prior)


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """docs with the column quality_score, 0 to 1, of the column or field `text` added or replaced."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))

    return docs.withColumn("quality_score", scored(text))


def op7_quality(spark, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    from tripgauge.llm.common import table

    docs = table(spark, sf_dir, "documents")
    found = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
                        (F.col("quality_score") >= threshold).cast("int").alias("predicted"))
