"""Toxicity classifier with a counterfactual penalty (operator 9).

A logistic model over words and word beginnings. Training sentences that name a group of people
get a twin with the group swapped; the loss adds the squared score change between the two, so
the weights of group names shrink and neutral mentions are not scored as toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of groups; a name is swapped for the next one of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "transgender", "bisexual"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
)

_WORD = re.compile(r"[^\W_]+")
_HEADS = (4, 5, 6)


class Settings(NamedTuple):
    """Training parameters; the sample and feature bounds bound memory at any corpus size."""

    max_toxic: int = 3000
    max_clean: int = 6000
    max_features: int = 2000
    min_documents: int = 4
    l2: float = 1.0
    counterfactual: float = 5.0
    steps: int = 250


def word_counts(text: str) -> Counter:
    """Lower-case words with their counts; a null text has none."""
    return Counter(_WORD.findall((text or "").lower()))


def feature_counts(words: Counter) -> Counter:
    """Counts of words and of word beginnings (marked by a trailing ``*``)."""
    out = Counter(words)
    for w, c in words.items():
        for n in _HEADS:
            if len(w) > n:
                out[w[:n] + "*"] += c
    return out


def swapped(words: Counter, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Counter | None:
    """The words with every group name replaced by the next of its row; None if there is none."""
    to = {t: row[(i + 1) % len(row)] for row in terms for i, t in enumerate(row)}
    if not any(w in to for w in words):
        return None
    out: Counter = Counter()
    for w, c in words.items():
        out[to.get(w, w)] += c
    return out


class _Sparse(NamedTuple):
    rows: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    n: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.vals * w[self.cols], minlength=self.n)

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.cols, self.vals * r[self.rows], minlength=size)


def _sparse(counted: Iterable[Counter], index: dict[str, int]) -> _Sparse:
    rows, cols, vals = [], [], []
    n = 0
    for i, counts in enumerate(counted):
        n = i + 1
        for f, c in counts.items():
            j = index.get(f)
            if j is not None:
                rows.append(i)
                cols.append(j)
                vals.append(c)
    return _Sparse(np.array(rows, int), np.array(cols, int), np.log1p(np.array(vals, float)), n)


def _select(words: Sequence[Counter], y: np.ndarray, s: Settings) -> list[str]:
    """Features whose share of documents differs most between the classes, by a z score."""
    pos, neg = Counter(), Counter()
    for counts, label in zip(words, y):
        (pos if label else neg).update(feature_counts(counts).keys())
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    scored = []
    for f in set(pos) | set(neg):
        a, b = pos[f], neg[f]
        if a + b < s.min_documents:
            continue
        p = (a + b) / (n1 + n0)
        z = abs(a / n1 - b / n0) / np.sqrt(max(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
        scored.append((-z, f))
    return [f for _, f in sorted(scored)[: s.max_features]]


def train(
    texts: Sequence[str],
    labels: Sequence[int],
    weights: Sequence[float] | None = None,
    settings: Settings = Settings(),
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> dict[str, float]:
    """Weights by feature; the intercept has the empty name.

    Minimises weighted log loss + l2/2 |w|^2 + counterfactual/2 * sum (score(x) - score(twin))^2
    over the scores before the logistic function, by accelerated gradient steps. With a single
    class, or no rows, the model is the intercept of the smoothed base rate.
    """
    y = np.asarray(labels, float)
    weight = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    base = (weight @ y + 0.5) / (weight.sum() + 1.0) if len(y) else 0.5
    bias = float(np.log(base / (1 - base)))
    if len(y) == 0 or y.min() == y.max():
        return {"": bias}
    words = [word_counts(t) for t in texts]
    names = _select(words, y, settings)
    index = {f: i for i, f in enumerate(names)}
    x = _sparse((feature_counts(c) for c in words), index)
    twins = [(i, t) for i, t in enumerate(swapped(c, terms) for c in words) if t]
    here = _sparse((feature_counts(words[i]) for i, _ in twins), index)
    there = _sparse((feature_counts(t) for _, t in twins), index)
    pair = weight[[i for i, _ in twins]] if twins else np.zeros(0)
    size = len(names)
    # The step is the inverse of a bound on the curvature, feature by feature.
    per_doc = np.bincount(x.rows, x.vals, minlength=x.n)
    curve = 0.25 * x._replace(vals=x.vals).back(weight * (per_doc + 1), size) + settings.l2
    for side in (here, there):
        if side.n:
            reach = np.bincount(here.rows, here.vals, minlength=here.n) + np.bincount(there.rows, there.vals, minlength=there.n)
            curve += settings.counterfactual * side.back(pair * reach, size)
    curve0 = 0.25 * (weight * (per_doc + 1)).sum()
    w, b = np.zeros(size), bias
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(settings.steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(vw) + vb, -35, 35)))
        r = weight * (p - y)
        grad = x.back(r, size) + settings.l2 * vw
        if twins:
            change = pair * (here.dot(vw) - there.dot(vw))
            grad += settings.counterfactual * (here.back(change, size) - there.back(change, size))
        nw, nb = vw - grad / curve, vb - r.sum() / curve0
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return {"": float(b)} | {f: float(v) for f, v in zip(names, w) if abs(v) > 1e-6}


def penalty_report(
    texts: Sequence[str],
    labels: Sequence[int],
    settings: Settings = Settings(),
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> dict[str, float]:
    """What the penalty does on labelled texts, trained with and without it.

    ``twins``: texts that name a group. ``gap`` and ``gap_without``: mean difference between the scores of
    a text and its twin. ``false`` and ``false_without``: texts of label 0 that name a group and
    score 0.5 or more. Without twins both models are the same.
    """
    named = [(t, y, twin) for t, y in zip(texts, labels) if (twin := swapped(word_counts(t), terms)) is not None]
    out: dict[str, float] = {"twins": len(named)}
    for suffix, weight in (("", settings.counterfactual), ("_without", 0.0)):
        model = train(texts, labels, settings=settings._replace(counterfactual=weight), terms=terms)
        scores = [(score_text(model, t), score_text(model, " ".join(twin.elements())), y) for t, y, twin in named]
        out[f"gap{suffix}"] = sum(abs(a - b) for a, b, _ in scores) / max(len(scores), 1)
        out[f"false{suffix}"] = sum(a >= 0.5 for a, _, y in scores if not y)
    return out


def score_text(model: dict[str, float], text: str | None) -> float:
    """Between 0 and 1; an empty or null text has the score of the intercept."""
    get = model.get
    hits: dict[str, int] = {}
    for w, c in word_counts(text).items():
        if w in model:
            hits[w] = hits.get(w, 0) + c
        for n in _HEADS:
            if len(w) > n and (h := w[:n] + "*") in model:
                hits[h] = hits.get(h, 0) + c
    z = get("", 0.0) + sum(model[f] * float(np.log1p(c)) for f, c in hits.items())
    return float(1 / (1 + np.exp(-max(-35.0, min(35.0, z)))))


def held_out(key: Column) -> Column:
    """True for the rows no label of which may be learned from; a null key counts as held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> dict[str, float]:
    """Trains on at most max_toxic + max_clean labelled rows, the first of each class by a hash.

    Rows of the held-out fold are never read. A key labelled twice is toxic if any label says so;
    null labels and keys are left out. The bounded list of keys is broadcast, so the documents
    are scanned once and not shuffled; one task trains on the sample and returns the weights.
    """
    labelled = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_key").isNotNull() & ~held_out(F.col("_key")))
        .groupBy("_key")
        .agg(F.max("_label").alias("_label"))
    )
    totals = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = {1: settings.max_toxic, 0: settings.max_clean}
    picked = [
        labelled.where(F.col("_label") == k).orderBy(F.xxhash64("_key"), "_key").limit(n) for k, n in bounds.items()
    ]
    weight = {k: max(1.0, totals.get(k, 0) / n) for k, n in bounds.items()}
    sample = (
        documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(picked[0].unionByName(picked[1])), "_key")
        .select("_key", F.coalesce("_text", F.lit("")).alias("_text"), "_label")
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True).sort_values(["_key", "_text"], kind="stable")
        y = rows["_label"].to_numpy()
        model = train(rows["_text"].tolist(), y, np.where(y == 1, weight[1], weight[0]), settings)
        yield pd.DataFrame({"feature": list(model), "weight": list(model.values())})

    # One task gets the whole (bounded) sample; an empty one yields no batch and no model.
    model = sample.repartition(1).mapInPandas(learn, "feature string, weight double").collect()
    return {r["feature"]: r["weight"] for r in model} or {"": 0.0}


def score(documents: DataFrame, model: dict[str, float], text: str = "text", out: str = "score") -> DataFrame:
    """All columns and ``out``: the score of the whole text. Replaces a column named ``out``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        weights = sent.value
        return pd.Series([score_text(weights, t) for t in texts], dtype="float64")

    return documents.withColumn(out, scored(F.col(text)))
