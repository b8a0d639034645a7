"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learned from document labels.

A sentence has the chance ``p = sigmoid(bias + sum of its features' weights)``; a
document is toxic unless all its sentences are clean, ``1 - prod(1 - p)``.  Weights
are fitted so that documents get their labels; which sentence offends is never told,
yet it is the one whose chance is high.  Features are words and their first letters,
so an insult is known with endings that were not seen.

The fit reads a bounded sample of labelled documents (``Fit``: documents per label, drawn
by a hash of the id, and of those the shortest that fit the number of characters) in one
task; scoring reads every whole text, against the chance that a sentence has without any feature.

Cases: null and empty texts, and texts without a word, have score 0; null labels and null ids
are not learned from; a document with two labels counts as toxic; without labelled
documents of both kinds every score is 0; repeated rows get equal scores; an empty
table gives an empty result; any other columns stay as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline.staging import stage

_WORD = re.compile(r"\w+")
#: A sentence with a word.
_WORDED = re.compile(r"[^.!?。！？\n\w]*\w[^.!?。！？\n]*")
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample, and the fit."""

    toxic_docs: int = 3_000
    clean_docs: int = 5_000
    chars: int = 40_000_000
    min_docs: int = 3
    max_features: int = 10_000
    rounds: int = 300
    step: float = 1.0
    sparsity: float = 1.0


@dataclass(frozen=True)
class Model:
    """At most ``Fit.max_features`` weights, so it can go to every task."""

    bias: float
    weights: dict[str, float]


def features(word: str) -> list[str]:
    """A word, and its first letters where it is longer; the hyphen tells the two apart."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) >= n)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans in code points."""
    return [m.span() for m in _WORDED.finditer(text)]


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 != 0


def training_sample(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """(text, toxic, weight): labelled documents outside the held-out fifth, within the bounds of ``fit``."""
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    told = told.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    told = stage(docs.select("doc_id").join(told, "doc_id").distinct())
    number = told.groupBy("toxic").agg(F.count("*").alias("all"))
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    drawn = [
        told.where(F.col("toxic") == flag).orderBy(order, "doc_id").limit(size)
        for flag, size in ((1, fit.toxic_docs), (0, fit.clean_docs))
    ]
    drawn = stage(drawn[0].unionByName(drawn[1]))
    taken = drawn.groupBy("toxic").agg(F.count("*").alias("taken"))
    share = number.join(taken, "toxic").select("toxic", (F.col("all") / F.col("taken")).alias("weight"))
    # both sides are bounded: two rows, and the documents drawn
    picked = drawn.join(F.broadcast(share), "toxic")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    once = texts.groupBy("doc_id", "toxic", "weight").agg(F.max("text").alias("text"))
    once = stage(once)
    # lengths alone go through the window, the shortest first: what does not fit is the longest, and drops nothing else
    chars = F.length("text")
    upto = F.sum("chars").over(Window.orderBy("chars", F.xxhash64("doc_id", F.lit("chars")), "doc_id"))
    fitting = once.select("doc_id", chars.alias("chars")).withColumn("upto", upto).where(F.col("upto") <= fit.chars)
    return once.join(F.broadcast(fitting.select("doc_id")), "doc_id").select("text", "toxic", "weight")


def fit_weights(texts: list[str], toxic: list[int], weight: list[float], fit: Fit) -> Model:
    """Fit the noisy-or by gradient steps with soft thresholds."""
    y, importance = np.array(toxic, float), np.array(weight, float)
    if not y.sum() or y.all():
        return Model(-50.0, {})
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for flag in (1, 0):  # features of clean documents count where toxic ones have them
        for text in (t for t, k in zip(texts, toxic, strict=True) if k == flag):
            held = {f for word in set(_WORD.findall(text.lower())) for f in features(word)}
            seen[flag].update(held if flag else held & seen[1].keys())
        if flag:
            for f in [f for f, n in seen[1].items() if n < fit.min_docs]:
                del seen[1][f]
    total = [max(1.0, float((importance * (y == k)).sum())) for k in (0, 1)]
    scale = [float(importance[y == k].mean()) if (y == k).any() else 1.0 for k in (0, 1)]
    lift = {
        f: (n * scale[1] / total[1] - seen[0][f] * scale[0] / total[0]) * math.log((n + 1) / (seen[0][f] * total[1] * scale[0] / (total[0] * scale[1]) + 1))
        for f, n in seen[1].items()
        if n * scale[1] / total[1] > seen[0][f] * scale[0] / total[0]
    }
    chosen = sorted(lift, key=lambda f: (-lift[f], f))[: fit.max_features]
    number = {f: i for i, f in enumerate(chosen)}
    cells: list[int] = []
    owner: list[int] = []
    doc_of: list[int] = []
    plain = np.zeros(len(texts))
    for d, text in enumerate(texts):
        for a, b in sentences(text):
            here = {number[f] for word in _WORD.findall(text[a:b].lower()) for f in features(word) if f in number}
            if here:
                cells += here
                owner += [len(doc_of)] * len(here)
                doc_of.append(d)
            else:
                plain[d] += 1
    column, row, doc = np.array(cells, np.int64), np.array(owner, np.int64), np.array(doc_of, np.int64)
    spread = np.bincount(column, importance[doc[row]], len(chosen))
    rate = fit.step / max(1.0, float(spread.max(initial=0.0)))
    w, bias = np.zeros(len(chosen)), -7.0
    ahead, last = w, w
    # plain accelerated steps: what many documents share is learned before what few share
    for t in range(1, fit.rounds + 1):
        z = bias + np.bincount(row, ahead[column], len(doc))
        risk = np.bincount(doc, np.logaddexp(0, z), len(texts)) + plain * np.logaddexp(0, bias)
        pull = importance * np.where(y == 1, -1 / np.expm1(np.clip(risk, 1e-9, 500)), 1.0)
        chance = 1 / (1 + np.exp(-z))
        slope = np.clip(pull[doc], -50, 50) * chance
        bias_slope = slope.sum() + (pull * plain).sum() / (1 + np.exp(-bias))
        bias = float(np.clip(bias - np.clip(0.2 * bias_slope / max(1.0, importance @ y), -0.05, 0.05), -12, -4))
        last, w = w, ahead - rate * np.bincount(column, slope[row], len(chosen))
        w = np.maximum(w - rate * fit.sparsity, 0)
        ahead = w + (t - 1) / (t + 2) * (w - last)
    return Model(float(bias), {f: float(x) for f, x in zip(chosen, w, strict=True) if abs(x) >= 0.05})


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Fit in one task on the bounded sample; the weights come back as rows."""

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for part in parts for row in zip(*(c.to_pylist() for c in part.columns), strict=True))
        if rows:
            model = fit_weights([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], fit)
            told = [("", model.bias), *sorted(model.weights.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in told]), pa.array([x for _, x in told])], names=["feature", "weight"]
            )

    sample = stage(training_sample(docs, labels, fit).withColumn("toxic", F.col("toxic").cast("int")))
    kinds = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if len(kinds) < 2 and told_kinds(docs, labels) > 1:
        raise ValueError(f"no labelled document of one kind fits into {fit.chars} characters")
    rows = sample.repartition(1).mapInArrow(fitted, "feature string, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in rows}
    return Model(weights.pop("", -50.0), weights)


def told_kinds(docs: DataFrame, labels: DataFrame) -> int:
    """How many of the two labels the documents to learn from have."""
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    return told.join(docs.select("doc_id"), "doc_id", "left_semi").select("toxic").distinct().count()


class Scorer:
    """Applies a model.

    A sentence counts by what its features add to the chance that any sentence has, so
    sentences without a feature add nothing and no text is toxic for its length.  All
    features of a word begin as the word does, so a text none of whose words begins
    like a feature has chance 0.
    """

    def __init__(self, model: Model):
        self.model = model
        self.base = math.log1p(math.exp(model.bias))
        self.starts = {f.rstrip("-")[: PREFIXES[0]] for f in model.weights}

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """Sentences with their log odds; a feature counts once in a sentence, as in the fit."""
        weights, found = self.model.weights, []
        for a, b in sentences(text):
            words = [w for w in _WORD.findall(text[a:b].lower()) if w[: PREFIXES[0]] in self.starts]
            told = {f for word in words for f in features(word) if f in weights}
            found.append((a, b, self.model.bias + sum(map(weights.__getitem__, sorted(told)))))
        return found

    def score(self, text: str) -> float:
        words = _WORD.findall(text.lower())
        if not words:
            return 0.0
        if self.starts.isdisjoint({w[: PREFIXES[0]] for w in words}):
            return 0.0
        risk = sum(max(z, 0) + math.log1p(math.exp(-abs(z))) - self.base for _, _, z in self.spans(text))
        return -math.expm1(-max(risk, 0.0))


def score_column(model: Model):
    """A column function: text to the document's score."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for part in parts:
            yield pd.Series([scorer.score(text) if text else 0.0 for text in part], dtype="float64")

    return score


def offending_column(model: Model, from_chance: float = 0.5):
    """A column function: text to its offending sentences, (start, end, chance) in code points."""

    @F.pandas_udf("array<struct<start:int,end:int,chance:double>>")
    def offending(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for part in parts:
            rows = []
            for text in part:
                told = [(a, b, 1 / (1 + math.exp(-min(max(z, -500), 500)))) for a, b, z in scorer.spans(text or "")]
                rows.append([{"start": a, "end": b, "chance": p} for a, b, p in told if p >= from_chance])
            yield pd.Series(rows)

    return offending


def score_documents(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = train(docs, labels, fit)
    scored = docs.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), score_column(model)("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``docs`` without the documents scored as toxic; all columns stay."""
    return docs.where(score_column(train(docs, labels, fit))("text") < 0.5)
