"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade > k) = sigmoid(w . x - theta_k): all thresholds share the weights w and are ordered by construction
(theta_0, then positive steps).  Features are words and word prefixes that graded documents hold more often than clean
ones, by their count and by their density; the output is the expected severity, sum over k of P(grade > k).

The model is fitted on a bounded sample of labelled rows (SAMPLE_ROWS, by hash of their key); scoring reads every
document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import empty_for_null, map_texts

SAMPLE_ROWS = 6000
FEATURES = 1024
#: Least likelihood ratio (G) of a feature, and least documents that hold it.
LEAST_G, LEAST_DOCS = 15.0, 3
PREFIXES = range(4, 9)
WORDS = re.compile(r"\w+")
CACHE = 100_000
#: Words of the text for which the two columns of a feature are about equal.
TYPICAL_WORDS = 300


def word_features(word: str) -> list[str]:
    """The word itself and its prefixes, which catch families of inflected words."""
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def document_words(text: str) -> Counter:
    return Counter(WORDS.findall(text.lower()))


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, x: np.ndarray) -> np.ndarray:
        """rows x thresholds: P(grade > k)."""
        z = (x @ self.weights)[:, None] - self.thresholds[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Vectorizer:
    """Texts to dense rows over the chosen features; remembers the features of words it has met."""

    def __init__(self, features: dict[str, int]):
        self.features, self.words = features, {}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            found = tuple(self.features[f] for f in word_features(word) if f in self.features)
            if len(self.words) < CACHE and len(word) <= 64:
                self.words[word] = found
        return found

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How often each feature occurs in each text, and the texts' words."""
        x = np.zeros((len(texts), len(self.features)), dtype=np.float32)
        length = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = document_words(text)
            length[i] = words.total()
            for word, n in words.items():
                for f in self.of(word):
                    x[i, f] += n
        return x, length

    def rows(self, texts: list[str]) -> np.ndarray:
        return scaled(*self.counts(texts))


def scaled(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Two columns for each feature: how often it occurs, and how often for the text's length."""
    return np.hstack([np.log1p(counts), np.log1p(counts * TYPICAL_WORDS / (words[:, None].astype(np.float32) + 50))])


def fit(x: np.ndarray, grade: np.ndarray, grades: int, l2: float = 1e-3, rounds: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the most likely cumulative-link model, by Adam with an L2 penalty."""
    n, d = x.shape
    x = x.astype(np.float32)
    w = np.zeros(d)
    share = np.array([np.clip((grade > k).mean() if n else 0.0, 1e-3, 1 - 1e-3) for k in range(grades - 1)])
    theta = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(grades - 1))
    raw = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    m = v = np.zeros(d + len(raw))
    for step in range(1, rounds + 1 if n else 1):
        theta = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        eta = (x @ w.astype(np.float32)).astype(np.float64)
        above = 1 / (1 + np.exp(-np.clip(eta[:, None] - theta[None, :], -60, 60)))
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = edges * (1 - edges)
        at = np.arange(n)
        p = np.maximum(edges[at, grade] - edges[at, grade + 1], 1e-12)
        from_eta = (slope[at, grade] - slope[at, grade + 1]) / p
        by_edge = np.zeros((n, grades + 1))
        by_edge[at, grade] -= slope[at, grade] / p
        by_edge[at, grade + 1] += slope[at, grade + 1] / p
        by_theta = by_edge[:, 1:-1].mean(axis=0)
        tail = np.cumsum(by_theta[::-1])[::-1]  # a step moves all later thresholds
        gradient = np.concatenate([(from_eta.astype(np.float32) @ x) / n - l2 * w, tail[:1], tail[1:] * np.exp(raw[1:])])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, raw = w + move[:d], raw + move[d:]
    return w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, grade of a bounded sample: 0 clean, 1 toxic, 2 toxic and of low quality.

    Labels with a null key or null toxicity are left out; labels that repeat a key count once, with the worst.  Of
    documents that repeat a labelled key the least text counts, so at most SAMPLE_ROWS rows come out.
    """
    toxic, quality = F.coalesce("toxic", F.lit(0)), F.coalesce("quality", F.lit(1))
    grade = F.when(toxic > 0, F.when(quality > 0, 1).otherwise(2)).otherwise(0)
    sample = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(grade).alias("grade"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    # at most SAMPLE_ROWS pairs of numbers are broadcast
    rows = docs.select("doc_id", empty_for_null("text").alias("text")).join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("text", "grade")


def train(sample: DataFrame, grades: int = 3, most_features: int = FEATURES) -> Model:
    """Fit on rows text, grade (0 to grades - 1); the caller bounds their number.

    Texts are not null (empty ones have no features); repeated rows count as often as they occur; features of equal G
    go by name.  Without rows, or without a telling feature, the model grades all texts alike.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, list[int]] = {}
        for batch in batches:
            for text, grade in zip(batch["text"], batch["grade"]):
                for f in {f for w in document_words(text) for f in word_features(w)}:
                    n = total.setdefault(f, [0, 0])
                    n[grade > 0] += 1
        rows = [(f, a, b) for f, (a, b) in total.items()]
        yield pd.DataFrame(rows, columns=["feature", "clean", "graded"]).astype({"clean": np.int64, "graded": np.int64})

    sample = sample.cache()
    size = {bool(r["g"]): r["count"] for r in sample.groupBy((F.col("grade") > 0).alias("g")).count().collect()}
    clean, graded = float(size.get(False, 0)), float(size.get(True, 0))
    occurrences = sample.mapInPandas(counted, "feature string, clean long, graded long").groupBy("feature").agg(F.sum("clean").alias("a"), F.sum("graded").alias("b"))

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    total = max(1.0, clean + graded)
    seen = F.col("a") + F.col("b")
    cells = ((F.col("a"), clean, seen), (F.col("b"), graded, seen), (clean - F.col("a"), clean, total - seen), (graded - F.col("b"), graded, total - seen))
    g = sum((part(n, F.greatest(side * whole / total, F.lit(1e-9))) for n, side, whole in cells), F.lit(0.0)) * 2
    chosen = occurrences.filter((seen >= LEAST_DOCS) & (F.col("b") * clean > F.col("a") * graded)).withColumn("g", g).filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "feature").limit(most_features).collect()
    features = {r["feature"]: i for i, r in enumerate(chosen)}

    def work():
        vectorizer = Vectorizer(features)

        def block(texts: list[str]):
            counts, words = vectorizer.counts(texts)
            cells = [np.flatnonzero(row) for row in counts]
            return None, [[c.astype("<i4").tobytes() for c in cells], [row[c].astype("<f4").tobytes() for row, c in zip(counts, cells)], words]

        return block

    # of each row only its non-zero cells reach the driver, whatever the length of its text
    rows = map_texts(sample, ("grade",), "text", {"cells": "binary", "counts": "binary", "words": "long"}, work).toPandas()
    sample.unpersist()
    rows = rows.sort_values(["grade", "words", "cells", "counts"], ignore_index=True)
    x = np.zeros((len(rows), len(features)), dtype=np.float32)
    for row, cells, counts in zip(x, rows["cells"], rows["counts"]):
        row[np.frombuffer(cells, "<i4")] = np.frombuffer(counts, "<f4")
    w, theta = fit(scaled(x, rows["words"].to_numpy(np.int64)), rows["grade"].to_numpy(np.int64), grades)
    return Model(features, w, theta)


def score(docs: DataFrame, model: Model, reject_at: float = 0.5, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep, severity, grade, p_toxic, rejected for every row of docs.

    severity is the expected grade, grade the most probable one, p_toxic = P(grade > 0); rows with
    p_toxic >= reject_at are rejected.  Null texts count as empty; null and repeated keys keep a row each; other
    columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        known = shared.value
        vectorizer = Vectorizer(known.features)

        def block(texts: list[str]):
            above = np.concatenate([known.exceed(vectorizer.rows(texts[i : i + 1024])) for i in range(0, len(texts), 1024)])
            edges = np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], axis=1)
            grade = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1)
            rejected = above[:, 0] >= reject_at
            return None, [above.sum(axis=1).round(6), grade.astype(np.int32), above[:, 0].round(6), rejected]

        return block

    return map_texts(docs, keep, text, {"severity": "double", "grade": "int", "p_toxic": "double", "rejected": "boolean"}, work)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What `score` gives for docs, by a model fitted on their `labelled` rows; without labels nothing is rejected."""
    return score(docs, train(labelled(docs, labels)))
