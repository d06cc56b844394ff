"""The ordinal model against a plain version: features by counting, gradients by differences."""

import math
import re

import numpy as np

from varloom.llm import toxicity

CALM, RUDE = "the river runs past old stone houses and quiet gardens".split(), "vile nasty vileness".split()


def corpus():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(90):
        grade = (0, 0, 1, 2)[i % 4]
        words = list(rng.choice(CALM, 20)) + list(rng.choice(RUDE, 2 * grade))
        if grade == 0 and i % 16 == 0:
            words.append("nasty")
        rows.append((i, " ".join(rng.permutation(words)), grade))
    return rows


def parts(word):
    return ["=" + word] + ["^" + word[:n] for n in range(4, 9) if len(word) >= n]


def plain_features(rows):
    clean, graded = (sum((g > 0) == side for *_, g in rows) for side in (False, True))
    found = {}
    for _, text, grade in rows:
        for f in {f for w in re.findall(r"\w+", text.lower()) for f in parts(w)}:
            found.setdefault(f, [0, 0])[grade > 0] += 1
    out = []
    for f, (a, b) in found.items():
        cells = [(a, clean, a + b), (b, graded, a + b), (clean - a, clean, len(rows) - a - b), (graded - b, graded, len(rows) - a - b)]
        g = 2 * sum(n * math.log(n / max(side * whole / len(rows), 1e-9)) for n, side, whole in cells if n)
        if a + b >= 3 and b * clean > a * graded and g >= 15:
            out.append((-g, f))
    return [f for _, f in sorted(out)]


def plain_row(text, features):
    words = re.findall(r"\w+", text.lower())
    n = [sum(parts(w).count(f) for w in words) for f in features]
    return [math.log1p(c) for c in n] + [math.log1p(c * 300 / (len(words) + 50)) for c in n]


def above(x, w, theta):
    return 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta[None, :], -60, 60)))


def plain_fit(x, grade):
    d, at = x.shape[1], np.arange(len(x))

    def value(v):
        edges = np.hstack([np.ones((len(x), 1)), above(x, v[:d], np.array([v[d], v[d] + math.exp(v[d + 1])])), np.zeros((len(x), 1))])
        return np.log(np.maximum(edges[at, grade] - edges[at, grade + 1], 1e-12)).mean() - 0.5e-3 * (v[:d] ** 2).sum()

    share = np.array([(grade > k).mean() for k in (0, 1)])
    start = np.log((1 - share) / share) + np.array([0, 1e-3])
    v = np.concatenate([np.zeros(d), [start[0], math.log(start[1] - start[0])]])
    m = s = np.zeros(d + 2)
    for step in range(1, 301):
        slope = np.array([(value(v + e) - value(v - e)) / 2e-5 for e in 1e-5 * np.eye(d + 2)])
        m, s = 0.9 * m + 0.1 * slope, 0.999 * s + 0.001 * slope**2
        v = v + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return v[:d], np.array([v[d], v[d] + math.exp(v[d + 1])])


def test_scores_are_those_of_the_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (None, "vile nasty"), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g > 0), 0 if g == 2 else 1) for i, _, g in rows], "doc_id long, toxic int, quality int")
    features = plain_features(rows)
    model = toxicity.train(toxicity.labelled(docs, labels))
    assert list(model.features) == features and "=vile" in features and "=nasty" in features
    w, theta = plain_fit(np.array([plain_row(t, features) for _, t, _ in rows]), np.array([g for *_, g in rows]))
    got = toxicity.toxicity(docs.withColumn("severity", toxicity.F.lit("x")), labels).collect()
    texts = {i: t for i, t, _ in rows} | {900: "", None: "vile nasty", 901: ""}
    assert len(got) == len(texts)
    for r in got:
        p = above(np.array([plain_row(texts[r.doc_id], features)]), w, theta)[0]
        assert abs(r.p_toxic - p[0]) < 5e-3 and abs(r.severity - p.sum()) < 1e-2 and p[0] > p[1]
        assert r.rejected == (p[0] >= 0.5) or abs(p[0] - 0.5) < 5e-3


def test_one_labelled_row_for_each_key(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, 0, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    assert sorted(map(tuple, toxicity.labelled(docs, labels).collect())) == [("b", 0), ("text 0", 1)]
