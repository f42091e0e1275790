from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from courierlens.llm.toxicity import (
    BITS,
    Ftrl,
    Settings,
    features,
    fit,
    learn_toxicity,
    score_batch,
    score_toxicity,
)

BAD = ["grub", "snide remark", "utter mess"]


def corpus(rng, n):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        text = rng.choices(words, k=rng.randint(3, 80))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_update_follows_the_formula():
    s = Settings(alpha=0.5, beta=1.0, l1=0.1, l2=0.5)
    model = Ftrl(3, s)
    z, n = np.zeros(3), np.zeros(3)
    for at, label, weight in [([0, 1], 1, 1.0), ([1, 2], 0, 2.0), ([0, 2], 1, 1.0)]:
        w = np.array([0 if abs(z[i]) <= s.l1 else -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2) for i in at])
        g = weight * (1 / (1 + np.exp(-w.sum())) - label)
        for i, wi in zip(at, w, strict=True):
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * wi
            n[i] += g * g
        model.learn(np.array(at), label, weight)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_strong_penalty_leaves_no_weights():
    rows = [(np.array([i % 5, 1 << BITS]), i % 2, 1.0) for i in range(40)]
    places, _ = fit(rows, Settings(l1=1e6))
    assert len(places) == 0


def test_features_cover_whole_texts_and_stay_in_their_row():
    long = "x " * 60_000 + "end"
    found = list(features(pa.array([None, "One", "one two three", "", long])))
    rows = np.concatenate([r for r, _, _ in found])
    # words and stems, neighbours, and pairs with one between
    assert [int((rows == i).sum()) for i in range(4)] == [0, 2, 6 + 2 + 1, 0]
    assert int((rows == 4).sum()) == 2 * 60_001 + 60_000 + 59_999
    keys = {int(r): set(k[rr == r].tolist()) for rr, k, _ in found for r in set(rr.tolist())}
    assert keys[1] < keys[2]


def test_learned_scores(spark, documents):
    rng = random.Random(7)
    rows = corpus(rng, 900)
    labels = [(i, 1, t if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - t) for i, _, t in rows if i % 5]
    labels += [(None, 1, 1), (1, 0, None), (99_999, 1, 1)]
    table = documents([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "  "), (None, "w1 grub")])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = learn_toxicity(table, marks, Settings(l1=0.5, rows_per_label=300))
    assert 0 < len(weights[0]) < 20_000
    found = score_toxicity(table, weights).collect()
    assert len(found) == len(rows) + 4
    by_id = {r.doc_id: r for r in found}
    unseen = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2 or i % 5 == 0]
    right = np.mean([by_id[i].predicted == rows[i][2] for i in unseen])
    assert right > 0.9
    assert by_id[5000].score == by_id[5001].score == by_id[5002].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    kept = score_toxicity(table, weights, keep=True)
    assert kept.columns == table.columns
    assert kept.count() == sum(r.predicted == 0 for r in found)


def test_without_labels(spark, documents):
    table = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = learn_toxicity(table, none)
    assert [r.score for r in score_toxicity(table, weights).collect()] == [0.5, 0.5]
    assert score_toxicity(table.limit(0), weights).count() == 0


@pytest.mark.parametrize("texts", [[], [None], ["a"] * 3])
def test_small_batches(texts):
    dense = np.zeros((1 << BITS) + 1)
    assert len(score_batch(dense, pa.array(texts, pa.string()))) == len(texts)
