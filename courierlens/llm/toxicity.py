"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the hashed words, their five-byte stems, the pairs of neighbours
and the pairs with one word between them; each counts once per text. The learner keeps a
rate per coordinate and drives most weights to exactly 0, so what is broadcast is a few
thousand numbers whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.blocks import SpanHasher, flat, lower_ascii, mixed, slices, word_spans

BITS = 20
STEM = 5
_HASHER = SpanHasher(0x70C1)
_PAIR, _SKIP, _STEM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Settings:
    """Learning rates, penalties and the bound on labelled rows (per label value)."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0
    epochs: int = 4
    rows_per_label: int = 4000


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """By slices of rows: (row, hashed feature) of every occurrence, and the rows read so far."""
    data, offsets = flat(column)
    shift = np.uint64(64 - BITS)
    for a, b in slices(offsets):
        part = lower_ascii(data[offsets[a] : offsets[b]])
        starts, ends, words = word_spans(part, offsets[a : b + 1] - offsets[a])
        row = np.repeat(np.arange(a, b), np.diff(words))
        whole = _HASHER(part, starts, ends)
        stems = _HASHER(part, starts, np.minimum(ends, starts + STEM))
        rows, keys = [row, row], [whole >> shift, mixed(stems * _STEM) >> shift]
        for gap, salt in ((1, _PAIR), (2, _SKIP)):
            same = row[gap:] == row[:-gap]
            rows.append(row[gap:][same])
            keys.append(mixed(whole[:-gap][same] * salt + whole[gap:][same]) >> shift)
        yield np.concatenate(rows), np.concatenate(keys).astype(np.int64), b


class Ftrl:
    """FTRL-proximal with per-coordinate rates; ``z`` and ``n`` are its whole state."""

    def __init__(self, size: int, settings: Settings) -> None:
        self.z, self.n, self.s = np.zeros(size), np.zeros(size), settings

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, s = self.z[at], self.s
        shrunk = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        gradient = weight * (sigmoid(w.sum()) - label)
        rate = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / self.s.alpha
        self.z[at] += gradient - rate * w
        self.n[at] += gradient**2


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[np.ndarray, int, float]], settings: Settings, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Nonzero weights (place, value) learned from (features, label, weight); the last place is the bias."""
    model = Ftrl((1 << BITS) + 1, settings)
    rng = np.random.default_rng(seed)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            model.learn(*rows[i])
    w = model.weights(slice(None))
    places = np.flatnonzero(w)
    return places, w[places]


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """At most ``rows_per_label`` texts per label value, the first by a hash of their id; none held out.

    ``weight`` restores the share of each label among all rows that may be learned from.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sizes = {r.label: r.n for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for label, n in sorted(sizes.items()):
        some = usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        some = some.limit(settings.rows_per_label).withColumn(
            "weight", F.lit(max(1.0, n / settings.rows_per_label))
        )
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        picked = usable.withColumn("weight", F.lit(1.0)).limit(0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most two times rows_per_label ids, so the broadcast is bounded by that parameter
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label", "weight")


def learn_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights learned from the bounded labelled sample, in one task that reads only that sample."""
    settings = settings or Settings()

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            ids, labels_, weights = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for row, key, _ in features(batch.column(1)):
                pairs = np.unique(row << BITS | key)
                cuts = np.flatnonzero(np.diff(pairs >> BITS)) + 1
                for own in np.split(pairs, cuts):
                    if len(own):
                        i = int(own[0] >> BITS)
                        at = np.append(own & ((1 << BITS) - 1), 1 << BITS).astype(np.int32)
                        rows.append((ids[i], at, labels_[i], weights[i]))
        rows.sort(key=lambda r: (r[0], r[1].tobytes()))
        places, values = fit([r[1:] for r in rows], settings)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], names=["place", "value"])

    # dealt, not merged: the documents are scanned by as many tasks as ever
    sample = labelled_sample(docs, labels, settings).repartition(1)
    found = sample.mapInArrow(train, "place long, value double").collect()
    return np.array([r.place for r in found], np.int64), np.array([r.value for r in found], np.float64)


def score_batch(dense: np.ndarray, column: pa.Array) -> np.ndarray:
    totals = np.full(len(column), float(dense[-1]))
    for row, key, _ in features(column):
        live = dense[key] != 0
        pairs = np.unique(row[live] << BITS | key[live])
        np.add.at(totals, pairs >> BITS, dense[pairs & ((1 << BITS) - 1)])
    return sigmoid(totals)


def score_toxicity(
    docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], threshold: float = 0.3, keep: bool = False
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; ``keep`` returns its columns instead of held_out.

    * A null, empty or blank text has the score of the bias alone.
    * Texts are read whole; repeated rows and null ids (not held out) give a row each.
    * Without labelled rows every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << BITS) + 1)
        dense[shared.value[0]] = shared.value[1]
        for batch in batches:
            score = score_batch(dense, batch.column("text"))
            if keep:
                yield batch.filter(pa.array(score < threshold))
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    if keep:
        return docs.select(*names).mapInArrow(run, docs.schema)
    asked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "text",
    )
    return asked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
