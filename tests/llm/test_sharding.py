from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from courierlens.llm.numbering import numbered
from courierlens.llm.blocks import scratch_table
from courierlens.llm.sharding import Feistel, shard_documents


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_and_its_inverse(total):
    shuffle = Feistel(total)
    places = shuffle.place(np.arange(total))
    assert sorted(places.tolist()) == list(range(total))
    assert shuffle.row(places).tolist() == list(range(total))


def test_other_seeds_shuffle_otherwise():
    a, b = (Feistel(1000, seed).place(np.arange(1000)) for seed in (1, 2))
    assert (a == b).sum() < 20 and (a == np.arange(1000)).sum() < 20


def test_neighbours_are_spread():
    # rows in a run land in all shards about equally often
    shards = Feistel(160_000).place(np.arange(16_000)) % 16
    assert np.bincount(shards, minlength=16).std() < 120


TEXTS = [(None, "a"), (None, None), (3, ""), (3, "é"), (3, "é"), (2, "x" * 300_000), (9, "\U0001f600"), (-1, "same"), (7, "same")]


def brute(rows, shards):
    light = sorted(
        (i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    places = Feistel(len(rows)).place(np.arange(len(rows)))
    return Counter(
        (i if known else None, size, crc, "rows", int(p % shards), int(p // shards), None, n)
        for n, ((known, i, size, crc), p) in enumerate(zip(light, places, strict=True))
    )


@pytest.mark.parametrize("copies", [1, 40])
def test_rows_equal_brute_force(spark, documents, copies):
    rows = TEXTS * copies + [(i, f"text {i}") for i in range(50)]
    schema = "doc_id long, text string, row long, tie string, size string"
    found = shard_documents(documents(rows, schema).repartition(5), shards=7)
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, 7)


def test_counts_and_slots(spark, documents):
    found = shard_documents(documents([(i % 10, "t") for i in range(1003)])).toPandas()
    sizes = found.groupby("shard")["slot"].agg(["count", "max", "min"])
    assert set(sizes["count"]) == {62, 63} and (sizes["max"] == sizes["count"] - 1).all() and (sizes["min"] == 0).all()


def test_empty_and_tiny_tables(spark, documents):
    assert shard_documents(documents([])).count() == 0
    assert [tuple(r) for r in shard_documents(documents([(1, None)])).collect()] == [(1, 1, 0, "rows", 0, 0, None, 0)]


def test_numbers_are_dense_over_many_ranges(spark):
    rows = scratch_table(spark.range(5000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id"), "test-rows")
    found, total = numbered(rows, ["k", "id"], "test-numbered")
    assert total == 5000
    got = sorted((r.row, r.k, r.id) for r in found.collect())
    assert [g[0] for g in got] == list(range(5000))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)
