from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from courierlens.llm import prefixtrie
from courierlens.llm.prefixtrie import extents, least_rows, prefix_trie, sparse_table

SCHEMA = "conv_id long, turn long, role string, text string, depth long, symbol string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA)


def symbol(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """Nodes by their whole sequences."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, symbol(role, text), role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), kids[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    return sorted((tuple(r) for r in prefix_trie(table(spark, rows).repartition(parts)).collect()), key=repr)


def random_rows(seed, convs=60, texts=3, most=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), convs):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "tool", None]), rng.choice(["é" * i for i in range(texts)] + [None])))
    return rows


def test_extents_and_minima_equal_a_walk():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 8, 33, 100):
        shared = rng.integers(-1, 5, n - 1)
        rows, depths = rng.integers(0, n, 200), rng.integers(0, 6, 200)
        left, right = extents(sparse_table(shared) if n > 1 else [np.zeros(0, np.int64)], rows, depths)
        ranks = rng.permutation(n)
        least = least_rows(sparse_table(ranks), left, right)
        for i, d, a, b, m in zip(rows, depths, left, right, least, strict=True):
            lo = hi = i
            while lo > 0 and shared[lo - 1] >= d:
                lo -= 1
            while hi < n - 1 and shared[hi] >= d:
                hi += 1
            assert (a, b, m) == (lo, hi, ranks[lo : hi + 1].min())


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(spark, rows) == brute(rows)


def test_small_slices_and_blocks(spark, monkeypatch):
    # workers get the settings with the functions: blocks are cut in Spark, so a real small block is tested there
    monkeypatch.setattr(prefixtrie, "BLOCK", 64)
    rows = [(c, t, "user", "same") for c in range(0, 40, 5) for t in range(150 + c % 3)]
    rows += [(c, t, "user", "same" if t < 100 else f"own {c}") for c in range(100, 140, 5) for t in range(130)]
    rows += [(c, t, "user", f"{c} {t}") for c in (1, 2, 300) for t in (0, 64, 65)]
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_and_turnless(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, None, None, None), (0, 5, "user", ""), (0, 5, "", "user")]
    # without a first of the family, short conversations lose all turns
    rows += [(c, t, "user", "short") for c in (11, 12, 13, 14, 21, 22, 23, 24) for t in range(1)]
    assert found(spark, rows) == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in brute(rows))


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "", "abc"), (15, 0, None, "abc")]
    assert found(spark, rows) == brute(rows)


def test_large_groups_of_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 20_000, 5) for t in range(3)]
    rows += random_rows(5)
    assert found(spark, rows, 8) == brute(rows)


def test_long_texts_and_empty_tables(spark):
    rows = [(0, 0, "user", "x" * 1_000_000), (5, 0, "user", "x" * 999_999)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []
