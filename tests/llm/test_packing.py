from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from courierlens.llm.packing import make_plan, pack_documents, piece_sizes
from courierlens.llm.queries import vocabulary_file


def unfold(plan, counts, capacity):
    """Check that each item has one place and each sequence is filled without gaps; count sequences."""
    filled = {}
    for size, first, count, sequence, offset in plan.runs:
        for i in range(count):
            filled.setdefault(sequence + i, []).append((offset, size, first + i))
    items = {}
    for places in filled.values():
        at = 0
        for offset, size, item in sorted(places):
            assert offset == at
            at += size
            items.setdefault(size, set()).add(item)
        assert at <= capacity
    assert {s: len(x) for s, x in items.items()} == {s: n for s, n in counts.items() if n}
    assert all(x == set(range(len(x))) for x in items.values())
    assert set(filled) == set(range(plan.sequences))
    return plan.sequences


def fewest(items, capacity):
    """The least number of bins, by search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for r in sorted(set(bins)):
            if r >= items[i]:
                rest = list(bins)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


def test_plans_are_whole_and_close_to_the_least():
    rng = random.Random(3)
    extra = 0
    for _ in range(300):
        capacity = rng.choice([7, 10, 20])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = {s: items.count(s) for s in set(items)}
        used = unfold(make_plan(counts, capacity), counts, capacity)
        least = fewest(items, capacity)
        assert least <= used
        extra += used - least
    assert extra <= 6


def test_reduction_alone_never_costs_a_sequence():
    from courierlens.llm.packing import Plan, reduce_instance

    rng = random.Random(9)
    for _ in range(200):
        capacity = 12
        items = [rng.randint(1, capacity) for _ in range(rng.randint(2, 8))]
        plan = Plan({s: items.count(s) for s in set(items)}, capacity)
        reduce_instance(plan)
        rest = [s for s, n in plan.left.items() for _ in range(n)]
        assert plan.sequences + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


def test_large_counts_plan_quickly():
    rng = np.random.default_rng(1)
    counts = {int(s): int(n) for s, n in enumerate(rng.integers(0, 10**9, 2049)) if s}
    plan = make_plan(counts, 2048)
    assert sum(r[0] * r[2] for r in plan.runs) == sum(s * n for s, n in counts.items())
    assert len(plan.runs) < 200_000


@pytest.mark.parametrize(("length", "sizes"), [(1, [1]), (8, [8]), (9, [1, 8]), (16, [8, 8]), (20, [4, 8, 8])])
def test_pieces(length, sizes):
    assert piece_sizes(length, 8) == sizes


def test_documents_are_packed_whole(spark, documents):
    rng = random.Random(5)
    texts = [None, "", " ", "a b", "中文 text's", "x " * 900] + [
        " ".join(rng.choice(["the", "Straße", "I'll", "12"]) for _ in range(rng.randint(1, 60))) for _ in range(40)
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same"), (7, texts[7])]
    path = vocabulary_file()
    library = Tokenizer.from_file(path)
    found = pack_documents(documents(rows).repartition(3), path, capacity=64).collect()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        own = [r for r in found if r.doc_id == doc_id]
        start = 0
        for piece, size in enumerate(piece_sizes(len(ids), 64)):
            whole = zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())
            assert any((r.piece, r.start, r.length, r.ids_crc32) == (piece, start, size, whole) for r in own)
            start += size
    assert len(found) == sum(len(piece_sizes(len(library.encode(t or "").ids) + 1, 64)) for _, t in rows)
    for _, places in itertools.groupby(sorted(found, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        at = 0
        for r in places:
            assert r.offset == at
            at += r.length
        assert at <= 64


def test_empty_table(spark, documents):
    assert pack_documents(documents([(1, "a")]).limit(0), vocabulary_file()).count() == 0
