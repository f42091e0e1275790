from __future__ import annotations

import hashlib

import numpy as np
import pytest

from courierlens.llm.vectorcodes import CellMemo, cell_step, code_vectors, learn_codec, part_bounds, whole_vectors
from courierlens.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x string, width int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 3) for r in rows], SCHEMA)


def brute(rows, rounds=4, entries=256):
    """Codes by plain distances to all entries, for vectors of one length."""
    kept = [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, [np.floor(1024 * np.float32(v)) for v in r[1]]))
    x = np.array([np.floor(1024 * np.array(r[1], np.float32).astype(float)) for r in kept], np.int64)
    codes, errors, books = [""] * len(x), np.zeros(len(x), np.int64), []
    for a, b in part_bounds(x.shape[1]):
        part, book = x[:, a:b], x[:entries, a:b].copy()
        for r in range(rounds + 1):
            apart = ((part[:, None] - book[None]) ** 2).sum(2)
            entry = apart.argmin(1)
            for e in range(len(book)) if r < rounds else ():
                if (entry == e).any():
                    members = part[entry == e]
                    book[e] = [int(s) // len(members) for s in members.sum(0)]
        codes = [c + f"{e:02x}" for c, e in zip(codes, entry, strict=True)]
        errors += apart.min(1)
        books.append(book)
    by_label = {}
    for r, e in zip(kept, errors.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return sorted(
        ((r[0], c, e, by_label[r[2]], digest, r[2]) for r, c, e in zip(kept, codes, errors.tolist(), strict=True)), key=repr
    )


def coded(spark, rows, parts=3):
    return sorted((tuple(r) for r in code_vectors(vectors(spark, rows).repartition(parts)).collect()), key=repr)


@pytest.mark.parametrize("n, m, k", [(2000, 16, 256), (500, 3, 7), (200, 1, 256), (50, 16, 1), (30, 0, 4)])
def test_memo_equals_all_distances(n, m, k):
    rng = np.random.default_rng(n)
    x = np.floor(rng.normal(0, 128, (n, m))).astype(np.int64)
    book = np.concatenate([x[rng.integers(0, n, k)], x[:2]])  # equal entries are ties
    entry, error = CellMemo(book).assign(x)
    apart = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (entry == apart.argmin(1)).all() and (error == apart.min(1)).all()


def test_cells_leave_few_entries_open_and_are_kept(monkeypatch):
    rng = np.random.default_rng(2)
    book = np.floor(rng.normal(0, 128, (256, 4))).astype(np.int64)
    x = book[rng.integers(0, 256, 5000)] + rng.integers(-3, 4, (5000, 4))
    memo = CellMemo(book)
    memo.assign(x)
    known = dict(memo.open)
    assert cell_step(book) > 1 and len(known) < 3000 and np.mean([len(v) for v in known.values()]) < 60
    memo.assign(x)
    assert memo.open.keys() == known.keys()
    # a memo that is too small is emptied and filled again, with the same results
    monkeypatch.setattr(vectorcodes, "KEEP", 40)
    small = CellMemo(book)
    assert (small.assign(x)[0] == memo.assign(x)[0]).all() and len(small.open) <= 40


def rows_of(n, width=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(v)) for v in rng.normal(0, 0.1, width)], int(i) % 3) for i in rng.permutation(n)]


def test_codes_equal_brute_force(spark):
    rows = rows_of(700)
    assert coded(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = rows_of(20)
    bad = [(90, None, 1), (91, [0.1] * 7 + [None], 1), (92, [float("nan")] * 8, 1), (93, [float("-inf")] * 8, None)]
    odd = [(None, [0.5] * 8, None), (None, [-0.5] * 8, None), *rows[:5], *rows[:5], *[(7, [0.25] * 8, None)] * 300]
    assert coded(spark, rows + bad + odd) == brute(rows + odd)


def test_lengths_apart_and_beyond_bounds(spark):
    rows = [(1, [], 1), (2, [], 1), (3, [0.5], 1), (4, [0.5, 0.25, 1.0, 2.0, 3.0], 1), (5, [3e38, -3e38, 0.0, 0.0], 2)]
    found = {r.vec_id: r for r in code_vectors(vectors(spark, rows)).collect()}
    assert {i: (r.code, r.error) for i, r in found.items()} == {i: ("00000000", 0) for i in range(1, 6)}
    assert found[1].codebooks_sha256 == hashlib.sha256(b"").hexdigest()
    assert part_bounds(5) == [(0, 1), (1, 2), (2, 3), (3, 5)]


def test_codes_decode_to_their_entries(spark):
    table = vectors(spark, rows_of(300))
    codec = learn_codec(whole_vectors(table))
    wanted = {r.vec_id: r.x for r in whole_vectors(table).collect()}
    for r in code_vectors(table).collect():
        assert sum((a - b) ** 2 for a, b in zip(codec.decode(8, r.code), wanted[r.vec_id], strict=True)) == r.error
        assert codec.digest(8) == r.codebooks_sha256


def test_empty_tables(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
