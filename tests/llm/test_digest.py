from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from courierlens.llm.digest import (
    BUCKETS,
    HEX,
    bucket_counts,
    difference,
    edited,
    fingerprint,
    fingerprint_documents,
    likeness,
)


def as_bytes(text):
    return np.frombuffer((text or "").encode(), np.uint8)


def brute_edit(own, after):
    half = len(own) // 2
    return own[: len(own) - half] + after[:half]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=30), st.text(max_size=30))
def test_edits_and_bounds(one, other):
    assert edited(as_bytes(one), as_bytes(other)).tobytes().decode() == brute_edit(one, other)
    a, b = fingerprint(as_bytes(one)), fingerprint(as_bytes(other))
    assert len(a) == HEX
    assert difference(a, b) == difference(b, a) >= 0
    assert 0 <= likeness(a, b) <= 1 == likeness(a, a)


def test_counts_by_definition():
    data = as_bytes("abcdefgh" * 3)
    assert bucket_counts(data).sum() == (len(data) - 2) + 2 * (len(data) - 3)
    assert bucket_counts(as_bytes("ab")).sum() == 0
    assert len(bucket_counts(data)) == BUCKETS


def rows_of_all_kinds():
    rng = random.Random(1)
    words = [f"wö{i}" for i in range(300)]
    rows = [(i * 7, " ".join(rng.choices(words, k=rng.randint(20, 400)))) for i in range(60)]
    return [*rows, (3, None), (4, ""), (8, "x"), (5000, "long " * 20_000), (9, "tie"), (9, "tie")]


def test_documents_in_order(spark, documents):
    rows = rows_of_all_kinds()
    found = fingerprint_documents(documents(rows).repartition(5)).collect()
    assert len(found) == len(rows)
    ordered = sorted(rows, key=lambda r: r[0])
    for i, (doc_id, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1] or ""
        changed = brute_edit(text or "", after)
        own = [r for r in found if r.doc_id == doc_id]
        assert hashlib.sha256(changed.encode()).hexdigest() in {r.edited_sha256 for r in own}
        assert {r.n_chars for r in own} == {len(text or "")}
        assert {r.fingerprint for r in own} == {fingerprint(as_bytes(text))}
        assert fingerprint(as_bytes(changed)) in {r.edited_fingerprint for r in own}
    long = [r for r in found if r.n_chars > 200 and r.doc_id != 5000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95


def test_few_rows(spark, documents):
    one = fingerprint_documents(documents([(4, "alone here")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"alonealone").hexdigest() or one[0].n_chars == 10
    assert one[0].near_next == 1.0
    assert fingerprint_documents(documents([(4, "a")]).limit(0)).count() == 0
    nulls = fingerprint_documents(documents([(None, "b c"), (None, None), (1, "z")])).collect()
    assert sorted(str(r.doc_id) for r in nulls) == ["1", "None", "None"]
