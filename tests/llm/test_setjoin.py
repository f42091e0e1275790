from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from courierlens.llm import setjoin
from courierlens.llm.blocks import flat
from courierlens.llm.setjoin import (
    Join,
    buckets,
    candidates,
    close_sets,
    difference,
    first_of_each,
    link_documents,
    may_link,
    meets,
    parity,
    signatures,
)
from courierlens.llm.shingles import linked, shingle_sets


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def joined(one, other):
    return bool(one and other) and 100 * len(one & other) >= 75 * len(one | other)


def brute(rows):
    """Smallest reachable id by definition."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and joined(sets[a], sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        i = rng.randrange(len(w) + 1)
        kind = rng.random()
        if kind < 0.4 and w:
            w[i % len(w)] = rng.choice("pqrstu")
        elif kind < 0.7:
            w.insert(i, rng.choice("pqrstu"))
        elif w:
            del w[i % len(w)]
    return " ".join(w)


def corpus(rng, families, size, longest):
    rows = []
    for _ in range(families):
        text = " ".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(1, longest)))
        rows.append(text)
        for _ in range(rng.randint(0, size)):
            rows.append(edited(rng, rng.choice(rows[-3:]), rng.randint(0, 1 + len(text.split()) // 12)))
    return list(enumerate(rows))


def test_sets_equal_their_definition():
    texts = [None, "", " \t\n", "A", "a b c d", "A b c d e", "a b c d e f a b c d e f", "É é x\x0by z w é", "a " * 999]
    data, offsets = flat(pa.array(texts))
    sets = shingle_sets(data, offsets)
    assert sets.sizes.tolist() == [len(shingles(t)) for t in texts]
    for i, one in enumerate(texts):
        for k, other in enumerate(texts):
            both = len(np.intersect1d(sets.row(i), sets.row(k)))
            assert both == len(shingles(one) & shingles(other))


@pytest.mark.parametrize("seed", range(6))
def test_every_link_is_a_candidate(seed):
    """All pairs that link share a bucket in which their roles meet, or have equal sets."""
    rng = random.Random(seed)
    rows = corpus(rng, 60, 4, [12, 40, 90, 200, 400, 30][seed])
    data, offsets = flat(pa.array([t for _, t in rows]))
    sets = shingle_sets(data, offsets)
    hashes, roles, docs = signatures(sets, Join())
    by_hash = {}
    for h, r, d in zip(hashes.tolist(), roles.tolist(), docs.tolist(), strict=True):
        by_hash.setdefault(h, []).append((d, r))
    met = set()
    for found in by_hash.values():
        for d1, r1 in found:
            for d2, r2 in found:
                if d1 < d2 and meets(np.array([r1]), np.array([r2]))[0]:
                    met.add((d1, d2))
    links = 0
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if linked(sets.row(a), sets.row(b), 75):
                links += 1
                assert (a, b) in met
                assert may_link(len(sets.row(a)), parity(sets.row(a)), len(sets.row(b)), parity(sets.row(b)), 75)
    assert links > 20


def test_close_sets_keep_links_and_see_each_pair_once():
    rng = random.Random(3)
    rows = corpus(rng, 40, 4, 80)
    sets = shingle_sets(*flat(pa.array([t for _, t in rows])))
    keep = [i for i in range(len(rows)) if len(sets.row(i))]
    marks = [parity(sets.row(i)) for i in keep]
    pairs = [(i, k) for i, near in close_sets(sets.sizes[keep], marks, 75) for k in near.tolist()]
    assert len(pairs) == len({frozenset(p) for p in pairs})
    known = {frozenset(p) for p in pairs}
    for i in range(len(keep)):
        for k in range(i):
            if linked(sets.row(keep[i]), sets.row(keep[k]), 75):
                assert frozenset((i, k)) in known


def test_large_buckets_become_stars_and_lists():
    docs = np.array([5, 3, 9, 7, 1, 8, 2])
    roles = np.array([1, 1, 1, 1, 1, 0, 0])
    hashes = np.array([4, 4, 4, 4, 4, 6, 6], np.uint32)
    pairs, count, members, _ = candidates(*buckets(docs, roles, hashes))
    assert pairs.tolist() == [[1, 3], [1, 5], [1, 7], [1, 9]]
    assert count.tolist() == [1] * 4
    assert [m.tolist() for m in members] == [[1, 3, 5, 7, 9]]


def test_difference_bound():
    for a in range(1, 40):
        for b in range(a, 40):
            for both in range(a + 1):
                if 100 * both >= 75 * (a + b - both):
                    assert a + b - 2 * both <= difference(a, b, 75)


@pytest.mark.parametrize("known", [0, 1 << 22])
def test_components_equal_brute_force(spark, documents, monkeypatch, known):
    # asked texts are found by a broadcast of their ids, or by a join of all
    monkeypatch.setattr(setjoin, "KNOWN_IDS", known)
    rng = random.Random(11)
    rows = corpus(rng, 40, 12, 120)
    base = " ".join(rng.choice("abcdefghijklmnopq") for _ in range(150))
    near = [edited(rng, base, rng.randint(0, 6)) for _ in range(60)]
    passage = " ".join(rng.choice("xyz") + str(rng.randrange(50)) for _ in range(60))
    shared = [f"{edited(rng, base[::-1], 40)} {passage} {edited(rng, base, 60)}" for _ in range(30)]
    texts = [t for _, t in rows] + near + shared + [rows[3][1]] * 20 + ["", None, " ", "a b", "A B", "a b c"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    wanted = brute(rows)
    table = documents([*rows, (None, base)]).repartition(5)
    found = link_documents(table).collect()
    assert len(found) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == wanted
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in found if r.doc_id is not None)
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    kept = first_of_each(table)
    assert kept.columns == table.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, c in wanted.items() if i == c)


def test_large_buckets_are_split_and_whole(spark, documents, monkeypatch):
    rng = random.Random(21)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(4000))
    passage = " ".join(word() for _ in range(90))
    other = [f"{passage} {' '.join(word() for _ in range(60))}" for _ in range(90)]
    near = [edited(rng, t, 2) for t in other[:20]]
    rows = list(enumerate([*other, *near]))
    groups, dealt = [], setjoin.open_groups

    def seen(*args):
        out = dealt(*args)
        groups.extend(r["count"] for r in out.groupBy("bucket", "low", "high").count().collect())
        return out

    large, split = [], setjoin.split_large

    def before(rows, *args):
        large.extend(r["count"] for r in rows.groupBy("bucket").count().collect())
        return split(rows, *args)

    monkeypatch.setattr(setjoin, "open_groups", seen)
    monkeypatch.setattr(setjoin, "split_large", before)
    found = link_documents(documents(rows).repartition(4), Join(large=8)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows)
    # the passage makes buckets of most rows; sets that share nothing else are never compared
    assert max(large) > 40
    assert max(groups, default=0) <= 20


@pytest.mark.parametrize("known, moved", [(1 << 22, 0), (1, 1)])
def test_texts_of_large_buckets_stay_where_they_are(spark, documents, monkeypatch, known, moved):
    monkeypatch.setattr(setjoin, "KNOWN_IDS", known)
    read, elements = [], setjoin.elements
    monkeypatch.setattr(setjoin, "elements", lambda texts: read.append(texts) or elements(texts))
    texts = documents([(i, f"a b c d {i % 4}") for i in range(40)]).select("doc_id", "text")
    rows = spark.createDataFrame([(b, i, 0, i, 1) for b in (1, 2) for i in range(0, 16, b)], "bucket long, rep long, role int, component long, n_shingles long")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = setjoin.split_large(rows, texts, Join()).collect()
        plan = read[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # the shingles are those of the buckets' own sets; texts are shuffled only if too many are asked for
    assert {r.doc_id for r in read[0].collect()} == set(range(16))
    assert plan.count("SortMergeJoin") == moved
    assert {(r.rep, r.role, r.n_shingles) for r in split} == {(i, 0, 1) for i in range(16)}


def test_empty_tables_and_blank_texts(spark, documents):
    table = documents([(1, None), (2, " "), (3, "")])
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(table).collect()) == [
        (1, 0, 1),
        (2, 0, 2),
        (3, 0, 3),
    ]
    assert link_documents(table.limit(0)).count() == 0


def test_rows_of_one_id_with_other_texts_stay(spark, documents):
    schema = "doc_id long, text string, lang string, kept_row string, kept_hash long"
    rows = [(1, "alpha beta gamma", "en", "x", 5), (1, "quite other words here", "de", "x", 5)]
    rows += [(2, "alpha beta gamma", "en", "y", 6), (3, None, "a", "z", 7), (3, None, "b", "z", 7)]
    table = documents(rows, schema)
    for _ in range(2):
        found = first_of_each(table.repartition(3))
        assert found.columns == table.columns
        got = sorted((r.doc_id, r.text or "", r.kept_row) for r in found.collect())
        assert got == [(1, "alpha beta gamma", "x"), (1, "quite other words here", "x"), (3, "", "z")]
