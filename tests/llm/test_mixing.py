from __future__ import annotations

import random
from collections import defaultdict

import duckdb

from courierlens.llm.mixing import LEAF, Mix, mix_documents, mix_sql, mixed_rows

MIX = Mix(
    domains={"a": "one", "b": "one", "c": "two"},
    weights={("one",): 3, ("one", "en"): 2, ("one", "en", "a"): 5, ("two", "de"): 0},
    share=0.7,
    epochs=3,
)


def water(children, budget):
    """Give shares by weight; what a full child cannot hold goes to the others, until it is placed."""
    given = dict.fromkeys(children, 0.0)
    open_ = {c for c, (cap, w) in children.items() if w > 0}
    while open_ and budget > 1e-9:
        level = budget / sum(children[c][1] for c in open_)
        full = {c for c in open_ if children[c][0] - given[c] <= level * children[c][1] + 1e-9}
        for c in full or open_:
            add = children[c][0] - given[c] if full else level * children[c][1]
            given[c] += add
            budget -= add
        if not full:
            break
        open_ -= full
    return given


def quotas(rows, mix):
    caps = defaultdict(float)
    for _, text, lang, source in rows:
        leaf = (mix.domains.get(source, "other"), lang or "?", source or "?")
        caps[leaf] += len((text or "").split()) * mix.epochs
    total = sum(caps.values()) / mix.epochs
    caps = {leaf: cap for leaf, cap in caps.items() if all(mix.weights.get(leaf[:n], 1) > 0 for n in (1, 2, 3))}

    def spread(prefix, budget):
        level = len(prefix) + 1
        children = defaultdict(float)
        for leaf, cap in caps.items():
            if leaf[: len(prefix)] == prefix:
                children[leaf[:level]] += cap
        found = water({c: (cap, mix.weights.get(c, 1)) for c, cap in children.items()}, budget)
        return found if level == 3 else {k: v for c, b in found.items() for k, v in spread(c, b).items()}

    return spread((), int(total * mix.share))


def make_rows(n=400):
    rng = random.Random(4)
    rows = [
        (i, " ".join("w" * rng.randint(0, 30)) or None, rng.choice(["en", "en", "de", None]), rng.choice("aaaabcd"))
        for i in range(n)
    ]
    return [*rows, (None, "x y", "en", None), (5, "tie tie", "en", "b"), (5, "tie tie", "en", "b"), (7, "", "en", "a")]


def test_quotas_and_prefixes(spark, documents):
    rows = make_rows()
    found = mix_documents(documents(rows), MIX).collect()
    wanted = quotas(rows, MIX)
    taken = defaultdict(int)
    for r in found:
        taken[(r.domain, r.language, r.origin)] += r.n_tokens
        assert abs(r.quota - wanted[(r.domain, r.language, r.origin)]) <= 1
    assert all(0 <= wanted[leaf] - n < 31 * 2 + 1 for leaf, n in taken.items())
    assert not any(leaf[:2] == ("two", "de") for leaf in taken)
    assert max(r.epoch for r in found) >= 1


def test_equal_to_sql(spark, documents):
    rows = make_rows()
    found = sorted(map(str, (tuple(r) for r in mix_documents(documents(rows), MIX).collect())))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert found == sorted(map(str, con.execute(mix_sql(MIX)).fetchall()))


def test_a_shortage_below_weight_0_goes_to_the_ancestors_siblings(spark, documents):
    # web can hold 500 of its 600: the rest goes to books, which can hold 1,000
    rows = [(i, "w " * 50, lang, s) for i, (lang, s) in enumerate([("en", "a"), ("de", "a")] * 10 + [("en", "b"), ("en", "b")] * 10)]
    mix = Mix(domains={"a": "web", "b": "books"}, weights={("web", "en"): 0}, share=0.6, epochs=1)
    found = {(r.domain, r.language): r.quota for r in mix_documents(documents(rows), mix).collect()}
    assert found == {("web", "de"): 500, ("books", "en"): 700}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert {(r[3], r[4]): r[6] for r in con.execute(mix_sql(mix)).fetchall()} == found


def test_rows_keep_their_columns(spark, documents):
    rows = [(*r, None, "mine", 7, "x") for r in make_rows(60)]
    extra = "domain string, epoch int, row string"
    table = documents(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    found = mixed_rows(table, MIX)
    assert found.columns == table.columns
    assert {(r.domain, r.epoch, r.row) for r in found.collect()} == {("mine", 7, "x")}
    slim = mix_documents(table, MIX)
    assert sorted(str(r.doc_id) for r in found.collect()) == sorted(str(r.doc_id) for r in slim.collect())
    assert set(LEAF) <= set(slim.columns)


def test_empty_and_blank_tables(spark, documents):
    table = documents([(1, None), (2, "  ")])
    assert mix_documents(table, MIX).count() == 0
    assert mix_documents(table.limit(0), MIX).count() == 0
