from __future__ import annotations

import numpy as np
import pytest

from courierlens.llm.components import connected_components
from courierlens.llm.graph import Graph, build_lists, link_vectors, local_components, search, unit_rows

SCHEMA = "vec_id long, embedding array<float>, label int, rep long"


def clustered(rng, groups, size, dim=16):
    centers = rng.standard_normal((groups, dim))
    return np.repeat(centers, size, axis=0) + 0.08 * rng.standard_normal((groups * size, dim))


def brute(rows):
    """Links by definition over rows (vec_id, vector, label)."""
    found = {}
    for i, (_, x, lx) in enumerate(rows):
        links = 0
        for k, (_, y, ly) in enumerate(rows):
            if i != k and lx is not None and lx == ly and x and y and len(x) == len(y):
                a, b = np.float32(x).astype(float), np.float32(y).astype(float)
                if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                    links += a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93
        found[i] = links
    return found


def test_search_finds_nearly_all():
    x = unit_rows(clustered(np.random.default_rng(1), 60, 12))
    g = Graph()
    there = x @ x.T >= g.threshold
    hits = search(x, x, build_lists(x, g), g)
    assert not (hits & ~there).any()
    assert hits.sum() / there.sum() > 0.97


def test_local_components():
    label = local_components(7, np.array([1, 2, 5]), np.array([2, 6, 4]))
    assert label.tolist() == [0, 1, 1, 3, 4, 4, 1]


@pytest.mark.parametrize("bounds", [{}, {"cell": 40, "shard": 25}])
def test_links_and_components(spark, bounds):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(clustered(rng, 30, 8))]
    rows += [(1000 + i, rows[4][1], 0) for i in range(30)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[4][1], None)]
    rows += [(2004, rows[4][1][:8], 0), (2005, [1e-30] * 16, 1), (2006, [float("inf")] * 16, 1)]
    table = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA).repartition(4)
    found = {r.vec_id: r for r in link_vectors(table, Graph(**bounds)).collect()}
    assert len(found) == len(rows)
    wanted = brute(rows)
    got = sum(min(found[rows[i][0]].n_links, n) for i, n in wanted.items())
    assert got / sum(wanted.values()) > 0.95
    assert all(found[rows[i][0]].n_links <= n for i, n in wanted.items())
    assert {found[1000 + i].component_id for i in range(30)} == {found[4].component_id}
    for i in (2000, 2001, 2002, 2003, 2004, 2006):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert min(r.audited_recall for r in found.values()) >= 0.9


def test_a_group_over_many_cells_stays_whole(spark):
    rng = np.random.default_rng(4)
    center = rng.standard_normal(32)
    near = center / np.sqrt(center @ center) + 0.035 * rng.standard_normal((300, 32))
    x = np.concatenate([near, 0.18 * rng.standard_normal((600, 32))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    table = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA).repartition(4)
    # some thirty cells for the group, searched in parts of 20 by blocks of 50
    found = {r.vec_id: r for r in link_vectors(table, Graph(cell=10, shard=20, block=50)).collect()}
    wanted = brute(rows)
    got = sum(found[i].n_links for i in wanted)
    assert sum(wanted.values()) > 50_000
    assert all(found[i].n_links <= n for i, n in wanted.items())
    assert got / sum(wanted.values()) >= 0.95
    assert {found[i].component_id for i in range(300) if wanted[i]} == {0}
    assert all(r.audited_recall >= 0.9 for r in found.values())


def test_empty_and_null_ids(spark):
    table = spark.createDataFrame([(None, [1.0, 0.0], 1, 0), (None, [1.0, 0.0], 1, 0)], SCHEMA)
    assert [(r.n_links, r.component_id, r.kept) for r in link_vectors(table).collect()] == [(0, None, True)] * 2
    assert link_vectors(table.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, 50 + i) for i in range(20)] + [(7, 7), (3, 2), (200, 201)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.component for r in found}
    assert {roots[i] for i in range(1, 21)} == {1}
    assert {roots[50 + i] for i in range(20)} == {50} == {roots[100]}
    assert roots[201] == 200 and len(found) == len(roots)
