"""Vector operators against brute force."""

import numpy as np
import pytest

from cargolith.llm import ann
from cargolith.llm.ann import neighbours
from cargolith.llm.vecdup import Grid, vector_duplicates

SCHEMA = "vec_id long, embedding array<float>, score double"


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[: n // 3] = x[0] + rng.normal(scale=0.08, size=(n // 3, 16))  # a hot group
    x[n // 2 : n // 2 + 40] = x[n // 2]
    return x * rng.uniform(0.5, 2, (n, 1)).astype(np.float32)


def frame(spark, x, odd=()):
    return spark.createDataFrame([(i, v.tolist(), 0.0) for i, v in enumerate(x)] + list(odd), SCHEMA)


ODD = [(-1, None, 0.0), (-2, [0.0] * 16, 0.0), (-3, [float("nan")] * 16, 0.0), (-4, [1.0, None] + [0.0] * 14, 0.0), (-5, [1.0, 2.0], 0.0), (None, [1.0] * 16, None)]


def test_links_and_components(spark):
    x = clustered(1500)
    got = {r.vec_id: r for r in vector_duplicates(frame(spark, x, ODD)).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    want = linked.sum(1)
    have = np.array([got[i].n_links for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.99 * want.sum()
    root = np.arange(len(x))
    for _ in range(50):
        root = np.minimum(root, np.where(linked, root[None, :], len(x)).min(1))
    assert np.mean([got[i].component_id == root[i] for i in range(len(x))]) > 0.99
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(-5, 0)) and len(got) == len(x) + 5


def test_neighbours_recall_and_scores(spark):
    x = clustered(3000, 1)
    got = neighbours(frame(spark, x, ODD)).collect()
    y = x.astype(float)
    hits = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
        assert abs(r.score - float(y[r.query_id] @ y[r.vec_id])) < 1e-9 and r.vec_id != r.query_id
    assert set(by) == set(range(0, 3000, 20))
    for q, rows in by.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        s = y @ y[q]
        s[q] = -np.inf
        edge = np.sort(s)[-20]
        hits += sum(r.score >= edge - 1e-9 for r in rows)
        total += 20
    assert hits / total >= 0.9


def test_few_and_no_vectors(spark):
    x = clustered(9)
    got = neighbours(frame(spark, x)).collect()
    assert len(got) == 8 and {r.query_id for r in got} == {0}
    empty = frame(spark, x).limit(0)
    assert neighbours(empty).count() == 0 and vector_duplicates(empty).count() == 0


def test_traversal_is_in_order():
    x = np.random.default_rng(3).normal(size=(400, 8))
    grid = Grid(x, 4000)
    a, b = grid.halves(x[:5])
    for k, cells in enumerate(grid.traverse(x[:5], 12)):
        every = (a[k][:, None] + b[k][None, :]).reshape(-1)
        assert np.allclose(every[cells], np.sort(every)[:12]) and grid.rank(a[k], b[k], int(cells[5])) in (5, 6)  # rounding
    assert ann.TARGET > 0.9


def test_visits_are_fitted_where_links_are_rare(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.normal(size=(60, 32))
    noise -= (noise * x[:60]).sum(1)[:, None] * x[:60]
    x[60:120] = 0.902 * x[:60] + np.sqrt(1 - 0.902**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    got = {r.vec_id: r.n_links for r in vector_duplicates(frame(spark, x)).collect()}
    assert sum(got[k] >= 1 for k in range(60)) >= 59


@pytest.mark.parametrize("kind", ["normal", "clustered"])
def test_recall_of_the_lists_beyond_the_sample(spark, kind):
    """20,000 vectors, more than twice the sample of the bound; no row of the result comes from that sample."""
    rng = np.random.default_rng(5)
    n, size = 20_000, 32
    x = rng.normal(size=(n, size))
    if kind == "clustered":
        x = rng.normal(size=(60, size))[rng.integers(0, 60, n)] * 2 + 0.6 * x
    x = x.astype(np.float32).astype(float)
    got = {}
    for r in neighbours(frame(spark, x)).collect():
        got.setdefault(r.query_id, []).append(r.score)
    hits = 0
    for q, scores in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += (np.array(scores) >= np.partition(s, n - 20)[n - 20] - 1e-9).sum()
    assert len(got) == n // 20 and all(len(s) == 20 for s in got.values())
    print(kind, hits / n)
    assert hits >= 0.95 * n


def test_lengths_are_searched_apart(spark):
    """Vectors of a rarer length link and are found among themselves."""
    x = clustered(200)
    odd = [(1000, [1.0, 2.0], 0.0), (1001, [2.0, 4.0], 0.0), (1002, [-1.0, 0.5], 0.0), (1020, [1.0], 0.0)]
    got = {r.vec_id: r for r in vector_duplicates(frame(spark, x, odd)).collect()}
    assert (got[1000].n_links, got[1001].n_links, got[1002].n_links, got[1020].n_links) == (1, 1, 0, 0) and got[1001].component_id == 1000
    near = {(r.query_id, r.rank): (r.vec_id, r.score) for r in neighbours(frame(spark, x, odd)).collect()}
    assert near[1000, 1] == (1001, 10.0) and near[1000, 2] == (1002, 0.0) and (1000, 3) not in near and (1020, 1) not in near
