"""Density clusters against a brute-force version."""

import numpy as np
import pytest

from cargolith.operators.density import _cubes_above, _near, density_clusters
from cargolith.operators.linked import components
from cargolith.session import drop_stash


def brute(ids, x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label, number = np.full(len(x), -1), 0
    for i in np.argsort(ids):
        if not core[i] or label[i] >= 0:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if label[j] >= 0:
                continue
            label[j] = number
            if core[j]:
                todo += np.flatnonzero(near[j] & (label < 0)).tolist()
        number += 1
    return {int(i): int(c) for i, c in zip(ids, label)}


def got(spark, ids, x, eps, least, odd=()):
    rows = [(int(i), v.tolist(), "a", 1.0) for i, v in zip(ids, x)] + [(i, v, None, None) for i, v in odd]
    points = spark.createDataFrame(rows, "k long, v array<double>, site string, x double")
    return {r.k: r.cluster for r in density_clusters(points, "k", "v", x.shape[1], eps, least).collect()}


@pytest.mark.parametrize("size", [1, 2, 4])
def test_against_brute_force(spark, size):
    rng = np.random.default_rng(size)
    hot = np.full((150, size), 0.31) + rng.uniform(-0.01, 0.01, (150, size))  # a third of all points in one cell
    x = np.concatenate((hot, np.full((60, size), 2.0), rng.normal(scale=1.2, size=(200, size)), rng.uniform(-4, 4, (60, size)), np.arange(20)[:, None] * 0.45 + np.full((20, size), 6.0)))
    ids = rng.permutation(len(x)) * 3 - 100
    odd = [(-1000, None), (-1001, [float("nan")] * size), (-1002, [1.0] * (size + 1)), (-1003, [None] * size)]
    out = got(spark, ids, x, 0.5, 5, odd)
    assert {i: out.pop(i) for i, _ in odd} == {i: -1 for i, _ in odd}
    assert out == brute(ids, x, 0.5, 5)


def test_cells_that_touch_at_a_distance_of_eps(spark):
    """Two dense clouds: their boxes leave the question open for several levels."""
    rng = np.random.default_rng(9)
    a = rng.uniform(0, 0.3, (200, 2))
    b = rng.uniform(0, 0.3, (200, 2)) + [0.3 + 0.49, 0]
    x = np.concatenate((a, b, [[0.3 + 0.245, 0.15]]))
    assert got(spark, np.arange(len(x)), x, 0.5, 5) == brute(np.arange(len(x)), x, 0.5, 5)


def test_no_points(spark):
    assert got(spark, np.zeros(0, int), np.zeros((0, 2)), 0.5, 5) == {}
    assert got(spark, np.arange(3), np.zeros((3, 2)), 0.5, 5) == {0: -1, 1: -1, 2: -1}


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (9, 8), (5, 5), (7, 9), (7, 7)] + [(100 + i, 101 + i) for i in range(30)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{100 + i: 100 for i in range(31)}}


def test_near_cells_against_all_pairs(spark):
    """Cubes are opened one side at a time in many tasks; pairs within one part are left out, each other pair comes once."""
    rng = np.random.default_rng(3)
    grid = np.unique(rng.integers(-6, 7, (150, 3)), axis=0)
    side, eps = 0.5 / 3**0.5 * (1 - 1e-12), 0.5
    lo, hi = (grid + 0.2) * side, (grid + 0.8) * side
    rows = [(i, g.tolist(), a.tolist(), b.tolist(), i % 4) for i, (g, a, b) in enumerate(zip(grid, lo, hi))]
    cells = _cubes_above(spark.createDataFrame(rows, "cell long, grid array<bigint>, lo array<double>, hi array<double>, part long"), 1)
    apart = np.maximum(0, np.maximum(lo[:, None] - hi[None], lo[None] - hi[:, None]))
    close = (apart**2).sum(-1) <= eps * eps
    frames = []
    one = _near(cells, cells, 3, eps, 1, frames)
    assert sorted((min(r), max(r)) for r in one.collect()) == [(i, j) for i in range(len(grid)) for j in range(i, len(grid)) if close[i, j] and i % 4 != j % 4]
    left = cells.filter("cell < 30").drop("part")
    two = _near(left, cells.drop("part"), 3, eps, 1, frames)
    assert sorted((r.a, r.b) for r in two.collect()) == [(i, j) for i in range(30) for j in range(len(grid)) if close[i, j]]
    drop_stash(*frames)
