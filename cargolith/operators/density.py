"""Density clusters (DBSCAN) as joins of grid cells.

Equal vectors collapse into one site with a count. Sites fall into cells with a diagonal of ``eps``: within a
cell all sites are neighbours. A cell with ``least`` points therefore holds core points only, without one
comparison, however many points it has; only sites of sparse cells (fewer than ``least`` points) look into
other cells. Cells carry the box of their points: a box wholly within ``eps`` counts as a whole, one wholly
outside not at all. What a box leaves open is answered by its children, half as wide, and so on down to single
sites; a site stops when it has its ``least`` neighbours, a pair of cells at the first pair of core points
within ``eps``, and pairs of cells that are connected already are not looked at.

Near cells are found from cubes wider than ``eps`` down: a walk over the dimensions finds cubes that touch, and
pairs are opened while the boxes of their points are near. How many cells lie near another is bounded by
geometry, not by the number of rows. Sites look at the cells of their own cube first, and links are sought there
and across faces first; the full search serves sites that lack neighbours and cells that are still apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.operators.keyed import group_slots, meet, with_group
from cargolith.operators.linked import components
from cargolith.operators.ranking import row_numbers
from cargolith.session import drop_stash, stash

#: Boxes with at most so many sites open into their sites rather than into halves.
LEAF = 32
NOISE = -1
col = F.col


def _apart(size: int, a: str, b: str, farthest: bool) -> Column:
    """Squared distance of the nearest (or farthest) corners of boxes ``a`` and ``b`` (prefixes of lo and hi)."""
    out = F.lit(0.0)
    for i in range(size):
        one, two = col(f"{b}hi")[i] - col(f"{a}lo")[i], col(f"{a}hi")[i] - col(f"{b}lo")[i]
        gap = F.greatest(one, two) if farthest else F.greatest(F.lit(0.0), -one, -two)
        out = out + gap * gap
    return out


def _box(size: int) -> list[Column]:
    return [F.array(*[f(col("x")[i]) for i in range(size)]).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"))]


def _grid(side: float, level: int) -> Column:
    """The cell at ``level``; halving is exact, so that children lie within their parent."""
    return F.transform("x", lambda v: F.floor(v / F.lit(side) * F.lit(float(2**level))))


class _Tree:
    """Boxes of sites below cells, made level by level for the cells that are asked for."""

    def __init__(self, sites: DataFrame, size: int, side: float):
        self.sites, self.size, self.side = sites, size, side

    def children(self, open_: DataFrame, prefix: str, level: int) -> DataFrame:
        """``open_`` with the boxes of side ``prefix`` (cell, own, few, lo, hi) replaced by their children."""
        p, size = prefix, self.size
        asked = open_.select(col(f"{p}cell").alias("cell")).distinct()
        below = self.sites.join(asked, "cell", "left_semi").select(
            "cell", "x", "n", _grid(self.side, level - 1).alias("up"), _grid(self.side, level).alias("own"))
        boxes = below.groupBy("cell", "up", "own").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) <= LEAF).alias("few"), *_box(size))
        single = below.select("cell", "up", "own", "n", F.lit(True).alias("few"), col("x").alias("lo"), col("x").alias("hi"))
        out = None
        for kind, nodes in ((~col(f"{p}few"), boxes), (col(f"{p}few"), single)):
            named = nodes.select(col("cell").alias(f"{p}cell"), col("up").alias(f"{p}own"), *[col(c).alias(f"__{c}") for c in ("own", "n", "few", "lo", "hi")])
            part = open_.filter(kind).drop(f"{p}n", f"{p}few", f"{p}lo", f"{p}hi").join(named, [f"{p}cell", f"{p}own"]).drop(f"{p}own")
            part = part.withColumnsRenamed({f"__{c}": f"{p}{c}" for c in ("own", "n", "few", "lo", "hi")}).select(*open_.columns)
            out = part if out is None else out.unionByName(part)
        return out


def _cubes_above(cells: DataFrame, top: int) -> DataFrame:
    """``cells`` with ``c0`` (the cell) to ``c{top}``: the smallest cell in its cube of 1, 2, 4 ... cells a side."""
    out = cells.withColumn("c0", col("cell"))
    for k in range(1, top + 1):
        out = out.withColumn(f"c{k}", F.min("cell").over(Window.partitionBy(F.transform("grid", lambda v: F.shiftright(v, k)))))  # noqa: B023
    return out


def _touching(left: DataFrame, right: DataFrame, size: int) -> DataFrame:
    """Pairs of cubes ``p`` and ``q`` whose places (at) differ by one at most. Prefixes that no cube has end the walk early."""
    walk = left.select("pcube", col("pat").alias("at"), F.array().cast("array<bigint>").alias("to"))
    for j in range(size):
        step = F.explode(F.array(*[F.concat("to", F.array(col("at")[j] + d)) for d in (-1, 0, 1)]))
        walk = walk.select("pcube", "at", step.alias("to")).join(right.select(F.slice("qat", 1, j + 1).alias("to")).distinct(), "to", "left_semi")
    return walk.select("pcube", "to").join(right.withColumnRenamed("qat", "to"), "to").join(left.drop("pat"), "pcube").drop("to")


def _near(left: DataFrame, right: DataFrame, size: int, eps: float, top: int, frames: list) -> DataFrame:
    """(a, b): cells of ``left`` and ``right`` whose boxes lie within ``eps``.

    From cubes wider than ``eps`` down to cells: a pair of cubes is opened while the boxes of what they hold are near.
    With a column ``part``, pairs within one part are left out. If ``left`` is ``right``, each pair comes once.
    """
    parted, reach = "part" in left.columns, eps * eps
    count = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = None
    for k in range(top, -1, -1):
        named = _apart(size, "p", "q", False) <= reach
        if parted:
            named = named & ~((col("pmin") == col("pmax")) & (col("qmin") == col("qmax")) & (col("pmin") == col("qmin")))
        sides = {}
        for p, cells in (("p", left), ("q", right)):
            link = F.first(F.transform("grid", lambda v: F.shiftright(v, top))).alias(f"{p}at") if k == top else F.first(f"c{k + 1}").alias(f"{p}up")
            extra = [f("part").alias(f"{p}{n}") for f, n in ((F.min, "min"), (F.max, "max"))] if parted else []
            boxes = [F.array(*[f(col(n)[i]) for i in range(size)]).alias(f"{p}{n}") for f, n in ((F.min, "lo"), (F.max, "hi"))]
            sides[p] = cells.groupBy(col(f"c{k}").alias(f"{p}cube")).agg(link, *boxes, *extra)
        if k == top:
            held = {p: stash(x, "cubes") for p, x in sides.items()}
            frames += held.values()
            pairs = _touching(held["p"].repartition(count, "pcube"), held["q"], size).filter(named)
        else:
            # One side at a time. The rows in are few and open into many: an explicit count keeps them spread.
            pairs = pairs.withColumn("same", col("pcube") == col("qcube"))
            for p, x in sides.items():
                rest = [c for c in pairs.columns if c[0] != p]
                opened = pairs.select(col(f"{p}cube").alias(f"{p}up"), *rest).repartition(count, f"{p}up")
                pairs = opened.join(x, f"{p}up").drop(f"{p}up").filter(named)
        if left is right:  # cubes of different parents come in one order already
            pairs = pairs.filter("pcube <= qcube" if k == top else "not same or pcube <= qcube")
        pairs = stash(pairs.drop("same"), "near")
        frames.append(pairs)
    return pairs.select(col("pcube").alias("a"), col("qcube").alias("b"))


def density_clusters(points: DataFrame, key: str, vector: str, size: int, eps: float = 0.5, least: int = 5) -> DataFrame:
    """``key``, ``cluster``: 0, 1, ... in the order of each cluster's smallest core key, -1 for noise.

    A point is core if ``least`` points, itself included, lie within ``eps``. Core points within ``eps`` of each
    other share a cluster; another point takes the first cluster that has a core point within ``eps``. Vectors
    that are NULL, of another length than ``size``, or hold NULL or non-finite components are noise. Keys are
    unique and whole numbers.
    """
    side, reach = eps / size**0.5 * (1 - 1e-12), eps * eps
    fine = F.coalesce((F.size(vector) == size) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False))
    used = stash(points.filter(fine).select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("x")), "points")
    sites = used.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("site")).withColumn("grid", _grid(side, 0))
    held = stash(sites, "sites")
    placed = stash(
        with_group(held, ["grid"], "site", [F.min("site").alias("cell"), F.sum("n").alias("cell_n"), (F.count(F.lit(1)) <= LEAF).alias("few")]), "placed")
    cells = stash(placed.groupBy("cell").agg(F.first("grid").alias("grid"), F.sum("n").alias("n"), F.first("few").alias("few"), *_box(size)), "cells")
    top = next(k for k in range(64) if 2**k >= eps / side * (1 + 1e-6))
    cells, plain = stash(_cubes_above(cells, top), "cells"), cells
    frames = [used, held, placed, plain, cells]
    dense = placed.filter(col("cell_n") >= least)
    sparse = placed.filter(col("cell_n") < least)

    # --- neighbours of the sites of sparse cells
    probes = sparse.select("site", col("cell").alias("a"), col("x").alias("plo"), col("x").alias("phi"))
    low = cells.filter(col("n") < least)
    around = cells.select(col("cell").alias("b"), col("cell").alias("qcell"), col("grid").alias("qown"), col("n").alias("qn"), col("few").alias("qfew"),
                          col("lo").alias("qlo"), col("hi").alias("qhi"))
    counts = sparse.select("site", F.lit(0).cast("long").alias("count"))
    # First the cells of the same cube, then all near ones, for sites that still lack neighbours.
    for first in (True, False):
        if first:
            near = low.select(col("cell").alias("a"), "c1").join(cells.select(col("cell").alias("b"), "c1"), "c1").drop("c1")
        else:
            lacking = sparse.join(counts.filter(col("count") < least), "site", "left_semi")
            low = stash(low.join(lacking.select("cell").distinct(), "cell", "left_semi").withColumn("part", col("c1")), "low")
            frames.append(low)
            near = _near(low, cells.withColumn("part", col("c1")), size, eps, top, frames)
            probes = probes.join(lacking.select("site"), "site", "left_semi")
        open_ = probes.join(near, "a").join(around, "b").drop("a", "b")
        tree, level = _Tree(placed, size, side), 0
        while True:
            met = stash(open_.filter(_apart(size, "p", "q", False) <= reach).withColumn("inside", _apart(size, "p", "q", True) <= reach), "met")
            inside = met.filter("inside").groupBy("site").agg(F.sum("qn").alias("more"))
            frames.append(met)
            counts = stash(counts.join(inside, "site", "left").select("site", (col("count") + F.coalesce("more", F.lit(0))).alias("count")), "counts")
            frames.append(counts)
            open_ = met.filter("not inside").drop("inside").join(counts.filter(col("count") < least), "site", "left_semi")
            if open_.isEmpty():
                break
            level += 1
            open_ = tree.children(open_, "q", level)
    enough = counts.filter(col("count") >= least).select("site")
    core = stash(dense.unionByName(sparse.join(enough, "site", "left_semi")), "core")

    # --- cells that share a cluster
    held_cells = stash(core.groupBy("cell").agg(
        F.first("grid").alias("own"), F.sum("n").alias("n"), (F.count(F.lit(1)) <= LEAF).alias("few"), F.min("site").alias("label"), *_box(size)), "core_cells")
    names = ("cell", "own", "n", "few", "lo", "hi")
    ends = [held_cells.select(col("cell").alias(k), *[col(c).alias(f"{p}{c}") for c in names]) for k, p in (("a", "p"), ("b", "q"))]
    core_cubes = cells.drop("lo", "hi").join(held_cells.select("cell", "lo", "hi"), "cell")
    links = None
    # First cells of one cube and cells with a common face; then near ones that these links leave apart.
    for first in (True, False):
        if first:
            ones = [F.array(*[col("grid")[j] + int(i == j) for j in range(size)]) for i in range(size)]
            faces = core_cubes.select(col("cell").alias("a"), F.explode(F.array(*ones)).alias("grid")).join(core_cubes.select(col("cell").alias("b"), "grid"), "grid").select("a", "b")
            near = core_cubes.select(col("cell").alias("a"), "c1").join(core_cubes.select(col("cell").alias("b"), "c1"), "c1").filter("a < b").select("a", "b").unionByName(faces)
        else:
            joined = components(links).withColumnRenamed("node", "cell")
            core_cubes = stash(core_cubes.join(joined, "cell", "left").withColumn("part", F.coalesce("component", "cell")).drop("component"), "core_cubes")
            frames.append(core_cubes)
            near = _near(core_cubes, core_cubes, size, eps, top, frames)
        open_ = near.join(ends[0], "a").join(ends[1], "b")
        tree, level = _Tree(core, size, side), 0
        while True:
            met = stash(open_.filter(_apart(size, "p", "q", False) <= reach).withColumn("inside", _apart(size, "p", "q", True) <= reach), "met")
            frames.append(met)
            found = stash(met.filter("inside").select("a", "b").distinct() if links is None else links.union(met.filter("inside").select("a", "b")).distinct(), "found")
            frames.append(found)
            links = found
            open_ = met.filter("not inside").drop("inside")
            if open_.isEmpty():
                break
            joined = components(links)
            of = [joined.select(col("node").alias(k), col("component").alias(f"__{k}")) for k in "ab"]
            apart = F.coalesce(col("__a"), col("a")) != F.coalesce(col("__b"), col("b"))
            open_ = open_.join(of[0], "a", "left").join(of[1], "b", "left").filter(apart).drop("__a", "__b")
            level += 1
            half = tree.children(open_, "p", level).filter(_apart(size, "p", "q", False) <= reach)
            open_ = tree.children(half, "q", level)
    labelled = held_cells.join(components(links).withColumnRenamed("node", "cell"), "cell", "left").withColumn("component", F.coalesce("component", "cell"))
    roots = labelled.groupBy("component").agg(F.min("label").alias("first"))
    cluster = row_numbers(roots, ["first"], "cluster", start=0)
    grouped = stash(labelled.drop("label").join(cluster.select("component", "cluster"), "component").drop("component"), "clusters")

    # --- points at the border
    border = sparse.join(enough, "site", "left_anti").select("site", col("cell").alias("a"), col("x").alias("plo"), col("x").alias("phi"))
    outer = cells.join(border.select(col("a").alias("cell")).distinct(), "cell", "left_semi")
    near = _near(outer, core_cubes.drop("part"), size, eps, top, frames)
    open_ = border.join(near, "a").join(grouped.select(col("cell").alias("b"), *[col(c).alias(f"q{c}") for c in names], "cluster"), "b").drop("a", "b")
    best, level = None, 0
    while True:
        met = stash(open_.filter(_apart(size, "p", "q", False) <= reach).withColumn("inside", _apart(size, "p", "q", True) <= reach), "met")
        frames.append(met)
        hits = met.filter("inside").select("site", "cluster")
        best = stash((hits if best is None else best.union(hits)).groupBy("site").agg(F.min("cluster").alias("cluster")), "best")
        frames.append(best)
        known = best.select("site", col("cluster").alias("__best"))
        open_ = met.filter("not inside").drop("inside").join(known, "site", "left").filter(col("__best").isNull() | (col("cluster") < col("__best"))).drop("__best")
        if open_.isEmpty():
            break
        level += 1
        open_ = tree.children(open_, "q", level)
    of_cell = grouped.select("cell", col("cluster").cast("long").alias("cluster"))
    of_core = core.join(of_cell, "cell").select("site", "cluster")
    of_site = of_core.unionByName(best.select("site", col("cluster").cast("long").alias("cluster")))

    # Back to the points: each vector's cluster, once for every slot of its points.
    slots = group_slots(used, ["x"], "id", [F.min("id").alias("site")]).join(of_site, "site", "left").select("x", "__slot", "cluster")
    placed_points = meet(used, slots, ["x"], "id").select("id", "cluster")
    rest = points.filter(~fine).select(col(key).cast("long").alias("id"), F.lit(None).cast("long").alias("cluster"))
    out = stash(placed_points.union(rest).select(col("id").alias(key), F.coalesce("cluster", F.lit(NOISE).cast("long")).alias("cluster")), "density")
    drop_stash(core, held_cells, grouped, *frames)
    return out
