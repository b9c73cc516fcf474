"""Micro-grids, properties and plans against each other."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrascape.functions import crs, expr, scalars
from terrascape.model import Grid
from terrascape.operators import erode, focal, grid, hydro, masks, network, reach, vector
from terrascape.plans import catalogue_files  # noqa: F401 (adds to the catalogue)
from terrascape.plans import catalogue, workflow
from terrascape.sources import tables
from terrascape.sources.fixtures import CELLS, FOCAL


def grid_of(spark, text, source="S"):
    """Cells of a drawing: a digit is friction, ``#`` a wall, ``N`` NaN, ``S`` a source."""
    value = {"#": 0.0, "N": float("nan"), "S": 1.0}
    rows = [("a", i, j, value.get(ch, float(ch) if ch.isdigit() else 0.0), ch == source) for i, line in enumerate(text.split()) for j, ch in enumerate(line)]
    return spark.createDataFrame(rows, "aoi_id string, row_i int, col_j int, friction float, source boolean")


def times(df):
    return {(r.row_i, r.col_j): r.t for r in df.collect()}


DRAWINGS = {
    "bound": ("S1111", 2.0),
    "diagonal": ("S11 111 111", 9.0),
    "entering": ("S51", 9.0),
    "wall": ("S#111 1#1#1 1#1#1 1###1 11111", 99.0),
    "no frontier": ("SSS SSS", 5.0),
    "nan": ("S1N1 1111", 9.0),
    "nothing": ("11 11", 3.0),
}


@pytest.mark.parametrize("name", DRAWINGS)
def test_reach_plans_agree(spark, name):
    text, limit = DRAWINGS[name]
    cells = grid_of(spark, text)
    group = times(reach.reach(cells, limit, plan="group"))
    assert group == times(reach.reach_relaxed(cells, limit)) == times(reach.reach(cells, limit, plan="tiles", tile=2))
    if name == "bound":
        assert group == {(0, 0): 0, (0, 1): 1, (0, 2): 2}
    if name == "diagonal":
        assert group[1, 1] == np.float32(math.sqrt(2)) and group[2, 2] == np.float32(math.sqrt(2)) + np.float32(math.sqrt(2))
    if name == "entering":
        assert group == {(0, 0): 0, (0, 1): 5, (0, 2): 6}
    if name == "no frontier":
        assert len(group) == 6 and set(group.values()) == {0}
    if name == "nan":
        assert (0, 2) not in group and (0, 3) in group


def test_reach_grows_with_time(spark):
    cells = grid_of(spark, "S3142 11511 92614 11111")
    found = [set(times(reach.reach(cells, t))) for t in (0, 2, 5, 50)]
    assert all(a <= b for a, b in zip(found, found[1:])) and len(found[0]) == 1


def test_masks(spark):
    layers = spark.createDataFrame([("a", "m", 0, 0, 5), ("a", "m", 0, 1, 2), ("a", "n", 0, 1, 7), ("b", "n", 3, 3, 1)], "aoi_id string, mask_id string, row_i int, col_j int, pop long")
    got = {(r.row_i, r.col_j): r["pop"] for r in masks.combine(layers).collect()}
    assert got == {(0, 0): 5, (0, 1): 7, (3, 3): 1}
    wide = {r.aoi: (r.m, r.n, r["combined pop"]) for r in masks.wide(masks.sums(layers, ["aoi_id"]), ["m", "n"]).collect()}
    assert wide == {"a": ("7", "7", "12"), "b": ("n/a", "1", "1")}
    edge = spark.createDataFrame([(0.0, 5), (1e-15, 5), (1e-13, 5), (1.0, -9), (float("nan"), 5)], "m double, pop long")
    assert [r[0] for r in edge.select(masks.covered_downstream(F.col("m"), F.col("pop"))).collect()] == [0, 0, 5, 0, 0]
    assert [r[0] for r in edge.select(masks.covered_by_reach(F.col("m"), F.col("pop"))).collect()][:2] == [0, 5]


def test_expressions(spark):
    df = spark.createDataFrame([(1.0,), (-2.0,), (float("nan"),), (12.0,), (0.0,)], "v double")
    good = {
        "value > 0": [True, False, False, True, False],
        "(value>0)&(value<9)": [True, False, False, False, False],
        "~(value > 0) | (value == 12)": [False, True, True, True, True],
        "np.abs(value) >= 2": [False, True, False, True, False],
        "np.isnan(value)": [False, False, True, False, False],
        "value != value": [False, False, True, False, False],
        "np.where(value > 5, 1, 0) == 1": [False, False, False, True, False],
        "value * 2 - 1 > 0.5": [True, False, False, True, False],
        "-value ** 2 < 0": [True, True, False, True, False],
        "np.logical_and(value > 0, value < 2)": [True, False, False, False, False],
        "value": [True, True, True, True, False],
    }
    for text, want in good.items():
        expr.check_expression(text)
        assert [bool(r[0]) for r in df.select(expr.compile_expression(text, F.col("v"))).collect()] == want, text
    for text in ("__import__('os')", "value.__class__", "open('x')", "np.load('x')", "0 < value < 3", "value and 1", "lambda: 1", "[1]", "x > 1", "value if 1 else 2", "", "value >", "np.abs", "'a'"):
        with pytest.raises(expr.ExpressionError):
            expr.compile_expression(text, F.col("v"))
        with pytest.raises(expr.ExpressionError):
            expr.check_expression(text)


def test_condition_without_data(spark):
    df = spark.createDataFrame([(0, 0, None), (0, 1, 5.0)], "row_i int, col_j int, v double")
    assert [r.hit for r in masks.condition(df, "value > 0").orderBy("col_j").collect()] == [0, 1]


def test_disc_and_distance(spark):
    assert [focal.disc_kernel(spark, r).count() for r in (0, 1, 6)] == [1, 5, 113]
    assert [focal.pixels_of(m, 1) for m in (4.5, 5.5)] == [4, 6] and focal.pixels_of(5000, 900) == 6
    marked = [(3, 3), (4, 9), (5, 4)]
    df = spark.createDataFrame(marked, "row_i int, col_j int")
    want = Counter((r + i, c + j) for r, c in marked for i in range(-4, 5) for j in range(-4, 5) if i * i + j * j <= 16)
    assert {(r.row_i, r.col_j): r.hits for r in focal.dilate(df, 4).collect()} == dict(want)
    cells = spark.createDataFrame([(i, j, (i, j) in marked) for i in range(9) for j in range(12)], "row_i int, col_j int, marked boolean")
    got = {(r.row_i, r.col_j): r.d2 for r in focal.distance(cells).collect()}
    assert got == {(i, j): min((i - a) ** 2 + (j - b) ** 2 for a, b in marked) for i in range(9) for j in range(12)}
    assert {r.d2 for r in focal.distance(cells.withColumn("marked", F.lit(False))).collect()} == {None}
    near = focal.distance(cells).where(masks.within_distance(F.lit(1), F.sqrt("d2"), 10.0, 20.0))
    assert {r.d2 for r in near.collect()} == {1, 2, 4}


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "hybas_id long, next_down long")


def test_network(spark):
    edges = edges_of(spark, [(1, 0), (2, 1), (3, 1), (4, 2), (5, 99), (6, 7), (7, 6)])
    seeds = edges.where("hybas_id IN (4, 5, 6)")
    assert {r.hybas_id for r in network.downstream_closure(seeds, edges).collect()} == {4, 2, 1, 5, 99, 6, 7}
    sinks = {r.hybas_id: r.next_sink for r in network.terminal_sinks(edges).collect()}
    assert sinks == {1: 1, 2: 1, 3: 1, 4: 1, 5: 99, 99: 99, 6: None, 7: None}
    ups = {(r.seed, r.hybas_id) for r in network.upstream_closure(edges.where("hybas_id = 1"), edges).collect()}
    assert ups == {(1, n) for n in (1, 2, 3, 4)}
    assert {r.hybas_id: r.upstream for r in network.upstream_adjacency(edges, edges).collect()} == {1: "2,3", 2: "4", 6: "7", 7: "6"}
    with pytest.raises(ValueError, match="terminal sink"):
        network.check_sinks(spark.createDataFrame([(5, None)], "hybas_id long, next_sink long"))
    once = network.downstream_closure(seeds, edges)
    assert network.downstream_closure(once, edges).exceptAll(once).count() == 0


def test_greedy(spark):
    rows = [("f", 1, 0, 10, True, 50), ("f", 2, 1, 90, False, 0), ("f", 3, 2, 5, True, 30), ("f", 4, 2, 1, True, 1), ("f", 5, 0, 80, True, 100), ("f", 6, 0, 70, True, 9)]
    df = spark.createDataFrame(rows, "focal_id string, hybas_id long, next_down long, pop_sum long, hits_pp boolean, pp_area_ha long")
    got = [(r.hybas_id, r.selected) for r in network.greedy_selection(df, 60.0).orderBy("step").collect()]
    # from 2 (not in the place, its people count) up to 3, which ends the walk; then 5 passes the budget
    assert got == [(2, False), (3, True), (5, True)]
    assert network.greedy_selection(df.limit(0), 60.0).count() == 0


def test_hydro(spark):
    z = [[9, 9, 9, 9, 9], [9, 3, 2, 3, 9], [9, 2, 1, 2, 9], [9, 3, 2, 5, 9], [9, 9, 7, 9, 9]]
    dem = spark.createDataFrame([(i, j, v) for i, row in enumerate(z) for j, v in enumerate(row)], "row_i int, col_j int, elev long")
    filled = {(r.row_i, r.col_j): r.elev for r in hydro.fill_pits(dem).collect()}
    assert filled[2, 2] == 7 and filled[3, 2] == 7 and filled[4, 2] == 7 and filled[0, 0] == 9 and len(filled) == 25
    assert {(r.row_i, r.col_j): r.elev for r in hydro.fill_pits(dem, "tiles", 2).collect()} == filled
    edges = hydro.flow_edges(dem)
    assert {(r.row_i, r.col_j) for r in hydro.reachable(edges, dem.where("row_i = 4 AND col_j = 2")).collect()} >= {(4, 2), (3, 2), (2, 2)}
    shares = hydro.flow_shares(edges)
    assert all(abs(r.s - 1) < 1e-9 for r in shares.groupBy("row_i", "col_j").agg(F.sum("share").alias("s")).collect())
    acc = {(r.row_i, r.col_j): r.acc for r in hydro.accumulate(shares, dem.select("row_i", "col_j", F.lit(1).alias("w"))).collect()}
    assert abs(acc[2, 2] - 25) < 1e-9  # all water ends in the pit


def terrain(spark, z):
    return spark.createDataFrame([(i, j, v) for i, row in enumerate(z) for j, v in enumerate(row) if v is not None], "row_i int, col_j int, elev long")


def test_filled_pits_let_water_through(spark):
    wall = [20] * 9
    dem = terrain(spark, [wall, [9, 8, 7, 3, 3, 6, 5, 4, 1], wall])
    filled = hydro.fill_pits(dem)
    head = dem.where("row_i = 1 AND col_j = 0")
    got = {(r.row_i, r.col_j) for r in hydro.reachable(hydro.flow_edges(filled), head).collect()}
    assert got == {(1, j) for j in range(9)}
    unfilled = {(r.row_i, r.col_j) for r in hydro.reachable(hydro.flow_edges(dem), head).collect()}
    assert unfilled == {(1, j) for j in range(4)}  # a flat without an outlet keeps its water


def brute_flow(z):
    """Flow edges with flats directed, breadth first, from plain dictionaries."""
    cells = {(i, j): v for i, row in enumerate(z) for j, v in enumerate(row) if v is not None}
    around = {c: [(c[0] + i, c[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0) and (c[0] + i, c[1] + j) in cells] for c in cells}
    still = {c for c in cells if len(around[c]) == 8 and min(cells[n] for n in around[c]) >= cells[c]}

    def steps(first):
        found, front, k = dict.fromkeys(first, 1), list(first), 1
        while front:
            k += 1
            front = [n for n in {n for c in front for n in around[c]} if n in still and n not in found]
            found |= dict.fromkeys(front, k)
        return found

    near = steps([c for c in still if any(cells[n] == cells[c] and n not in still for n in around[c])])
    far = steps([c for c in still if any(cells[n] > cells[c] for n in around[c])])
    level = {c: 2 * near[c] - far.get(c, 0) for c in near}
    edges = {(*c, *n, cells[c] - cells[n], False) for c in cells for n in around[c] if cells[n] < cells[c]}
    for c in level:
        for n in around[c]:
            drop = 2 if n not in still else level[c] - level[n] if n in level else 0
            if cells[n] == cells[c] and drop > 0:
                edges.add((*c, *n, drop, True))
    return cells, edges


@pytest.mark.parametrize("seed,low,tile", [(1, 3, 5), (2, 2, 7), (3, 6, 64)])
def test_flats_and_tiles(spark, seed, low, tile):
    """Flow over random terraces, reached cells and water, against plain walks; tiles of
    several sizes, whose borders flow paths cross more than once."""
    import random

    rng = random.Random(seed)
    z = [[None if rng.random() < 0.02 else rng.randrange(low) for _ in range(23)] for _ in range(19)]
    filled = {(r.row_i, r.col_j): r.elev for r in hydro.fill_pits(terrain(spark, z)).collect()}
    z = [[filled.get((i, j)) for j in range(23)] for i in range(19)]
    dem = terrain(spark, z)
    cells, want = brute_flow(z)
    for plan in ("group", "tiles"):
        edges = hydro.flow_edges(dem, plan=plan, tile=tile)
        assert {(r.row_i, r.col_j, r.to_i, r.to_j, r.drop, r.flat) for r in edges.collect()} == want
    after = {}
    for a, b, c, d, drop, _ in want:
        after.setdefault((a, b), []).append(((c, d), drop / (2**0.5 if a != c and b != d else 1)))
    inner = [c for c in cells if all((c[0] + i, c[1] + j) in cells for i in (-1, 0, 1) for j in (-1, 0, 1))]
    assert all(c in after for c in inner)  # every cell inside drains
    start = rng.sample(sorted(cells), 3)
    seen, front = set(start), list(start)
    while front:
        front = list({n for c in front for n, _ in after.get(c, [])} - seen)
        seen |= set(front)
    marks = spark.createDataFrame(start, "row_i int, col_j int")
    assert {(r.row_i, r.col_j) for r in hydro.reachable(edges, marks, tile=tile).collect()} == seen
    keyed = hydro.reachable(edges, marks.selectExpr("concat('a', row_i) AS aoi_id", "row_i", "col_j"), ["aoi_id"], tile=tile)
    assert {(r.row_i, r.col_j) for r in keyed.collect()} == seen
    water, left = {c: 1.0 for c in cells}, {c: 0 for c in cells}
    for c in after:
        for n, _ in after[c]:
            left[n] += 1
    ready = [c for c in cells if not left[c]]
    while ready:
        c = ready.pop()
        total = sum(s for _, s in after.get(c, []))
        for n, s in after.get(c, []):
            water[n] += water[c] * s / total
            left[n] -= 1
            if not left[n]:
                ready.append(n)
    got = {(r.row_i, r.col_j): r.acc for r in hydro.accumulate(hydro.flow_shares(edges), dem.selectExpr("row_i", "col_j", "1 AS w"), tile=tile).collect()}
    assert got == pytest.approx(water)
    with pytest.raises(Exception, match="cycle"):
        hydro.reachable(spark.createDataFrame([(0, 0, 0, 1), (0, 1, 0, 0)], "row_i int, col_j int, to_i int, to_j int"), marks).count()


SQUARE = [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}], [{"x": 1.0, "y": 1.0}, {"x": 1.0, "y": 3.0}, {"x": 3.0, "y": 3.0}, {"x": 3.0, "y": 1.0}]]
FEATURE = "fid long, rings array<array<struct<x:double,y:double>>>"


def test_vector(spark):
    df = spark.createDataFrame([(1, SQUARE)], FEATURE)
    m = vector.measures(df, ["fid"]).first()
    assert (m.area, m.cx, m.cy) == (12, 2, 2)
    cells = {(r.row_i, r.col_j) for r in vector.rasterize(df, ["fid"], 10, 10).collect()}
    assert cells == {(i, j) for i in range(4) for j in range(4)} - {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert {(r.row_i, r.col_j) for r in vector.touched(df, ["fid"], 10, 10).collect()} >= cells
    sliver = spark.createDataFrame([(2, [[{"x": 0.2, "y": 0.2}, {"x": 2.8, "y": 0.3}, {"x": 0.2, "y": 0.4}]])], FEATURE)
    assert vector.rasterize(sliver, ["fid"], 5, 5).count() == 0
    assert {(r.row_i, r.col_j) for r in vector.touched(sliver, ["fid"], 5, 5).collect()} == {(0, 0), (0, 1), (0, 2)}
    assert vector.extent(vector.boxes(df, ["fid"])).first().asDict() == {"minx": 0, "miny": 0, "maxx": 4, "maxy": 4, "empty": False}
    with pytest.raises(ValueError):
        grid.common_bounds([(0, 0, 1, 1), (2, 2, 3, 3)])


def brute_meet(a, b):
    """Whether two features meet: every pair of edges, and every corner."""
    edges = lambda rings: [(r[k], r[(k + 1) % len(r)]) for r in rings for k in range(len(r))]
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    on = lambda p, q, r: turn(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    def cross(e, f):
        (p, q), (r, s) = e, f
        return turn(p, q, r) * turn(p, q, s) < 0 and turn(r, s, p) * turn(r, s, q) < 0 or on(p, q, r) or on(p, q, s) or on(r, s, p) or on(r, s, q)

    def inside(x, y, rings):
        return sum((p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0] for p, q in edges(rings)) % 2 == 1

    return any(cross(e, f) for e in edges(a) for f in edges(b)) or any(inside(*p, b) for r in a for p in r) or any(inside(*p, a) for r in b for p in r)


@pytest.mark.parametrize("edge_bin", [0.7, 3.0, 100.0])
def test_intersects_join_by_edges(spark, edge_bin):
    """Random features of several rings, holes, touching and nested ones, at bins smaller
    and larger than they are."""
    import random

    rng = random.Random(int(edge_bin))

    def ring(x, y, size, n):
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        return [(round(x + size * math.cos(t), 2), round(y + size * math.sin(t), 2)) for t in angles]

    def feature():
        x, y, size = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(0.2, 6)
        rings = [ring(x, y, size, rng.randint(3, 9))]
        if rng.random() < 0.4:
            rings.append(ring(x, y, size / 3, 5))
        if rng.random() < 0.3:
            rings.append(ring(x + 10, y - 7, 1, 4))
        return rings

    left, right = [feature() for _ in range(30)], [feature() for _ in range(30)]
    left += [[[(0, 0), (8, 0), (8, 8), (0, 8)], [(2, 2), (6, 2), (6, 6), (2, 6)]], [[(30, 30), (31, 30), (31, 31)]]]
    right += [[[(3, 3), (5, 3), (5, 5), (3, 5)]], [[(8, 8), (9, 8), (9, 9)]], [[(1, 0.5), (1.5, 0.5), (1.5, 1)]]]
    points = lambda rings: [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    a = spark.createDataFrame([(k, points(f)) for k, f in enumerate(left)], FEATURE).withColumnRenamed("fid", "a")
    b = spark.createDataFrame([(k, points(f)) for k, f in enumerate(right)], FEATURE).withColumnRenamed("fid", "b")
    got = [(r.a, r.b) for r in vector.intersects_join(a, b, 5.0, "a", "b", edge_bin).collect()]
    assert sorted(got) == sorted((i, j) for i, f in enumerate(left) for j, g in enumerate(right) if brute_meet(f, g))


def inside(x, y, rings):
    edges = [(r[k], r[(k + 1) % len(r)]) for r in rings for k in range(len(r))]
    return sum((p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0] for p, q in edges) % 2 == 1


def test_node_repairs_rings(spark):
    """Bow-ties, stars, rings that overlap, touch or lie on each other: rings without
    crossings, of the same inside."""
    import random

    rng = random.Random(6)
    bow = [[(0, 0), (2, 2), (2, 0), (0, 2)]]
    star = [[(round(10 * math.cos(k * 4 * math.pi / 5), 3), round(10 * math.sin(k * 4 * math.pi / 5), 3)) for k in range(5)]]
    twice = [[(0, 0), (4, 0), (4, 4), (0, 4)], [(2, 2), (6, 2), (6, 6), (2, 6)], [(10, 0), (12, 0), (12, 2), (10, 2)], [(12, 0), (14, 0), (14, 2), (12, 2)]]
    gone = [[(0, 0), (4, 0), (4, 4)], [(0, 0), (4, 0), (4, 4)]]
    features = [bow, star, twice, gone] + [[[(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(3, 8))] for _ in range(rng.randint(1, 2))] for _ in range(25)]
    points = lambda rings: [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    df = spark.createDataFrame([(k, points(f)) for k, f in enumerate(features)], FEATURE)
    got = {r.fid: [[(p.x, p.y) for p in ring] for ring in r.rings] for r in vector.node(df, "fid", 3.0).collect()}
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])) / 2
    assert sorted(area(r) for r in got[0]) == [1, 1] and 3 not in got
    assert len(got[1]) == 5 and sum(map(area, got[2])) == 16 - 4 + 16 - 4 + 8
    for k, rings in enumerate(features):
        for _ in range(60):
            x, y = rng.uniform(-11, 13), rng.uniform(-11, 13)
            assert inside(x, y, rings) == inside(x, y, got.get(k, []))
        grid_area = sum(inside(a / 7 + 0.0123, b / 7 + 0.0217, rings) for a in range(-80, 100) for b in range(-80, 100)) / 49
        assert abs(sum(map(area, got.get(k, []))) - grid_area) < 0.1 * grid_area + 2


def test_long_edges_have_few_bins(spark):
    """An edge lies in bins along its way, not in all of its box."""
    edge = spark.createDataFrame([(1, 0.0, 0.0, 1000.0, 1000.0), (2, 0.0, 0.5, 1000.0, 0.5)], "lk int, x1 double, y1 double, x2 double, y2 double")
    assert vector.edge_bins(edge, 1.0).groupBy("lk").count().agg(F.max("count")).first()[0] < 3100


def test_tiles_write_what_changes(spark, monkeypatch):
    """A front that passes a row of tiles writes the tiles it meets, not the others."""
    written = []

    class Told(reach.Stage):
        def __init__(self, df, partition_by=None):
            super().__init__(df, partition_by)
            if partition_by:
                written.append(self.df.where("NOT mail").count())

    monkeypatch.setattr(reach, "Stage", Told)
    cells = grid_of(spark, " ".join("S" + "1" * 79 for _ in range(4)))
    got = reach.reach(cells, 1e6, plan="tiles", tile=4)
    assert got.count() == 320
    assert written[0] == 320 and len(written) >= 20
    assert max(written[2:]) <= 4 * 16 and sum(written) <= 320 + 3 * 320


def test_repair_and_full_extent(spark):
    p = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    rows = [(1, [p((0, 0), (2, 0), (2, 0), (2, 2), (0, 0))]), (2, [p((1, 1), (1, 1))]), (3, [])]
    got = vector.repair(spark.createDataFrame(rows, FEATURE)).collect()
    assert [(r.fid, len(r.rings[0])) for r in got] == [(1, 3)]
    grids = [Grid(0, 10, 1, -1, 10, 10, "EPSG:4326"), Grid(4, 12, 1, -1, 10, 10, "EPSG:4326")]
    area = vector.boxes(workflow.full_extent_area(spark, grids), ["aoi_id"]).first()
    assert (area.minx, area.miny, area.maxx, area.maxy) == (4, 2, 10, 10)
    with pytest.raises(ValueError, match="no coordinate"):
        workflow.full_extent_area(spark, [Grid(0, 1, 1, -1, 1, 1)])


def test_box_join_finds_each_once(spark):
    rng = np.random.default_rng(1)
    low = rng.uniform(-50, 50, (80, 2))
    high = low + rng.uniform(0, 30, (80, 2))
    rows = [(k, *map(float, (*low[k], *high[k]))) for k in range(80)]
    df = spark.createDataFrame(rows, "k long, minx double, miny double, maxx double, maxy double")
    got = [(r.a, r.b) for r in vector.box_join(df.withColumnRenamed("k", "a"), df.withColumnRenamed("k", "b"), 7.0, "a", "b").collect()]
    want = {(p[0], q[0]) for p in rows for q in rows if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(got) == len(set(got)) and set(got) == want


def test_grid_and_rasters(spark, tmp_path):
    source = Grid(0, 10, 1, -1, 10, 10)
    cells = spark.createDataFrame([(i, j, float(i * 10 + j)) for i in range(10) for j in range(10)], "row_i int, col_j int, v double")
    same = grid.resample(cells, source, source)
    assert same.exceptAll(cells).count() == 0 and same.count() == 100
    part = grid.resample(cells, source, source, bounds=(2, 3, 4, 6))
    assert {(r.row_i, r.col_j) for r in part.collect()} == {(i, j) for i in range(4, 7) for j in range(2, 4)}
    tables.write_raster(cells, source, str(tmp_path / "r"), "pop", tile=4)
    back, g = tables.read_raster(spark, str(tmp_path / "r"), "pop", tile=4)
    assert g == source and back.exceptAll(cells).count() == 0 and back.count() == 100
    some, _ = tables.read_raster(spark, str(tmp_path / "r"), "pop", tile=4, bounds=(0, 8, 2, 10))
    assert {(r.row_i, r.col_j) for r in some.collect()} == {(i, j) for i in range(2) for j in range(2)}
    joint = grid.union_grid([source, Grid(5, 20, 1, -1, 10, 10)], 1, 1)
    assert (joint.x0, joint.y0, joint.width, joint.height) == (0, 20, 15, 20)


def test_features_and_areas(spark, tmp_path):
    df = spark.createDataFrame([(1, SQUARE), (2, [])], FEATURE)
    tables.write_features(df, str(tmp_path / "layer"))
    assert [r.fid for r in tables.read_features(spark, str(tmp_path / "layer"), bounds=(3, 3, 9, 9), columns=["fid"]).collect()] == [1]
    with pytest.raises(ValueError, match="lacks"):
        tables.read_features(spark, str(tmp_path / "layer"), fields=["NEXT_SINK"])
    with pytest.raises(ValueError, match="share a name"):
        tables.areas(spark, ["x/a.parquet", "y/a.parquet"])
    with pytest.raises(FileNotFoundError):
        tables.areas(spark, [])
    assert {r.aoi_id for r in tables.areas(spark, [str(tmp_path / "layer")]).collect()} == {"layer"}


def test_crs(spark):
    assert crs.pick_crs(2, 40, 7.9, 50).crs == "EPSG:32631"
    assert crs.pick_crs(2, -50, 7.9, -40).crs == "EPSG:32731"
    assert "aeqd" in crs.pick_crs(2, 40, 8.5, 50).crs and "aeqd" in crs.pick_crs(2, 84, 5, 87).crs
    assert "eqdc" in crs.pick_crs(-60, 30, 60, 40).crs and "aeqd" in crs.pick_crs(0, -60, 7, 60).crs
    assert crs.pick_crs(-180, -60, 180, 60).crs == "EPSG:32601"  # a global box counts as narrow
    assert crs.pick_crs(178, 10, -178, 12).crs in ("EPSG:32601", "EPSG:32660")
    assert abs(crs.geodesic_m(0, 0, 1, 0) - 111319.4908) < 0.001 and abs(crs.geodesic_m(0, 0, 0, 1) - 110574.3886) < 0.001
    one = spark.createDataFrame([(9.3, 48.7), (5.9, -12.0)], "lon double, lat double")
    for south in (False, True):
        x, y = crs.utm(F.col("lon"), F.col("lat"), 32, south)
        lon, lat = crs.utm_inverse(F.col("x"), F.col("y"), 32, south)
        for r in one.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
            assert abs(r.lon - r.a) < 1e-7 and abs(r.lat - r.b) < 1e-7
    x, y = crs.azimuthal(F.col("lon"), F.col("lat"), 8.0, 20.0)
    lon, lat = crs.azimuthal_inverse(F.col("x"), F.col("y"), 8.0, 20.0)
    for r in one.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        assert abs(r.lon - r.a) < 1e-7 and abs(r.lat - r.b) < 1e-7


def test_erosion(spark):
    square = spark.createDataFrame([(i, j) for i in range(20) for j in range(20)], "row_i int, col_j int")
    assert erode.erode_to_area(square, 400, 4).count() == 400
    got = erode.erode_to_area(square, 256, 3)
    assert {(r.row_i, r.col_j) for r in got.collect()} == {(i, j) for i in range(2, 18) for j in range(2, 18)}
    assert erode.erode_to_area(square, 300, 1).count() == 400  # no depth comes near: the whole area
    assert erode.erode_to_area(square, 300, 1, step=True).count() == 256


def test_travel_population(spark):
    cells = grid_of(spark, "S11 1#1 111").withColumn("pop", F.lit(10).cast("long"))
    got = workflow.travel_population(cells, 1 / 60, 1.0)
    assert got.agg(F.sum("pop")).first()[0] == 30  # the source and two straight steps


def test_scalars():
    assert [scalars.parse_size(x) for x in ("7", "2K", "64M", "1g", "1T", "1.5G")] == [7, 2048, 64 << 20, 1 << 30, 1 << 40, 3 << 29]
    for bad in ("", "64MB", "x", "-1", "1.5"):
        with pytest.raises(ValueError):
            scalars.parse_size(bad)
    assert scalars.as_list(None) == [] and scalars.as_list("a") == ["a"] and scalars.as_list(("a", 1)) == ["a", 1]
    assert [scalars.part_count(n, 4) for n in (0, 1, 4, 5)] == [1, 1, 1, 2]


def connect(folder):
    c = duckdb.connect()
    for t in ("events", "orders", "customer", "nation", "supplier", "lineitem", "documents"):
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) & set(catalogue.ORACLE)))
def test_query_is_its_sql(spark, small, name):
    df = catalogue.QUERIES[name](spark, small)
    got = Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    want = connect(small).sql(catalogue.ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert got == Counter(want.select(*[f'"{x}"' for x in sorted(df.columns)]).fetchall())


def test_queries_without_sql():
    """They are held against plain computation below."""
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE) == {"erode_to_area", "greedy_selection", "selection_totals"}


def test_greedy_selection_query(spark, small):
    """The registered query, seed by seed, and its totals."""
    rows = connect(small).sql(f"select hybas_id, next_down, pop_sum, hits_pp, pp_area_ha from ({FOCAL})").fetchall()
    want = set()
    for rest in range(3):
        mine = sorted(r for r in rows if r[0] % 3 == rest)
        up = {i: [r[0] for r in mine if r[1] == i] for i, *_ in mine}
        pop, hit = {r[0]: r[2] for r in mine}, {r[0]: r[4] if r[3] else 0 for r in mine}
        area, order = 0, []
        for seed in sorted(pop, key=lambda i: (-pop[i], i)):
            if area >= 100:
                break
            level = [seed]
            while level:  # a whole level of the walk at a time
                fresh = [i for i in dict.fromkeys(level) if i not in order]
                found = next((i for i in fresh if hit[i]), None)
                order += fresh[: fresh.index(found) + 1] if found else fresh
                area += hit.get(found, 0)
                level = [] if found else [u for i in fresh for u in up[i]]
        want |= {(f"f{rest}", k, i, bool(hit[i]), pop[i], float(hit[i])) for k, i in enumerate(order)}
    assert {tuple(r) for r in catalogue.QUERIES["greedy_selection"](spark, small).collect()} == want
    for r in catalogue.QUERIES["selection_totals"](spark, small).collect():
        mine = [w for w in want if w[0] == r.focal_id]
        assert (r.n_visited, r.n_selected, r.pop_sum, r.area_ha) == (len(mine), sum(w[3] for w in mine), sum(w[4] for w in mine), sum(w[5] for w in mine))


def test_erode_query(spark, small):
    """The registered query leaves the cells deeper than some depth, about half of them."""
    area = set(connect(small).sql(f"select row_i, col_j from ({CELLS}) where friction > 0 or cond > 0").fetchall())
    outside = {(i + a, j + b) for i, j in area for a in (-1, 0, 1) for b in (-1, 0, 1)} - area
    depth = {(i, j): min((i - a) ** 2 + (j - b) ** 2 for a, b in outside) for i, j in area}
    got = {(r.row_i, r.col_j) for r in catalogue.QUERIES["erode_to_area"](spark, small).collect()}
    assert got and (got == area or got == {c for c in area if depth[c] >= min(depth[g] for g in got)})
    assert got == area or abs(len(got) - len(area) / 2) <= len(area) / 4


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
