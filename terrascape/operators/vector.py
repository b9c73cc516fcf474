"""Vector layers: measures, extents, rasterisation, spatial and zonal joins.

Rings are arrays of points; the first ring of a part is its shell, others are holes
(an even-odd rule decides).  Coordinates of rasterisation are in cells: the centre of
cell (i, j) is (j + 0.5, i + 0.5).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.sources.durable import Stage


def edges_of(features: DataFrame, key: list[str]) -> DataFrame:
    """``x1, y1, x2, y2`` of every edge; rings are closed if they aren't."""
    ring = features.select(*key, F.posexplode("rings").alias("ring", "p"))
    n = F.size("p")
    nxt = lambda k: F.element_at("p", F.when(k + 2 <= n, k + 2).otherwise(1))
    pairs = F.transform("p", lambda p, k: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), nxt(k)["x"].alias("x2"), nxt(k)["y"].alias("y2")))
    return ring.select(*key, "ring", F.explode(pairs).alias("e")).select(*key, "ring", "e.*")


def repair(features: DataFrame) -> DataFrame:
    """Rings without repeated points and without a closing point, of at least three
    points; features that keep no ring are dropped.  Self-crossing rings are left: the
    even-odd rule gives them a defined inside."""
    same = lambda a, b: (a["x"] == b["x"]) & (a["y"] == b["y"])
    before = lambda ring, k: F.element_at(ring, F.when(k > 0, k).otherwise(F.size(ring)))
    clean = F.transform("rings", lambda ring: F.filter(ring, lambda p, k: ~same(p, before(ring, k)) | (F.size(ring) == 1)))
    return features.withColumn("rings", F.filter(clean, lambda r: F.size(r) >= 3)).where(F.size("rings") > 0)


def measures(features: DataFrame, key: list[str]) -> DataFrame:
    """``area, cx, cy`` by the shoelace formula; holes turn against their shell."""
    e = edges_of(features, key).withColumn("c", F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    s = e.groupBy(*key).agg(F.sum("c").alias("a2"), F.sum((F.col("x1") + F.col("x2")) * F.col("c")).alias("sx"), F.sum((F.col("y1") + F.col("y2")) * F.col("c")).alias("sy"))
    return s.select(*key, F.abs(F.col("a2") / 2).alias("area"), F.when(F.col("a2") != 0, F.col("sx") / (3 * F.col("a2"))).alias("cx"), F.when(F.col("a2") != 0, F.col("sy") / (3 * F.col("a2"))).alias("cy"))


def hectares(area_m2: Column) -> Column:
    return area_m2 / 10000


def boxes(features: DataFrame, key: list[str]) -> DataFrame:
    """Bounding boxes ``minx, miny, maxx, maxy``."""
    e = edges_of(features, key)
    return e.groupBy(*key).agg(F.min("x1").alias("minx"), F.min("y1").alias("miny"), F.max("x1").alias("maxx"), F.max("y1").alias("maxy"))


def extent(boxes: DataFrame, how: str = "union", by: list[str] | None = None) -> DataFrame:
    """The union or the intersection of boxes; an intersection that is empty is a row
    with ``empty`` true."""
    lo, hi = (F.min, F.max) if how == "union" else (F.max, F.min)
    got = (boxes.groupBy(*by) if by else boxes.groupBy()).agg(lo("minx").alias("minx"), lo("miny").alias("miny"), hi("maxx").alias("maxx"), hi("maxy").alias("maxy"))
    return got.withColumn("empty", F.coalesce((F.col("minx") >= F.col("maxx")) | (F.col("miny") >= F.col("maxy")), F.lit(True)))


def box_join(left: DataFrame, right: DataFrame, bin_size: float, left_key: str, right_key: str) -> DataFrame:
    """``left_key, right_key`` of boxes that meet (touching counts).

    Boxes are dealt into square bins, so the join is on the bin; a pair counts in the
    bin of the lower corner of the boxes' intersection only, so none is found twice.
    Bins should be of the size of ordinary boxes.
    """

    def binned(df: DataFrame, p: str, key: str) -> DataFrame:
        cell = lambda c: F.floor(F.col(c) / bin_size).cast("long")
        d = df.select(F.col(key).alias(f"{p}k"), *[F.col(c).alias(f"{p}{c}") for c in ("minx", "miny", "maxx", "maxy")], F.explode(F.sequence(cell("minx"), cell("maxx"))).alias("bx"), cell("miny").alias("lo"), cell("maxy").alias("hi"))
        return d.select("*", F.explode(F.sequence("lo", "hi")).alias("by")).drop("lo", "hi")

    both = binned(left, "l", left_key).join(binned(right, "r", right_key), ["bx", "by"])
    meets = both.where("lminx <= rmaxx AND rminx <= lmaxx AND lminy <= rmaxy AND rminy <= lmaxy")
    first = (F.col("bx") == F.floor(F.greatest("lminx", "rminx") / bin_size)) & (F.col("by") == F.floor(F.greatest("lminy", "rminy") / bin_size))
    return meets.where(first).select(F.col("lk").alias(left_key), F.col("rk").alias(right_key))


def edge_bins(edges: DataFrame, size: float) -> DataFrame:
    """Each edge in every square bin that it passes (``bx, by``), a row band at a time, so
    a long edge has as many bins as it is long.  Bins overlap by a millionth of their
    size, more than rounding moves a crossing."""
    low, high, slack = F.least("y1", "y2"), F.greatest("y1", "y2"), 1e-6 * size
    band = lambda y: F.floor(y / size).cast("long")
    rows = edges.withColumn("by", F.explode(F.sequence(band(low), band(high))))
    at = lambda y: F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    a, b = at(F.greatest(low, F.col("by") * size)), at(F.least(high, (F.col("by") + 1) * size))
    level = F.col("y1") == F.col("y2")
    left = F.when(level, F.least("x1", "x2")).otherwise(F.least(a, b)) - slack
    right = F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(a, b)) + slack
    return rows.withColumn("bx", F.explode(F.sequence(band(left), band(right))))


def crossing_pairs(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """``lk, rk`` of edges (``lk`` or ``rk``, and ``x1, y1, x2, y2``) that cross or touch,
    each pair once: edges meet in the bins that both pass."""
    name = {c: f"r{c}" for c in ("x1", "y1", "x2", "y2")}
    l, r = edge_bins(left, size), edge_bins(right, size).withColumnsRenamed(name)  # noqa: E741
    e, f = ({c: F.col(p + c) for c in name} for p in ("", "r"))
    met = l.join(r, ["bx", "by"]).where((F.least("x1", "x2") <= F.greatest("rx1", "rx2")) & (F.least("rx1", "rx2") <= F.greatest("x1", "x2")) & (F.least("y1", "y2") <= F.greatest("ry1", "ry2")) & (F.least("ry1", "ry2") <= F.greatest("y1", "y2")))
    turn = lambda e, x, y: F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))
    beside = lambda e, x, y: (F.least(e["x1"], e["x2"]) <= x) & (x <= F.greatest(e["x1"], e["x2"])) & (F.least(e["y1"], e["y2"]) <= y) & (y <= F.greatest(e["y1"], e["y2"]))
    p, q, s, t = turn(e, f["x1"], f["y1"]), turn(e, f["x2"], f["y2"]), turn(f, e["x1"], e["y1"]), turn(f, e["x2"], e["y2"])
    touch = ((p == 0) & beside(e, f["x1"], f["y1"])) | ((q == 0) & beside(e, f["x2"], f["y2"])) | ((s == 0) & beside(f, e["x1"], e["y1"])) | ((t == 0) & beside(f, e["x2"], e["y2"]))
    return met.where(((p * q < 0) & (s * t < 0)) | touch).select("lk", "rk").distinct()


def points_inside(points: DataFrame, edges: DataFrame, pairs: DataFrame, size: float) -> DataFrame:
    """``pk, ek`` of ``pairs`` where a point of ``pk`` (``pk, ring, x, y``) lies in the
    feature of ``ek`` (edges ``ek, x1, y1, x2, y2``), by the even-odd rule: points and
    edges meet in row bands, and crossings to the right of a point are counted."""
    band = lambda y: F.floor(y / size).cast("long")
    asked = pairs.join(points, "pk").withColumn("band", band(F.col("y")))
    rows = edges.where("y1 <> y2").withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
    met = asked.join(rows, ["ek", "band"])
    hit = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    return met.where(hit).groupBy("pk", "ring", "ek").agg(F.count("*").alias("n")).where("n % 2 = 1").select("pk", "ek").distinct()


def intersects_join(left: DataFrame, right: DataFrame, bin_size: float, left_key: str, right_key: str, edge_bin: float | None = None) -> DataFrame:
    """``left_key, right_key`` of features that meet.  Features meet where edges cross or
    touch, or, as then each ring lies wholly in or out of the other feature, where a
    ring's first point lies in it, by the even-odd rule over all rings.

    Edges are dealt to bins of ``edge_bin`` (a quarter of ``bin_size`` unless given) and
    points to row bands of edges, so no task holds a whole feature, however many edges
    it has.  Boxes (``box_join``) tell which pairs points are looked up for."""
    size = edge_bin or bin_size / 4
    l = Stage(edges_of(left.select(F.col(left_key).alias("lk"), "rings"), ["lk"]))  # noqa: E741
    r = Stage(edges_of(right.select(F.col(right_key).alias("rk"), "rings"), ["rk"]))
    corner = lambda e, key: e.groupBy(key).agg(F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"), F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"))
    pairs = box_join(corner(l.df, "lk"), corner(r.df, "rk"), bin_size, "lk", "rk")
    cross = Stage(crossing_pairs(l.df.drop("ring"), r.df.drop("ring"), size))
    apart = Stage(pairs.join(cross.df, ["lk", "rk"], "left_anti"))

    def inside(points: DataFrame, p: str, edges: DataFrame, e: str) -> DataFrame:
        first = points.groupBy(F.col(p).alias("pk"), "ring").agg(F.min(F.struct("x1", "y1")).alias("at")).select("pk", "ring", F.col("at.x1").alias("x"), F.col("at.y1").alias("y"))
        asked = apart.df.select(F.col(p).alias("pk"), F.col(e).alias("ek"))
        return points_inside(first, edges.drop("ring").withColumnRenamed(e, "ek"), asked, size).select(F.col("pk").alias(p), F.col("ek").alias(e))

    held = inside(l.df, "lk", r.df, "rk").unionByName(inside(r.df, "rk", l.df, "lk"))
    found = Stage(cross.df.unionByName(held).distinct().select(F.col("lk").alias(left_key), F.col("rk").alias(right_key)))
    for old in (l, r, cross, apart):
        old.drop()
    return found.df


def boundary_edges(features: DataFrame, key: str, bin_size: float) -> DataFrame:
    """``key, x1, y1, x2, y2``: the boundary of what the even-odd rule calls inside, the
    inside to the left of each edge.

    A feature's edges that cross or touch, found by bins, are split there, and pieces
    that lie twice on each other go; each piece then has the inside on one side, which a
    ray from its middle tells: it counts the pieces beyond, met in bands.
    """
    ring = features.select(F.col(key).alias("k"), F.posexplode("rings").alias("ring", "p"))
    n = F.size("p")
    nxt = lambda i: F.element_at("p", F.when(i + 2 <= n, i + 2).otherwise(1))
    sides = F.transform("p", lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), nxt(i)["x"].alias("x2"), nxt(i)["y"].alias("y2")))
    e = Stage(ring.select("k", "ring", F.posexplode(sides).alias("at", "e")).select("k", F.struct("ring", "at").alias("id"), "e.*").where("x1 <> x2 OR y1 <> y2"))
    binned = edge_bins(e.df, bin_size)
    met = binned.join(binned.withColumnsRenamed({"id": "jd", "x1": "u1", "y1": "v1", "x2": "u2", "y2": "v2"}), ["k", "bx", "by"]).where("id <> jd").drop("bx", "by").distinct()
    turn = lambda ax, ay, bx, by, x, y: (F.col(bx) - F.col(ax)) * (F.col(y) - F.col(ay)) - (F.col(by) - F.col(ay)) * (F.col(x) - F.col(ax))
    p, q = turn("x1", "y1", "x2", "y2", "u1", "v1"), turn("x1", "y1", "x2", "y2", "u2", "v2")
    r, s = turn("u1", "v1", "u2", "v2", "x1", "y1"), turn("u1", "v1", "u2", "v2", "x2", "y2")
    # the crossing is computed from the smaller of both edges, so both get the same point
    lead = F.col("id") < F.col("jd")
    t = F.when(lead, r / (r - s)).otherwise(p / (p - q))
    along = lambda a, b, c, d: F.when(lead, F.col(a) + t * (F.col(b) - F.col(a))).otherwise(F.col(c) + t * (F.col(d) - F.col(c)))
    on = lambda x, y: (F.least("x1", "x2") <= F.col(x)) & (F.col(x) <= F.greatest("x1", "x2")) & (F.least("y1", "y2") <= F.col(y)) & (F.col(y) <= F.greatest("y1", "y2"))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    found = F.array(
        F.when((F.signum(p) * F.signum(q) < 0) & (F.signum(r) * F.signum(s) < 0), point(along("x1", "x2", "u1", "u2"), along("y1", "y2", "v1", "v2"))),
        F.when((p == 0) & on("u1", "v1"), point(F.col("u1"), F.col("v1"))),
        F.when((q == 0) & on("u2", "v2"), point(F.col("u2"), F.col("v2"))),
    )
    cuts = met.select("k", "id", F.explode(F.filter(found, lambda c: c.isNotNull())).alias("c")).groupBy("k", "id").agg(F.collect_set("c").alias("cuts"))
    far = lambda c: (c["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (c["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    every = F.array_union(F.coalesce("cuts", F.expr("cast(array() as array<struct<x:double,y:double>>)")), F.array(point(F.col("x1"), F.col("y1")), point(F.col("x2"), F.col("y2"))))
    order = F.array_sort(F.transform(every, lambda c: F.struct(far(c).alias("d"), c["x"].alias("x"), c["y"].alias("y"))))
    parts = e.df.join(cuts, ["k", "id"], "left").select("k", order.alias("o")).select("k", F.posexplode("o").alias("i", "a"), "o").where("i + 1 < size(o)").select("k", "a", F.element_at("o", F.col("i") + 2).alias("b"))
    low, high = F.least(F.struct("a.x", "a.y"), F.struct("b.x", "b.y")), F.greatest(F.struct("a.x", "a.y"), F.struct("b.x", "b.y"))
    once = parts.select("k", low.alias("a"), high.alias("b")).groupBy("k", "a", "b").agg(F.count("*").alias("n")).where("n % 2 = 1 AND a <> b")
    piece = Stage(once.select("k", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2")))
    e.drop()
    out = None
    # a ray to the right from the middle of a piece; upwards where the piece lies level
    for level, (m, c) in ((False, ("y", "x")), (True, ("x", "y"))):
        own = piece.df.where(F.col("y1") == F.col("y2") if level else F.col("y1") != F.col("y2"))
        own = own.withColumns({"mx": (F.col("x1") + F.col("x2")) / 2, "my": (F.col("y1") + F.col("y2")) / 2})
        band = lambda v: F.floor(v / bin_size).cast("long")
        lo, hi = F.least(f"{m}1", f"{m}2"), F.greatest(f"{m}1", f"{m}2")
        walls = piece.df.where(lo < hi).withColumn("band", F.explode(F.sequence(band(lo), band(hi)))).withColumnsRenamed({"x1": "u1", "y1": "v1", "x2": "u2", "y2": "v2"})
        a, b, d, f = (("v1", "v2", "u1", "u2") if m == "y" else ("u1", "u2", "v1", "v2"))
        at = F.col(d) + (F.col(f"m{m}") - F.col(a)) / (F.col(b) - F.col(a)) * (F.col(f) - F.col(d))
        same = (F.col("u1") == F.col("x1")) & (F.col("v1") == F.col("y1")) & (F.col("u2") == F.col("x2")) & (F.col("v2") == F.col("y2"))
        hit = ((F.col(a) > F.col(f"m{m}")) != (F.col(b) > F.col(f"m{m}"))) & (at > F.col(f"m{c}")) & ~same
        keyed = own.withColumn("band", band(F.col(f"m{m}")))
        hits = keyed.join(walls, ["k", "band"], "left").groupBy("k", "x1", "y1", "x2", "y2").agg(F.count(F.when(hit, 1)).alias("n"))
        # beyond the piece (right of it, above it) is inside where the ray meets an odd number
        beyond = F.col("n") % 2 == 1
        keep = ((F.col("y1") > F.col("y2")) == beyond) if not level else ((F.col("x1") < F.col("x2")) == beyond)
        turned = hits.select("k", *[F.when(keep, F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))])
        out = turned if out is None else out.unionByName(turned)
    found = Stage(out.withColumnRenamed("k", key))
    piece.drop()
    return found.df


def node(features: DataFrame, key: str, bin_size: float) -> DataFrame:
    """``key, rings``: the features with rings that neither cross nor overlap themselves or each
    other, of the same inside by the even-odd rule: shells turn left, holes right.  A
    feature without an inside is gone.  A task holds the boundary of one feature."""
    kind = features.schema[key].dataType.simpleString()

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        start = list(zip(rows["x1"], rows["y1"]))
        stop = list(zip(rows["x2"], rows["y2"]))
        leaving: dict[tuple, list[int]] = {}
        for i, p in enumerate(start):
            leaving.setdefault(p, []).append(i)
        left, rings = set(range(len(start))), []
        while left:
            first = i = min(left)
            ring = []
            while True:
                left.discard(i)
                ring.append(start[i])
                x, y = stop[i]
                ways = [j for j in leaving[x, y] if j in left or j == first]
                if not ways or stop[i] == start[first]:
                    break
                back = math.atan2(start[i][1] - y, start[i][0] - x)
                # the first way clockwise from where it came keeps to the same part
                i = min(ways, key=lambda j: (back - math.atan2(stop[j][1] - y, stop[j][0] - x)) % (2 * math.pi) or 2 * math.pi)
                if i == first:
                    break
            rings.append(ring)
        area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))
        rings.sort(key=lambda r: (-area(r), r))
        return pd.DataFrame({key: [rows[key].iloc[0]], "rings": [[[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]]})

    return boundary_edges(features, key, bin_size).groupBy(key).applyInPandas(walk, f"`{key}` {kind}, rings array<array<struct<x:double,y:double>>>")


def mark_intersecting(features: DataFrame, layer: DataFrame, bin_size: float, key: str, name: str) -> DataFrame:
    """``key`` of every feature and, as ``name``, whether it meets any of the layer."""
    other = f"{key}_of_layer"
    hit = intersects_join(features.select(key, "rings"), layer.select(F.col(key).alias(other), "rings"), bin_size, key, other).select(key).distinct()
    return features.select(key).join(hit.withColumn(name, F.lit(True)), key, "left").select(key, F.coalesce(name, F.lit(False)).alias(name))


def rasterize(features: DataFrame, key: list[str], width: int, height: int) -> DataFrame:
    """``row_i, col_j`` of the cells whose centre lies in the feature, by row runs.

    An edge meets a row of centres where min(y) <= yc < max(y), so shared edges count
    once; crossings of a row are sorted and paired; a centre on the left end is in.
    """
    e = edges_of(features, key)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.greatest(F.ceil(low - 0.5), F.lit(0)), F.least(F.ceil(high - 0.5) - 1, F.lit(height - 1))
    rows = e.where(F.col("y1") != F.col("y2")).withColumns({"a": first.cast("int"), "b": last.cast("int")}).where("a <= b").withColumn("row_i", F.explode(F.sequence("a", "b")))
    x = F.col("x1") + (F.col("row_i") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    runs = rows.select(*key, "row_i", x.alias("x")).groupBy(*key, "row_i").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(1), (F.size("xs") / 2).cast("int")), lambda k: F.struct(F.element_at("xs", 2 * k - 1).alias("u"), F.element_at("xs", 2 * k).alias("v")))
    spans = runs.where("size(xs) > 1").select(*key, "row_i", F.explode(pairs).alias("s"))
    left, right = F.greatest(F.ceil(F.col("s.u") - 0.5), F.lit(0)).cast("int"), F.least(F.ceil(F.col("s.v") - 0.5) - 1, F.lit(width - 1)).cast("int")
    return spans.select(*key, "row_i", left.alias("a"), right.alias("b")).where("a <= b").select(*key, "row_i", F.explode(F.sequence("a", "b")).alias("col_j"))


def touched(features: DataFrame, key: list[str], width: int, height: int) -> DataFrame:
    """Cells that the feature's area or boundary meets: the cells of ``rasterize`` and,
    for each edge and each row band it crosses, the columns it spans there."""
    e = edges_of(features, key)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = e.withColumns({"a": F.greatest(F.floor(low), F.lit(0)).cast("int"), "b": F.least(F.floor(high), F.lit(height - 1)).cast("int")}).where("a <= b").withColumn("row_i", F.explode(F.sequence("a", "b")))
    ya, yb = F.greatest(low, F.col("row_i").cast("double")), F.least(high, F.col("row_i") + 1.0)
    x_at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    flat = F.col("y1") == F.col("y2")
    xa = F.when(flat, F.least("x1", "x2")).otherwise(F.least(x_at(ya), x_at(yb)))
    xb = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x_at(ya), x_at(yb)))
    line = rows.withColumns({"u": F.greatest(F.floor(xa), F.lit(0)).cast("int"), "v": F.least(F.floor(xb), F.lit(width - 1)).cast("int")}).where("u <= v")
    met = line.select(*key, "row_i", F.explode(F.sequence("u", "v")).alias("col_j"))
    return rasterize(features, key, width, height).unionByName(met).distinct()


def union_cells(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The union of features as cells: each cell once, for each value of ``by``."""
    return cells.select(*(by or []), "row_i", "col_j").distinct()


def zonal_sums(zones: DataFrame, cells: DataFrame, key: str, value: str = "pop") -> DataFrame:
    """``key, pop_sum, n`` of each zone's cells; nodata counts as 0; a zone without
    cells has sum 0.  Fractional values have fractional sums."""
    met = zones.join(cells, ["row_i", "col_j"], "left")
    return met.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0)).alias("pop_sum"), F.count(value).alias("n"))
