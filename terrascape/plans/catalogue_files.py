"""More registered queries: files written and read again, and layers that meet on grids
that differ; with their SQL."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.functions import crs
from terrascape.model import Grid
from terrascape.operators import focal, grid, hydro, masks, network, vector
from terrascape.plans import catalogue as c
from terrascape.sources import chunks, tables
from terrascape.sources.durable import shared_dir
from terrascape.sources.fixtures import CELLS, EDGES, load

CELL = c.CELL
query = c.query


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/terrascape-{uuid.uuid4().hex}"


def _grid(cells: DataFrame) -> Grid:
    """The grid of the cells: one unit a cell, rows downwards from 0."""
    return Grid(0, 0, 1, -1, 100, cells.agg(F.max("row_i")).first()[0] + 1, "EPSG:4326")


@query(f"SELECT row_i, col_j, cast(pop AS DOUBLE) AS v FROM ({CELLS}) WHERE row_i BETWEEN 2 AND 7 AND col_j BETWEEN 20 AND 40")
def raster_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster written as tiles, and the tiles of a window read."""
    cells = load(spark, sf_dir, "fx_cells").select(*CELL, F.col("pop").cast("double").alias("v"))
    path = _place(spark)
    tables.write_raster(cells, _grid(cells), path, "pop")
    return tables.open_raster(spark, path, (20.5, -7.5, 40.5, -2.5))[0]


@query(f"WITH {c._TRI_EDGES}, b AS (SELECT fid, min(x1) AS minx, min(y1) AS miny, max(x1) AS maxx, max(y1) AS maxy FROM e GROUP BY fid) SELECT fid FROM b WHERE minx <= 50 AND maxx >= 20 AND miny <= 45 AND maxy >= 10")
def feature_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer written with its boxes, and the features whose box meets a window read."""
    path = _place(spark)
    tables.write_features(c._triangles(spark, sf_dir), path)
    return tables.read_features(spark, path, (20, 10, 50, 45), ["fid"], ["FID", "rings"])


@query("SELECT CASE WHEN n_regionkey < 2 THEN 'near' ELSE 'far' END AS aoi_id, count(*) AS n FROM nation GROUP BY ALL")
def area_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas by the names of the files that a pattern finds."""
    path, nations = _place(spark), spark.read.parquet(f"{sf_dir}/nation.parquet")
    nations.where("n_regionkey < 2").select("n_nationkey").write.parquet(f"{path}/near.parquet")
    nations.where("n_regionkey >= 2").select("n_nationkey").write.parquet(f"{path}/far.parquet")
    return tables.areas(spark, tables.matching(spark, [f"{path}/*.parquet", f"{path}/near*"])).groupBy("aoi_id").agg(F.count("*").alias("n"))


@query(c.ORACLE["population_by_mask_wide"])
def result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of results as CSV, read again."""
    path = tables.write_result(c.population_by_mask_wide(spark, sf_dir), _place(spark), "run")
    return spark.read.option("header", True).csv(path)


@query(c._SINKS + f", c(hybas_id) AS ({c._SEED} UNION SELECT e.next_down FROM c JOIN e USING (hybas_id) WHERE e.next_down <> 0) SELECT hybas_id, next_sink FROM c JOIN s USING (hybas_id)")
def partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of each drain partition, a folder for each terminal sink, read again."""
    edges, path = load(spark, sf_dir, "fx_edges"), _place(spark)
    tables.write_partitions(network.members_by_sink(c._seeds(spark, sf_dir), edges.join(network.terminal_sinks(edges), "hybas_id")), path)
    return spark.read.parquet(path).select("hybas_id", F.col("next_sink").cast("long").alias("next_sink"))


@query("""SELECT cast(i AS INT) AS idx, cast(octet_length(part) AS BIGINT) AS size, sha256(part) AS sha256 FROM (SELECT i, encode(substr(whole, cast((i - 1) * 40000 + 1 AS BIGINT), 40000)) AS part
  FROM (SELECT whole, octet_length(encode(whole)) AS size FROM (SELECT string_agg(o_orderkey || ' ' || o_orderdate::DATE || chr(10), '' ORDER BY o_orderkey) AS whole FROM orders)), range(1, 100000) r(i) WHERE i <= greatest(1, cast(ceil(size / 40000.0) AS BIGINT)))""")
def chunk_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of orders split into zipped parts, joined again and compared; the
    manifest's digests.  Splitting works on a file that driver and executors open by
    path, so the shared folder must be one of a file system."""
    place = _place(spark).removeprefix("file:")
    if "://" in place:
        raise ValueError(f"files are split in a folder of a file system, not at {place}")
    folder = Path(place)
    folder.mkdir(parents=True)
    lines = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.concat_ws(" ", "o_orderkey", F.to_date("o_orderdate")).alias("line"))
    chunks.write_lines(lines, "o_orderkey", folder / "whole.txt")
    manifest = chunks.split_file(spark, folder / "whole.txt", folder / "parts", 40_000)
    chunks.join_file(manifest, folder / "again.txt")
    parts = json.loads(manifest.read_text())["parts"]
    return spark.createDataFrame([(k, p["raw_size"], p["raw_sha256"]) for k, p in enumerate(parts, 1)], "idx int, size long, sha256 string")


_FINE = f"SELECT row_i, col_j, greatest(pop, 0) AS pop FROM ({CELLS}) WHERE pop IS NOT NULL"
#: A second layer of cells of 1.5 units that begins a little beside and above the first.
_COARSE = f"SELECT row_i, col_j, greatest(pop, 0) * 2 AS pop FROM ({CELLS}) WHERE pop IS NOT NULL AND row_i < 8 AND col_j < 60"


@query(f"""WITH fine AS ({_FINE}), coarse AS ({_COARSE}), h AS (SELECT max(row_i) + 1 AS n FROM ({CELLS})),
  t AS (SELECT i, j, -0.7 + (j + 0.5) * 0.8 AS x, 0.4 - (i + 0.5) * 0.8 AS y FROM h, range(0, cast(ceil((greatest(h.n, 11.6) + 0.4) / 0.8 - 1e-9) AS BIGINT)) a(i), range(0, cast(ceil(100.7 / 0.8 - 1e-9) AS BIGINT)) b(j)),
  l AS (SELECT 'fine' AS mask_id, t.i, t.j, pop FROM t JOIN fine f ON f.row_i = cast(floor(-y) AS INT) AND f.col_j = cast(floor(x) AS INT)
    UNION ALL SELECT 'coarse', t.i, t.j, pop FROM t JOIN coarse f ON f.row_i = cast(floor((0.4 - y) / 1.5) AS INT) AND f.col_j = cast(floor((x + 0.7) / 1.5) AS INT))
  SELECT mask_id, cast(sum(pop) AS BIGINT) AS pop_sum FROM l GROUP BY mask_id
  UNION ALL SELECT 'combined pop', cast(sum(pop) AS BIGINT) FROM (SELECT max(pop) AS pop FROM l GROUP BY i, j)""")
def aligned_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population rasters of unequal cells and extents, aligned to the union of both."""
    cells = load(spark, sf_dir, "fx_cells")
    height = _grid(cells).height
    pop = F.greatest("pop", F.lit(0)).alias("pop")
    fine = cells.where("pop IS NOT NULL").select(*CELL, pop), Grid(0, 0, 1, -1, 100, height)
    coarse = cells.where("pop IS NOT NULL AND row_i < 8 AND col_j < 60").select(*CELL, (pop * 2).alias("pop")), Grid(-0.7, 0.4, 1.5, -1.5, 60, 8)
    return masks.sums(grid.align_layers({"fine": fine, "coarse": coarse}, 0.8, 0.8), [])


@query(f"""WITH c AS ({CELLS}), h AS (SELECT max(row_i) + 1 AS n FROM c), k AS (SELECT i, j, (j - 30 + 0.5) * 40000 AS x, (10 - i - 0.5) * 40000 AS y FROM range(0, 20) a(i), range(0, 60) b(j)),
  g AS (SELECT *, sqrt(x * x + y * y) AS rho, sqrt(x * x + y * y) / {crs.RADIUS} AS a, radians(-4.0) AS p0 FROM k),
  d AS (SELECT i, j, degrees(asin(cos(a) * sin(p0) + y * sin(a) * cos(p0) / rho)) AS lat, 12.0 + degrees(atan2(x * sin(a) / rho, cos(a) * cos(p0) - y * sin(a) * sin(p0) / rho)) AS lon FROM g)
  SELECT cast(i AS INT) AS row_i, cast(j AS INT) AS col_j, c.pop FROM d JOIN c ON c.row_i = cast(floor(lat / -1) AS INT) AND c.col_j = cast(floor(lon) AS INT)""")
def reproject_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster of degrees on a metric grid in another system."""
    cells = load(spark, sf_dir, "fx_cells").select(*CELL, "pop")
    target = Grid(-30 * 40000, 10 * 40000, 40000, -40000, 60, 20)
    return grid.resample(cells, _grid(cells), target, lambda x, y: crs.azimuthal_inverse(x, y, 12.0, -4.0))


_INSIDE = c.ORACLE["rasterize_polygon"]


@query(f"WITH a AS ({_INSIDE}), v AS ({c.ORACLE['nearest_resample']}) SELECT a.fid, v.row_i, v.col_j, v.pop FROM v JOIN a USING (row_i, col_j)")
def masked_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster on another grid, inside areas only."""
    return grid.within(c.nearest_resample(spark, sf_dir), vector.rasterize(c._triangles(spark, sf_dir), ["fid"], 100, 100))


@query(f"WITH a AS ({_INSIDE}) SELECT DISTINCT a.fid, cast(a.row_i + i AS INT) AS row_i, cast(a.col_j + j AS INT) AS col_j FROM a, range(-2, 3) x(i), range(-2, 3) y(j) WHERE i * i + j * j <= 4")
def polygon_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas widened by a distance, each by itself."""
    inside = vector.rasterize(c._triangles(spark, sf_dir), ["fid"], 100, 100)
    return focal.dilate(inside, focal.pixels_of(1800, 900), ["fid"]).select("fid", *CELL)


@query(f"WITH a AS ({_INSIDE}) SELECT DISTINCT n_regionkey AS region, row_i, col_j FROM a JOIN nation ON n_nationkey = fid")
def layer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area of each region: the union of its nations'."""
    region = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("fid"), F.col("n_regionkey").alias("region"))
    return vector.union_cells(vector.rasterize(c._triangles(spark, sf_dir), ["fid"], 100, 100).join(region, "fid"), ["region"])


@query(f"WITH {c._TRI_EDGES}, a AS ({_INSIDE}), m AS (SELECT fid, x1 + 4.5 AS x1, y1 + 3.75 AS y1, x2 + 4.5 AS x2, y2 + 3.75 AS y2 FROM e), r AS (SELECT fid, i AS row_i, x1 + (i + 0.5 - y1) * (x2 - x1) / (y2 - y1) AS x FROM m, range(0, 100) g(i) WHERE least(y1, y2) <= i + 0.5 AND i + 0.5 < greatest(y1, y2)), s AS (SELECT fid, row_i, min(x) AS u, max(x) AS v FROM r GROUP BY ALL), b AS (SELECT DISTINCT row_i, j AS col_j FROM s, range(0, 100) g(j) WHERE j + 0.5 >= u AND j + 0.5 < v) SELECT a.fid, a.row_i, a.col_j FROM a SEMI JOIN b USING (row_i, col_j)")
def layer_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of areas inside another layer; areas without a part are gone."""
    layer = vector.union_cells(vector.rasterize(c._moved(spark, sf_dir), ["fid"], 100, 100))
    return grid.within(vector.rasterize(c._triangles(spark, sf_dir), ["fid"], 100, 100), layer)


@query("SELECT n_nationkey AS fid, cast(3 AS INT) AS points FROM nation")
def repaired_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles with repeated and closing points, and rings without area beside them."""
    twice = lambda ring: F.concat(ring, F.slice(ring, 3, 1), F.slice(ring, 1, 1))
    broken = c._triangles(spark, sf_dir).withColumn("rings", F.concat(F.transform("rings", twice), F.transform("rings", lambda r: F.slice(r, 1, 2))))
    gone = broken.where("fid < 3").withColumns({"fid": F.col("fid") + 100, "rings": F.slice("rings", 2, 1)})
    return vector.repair(broken.unionByName(gone)).select("fid", F.size(F.element_at("rings", 1)).alias("points"))


@query("""WITH p AS (SELECT c_custkey, radians((c_custkey * 37 % 360) - 180.0) AS l, radians((c_custkey * 17 % 160) - 80.0) AS f FROM customer)
  SELECT c_custkey, cast(round(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((f - radians(20.0)) / 2), 2) + cos(f) * cos(radians(20.0)) * pow(sin((l - radians(8.0)) / 2), 2)))) / 10) AS BIGINT) AS decametres FROM p""")
def projected_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances from the middle of an equidistant system."""
    points = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", (F.col("c_custkey") * 37 % 360 - 180.0).alias("lon"), (F.col("c_custkey") * 17 % 160 - 80.0).alias("lat"))
    x, y = crs.azimuthal(F.col("lon"), F.col("lat"), 8.0, 20.0)
    return points.select("c_custkey", F.round(F.sqrt(x * x + y * y) / 10).cast("long").alias("decametres"))


@query("SELECT s_suppkey AS k, cast(round(((s_suppkey * 37 % 360) - 180.0) * 100000) AS BIGINT) AS lon_1e5, cast(round(((s_suppkey * 17 % 150) - 75.0) * 100000) AS BIGINT) AS lat_1e5 FROM supplier")
def systems_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in the system that is chosen for a box around them, and back."""
    lon, lat = F.col("s_suppkey") * 37 % 360 - 180.0, F.col("s_suppkey") * 17 % 150 - 75.0
    wide, tall = 2.0 + F.col("s_suppkey") % 4 * 20, 2.0 + F.col("s_suppkey") % 3 * 6
    points = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"), lon.alias("lon"), lat.alias("lat"), (lon - wide / 3).alias("minx"), (lon + wide / 2).alias("maxx"), (lat - tall / 3).alias("miny"), (lat + tall / 3).alias("maxy"))
    known = points.join(crs.choose_crs(points, "k").select("k", "system"), "k")
    x, y = crs.project(F.col("system"), F.col("lon"), F.col("lat"))
    lon, lat = crs.unproject(F.col("system"), F.col("x"), F.col("y"))
    back = known.select("k", "system", x.alias("x"), y.alias("y")).select("k", lon.alias("lon"), lat.alias("lat"))
    # the two names of one meridian
    turned = F.when(F.col("lon") > 180 - 1e-7, F.col("lon") - 360).otherwise(F.col("lon"))
    return back.select("k", F.round(turned * 100_000).cast("long").alias("lon_1e5"), F.round(F.col("lat") * 100_000).cast("long").alias("lat_1e5"))


@query(f"""WITH RECURSIVE {c._FLOW} SELECT row_i, col_j, to_i, to_j, cast(round(slope / sum(slope) OVER (PARTITION BY row_i, col_j) * 1000000) AS BIGINT) AS share_1e6 FROM (SELECT *, "drop" / (CASE WHEN slant THEN sqrt(2.0::DOUBLE) ELSE 1.0::DOUBLE END) AS slope FROM l)""")
def flow_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = hydro.flow_shares(hydro.flow_edges(load(spark, sf_dir, "fx_dem")))
    return shares.select(*CELL, "to_i", "to_j", F.round(F.col("share") * 1_000_000).cast("long").alias("share_1e6"))


@query(f"WITH e AS ({EDGES}) SELECT count(*) AS n_edges, count(*) FILTER (next_down = 0) AS n_outlets FROM e")
def network_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "fx_edges").agg(F.count("*").alias("n_edges"), F.count(F.when(F.col("next_down") == 0, 1)).alias("n_outlets"))


@query("""WITH b AS (SELECT s_suppkey AS box_id, (s_suppkey * 37 % 360) - 180.0 AS minx, (s_suppkey * 17 % 100) - 50.0 AS miny, 80.0 + s_suppkey % 3 * 10 AS wide, 2.0 + s_suppkey % 5 AS tall FROM supplier),
  d AS (SELECT *, miny + tall / 2 AS lat0, minx + wide / 2 AS lon FROM b)
  SELECT box_id, '+proj=eqdc +lat_1=' || printf('%.8f', miny + tall / 4) || ' +lat_2=' || printf('%.8f', miny + 3 * tall / 4) || ' +lat_0=' || printf('%.8f', lat0) || ' +lon_0=' || printf('%.8f', CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END) || ' +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs' AS crs FROM d""")
def choose_crs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of thousands of kilometres that are wider than tall: conic systems."""
    wide, tall = 80.0 + F.col("s_suppkey") % 3 * 10, 2.0 + F.col("s_suppkey") % 5
    minx, miny = F.col("s_suppkey") * 37 % 360 - 180.0, F.col("s_suppkey") * 17 % 100 - 50.0
    right = minx + wide
    boxes = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("box_id"), minx.alias("minx"), miny.alias("miny"), F.when(right > 180, right - 360).otherwise(right).alias("maxx"), (miny + tall).alias("maxy"))
    return crs.choose_crs(boxes, "box_id").select("box_id", "crs")


@query("SELECT n_nationkey AS fid, cast(2 AS INT) AS n_rings, cast(2000 * (1 + n_nationkey % 4) * (1 + n_nationkey % 3) AS BIGINT) AS area_milli, cast(1000 * (1 + n_nationkey % 4) * (1 + n_nationkey % 3) AS BIGINT) AS first_milli FROM nation")
def noded_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that cross themselves, a bow-tie for each nation, as rings that don't: their
    number, whole area and the area of the first."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key = F.col("n_nationkey")
    x, y, a, b = key * 7.25, key * 3.5, 1.0 + key % 4, 1.0 + key % 3
    corner = lambda i, j: F.struct((x + 2 * i * a).alias("x"), (y + 2 * j * b).alias("y"))
    bows = nations.select(key.cast("int").alias("fid"), F.array(F.array(corner(0, 0), corner(1, 1), corner(1, 0), corner(0, 1))).alias("rings"))
    rings = vector.node(bows, "fid", 2.0)
    one = rings.select("fid", F.array(F.element_at("rings", 1)).alias("rings"))
    size = vector.measures(rings, ["fid"]).select("fid", F.round(F.col("area") * 1000).cast("long").alias("area_milli"))
    first = vector.measures(one, ["fid"]).select("fid", F.round(F.col("area") * 1000).cast("long").alias("first_milli"))
    return rings.select("fid", F.size("rings").alias("n_rings")).join(size, "fid").join(first, "fid")


@query(f"SELECT row_i, col_j, pop AS v, 'bigint' AS dtype, cast(-9999 AS DOUBLE) AS nodata FROM ({CELLS}) WHERE pop <> -9999 AND row_i BETWEEN 1 AND 8")
def raster_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster of whole numbers with a nodata value, written and its window read: the
    type stays, nodata cells are missing."""
    cells = load(spark, sf_dir, "fx_cells").select(*CELL, F.col("pop").alias("v"))
    path = _place(spark)
    tables.write_raster(cells, _grid(cells), path, "pop", nodata=-9999)
    found, _ = tables.read_raster(spark, path, "pop", bounds=(0.5, -8.5, 99.5, -1.5))
    header = tables.raster_header(spark, path, "pop")
    return found.select(*CELL, "v", F.lit(header["dtype"]).alias("dtype"), F.lit(header["nodata"]).alias("nodata"))
