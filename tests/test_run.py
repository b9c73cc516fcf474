"""A configuration run from files, against plain computation."""

import csv
import glob
import math

import pytest
from pyspark.sql import functions as F

from terrascape.functions import crs
from terrascape.model import Grid
from terrascape.operators import grid as grids
from terrascape.operators import vector
from terrascape.plans import cli, config, run
from terrascape.sources import tables

#: A world of 60 x 60 cells of 0.01 degrees.
WORLD = Grid(8.7, 48.3, 0.01, -0.01, 60, 60, "EPSG:4326")


def square(minx, miny, maxx, maxy):
    return [[{"x": float(x), "y": float(y)} for x, y in ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy))]]


def features(spark, rows, ddl, path):
    df = spark.createDataFrame(rows, f"{ddl}, rings array<array<struct<x:double,y:double>>>")
    tables.write_features(df, path, df.columns[0])


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    cells = grids.target_cells(spark, WORLD)
    for name, value in {
        "pop": F.lit(1.25) + F.col("col_j") % 3,
        "friction": F.when(F.col("row_i") == 5, -1.0).otherwise(0.0001),
        "dem": F.col("row_i") * 0 - F.col("col_j") + 100.0,
        "rain": F.when((F.col("row_i") == 30) & (F.col("col_j") == 31), 9.0).otherwise(1.0),
    }.items():
        tables.write_raster(cells.withColumn("v", value.cast("double")), WORLD, f"{root}/{name}", name)
    features(spark, [(1, square(8.98, 47.98, 9.02, 48.02))], "fid bigint", f"{root}/aoi_one.parquet")
    features(spark, [(1, square(8.8, 48.2, 8.81, 48.21))], "fid bigint", f"{root}/aoi_two.parquet")
    # watersheds: the middle drains to its eastern neighbour, and that one is an outlet; a third one lies apart
    sheds = [(1, 2, 2, square(8.9, 47.9, 9.1, 48.1)), (2, 0, 2, square(9.1, 47.9, 9.2, 48.1)), (3, 0, 3, square(8.75, 48.15, 8.85, 48.25)), (4, 0, 4, square(9.25, 48.25, 9.29, 48.29))]
    features(spark, sheds, "HYBAS_ID bigint, NEXT_DOWN bigint, NEXT_SINK bigint", f"{root}/sheds.parquet")
    text = f"""
run_name: tiny
work_dir: {root}/work
output_dir: {root}/out
logging: {{level: INFO, to_file: "{root}/log.txt"}}
inputs:
  population_raster_path: {root}/pop
  traveltime_raster_path: {root}/friction
  dem_raster_path: {root}/dem
  subwatershed_vector_path: {root}/sheds.parquet
  aoi_vector_pattern: ["{root}/aoi_*.parquet"]
  wgs84_pixel_size: 0.01
  travel_time_pixel_size_m: 500
  buffer_size_m: 500
sections:
  - masks:
      - {{id: drive, type: travel_time_population, params: {{max_hours: 0.05}}}}
      - {{id: rain, type: conditional_raster, params: {{condition_raster_path: {root}/rain, expression: "value > 5"}}}}
  - combine: [{{id: all, logic: OR}}]
"""
    (root / "tiny.yaml").write_text(text)
    return root


def population(row, col):
    return 1.25 + col % 3


def test_run_end_to_end(spark, world, capsys):
    assert cli.main(["run", str(world / "tiny.yaml"), "--validate-paths"]) == 0
    assert cli.main(["run", str(world / "tiny.yaml")]) == 0
    path = capsys.readouterr().out.strip().splitlines()[-1]
    rows = {r["aoi"]: r for f in glob.glob(f"{path}/*.csv") for r in csv.DictReader(open(f))}
    assert set(rows) == {"aoi_one", "aoi_two"} and list(rows["aoi_one"]) == ["aoi", "drive", "rain", "combined pop"]
    # rain falls on one cell of the middle watershed; below it, to the east, all cells of its row and, as every
    # neighbour to the east is lower, of a cone are reached, to the end of the partition's box; one cell around
    start = (30, 31)
    cone = {(start[0] + i, start[1] + j) for j in range(0, 40) for i in range(-j, j + 1)}
    c0, c1, r0, r1 = 20, 49, 20, 39  # the box of watersheds 1 and 2 in cells
    cone = {(i, j) for i, j in cone if r0 <= i <= r1 and c0 <= j <= c1}
    wide = {(i + a, j + b) for i, j in cone for a, b in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))}
    wide = {(i, j) for i, j in wide if r0 <= i <= r1 and c0 <= j <= c1}
    assert float(rows["aoi_one"]["rain"]) == sum(population(*c) for c in wide) and float(rows["aoi_two"]["rain"]) == 0
    kept = spark.read.parquet(f"{world}/out/pop_layers")
    got = {(r.row_i, r.col_j): r.pop for r in kept.where("aoi_id = 'aoi_one' AND mask_id = 'rain'").collect()}
    assert got == {c: population(*c) for c in wide}
    # travel: friction is small, so the whole metric frame is reached
    drive = {(r.row_i, r.col_j): r.pop for r in kept.where("aoi_id = 'aoi_one' AND mask_id = 'drive'").collect()}
    around = 0.05 * 104_000
    tall, broad = 2 * around + 0.04 * 111_200, 2 * around + 0.04 * 111_320 * math.cos(math.radians(48))
    area = tall * broad / (0.01 * 111_200 * 0.01 * 111_320 * math.cos(math.radians(48)))
    assert abs(len(drive) - area) < 0.15 * area
    assert all(abs(pop - population(*c)) <= 2 for c, pop in drive.items())
    assert float(rows["aoi_one"]["drive"]) == sum(drive.values())
    both = {c: max(drive.get(c, 0), got.get(c, 0)) for c in drive.keys() | got.keys()}
    assert float(rows["aoi_one"]["combined pop"]) == sum(both.values())
    # drain partitions: a folder for each area and sink
    parts = spark.read.parquet(f"{world}/work/drain_partitions")
    assert {(r.aoi_id, r.next_sink, r.hybas_id) for r in parts.collect()} == {("aoi_one", 2, 1), ("aoi_one", 2, 2), ("aoi_two", 3, 3)}
    assert "2 areas" in (world / "log.txt").read_text()


def test_run_errors(spark, world):
    found = config.load(world / "tiny.yaml")
    found.aoi_patterns = [f"{world}/nothing_*"]
    with pytest.raises(FileNotFoundError):
        run.areas_of(spark, found)
    far = spark.createDataFrame([("x", square(0, 0, 1, 1))], "aoi_id string, rings array<array<struct<x:double,y:double>>>")
    sheds = spark.read.parquet(f"{world}/sheds.parquet").selectExpr("HYBAS_ID AS hybas_id", "NEXT_DOWN AS next_down", "NEXT_SINK AS next_sink", "rings")
    assert run.drain_partitions(far, sheds).count() == 0
    near = far.withColumn("rings", F.lit(None)).limit(0).unionByName(far.withColumn("rings", F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 8.95).alias("x"), (p["y"] + 47.95).alias("y"))))))
    with pytest.raises(ValueError, match="without a terminal sink"):
        run.drain_partitions(near, sheds.withColumn("next_sink", F.when(F.col("hybas_id") != 2, F.col("next_sink"))))


def test_full_extent(spark, world):
    found = config.load(world / "tiny.yaml")
    found.full_extent, found.aoi_patterns = True, []
    b = vector.boxes(run.areas_of(spark, found), ["aoi_id"]).first()
    assert (b.minx, b.maxy) == (8.7, 48.3) and abs(b.maxx - 9.3) < 1e-9 and abs(b.miny - 47.7) < 1e-9


@pytest.mark.parametrize("box", [(8.0, 47.0, 9.0, 48.0), (8.0, -48.0, 9.0, -47.0), (170.0, 10.0, -170.0, 30.0), (-60.0, 30.0, 60.0, 40.0), (-60.0, -20.0, 60.0, 20.0), (0.0, -60.0, 7.0, 60.0)])
def test_systems_round_trip(spark, box):
    """What a chosen system projects comes back."""
    boxes = spark.createDataFrame([(1, *box)], "k int, minx double, miny double, maxx double, maxy double")
    points = crs.choose_crs(boxes, "k").crossJoin(spark.createDataFrame([(u / 4, v / 4) for u in range(1, 4) for v in range(1, 4)], "u double, v double"))
    span = (box[2] - box[0]) % 360
    points = points.select("system", crs.normalize_lon(F.lit(box[0]) + F.col("u") * span).alias("lon"), (F.lit(box[1]) + F.col("v") * (box[3] - box[1])).alias("lat"))
    x, y = crs.project(F.col("system"), F.col("lon"), F.col("lat"))
    lon, lat = crs.unproject(F.col("system"), F.col("x"), F.col("y"))
    for r in points.select("*", x.alias("x"), y.alias("y")).select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs((r.lon - r.lon2 + 180) % 360 - 180) < 1e-6 and abs(r.lat - r.lat2) < 1e-6


def test_priority_areas(spark, world, capsys):
    """Of three watersheds around a place the one below it leads upstream to it."""
    # the place lies in watershed 1, which drains to 2; 3 and 4 are beyond the buffer
    features(spark, [(1, square(8.95, 47.95, 9.05, 48.05))], "fid bigint", f"{world}/place.parquet")
    text = f"""
aggregate_vector_path: sheds.parquet
out_dir: proposed
focal_vectors:
  - {{id: inland, path: place.parquet, is_marine: false, buffer_distance_m: 6000, max_proposed_priority_area_ha: 100000}}
  - {{id: small, path: place.parquet, is_marine: false, buffer_distance_m: 6000, max_proposed_priority_area_ha: 4000}}
  - {{id: coast, path: place.parquet, is_marine: true, buffer_distance_m: 6000, max_proposed_priority_area_ha: 100000}}
  - {{id: lost, path: nowhere.parquet, is_marine: false, buffer_distance_m: 1, max_proposed_priority_area_ha: 1}}
"""
    (world / "focal.yaml").write_text(text)
    assert cli.main(["priority", str(world / "focal.yaml"), "--population", f"{world}/pop", "--cell-m", "250"]) == 0
    assert [p.rsplit("/", 1)[1] for p in capsys.readouterr().out.split()] == [f"{n}_proposed_areas" for n in ("inland", "small", "coast")]
    got = {n: spark.read.parquet(f"{world}/proposed/{n}_proposed_areas/totals").first() for n in ("inland", "small", "coast")}
    hectares = 0.1 * 111.2 * 0.1 * 111.32 * math.cos(math.radians(48)) * 100
    assert abs(got["inland"].total_pp_selected_area_ha - hectares) < 0.02 * hectares
    # all touched cells: a ring of one more where the shape ends on a cell's border
    pops = {i: sum(population(r, c) for r in range(20, 41) for c in range(*cols)) for i, cols in {1: (20, 41), 2: (40, 51)}.items()}
    walk = {r.hybas_id: r for r in spark.read.parquet(f"{world}/proposed/inland_proposed_areas/walk").collect()}
    assert set(walk) == {1, 2} and walk[1].selected and not walk[2].selected
    assert all(abs(walk[i].pop_sum - pops[i]) <= 0.12 * pops[i] for i in pops)
    assert got["inland"].total_downstream_pop == sum(r.pop_sum for r in walk.values())
    assert 3300 <= got["small"].total_pp_selected_area_ha <= 4040  # a ring of cells less or more
    assert got["coast"].total_pp_selected_area_ha > got["inland"].total_pp_selected_area_ha
    cells = spark.read.parquet(f"{world}/proposed/small_proposed_areas/cells").agg(F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).first()
    assert 8.95 < cells[0] < cells[1] < 9.05 and 47.95 < cells[2] < cells[3] < 48.05
