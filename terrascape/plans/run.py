"""A configuration run from files to its table: rasters and layers in degrees are read,
each area's masks are computed on grids of its own, and population is counted after
all layers are aligned to one grid of degrees.

Areas are a column of every table, so a run is one plan for all of them: a travel-time
mask works on a metric grid for each area, a conditional mask on the box of each drain
partition of it.  The grid of degrees has the configured cell size and begins where the
population raster does.
"""

from __future__ import annotations

import logging
import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.functions import crs
from terrascape.functions.scalars import buffer_metres
from terrascape.model import Grid
from terrascape.operators import grid as grids
from terrascape.operators import hydro, masks, network, reach, vector
from terrascape.plans import workflow
from terrascape.plans.config import CONDITIONAL, TRAVEL_TIME, WATERSHED_FIELDS, Config
from terrascape.sources import tables
from terrascape.sources.durable import Stage

log = logging.getLogger("terrascape")
CELL = ["row_i", "col_j"]
#: Points along each side of a box by which its outline is projected.
OUTLINE = 20


def areas_of(spark: SparkSession, config: Config) -> DataFrame:
    """``aoi_id, rings``: the areas that the configuration names."""
    if config.full_extent:
        found = [tables.open_raster(spark, str(p))[1] for k, p in config.paths.items() if k.endswith("raster_path")]
        return workflow.full_extent_area(spark, found)
    read = tables.areas(spark, tables.matching(spark, config.aoi_patterns))
    return vector.repair(read.groupBy("aoi_id").agg(F.flatten(F.collect_list("rings")).alias("rings")))


def on_grid(raster: DataFrame, source: Grid, places: DataFrame, x: Column, y: Column, name: str) -> DataFrame:
    """``places`` with the value, as ``name``, of the source cell that holds (x, y)."""
    row, col = grids.cell_of(source, x, y)
    values = raster.select(F.col("row_i").alias("__i"), F.col("col_j").alias("__j"), F.col("v").alias(name))
    return places.withColumns({"__i": row, "__j": col}).join(values, ["__i", "__j"], "left").drop("__i", "__j")


def _cells_of(frames: DataFrame) -> DataFrame:
    """All cells ``row_i, col_j`` of windows (``r0, r1, c0, c1``, inclusive)."""
    return frames.where("r0 <= r1 AND c0 <= c1").withColumn("row_i", F.explode(F.sequence("r0", "r1"))).withColumn("col_j", F.explode(F.sequence("c0", "c1"))).drop("r0", "r1", "c0", "c1")


def _window(world: Grid, boxes: DataFrame) -> DataFrame:
    """Boxes of degrees as windows ``r0, r1, c0, c1`` of the grid of degrees: the cells that
    they overlap by more than rounding."""
    r = lambda y: (F.col(y) - world.y0) / world.dy
    c = lambda x: (F.col(x) - world.x0) / world.dx
    first, last = lambda v: F.floor(v + 1e-6).cast("int"), lambda v: (F.ceil(v - 1e-6) - 1).cast("int")
    return boxes.withColumns({"r0": first(r("maxy")), "r1": last(r("miny")), "c0": first(c("minx")), "c1": last(c("maxx"))}).drop("minx", "miny", "maxx", "maxy")


def _bounds(boxes: DataFrame, around: float = 0.0) -> tuple[float, float, float, float]:
    """The box of all boxes, widened, by which files are pruned."""
    b = vector.extent(boxes).first()
    return b["minx"] - around, b["miny"] - around, b["maxx"] + around, b["maxy"] + around


def _rings_in(features: DataFrame, x: Column, y: Column, key: list[str]) -> DataFrame:
    """The rings of features with other coordinates; x and y are given as columns of
    ``x``, ``y`` and the key."""
    points = features.select(*key, F.posexplode("rings").alias("ring", "p")).select(*key, "ring", F.posexplode("p").alias("at", "p")).select(*key, "ring", "at", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    moved = points.select(*key, "ring", F.struct("at", x.alias("x"), y.alias("y")).alias("p"))
    rings = moved.groupBy(*key, "ring").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return rings.select(*key, F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("r")).groupBy(*key).agg(F.collect_list("r").alias("rings"))


def travel_layer(areas: DataFrame, systems: DataFrame, rasters: dict[str, tuple[DataFrame, Grid]], world: Grid, hours: float, pixel_m: float) -> DataFrame:
    """``aoi_id, row_i, col_j, pop`` on the grid of degrees: population that reaches the
    area in time.  The metric grid is the area's projected box and as far around it as
    any travel goes."""
    known = areas.join(systems.select("aoi_id", "system"), "aoi_id")
    x, y = crs.project(F.col("system"), F.col("x"), F.col("y"))
    metric = Stage(_rings_in(known, x, y, ["aoi_id", "system"])).df
    around = buffer_metres(hours)
    size = lambda lo, hi: F.ceil((F.col(hi) - F.col(lo) + 2 * around) / pixel_m).cast("int")
    frame = vector.boxes(metric, ["aoi_id", "system"]).select("aoi_id", "system", (F.col("minx") - around).alias("left"), (F.col("maxy") + around).alias("top"), F.lit(0).alias("r0"), (size("miny", "maxy") - 1).alias("r1"), F.lit(0).alias("c0"), (size("minx", "maxx") - 1).alias("c1"))
    frame = Stage(frame).df  # a row an area
    cells = _cells_of(frame)
    lon, lat = crs.unproject(F.col("system"), F.col("left") + (F.col("col_j") + 0.5) * pixel_m, F.col("top") - (F.col("row_i") + 0.5) * pixel_m)
    cells = cells.withColumns({"lon": lon, "lat": lat}).select("aoi_id", *CELL, "lon", "lat")
    for name in ("friction", "pop"):
        cells = on_grid(*rasters[name], cells, F.col("lon"), F.col("lat"), name)
    px = lambda c, lo, sign: (F.col(c) - F.col(lo)) * sign / pixel_m
    shapes = _rings_in(metric.join(frame.select("aoi_id", "left", "top"), "aoi_id"), px("x", "left", 1), px("y", "top", -1), ["aoi_id", "left", "top"]).drop("left", "top")
    inside = vector.rasterize(shapes, ["aoi_id"], 1 << 30, 1 << 30).withColumn("source", F.lit(True))
    cells = Stage(cells.join(inside, ["aoi_id", *CELL], "left").select("aoi_id", *CELL, "friction", F.coalesce("source", F.lit(False)).alias("source"), "pop")).df
    masked = workflow.travel_population(cells, hours, pixel_m).where("pop > 0")
    # to the grid of degrees: the window of the frame's outline, then each cell's place in the frame
    side = F.explode(F.array(*[F.lit(k / OUTLINE) for k in range(OUTLINE + 1)]))
    ring = frame.withColumn("t", side).withColumns({"w": (F.col("c1") + 1) * pixel_m, "h": (F.col("r1") + 1) * pixel_m})
    at = F.explode(F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in ((F.col("t"), F.lit(0.0)), (F.col("t"), F.lit(1.0)), (F.lit(0.0), F.col("t")), (F.lit(1.0), F.col("t")))]))
    outline = ring.withColumn("at", at)
    lon, lat = crs.unproject(F.col("system"), F.col("left") + F.col("at.u") * F.col("w"), F.col("top") - F.col("at.v") * F.col("h"))
    seen = outline.select("aoi_id", lon.alias("lon"), lat.alias("lat")).groupBy("aoi_id").agg(F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy"))
    goal = _cells_of(_window(world, seen)).join(frame.select("aoi_id", "system", "left", "top"), "aoi_id")
    lon, lat = grids.centre(world, F.col("row_i"), F.col("col_j"))
    x, y = crs.project(F.col("system"), lon, lat)
    goal = goal.select("aoi_id", *CELL, F.floor((F.col("top") - y) / pixel_m).cast("int").alias("__i"), F.floor((x - F.col("left")) / pixel_m).cast("int").alias("__j"))
    held = masked.select("aoi_id", F.col("row_i").alias("__i"), F.col("col_j").alias("__j"), "pop")
    return goal.join(held, ["aoi_id", "__i", "__j"]).select("aoi_id", *CELL, F.col("pop").cast("double").alias("pop"))


def drain_partitions(areas: DataFrame, watersheds: DataFrame, bin_size: float = 1.0) -> DataFrame:
    """``aoi_id, hybas_id, next_sink, rings`` of the watersheds that meet an area and of
    all downstream of them; a watershed without a terminal sink is an error."""
    edges = watersheds.groupBy("hybas_id").agg(F.min("next_down").alias("next_down"), F.min("next_sink").alias("next_sink"))
    met = vector.intersects_join(areas.select("aoi_id", "rings"), watersheds.select("hybas_id", "rings"), bin_size, "aoi_id", "hybas_id")
    closed = network.downstream_closure(met, edges, ["aoi_id"]).join(edges.select("hybas_id", "next_sink"), "hybas_id", "left")
    network.check_sinks(closed)
    return closed.join(network.first_rows(watersheds.select("hybas_id", "rings"), ["hybas_id"], ["rings"]), "hybas_id").select("aoi_id", "hybas_id", "next_sink", "rings")


def conditional_layers(config: Config, areas: DataFrame, members: DataFrame, rasters: dict[str, tuple[DataFrame, Grid]], world: Grid) -> dict[str, DataFrame]:
    """``aoi_id, row_i, col_j, pop`` of each conditional mask on the grid of degrees.

    A unit is one drain partition of one area, clipped to the box of its watersheds;
    terrain is filled and flows within it."""
    unit = F.concat_ws("/drain_", "aoi_id", F.col("next_sink").cast("string"))
    boxes = vector.boxes(members.withColumn("unit", unit), ["unit", "aoi_id"])
    lon, lat = grids.centre(world, F.col("row_i"), F.col("col_j"))
    places = _cells_of(_window(world, boxes))
    base = on_grid(*rasters["dem"], on_grid(*rasters["pop"], places, lon, lat, "pop"), lon, lat, "elev")
    base = Stage(base.select(F.col("unit").alias("aoi_id"), F.col("aoi_id").alias("area"), *CELL, "pop", F.col("elev").cast("double").alias("elev"))).df
    terrain = Stage(hydro.fill_pits(base.select("aoi_id", *CELL, "elev"))).df
    px = lambda c, lo, step: (F.col(c) - lo) / step
    shapes = _rings_in(areas, px("x", world.x0, world.dx), px("y", world.y0, world.dy), ["aoi_id"])
    inside = Stage(vector.rasterize(shapes, ["aoi_id"], 1 << 30, 1 << 30).withColumnRenamed("aoi_id", "area")).df
    out = {}
    for m in config.masks:
        if m.type != CONDITIONAL:
            continue
        own = base.select("aoi_id", "area", *CELL).join(inside, ["area", *CELL], "left_semi")
        value = on_grid(*rasters[m.id], own, lon, lat, "v")
        hit = masks.condition(value, m.params["expression"], keep=["aoi_id"])
        limit = m.params.get("max_downstream_distance_m")
        got = workflow.downstream_population(terrain, hit, base.select("aoi_id", *CELL, "pop"), config.numbers["buffer_size_m"], config.numbers["travel_time_pixel_size_m"], None if limit is None else float(limit), filled=True, by=["aoi_id"])
        areas_of_units = boxes.select(F.col("unit").alias("aoi_id"), F.col("aoi_id").alias("area"))
        out[m.id] = got.where("pop > 0").join(areas_of_units, "aoi_id").groupBy(F.col("area").alias("aoi_id"), *CELL).agg(F.max("pop").cast("double").alias("pop"))
    return out


def run(spark: SparkSession, config: Config, now: datetime | None = None) -> str:
    """Compute the table of a configuration and write it; returns its path.  The layers
    are kept in ``output_dir``, the drain partitions in ``work_dir``."""
    areas = Stage(areas_of(spark, config)).df
    boxes = vector.boxes(areas, ["aoi_id"])
    systems = Stage(crs.choose_crs(boxes, "aoi_id")).df
    log.info("%d areas", systems.count())
    names = {"pop": config.paths["population_raster_path"], "friction": config.paths["traveltime_raster_path"], "dem": config.paths["dem_raster_path"]}
    names |= {m.id: m.params["condition_raster_path"] for m in config.masks if m.type == CONDITIONAL}
    farthest = max([buffer_metres(float(m.params["max_hours"])) for m in config.masks if m.type == TRAVEL_TIME], default=0.0)
    conditional = any(m.type == CONDITIONAL for m in config.masks)
    members = None
    extent = _bounds(boxes)
    if conditional:
        read = tables.read_features(spark, str(config.paths["subwatershed_vector_path"]), fields=list(WATERSHED_FIELDS))
        sheds = read.select(*[F.col(f).alias(f.lower()) for f in WATERSHED_FIELDS], "rings")
        members = Stage(drain_partitions(areas, vector.repair(sheds))).df
        lost = areas.select("aoi_id").join(members, "aoi_id", "left_anti").first()
        if lost is not None:
            raise ValueError(f"no watershed meets the area {lost['aoi_id']!r}")
        tables.write_partitions(members, f"{config.work_dir}/drain_partitions")
        log.info("%d watersheds in drain partitions", members.count())
        extent = _bounds(vector.boxes(areas.select("rings", F.lit(0).alias("k")).unionByName(members.select("rings", F.lit(0).alias("k"))), ["k"]))
    # degrees that a travel may cross at the highest latitude of the areas
    tall = farthest / 110_000
    wide = tall / max(0.05, math.cos(math.radians(min(85.0, max(abs(extent[1]), abs(extent[3])) + tall))))
    near = (extent[0] - wide, extent[1] - tall, extent[2] + wide, extent[3] + tall)
    rasters = {k: tables.open_raster(spark, str(p), near) for k, p in names.items()}
    for k, (_, g) in rasters.items():
        if g.crs != "EPSG:4326":
            raise ValueError(f"the raster {names[k]} is not in degrees (EPSG:4326) but {g.crs or 'without a system'}")
    source, step = rasters["pop"][1], config.numbers["wgs84_pixel_size"]
    world = Grid(source.x0, source.y0, step, -step, math.ceil(source.width * abs(source.dx) / step), math.ceil(source.height * abs(source.dy) / step), "EPSG:4326")
    layers = conditional_layers(config, areas, members, rasters, world) if conditional else {}
    for m in config.masks:
        if m.type == TRAVEL_TIME:
            layers[m.id] = travel_layer(areas, systems, rasters, world, float(m.params["max_hours"]), config.numbers["travel_time_pixel_size_m"])
    order = [m.id for m in config.masks]
    every = None
    for name in order:
        one = layers[name].select("aoi_id", *CELL, F.lit(name).alias("mask_id"), "pop")
        every = one if every is None else every.unionByName(one)
    # an area whose layer has no population counts 0
    zero = areas.select("aoi_id", F.lit(-1).alias("row_i"), F.lit(-1).alias("col_j"), F.explode(F.array(*[F.lit(n) for n in order])).alias("mask_id"), F.lit(0.0).alias("pop"))
    every = Stage(every.unionByName(zero)).df
    every.where("row_i >= 0").write.mode("overwrite").partitionBy("aoi_id", "mask_id").parquet(f"{config.output_dir}/pop_layers")
    return tables.write_result(masks.wide(masks.sums(every, ["aoi_id"]), order), config.output_dir, config.run_name, now)
