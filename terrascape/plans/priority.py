"""Proposed priority areas: for each focal area, the watersheds around it are ranked by
population, walked upstream under an area budget, and what they hold of the priority
place is eroded to the budget.

Shapes are cells of a metric grid around the focal area (azimuthal equidistant, at its
centroid): buffers are dilations, clips joins, unions distinct cells, areas counts.
Populations are summed on the population raster's own grid.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.functions import crs
from terrascape.model import Grid
from terrascape.operators import erode, focal, grid, network, vector
from terrascape.plans.config import FocalArea, load_focal
from terrascape.plans.run import _rings_in
from terrascape.sources import tables
from terrascape.sources.durable import Stage

log = logging.getLogger("terrascape")
CELL = ["row_i", "col_j"]


def zonal_population(watersheds: DataFrame, pop: DataFrame, source: Grid) -> DataFrame:
    """``hybas_id, pop_sum``: the sum over all cells of the raster that a watershed touches."""
    px = lambda c, lo, step: (F.col(c) - lo) / step
    shapes = _rings_in(watersheds, px("x", source.x0, source.dx), px("y", source.y0, source.dy), ["hybas_id"])
    zones = vector.touched(shapes, ["hybas_id"], source.width, source.height)
    return vector.zonal_sums(zones, pop.select(*CELL, F.col("v").alias("pop")), "hybas_id").select("hybas_id", "pop_sum")


def propose(spark: SparkSession, place: DataFrame, watersheds: DataFrame, population: tuple[DataFrame, Grid], area: FocalArea, cell_m: float = 1000.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The proposed cells (``row_i, col_j, lon, lat``), the walk (as of
    ``network.greedy_selection``) and the totals of one focal area.

    ``place``: ``rings`` of the priority place, ``watersheds``: ``hybas_id, next_down,
    rings``, both in degrees; of several rows of a watershed the first by its next one
    counts.  A marine place is its buffer, as far as watersheds reach into it."""
    whole = place.select(F.lit(area.id).alias("focal_id"), "rings").groupBy("focal_id").agg(F.flatten(F.collect_list("rings")).alias("rings"))
    middle = vector.measures(whole, ["focal_id"]).first()
    if middle is None:
        raise ValueError(f"the focal area {area.id!r} has no shape")
    # one row of numbers
    number = {"kind": F.lit("aeqd"), "lon0": F.lit(middle["cx"]), "lat0": F.lit(middle["cy"]), "lat1": F.lit(0.0), "lat2": F.lit(0.0), "north": F.lit(0.0)}
    system = F.struct(*[v.alias(k) for k, v in number.items()])
    x, y = crs.project(system, F.col("x"), F.col("y"))
    metric = Stage(_rings_in(whole, x, y, ["focal_id"])).df
    box = vector.boxes(metric, ["focal_id"]).first()
    around = area.buffer_m + 2 * cell_m
    left, top = box["minx"] - around, box["maxy"] + around
    width, height = math.ceil((box["maxx"] + around - left) / cell_m), math.ceil((top - box["miny"] + around) / cell_m)
    px = lambda shapes, key: _rings_in(shapes, (F.col("x") - left) / cell_m, (top - F.col("y")) / cell_m, key)
    inside = Stage(vector.union_cells(vector.rasterize(px(metric, ["focal_id"]), ["focal_id"], width, height))).df
    buffer = Stage(focal.dilate(inside, focal.pixels_of(area.buffer_m, cell_m)).select(*CELL)).df
    # watersheds near the frame, as cells of it
    lon, lat = crs.unproject(system, left + F.col("u") * width * cell_m, top - F.col("v") * height * cell_m)
    corners = spark.createDataFrame([(a / 8, b / 8) for a in range(9) for b in range(9)], "u double, v double").select(lon.alias("lon"), lat.alias("lat"))
    b = corners.agg(F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy")).first()
    sheds = network.first_rows(watersheds.select("hybas_id", "next_down", "rings"), ["hybas_id"], ["next_down", "rings"])
    boxed = sheds.join(vector.boxes(sheds, ["hybas_id"]), "hybas_id").where((F.col("minx") <= b["maxx"]) & (F.col("maxx") >= b["minx"]) & (F.col("miny") <= b["maxy"]) & (F.col("maxy") >= b["miny"]))
    near = Stage(boxed.select("hybas_id", "next_down", "rings")).df
    shapes = px(_rings_in(near, x, y, ["hybas_id"]), ["hybas_id"])
    touched = Stage(vector.touched(shapes, ["hybas_id"], width, height)).df
    held = Stage(vector.rasterize(shapes, ["hybas_id"], width, height)).df
    found = Stage(grid.within(touched, buffer).select("hybas_id").distinct()).df
    log.info("%s: %d watersheds meet the buffer", area.id, found.count())
    target = grid.within(buffer, vector.union_cells(held.join(found, "hybas_id", "left_semi"))) if area.is_marine else inside
    clipped = Stage(grid.within(held.join(found, "hybas_id", "left_semi"), target)).df
    hectares = cell_m * cell_m / 10_000
    areas = clipped.groupBy("hybas_id").agg((F.count("*") * hectares).alias("pp_area_ha"))
    meeting = near.join(found, "hybas_id", "left_semi")
    rows = meeting.select("hybas_id", "next_down").join(zonal_population(meeting, *population), "hybas_id", "left").join(areas, "hybas_id", "left")
    rows = rows.select(F.lit(area.id).alias("focal_id"), "hybas_id", "next_down", F.coalesce("pop_sum", F.lit(0)).cast("double").alias("pop_sum"), F.col("pp_area_ha").isNotNull().alias("hits_pp"), F.coalesce("pp_area_ha", F.lit(0.0)).alias("pp_area_ha"))
    walk = Stage(network.greedy_selection(rows, area.max_ha)).df
    chosen = Stage(vector.union_cells(clipped.join(walk.where("selected").select("hybas_id"), "hybas_id", "left_semi"))).df
    most = area.max_ha / hectares
    kept = Stage(erode.erode_to_area(chosen, most, 0.01 * most, step=True)).df
    lon, lat = crs.unproject(system, left + (F.col("col_j") + 0.5) * cell_m, top - (F.col("row_i") + 0.5) * cell_m)
    size = kept.agg(F.floor(F.count("*") * hectares).cast("long").alias("total_pp_selected_area_ha"))
    totals = network.selection_totals(walk).select("focal_id", F.floor("pop_sum").cast("long").alias("total_downstream_pop"), "n_visited", "n_selected").crossJoin(F.broadcast(size))  # one row each
    return kept.select(*CELL, lon.alias("lon"), lat.alias("lat")), walk, totals


def run(spark: SparkSession, path: str, population_path: str, cell_m: float = 1000.0) -> list[str]:
    """Each focal area of a configuration; an area that cannot be read or meets no
    watershed is told and passed over.  Returns the folders written."""
    layer, out_dir, areas = load_focal(path)
    watersheds = tables.read_features(spark, layer, fields=["HYBAS_ID", "NEXT_DOWN"])
    watersheds = vector.repair(watersheds.select(F.col("HYBAS_ID").alias("hybas_id"), F.col("NEXT_DOWN").alias("next_down"), "rings"))
    population, written = tables.open_raster(spark, population_path), []
    for area in areas:  # as many as the configuration lists
        if not tables.matching(spark, [area.path]):
            log.warning("%s: no layer at %s", area.id, area.path)
            continue
        kept, walk, totals = propose(spark, vector.repair(spark.read.parquet(area.path)), watersheds, population, area, cell_m)
        if walk.isEmpty():
            log.warning("%s meets no watershed", area.id)
            continue
        for name, table in (("cells", kept), ("walk", walk), ("totals", totals)):
            table.write.mode("overwrite").parquet(f"{out_dir}/{area.id}_proposed_areas/{name}")
        written.append(f"{out_dir}/{area.id}_proposed_areas")
    return written
