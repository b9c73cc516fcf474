"""The composite analyses: population within a travel time and population downstream of a
condition.

Areas of interest are a column of every table, so all areas of a run are one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.model import Grid
from terrascape.operators import focal, hydro, masks, reach
from terrascape.operators.grid import common_bounds


def full_extent_area(spark: SparkSession, grids: list[Grid], name: str = "full_raster_extent") -> DataFrame:
    """The generated area of interest: the box that all rasters share (in one system of
    degrees), as a feature; no common area or a raster without a system is an error."""
    if any(not g.crs for g in grids):
        raise ValueError("a raster has no coordinate system")
    minx, miny, maxx, maxy = (float(v) for v in common_bounds([g.bounds for g in grids]))
    ring = [{"x": x, "y": y} for x, y in ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy))]
    return spark.createDataFrame([(name, [ring])], "aoi_id string, rings array<array<struct<x:double,y:double>>>")


def travel_population(cells: DataFrame, max_hours: float, cell_len: float) -> DataFrame:
    """``aoi_id, row_i, col_j, pop``: population that reaches an area within the time.

    ``cells``: ``aoi_id, row_i, col_j, friction, source, pop`` on a metric grid, already
    within ``buffer_metres(max_hours)`` of each area's box.
    """
    found = reach.reach(cells, max_hours * 60, cell_len)
    key = ["aoi_id", "row_i", "col_j"]
    both = cells.select(*key, "pop").join(found.select(*key, F.lit(1).alias("m")), key, "left")
    return both.select(*key, masks.covered_by_reach(F.coalesce("m", F.lit(0)), F.col("pop")).alias("pop"))


def downstream_population(dem: DataFrame, condition: DataFrame, pop: DataFrame, buffer_m: float, pixel_m: float, max_distance_m: float | None = None, filled: bool = False, by: list[str] | None = None) -> DataFrame:
    """``row_i, col_j, pop``: population on or downstream of cells where the condition
    holds (``row_i, col_j, hit``), widened by ``buffer_m``; with a distance, only where
    the straight line to the condition is longer than 0 and at most that long.  With
    ``by`` (``aoi_id``) all tables hold several grids, each by itself."""
    by = by or []
    key = [*by, "row_i", "col_j"]
    terrain = dem if filled else hydro.fill_pits(dem)
    start = condition.where("hit > 0").select(*key)
    covered = hydro.reachable(hydro.flow_edges(terrain, by), start.join(terrain.hint("merge"), key, "left_semi"), by)
    wide = focal.dilate(covered, focal.pixels_of(buffer_m, pixel_m), by).select(*key, F.lit(1).alias("m"))
    if max_distance_m is not None:
        marks = terrain.select(*key).join(start.withColumn("marked", F.lit(True)).hint("merge"), key, "left").fillna(False, ["marked"])
        far = focal.distance(marks, by=by).select(*key, F.sqrt("d2").alias("px"))
        wide = wide.join(far.hint("merge"), key).where(masks.within_distance(F.col("m"), F.col("px"), pixel_m, max_distance_m)).select(*key, "m")
    return masks.mask_population(pop, wide, masks.covered_downstream, by)
