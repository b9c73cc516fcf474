"""Neighbourhood operators: disc dilation and exact Euclidean distance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def pixels_of(metres: float, pixel_m: float) -> int:
    """Radius in cells, half to even."""
    return int(round(metres / pixel_m))


def disc_kernel(spark: SparkSession, radius: int) -> DataFrame:
    """``di, dj`` of the cells within the radius."""
    side = F.sequence(F.lit(-radius), F.lit(radius))
    return spark.range(1).select(F.explode(side).alias("di")).select("di", F.explode(side).alias("dj")).where(F.col("di") * F.col("di") + F.col("dj") * F.col("dj") <= radius * radius)


def disc_cells(radii: DataFrame, key: str, metres: str, pixel_m: float) -> DataFrame:
    """``key, di, dj``: the cells within each row's radius (``metres``; in cells, half to
    even)."""
    r = F.bround(F.col(metres) / pixel_m).cast("int")
    side = F.sequence(-F.col("r"), F.col("r"))
    rows = radii.select(key, r.alias("r")).withColumn("di", F.explode(side)).withColumn("dj", F.explode(side))
    return rows.where("di * di + dj * dj <= r * r").select(key, "di", "dj")


def dilate(marked: DataFrame, radius: int, by: list[str] | None = None) -> DataFrame:
    """``row_i, col_j, hits``: how many marked cells lie within the radius, where any
    does; apart for each value of the columns ``by``.

    Each marked cell opens and closes a run in each row of its disc; the runs' ends
    are added up by place, and a running sum along the row gives the hits of each
    stretch between two ends.  Work follows the disc's rows, not its area; a row of
    the grid is the unit of a task.
    """
    runs = [(d, math.isqrt(radius * radius - d * d)) for d in range(-radius, radius + 1)]
    ends = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(j).alias("j"), F.lit(s).alias("s")) for d, h in runs for j, s in ((-h, 1), (h + 1, -1))])
    by = by or []
    placed = marked.select(*by, "row_i", "col_j", F.explode(ends).alias("e")).select(*by, (F.col("row_i") + F.col("e.d")).alias("row_i"), (F.col("col_j") + F.col("e.j")).alias("col_j"), F.col("e.s").alias("s"))
    steps = placed.groupBy(*by, "row_i", "col_j").agg(F.sum("s").alias("s"))
    along = Window.partitionBy(*by, "row_i").orderBy("col_j")
    stretches = steps.select(*by, "row_i", "col_j", F.sum("s").over(along).alias("hits"), F.lead("col_j").over(along).alias("until")).where("hits > 0")
    return stretches.select(*by, "row_i", F.explode(F.sequence("col_j", F.col("until") - 1)).alias("col_j"), "hits")


def distance(grid: DataFrame, marked: str = "marked", by: list[str] | None = None) -> DataFrame:
    """``row_i, col_j, d2``: squared distance in cells to the nearest marked cell, NULL
    where there is none; exact (Felzenszwalb and Huttenlocher, 2012); apart for each
    value of the columns ``by``.

    First along columns by windows, then along each row as the lower envelope of
    parabolas; a task holds one row or column of the grid.
    """
    by = by or []
    down = Window.partitionBy(*by, "col_j").orderBy("row_i")
    up = Window.partitionBy(*by, "col_j").orderBy(F.desc("row_i"))
    at = F.when(F.col(marked), F.col("row_i"))
    near = grid.select(*by, "row_i", "col_j", F.least(F.col("row_i") - F.last(at, True).over(down.rowsBetween(Window.unboundedPreceding, 0)), F.last(at, True).over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("row_i")).cast("long").alias("g"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("col_j")
        x, g = rows["col_j"].to_numpy(np.int64), rows["g"].to_numpy(np.float64)
        known = ~np.isnan(g)
        out = rows[[*by, "row_i", "col_j"]].copy()
        if not known.any():
            return out.assign(d2=pd.array([None] * len(rows), "Int64"))
        sx, sg = x[known], (g[known].astype(np.int64)) ** 2
        hull, begins = [], []  # parabolas of the envelope, and where each begins
        for k in range(len(sx)):
            while hull:
                p = hull[-1]
                cross = ((sg[k] + sx[k] ** 2) - (sg[p] + sx[p] ** 2)) / (2 * (sx[k] - sx[p]))
                if cross > begins[-1]:
                    break
                hull.pop(), begins.pop()
            begins.append(cross if hull else -np.inf)
            hull.append(k)
        own = np.array(hull)[np.searchsorted(np.array(begins), x, "right") - 1]
        return out.assign(d2=pd.array((x - sx[own]) ** 2 + sg[own], "Int64"))

    kinds = "".join(f"{c} {grid.schema[c].dataType.simpleString()}, " for c in by)
    return near.groupBy(*by, "row_i").applyInPandas(run, f"{kinds}row_i int, col_j int, d2 bigint")
