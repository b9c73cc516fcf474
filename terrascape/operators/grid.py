"""Grids: cell and coordinate, resampling onto another grid, alignment, windows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.model import TILE, Grid


def centre(grid: Grid, row: Column, col: Column) -> tuple[Column, Column]:
    """Coordinates of cell centres."""
    return grid.x0 + (col + 0.5) * grid.dx, grid.y0 + (row + 0.5) * grid.dy


def cell_of(grid: Grid, x: Column, y: Column) -> tuple[Column, Column]:
    """Row and column that hold a coordinate."""
    return F.floor((y - grid.y0) / grid.dy).cast("int"), F.floor((x - grid.x0) / grid.dx).cast("int")


def window(grid: Grid, bounds: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
    """First and last row and column (inclusive) of the cells that bounds meet."""
    import math

    minx, miny, maxx, maxy = bounds
    cols = sorted(((minx - grid.x0) / grid.dx, (maxx - grid.x0) / grid.dx))
    rows = sorted(((miny - grid.y0) / grid.dy, (maxy - grid.y0) / grid.dy))
    fit = lambda a, b, n: (max(0, math.floor(a)), min(n, math.ceil(b)) - 1)
    return (*fit(*rows, grid.height), *fit(*cols, grid.width))


def clip(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Cells of a window; the filter reaches the scan."""
    return cells.where(F.col("row_i").between(*rows) & F.col("col_j").between(*cols))


def cells_of_boxes(cells: DataFrame, boxes: DataFrame, around: int = 0, tile: int = 64) -> DataFrame:
    """Cells beside each box (``row_lo, row_hi, col_lo, col_hi``, inclusive, widened by
    ``around``) that holds them.  Cells and boxes meet by tile, so a box is compared with
    the cells of its tiles only, however many boxes there are."""
    of = lambda c: F.floor(c / tile).cast("int")
    rows = F.sequence(of(F.col("row_lo") - around), of(F.col("row_hi") + around))
    dealt = boxes.withColumn("trow", F.explode(rows)).withColumn("tcol", F.explode(F.sequence(of(F.col("col_lo") - around), of(F.col("col_hi") + around))))
    keyed = cells.withColumns({"trow": of(F.col("row_i")), "tcol": of(F.col("col_j"))})
    near = F.col("row_i").between(F.col("row_lo") - around, F.col("row_hi") + around) & F.col("col_j").between(F.col("col_lo") - around, F.col("col_hi") + around)
    return keyed.join(dealt, ["trow", "tcol"]).where(near).drop("trow", "tcol")


def target_cells(spark, grid: Grid) -> DataFrame:
    """All cells of a grid, made in parallel by row."""
    return spark.range(grid.height).select(F.col("id").cast("int").alias("row_i"), F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1))).alias("col_j"))


def resample(cells: DataFrame, source: Grid, target: Grid, to_source: Callable[[Column, Column], tuple[Column, Column]] | None = None, bounds=None) -> DataFrame:
    """Nearest resampling: each target cell takes the source cell that holds its centre
    (``to_source``: from target to source coordinates; default: the same system).
    Values are neither spread nor conserved; cells outside the source are absent.
    Target cells are made, so Spark can't tell how many there are; they are never sent
    to all tasks."""
    goal = target_cells(cells.sparkSession, target)
    if bounds is not None:
        r0, r1, c0, c1 = window(target, bounds)
        goal = clip(goal, (r0, r1), (c0, c1))
    x, y = centre(target, F.col("row_i"), F.col("col_j"))
    if to_source is not None:
        x, y = to_source(x, y)
    row, col = cell_of(source, x, y)
    wanted = goal.select("row_i", "col_j", row.alias("si"), col.alias("sj")).where((F.col("si").between(0, source.height - 1)) & F.col("sj").between(0, source.width - 1))
    values = [c for c in cells.columns if c not in ("row_i", "col_j")]
    return wanted.hint("merge").join(cells.withColumnsRenamed({"row_i": "si", "col_j": "sj"}), ["si", "sj"]).select("row_i", "col_j", *values)


def union_grid(grids: list[Grid], dx: float, dy: float) -> Grid:
    """The grid of a cell size over the union of grids' bounds."""
    return _over([g.bounds for g in grids], min, max, dx, dy, grids[0].crs)


def align_layers(layers: dict[str, tuple[DataFrame, Grid]], dx: float, dy: float) -> DataFrame:
    """``mask_id, row_i, col_j, pop`` of all layers on one grid of the given cells over
    the union of their extents, by nearest resampling."""
    target, out = union_grid([g for _, g in layers.values()], dx, dy), None
    for name, (cells, source) in layers.items():
        one = resample(cells.select("row_i", "col_j", "pop"), source, target).withColumn("mask_id", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def within(cells: DataFrame, area: DataFrame) -> DataFrame:
    """The cells that lie in an area (``row_i, col_j``), or in each of several (other
    columns of ``area`` that the cells lack are kept)."""
    more = [c for c in area.columns if c not in cells.columns]
    return cells.join(area.select("row_i", "col_j", *more), ["row_i", "col_j"], "inner" if more else "left_semi")


def common_bounds(bounds: list[tuple[float, float, float, float]]) -> tuple[float, float, float, float]:
    """Intersection of bounds; raises where they share no area."""
    got = (max(b[0] for b in bounds), max(b[1] for b in bounds), min(b[2] for b in bounds), min(b[3] for b in bounds))
    if got[0] >= got[2] or got[1] >= got[3]:
        raise ValueError("the rasters share no area")
    return got


def _over(bounds, low, high, dx: float, dy: float, crs: str) -> Grid:
    import math

    x0, y0 = low(b[0] for b in bounds), low(b[1] for b in bounds)
    x1, y1 = high(b[2] for b in bounds), high(b[3] for b in bounds)
    return Grid(x0, y1, dx, -dy, max(1, math.ceil((x1 - x0) / dx - 1e-9)), max(1, math.ceil((y1 - y0) / dy - 1e-9)), crs)


def to_tiles(cells: DataFrame, value: str = "v", tile: int = TILE) -> DataFrame:
    """Cells as dense tiles: ``trow, tcol, data`` (row-major; absent cells NULL); a task
    fills one tile's array."""

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        at, values = rows.column("k").to_numpy(), rows.column("v").combine_chunks()
        data, absent = np.zeros(tile * tile), np.ones(tile * tile, bool)
        data[at] = values.fill_null(0.0).to_numpy(zero_copy_only=False)
        absent[at] = values.is_null().to_numpy(zero_copy_only=False)
        whole = pa.ListArray.from_arrays(pa.array([0, tile * tile], pa.int32()), pa.array(data, mask=absent))
        return pa.table([pa.array([k.as_py()], pa.int32()) for k in key] + [whole], ["trow", "tcol", "data"])

    keyed = cells.select(F.floor(F.col("row_i") / tile).cast("int").alias("trow"), F.floor(F.col("col_j") / tile).cast("int").alias("tcol"), (F.pmod("row_i", F.lit(tile)) * tile + F.pmod("col_j", F.lit(tile))).alias("k"), F.col(value).cast("double").alias("v"))
    return keyed.groupBy("trow", "tcol").applyInArrow(fill, "trow int, tcol int, data array<double>")


def from_tiles(tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """The cells of tiles that hold a value."""
    cells = tiles.select("trow", "tcol", F.posexplode("data").alias("k", "v")).where("v IS NOT NULL")
    return cells.select((F.col("trow") * tile + F.floor(F.col("k") / tile)).cast("int").alias("row_i"), (F.col("tcol") * tile + F.col("k") % tile).cast("int").alias("col_j"), "v")
