"""Eroding an area to a size: bisection over a depth, in the raster domain.

The eroded area at depth d is the cells farther than d from the outside, so one
distance transform gives the area at every depth.  Cells are counted by depth once, and
a query over these counts tells the areas at all depths that the next LEVELS steps of the
bisection may look at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.operators.focal import distance
from terrascape.sources.durable import Stage

#: Steps of the bisection that one query answers.
LEVELS = 6


def _middles(low: float, high: float, levels: int) -> list[float]:
    """The middles of a bracket and of the brackets that follow, some levels deep."""
    middle = (low + high) / 2
    return [middle, *_middles(low, middle, levels - 1), *_middles(middle, high, levels - 1)] if levels else []


def erode_to_area(cells: DataFrame, max_cells: float, tolerance: float, iterations: int = 50, step: bool = False) -> DataFrame:
    """``row_i, col_j`` of the area eroded until its count is within ``tolerance`` of
    ``max_cells``; the whole area where it is small enough, or where no depth is within
    the tolerance after ``iterations``.  With ``step``, as areas of cells fall in steps,
    the largest one below ``max_cells`` is taken then."""
    area = cells.select("row_i", "col_j").distinct()
    total = area.count()
    if total <= max_cells:
        return area
    # a frame of one cell around every cell of the area: distances to the outside
    frame = area.select(F.explode(F.array(*[F.struct((F.col("row_i") + i).alias("row_i"), (F.col("col_j") + j).alias("col_j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("c")).select("c.*").distinct()
    grid = frame.join(area.withColumn("inside", F.lit(True)), ["row_i", "col_j"], "left").select("row_i", "col_j", F.col("inside").isNull().alias("marked"))
    depth = Stage(distance(grid).where("d2 > 0"))
    counts = Stage(depth.df.groupBy("d2").agg(F.count("*").alias("n")))

    def left(depths: list[float]) -> dict[float, int]:
        """Cells deeper than each of the depths."""
        deeper = [F.coalesce(F.sum(F.when(F.col("d2") > d * d, F.col("n"))), F.lit(0)) for d in depths]
        return dict(zip(depths, counts.df.agg(*[c.alias(f"n{k}") for k, c in enumerate(deeper)]).first()))

    def cut(d: float) -> DataFrame:
        return depth.df.where(F.col("d2") > d * d).select("row_i", "col_j")

    known = left([2.0**k for k in range(32)])  # a cell's number has 31 bits
    low, high = 0.0, 1.0
    while known[high] > max_cells:
        high *= 2
    if not known[high]:  # as the bracket is defined: back to a depth that leaves something
        high /= 2
        known = known if high in known else left([high])
        if not known[high]:
            return area.limit(0)
    if abs(known[high] - max_cells) <= tolerance:  # areas fall in steps here, so the bracket's end may be the answer
        return cut(high)
    for k in range(iterations):
        if k % LEVELS == 0:
            known = left(_middles(low, high, LEVELS))
        middle = (low + high) / 2
        if known[middle] and abs(known[middle] - max_cells) <= tolerance:
            return cut(middle)
        low, high = (middle, high) if known[middle] > max_cells else (low, middle)
    return cut(high) if step else area
