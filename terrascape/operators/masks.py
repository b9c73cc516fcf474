"""Map algebra on aligned cells: masks, their combination and sums.

Cells of rasters on one grid meet by (row_i, col_j); an absent cell is 0.  Nodata is
handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.functions.expr import compile_expression
from terrascape.model import TILE

CELL = ["row_i", "col_j"]
#: Coverage above this counts as covered.
EPSILON = 100 * 2.0**-52


def condition(cells: DataFrame, expression: str, value: str = "v", keep: list[str] | None = None) -> DataFrame:
    """``row_i, col_j, hit`` (0 or 1) of a user expression over ``value``, beside the
    columns ``keep``; nodata (NULL) is not evaluated and is 0."""
    hit = compile_expression(expression, F.col(value))
    return cells.select(*(keep or []), *CELL, F.when(F.col(value).isNotNull(), F.coalesce(hit.cast("int"), F.lit(0))).otherwise(0).alias("hit"))


def covered_by_reach(mask: Column, pop: Column) -> Column:
    """Population where a travel-time mask and the population are positive, as an integer."""
    return F.when((mask > 0) & (pop > 0), pop).otherwise(0).cast("int")


def covered_downstream(mask: Column, pop: Column) -> Column:
    """Population where a coverage mask is above EPSILON and the population positive."""
    return F.when((mask > EPSILON) & ~F.isnan(mask.cast("double")) & (pop > 0), pop).otherwise(F.lit(0))


def mask_population(pop: DataFrame, mask: DataFrame, rule=covered_by_reach, by: list[str] | None = None) -> DataFrame:
    """``pop`` (``row_i, col_j, pop``) under ``mask`` (``row_i, col_j, m``): every cell
    of ``pop``, with the masked value as ``pop``; ``by``: columns that tell grids apart."""
    key = [*(by or []), *CELL]
    return pop.join(mask.hint("merge"), key, "left").select(*key, rule(F.coalesce("m", F.lit(0)), F.col("pop")).alias("pop"))


def combine(layers: DataFrame) -> DataFrame:
    """Largest value of each cell over the layers (``mask_id, row_i, col_j, pop``) that
    have it; extents may differ."""
    return layers.groupBy(*CELL).agg(F.max("pop").alias("pop"))


def sums(layers: DataFrame, by: list[str]) -> DataFrame:
    """Sum of each mask and of the combination, by the given columns: whole for whole
    populations, 64-bit floats for fractional ones, which nothing cuts."""
    each = layers.groupBy(*by, "mask_id").agg(F.sum("pop").alias("pop_sum"))
    most = layers.groupBy(*by, *CELL).agg(F.max("pop").alias("pop"))
    together = (most.groupBy(*by) if by else most.groupBy()).agg(F.sum("pop").alias("pop_sum"))
    return each.unionByName(together.select(*by, F.lit("combined pop").alias("mask_id"), "pop_sum"))


def wide(results: DataFrame, masks: list[str], missing: str | None = "n/a") -> DataFrame:
    """One row per area, a column per mask in the given order, ``combined pop`` last;
    a missing result is the string ``missing`` (None: NULL)."""
    columns = [*masks, "combined pop"]
    table = results.groupBy("aoi_id").pivot("mask_id", columns).agg(F.first("pop_sum"))
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias(c) if missing is not None else F.col(f"`{c}`") for c in columns]
    return table.select(F.col("aoi_id").alias("aoi"), *shown)


def block_sums(cells: DataFrame, value: str = "pop", tile: int = TILE) -> DataFrame:
    """Partial sums by tile; nodata values are summed as they are."""
    return cells.groupBy(F.floor(F.col("row_i") / tile).cast("int").alias("trow"), F.floor(F.col("col_j") / tile).cast("int").alias("tcol")).agg(F.sum(value).alias("block_sum"), F.count("*").alias("n"))


def within_distance(mask: Column, pixels: Column, pixel_m: float, max_m: float) -> Column:
    """Covered cells farther than 0 and at most ``max_m`` from the sources."""
    return (pixels > 0) & mask.cast("boolean") & (pixels * pixel_m <= max_m)
