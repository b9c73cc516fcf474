"""Least-cost reach: cells within a travel time of source cells, on the 8-neighbour
grid, where a step costs the friction of the cell it enters times its length.

Arithmetic is 32-bit.  Friction that is null, NaN or at most 0 can't be entered; a time
equal to the bound is within it; source cells are always covered and never re-entered.

``reach`` has two plans of the same result: one task per area (bounded by
``group_cells`` cells of its box), or rounds over tiles, where a tile settles all its cells at once and
sends the times of its border to its neighbours, so rounds follow tile crossings, not
cell steps, and no task holds more than a tile.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.model import NEIGHBOURS
from terrascape.sources.durable import SMALL, Stage

#: Cells of an area that one task may hold: four tiles.
GROUP_CELLS = 4 * 256 * 256
#: Folders that the versions of tiles are dealt to.
BANDS = 64
log = logging.getLogger("terrascape")


def step_lengths(cell_len: float) -> tuple[np.float32, np.float32]:
    """Lengths of a straight and a diagonal step."""
    return np.float32(cell_len), np.float32(np.sqrt(np.float64(2.0 * cell_len * cell_len)))


class Travel:
    """The rule of travel: arrival in 32-bit arithmetic, infinite beyond the bound."""

    dtype = np.float32

    def __init__(self, max_time: float, cell_len: float) -> None:
        self.straight, self.diagonal = step_lengths(cell_len)
        self.limit = np.float32(max_time)

    def __call__(self, time: np.ndarray, friction: np.ndarray, slant) -> np.ndarray:
        arrive = time + friction * np.where(slant, self.diagonal, self.straight)
        return np.where(arrive <= self.limit, arrive, np.float32(np.inf))


def settle(rows, cols, cost, closed, start, rule) -> np.ndarray:
    """Least values of the cells of one area or tile.

    ``closed`` cells are not entered; ``start``: values of seeds, infinite elsewhere;
    ``rule(values, costs, slant)``: values on entering cells from neighbours, never less
    than the neighbours'.  All cells of the box around the last round's changes are
    relaxed at once, until nothing changes; values only fall, so the result is that of
    any order.
    """
    r, c = rows - rows.min() + 1, cols - cols.min() + 1
    shape = (int(r.max()) + 2, int(c.max()) + 2)
    value, price, shut = np.full(shape, np.inf, rule.dtype), np.zeros(shape, rule.dtype), np.ones(shape, bool)
    value[r, c] = start
    price[r, c] = np.where(closed, 0, cost)
    shut[r, c] = closed
    seeds = np.flatnonzero(np.isfinite(start))
    if not len(seeds):
        return start
    top, bottom, left, right = r[seeds].min(), r[seeds].max(), c[seeds].min(), c[seeds].max()
    while True:
        a, b = max(1, top - 1), min(shape[0] - 1, bottom + 2)
        d, e = max(1, left - 1), min(shape[1] - 1, right + 2)
        old = value[a:b, d:e]
        best = old.copy()
        for i, j, slant in NEIGHBOURS:
            np.minimum(best, rule(value[a + i : b + i, d + j : e + j], price[a:b, d:e], slant), out=best)
        fell = (best < old) & ~shut[a:b, d:e]
        if not fell.any():
            return value[r, c]
        old[fell] = best[fell]
        y, x = np.flatnonzero(fell.any(axis=1)), np.flatnonzero(fell.any(axis=0))
        top, bottom, left, right = a + y[0], a + y[-1], d + x[0], d + x[-1]


def reach(cells: DataFrame, max_time: float, cell_len: float = 1.0, group_cells: int = GROUP_CELLS, tile: int = 256, plan: str | None = None) -> DataFrame:
    """``aoi_id, row_i, col_j, t`` of the covered cells of each area.

    ``cells``: ``aoi_id, row_i, col_j, friction, source`` (boolean), a cell once an area.
    ``plan``: ``group``, ``tiles`` or None (by the cells of the largest area's box).
    """
    cells = cells.select("aoi_id", "row_i", "col_j", F.col("friction").cast("float").alias("friction"), F.coalesce("source", F.lit(False)).alias("source"))
    plan = plan or choose_plan(cells, group_cells)
    wall = F.isnan("friction") | F.col("friction").isNull() | (F.col("friction") <= 0)
    start = F.when(F.col("source"), F.lit(0.0))
    grid = cells.select("aoi_id", "row_i", "col_j", F.col("friction").cast("double").alias("cost"), (F.col("source") | wall).alias("closed"), start.alias("v"))
    return least_values(grid, Travel(max_time, cell_len), plan, tile).select("aoi_id", "row_i", "col_j", F.col("v").cast("float").alias("t"))


def choose_plan(cells: DataFrame, group_cells: int) -> str:
    """``group`` where the box of every area has at most so many cells."""
    side = lambda c: F.max(c).cast("long") - F.min(c) + 1
    most = cells.groupBy("aoi_id").agg((side("row_i") * side("col_j")).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    return "group" if most <= group_cells else "tiles"


def least_values(grid: DataFrame, rule, plan: str, tile: int = 256) -> DataFrame:
    """``aoi_id, row_i, col_j, v`` of the cells that the seeds' ways reach.

    ``grid``: ``aoi_id, row_i, col_j, cost double, closed boolean, v double`` where v is
    the value of a seed, else NULL; ``rule`` as in ``settle``.
    """
    if plan == "tiles":
        return _by_tiles(grid, rule, tile)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        start = rows["v"].to_numpy(np.float64)
        start = np.where(np.isnan(start), np.inf, start)
        best = settle(rows["row_i"].to_numpy(np.int64), rows["col_j"].to_numpy(np.int64), rows["cost"].to_numpy(np.float64), rows["closed"].to_numpy(bool), start, rule).astype(np.float64)
        return rows[["aoi_id", "row_i", "col_j"]].assign(v=best)[np.isfinite(best)]

    return grid.groupBy("aoi_id").applyInPandas(run, "aoi_id string, row_i int, col_j int, v double")


#: A cell of a packed tile, and a value that crosses a border: the cell that it enters.
_CELL = np.dtype([("r", "<i4"), ("c", "<i4"), ("cost", "<f8"), ("closed", "?")])
_TOLD = np.dtype([("r", "<i4"), ("c", "<i4"), ("v", "<f8"), ("slant", "?")])
_PACKED = "aoi_id string, tr int, tc int, kind string, n int, data binary, band int"


def _by_tiles(grid: DataFrame, rule, tile: int) -> DataFrame:
    """Rounds over tiles.  Cells are packed once: a tile is one row (``cells``), its values
    another (``value``), and what it tells a neighbouring tile a third (``mail``).  A round
    writes new values of the tiles that it settles and nothing of the others; a small table
    tells the newest version of each tile.  Rows lie in BANDS folders by the tile's hash,
    of which a round reads those of its tiles."""
    keys = ["aoi_id", "tr", "tc"]
    names = [f.split()[0] for f in _PACKED.split(", ")]
    band = F.pmod(F.hash(*keys), F.lit(BANDS))
    where = [F.floor(F.col("row_i") / tile).cast("int").alias("tr"), F.floor(F.col("col_j") / tile).cast("int").alias("tc")]

    def written(rows: pd.DataFrame, found: list[tuple[str, int, int, bytes, int]]) -> pd.DataFrame:
        return pd.DataFrame([(rows["aoi_id"].iloc[0], i, j, kind, len(data), data.tobytes(), b) for kind, i, j, data, b in found], columns=names)

    def letters_of(cells: np.ndarray, new: np.ndarray, told: np.ndarray, tr: int, tc: int) -> list:
        r, c, value, found = cells["r"][told].astype(np.int64), cells["c"][told].astype(np.int64), new[told], {}
        edge = (r % tile == 0) | (r % tile == tile - 1) | (c % tile == 0) | (c % tile == tile - 1)
        r, c, value = r[edge], c[edge], value[edge]
        for i, j, slant in NEIGHBOURS:
            over = ((r + i) // tile - tr) * 3 + (c + j) // tile - tc
            for to in np.unique(over[over != 0]).tolist():
                at = over == to
                letter = np.empty(int(at.sum()), _TOLD)
                letter["r"], letter["c"], letter["v"], letter["slant"] = r[at] + i, c[at] + j, value[at], slant
                found.setdefault(to, []).append(letter)
        return [("mail", tr + (to + 1) // 3, tc + (to + 1) % 3 - 1, np.concatenate(parts), -1) for to, parts in found.items()]

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        cells = np.empty(len(rows), _CELL)
        for name, column in (("r", "row_i"), ("c", "col_j"), ("cost", "cost"), ("closed", "closed")):
            cells[name] = rows[column].to_numpy()
        tr, tc, at = (int(rows[c].iloc[0]) for c in ("tr", "tc", "band"))
        start = rows["v"].to_numpy(np.float64)
        start = np.where(np.isnan(start), np.inf, start)
        new = np.minimum(start, settle(rows["row_i"].to_numpy(np.int64), rows["col_j"].to_numpy(np.int64), cells["cost"], cells["closed"], start, rule).astype(np.float64))
        return written(rows, [("cells", tr, tc, cells, at), ("value", tr, tc, new, at), *letters_of(cells, new, np.flatnonzero(np.isfinite(new)), tr, tc)])

    def of(rows: pd.DataFrame, kind: str, dtype) -> np.ndarray:
        return np.concatenate([np.empty(0, dtype), *(np.frombuffer(d, dtype) for d in rows.loc[rows["kind"] == kind, "data"])])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cells, old, mail = of(rows, "cells", _CELL), of(rows, "value", np.float64), of(rows, "mail", _TOLD)
        if not len(cells):
            return written(rows, [])
        tr, tc, at = (int(rows[c].iloc[0]) for c in ("tr", "tc", "band"))
        place = np.full((tile, tile), -1, np.int64)
        place[cells["r"] - tr * tile, cells["c"] - tc * tile] = np.arange(len(cells))
        k = place[mail["r"] - tr * tile, mail["c"] - tc * tile]
        mail, k = mail[k >= 0], k[k >= 0]
        closed, start = cells["closed"], old.copy()
        arrive = rule(mail["v"].astype(rule.dtype), np.where(closed[k], 0, cells["cost"][k]).astype(rule.dtype), mail["slant"]).astype(np.float64)
        np.minimum.at(start, k, np.where(closed[k], np.inf, arrive))
        # only what is new spreads; other values are settled already
        new = np.minimum(start, settle(cells["r"].astype(np.int64), cells["c"].astype(np.int64), cells["cost"], closed, np.where(start < old, start, np.inf), rule).astype(np.float64))
        told = np.flatnonzero(new < old)
        return written(rows, [("value", tr, tc, new, at), *letters_of(cells, new, told, tr, tc)] if len(told) else [("value", tr, tc, new, at)])

    def unpack(rows: pd.DataFrame) -> pd.DataFrame:
        cells, value = of(rows, "cells", _CELL), of(rows, "value", np.float64)
        got = np.isfinite(value)
        return pd.DataFrame({"aoi_id": rows["aoi_id"].iloc[0], "row_i": cells["r"][got], "col_j": cells["c"][got], "v": value[got]})

    tiled = grid.select("aoi_id", *where, "row_i", "col_j", "cost", "closed", "v").withColumn("band", band)
    packed = Stage(tiled.groupBy(*keys).applyInPandas(pack, _PACKED).repartition("band"), partition_by="band")
    versions = [packed]
    newest = Stage(packed.df.where("kind = 'cells'").select(*keys, F.lit(0).alias("version")))

    def current(tiles: Stage, bands: list[int] | None) -> DataFrame:
        """The cells and the newest values of ``tiles`` (with ``version``)."""
        few = F.broadcast(tiles.df) if tiles.bytes <= SMALL else tiles.df
        every = packed.df.where("kind = 'cells'").select(*names).join(few.select(*keys), keys, "left_semi")
        for k, stage in enumerate(versions):
            part = stage.df.where("kind = 'value'").select(*names).join(few.where(F.col("version") == k).select(*keys), keys, "left_semi")
            every = every.unionByName(part)
        return every if bands is None else every.where(F.col("band").isin(bands))

    while True:
        letters = versions[-1].df.where("band = -1").select(*names)
        sent = letters.agg(F.sum("n")).first()[0] or 0
        log.info("tiles: round %d, %d values cross a border", len(versions), sent)
        if not sent:
            whole = Stage(current(newest, None).groupBy(*keys).applyInPandas(unpack, "aoi_id string, row_i int, col_j int, v double"))
            for stage in (*versions, newest):
                stage.drop()
            return whole.df
        wanted = Stage(newest.df.join(letters.select(*keys).distinct(), keys, "left_semi"))
        bands = [r["band"] for r in wanted.df.select(band.alias("band")).distinct().collect()]  # at most BANDS
        rows = current(wanted, bands).unionByName(letters.withColumn("band", band))
        done = Stage(rows.repartition("band").groupBy("band", *keys).applyInPandas(run, _PACKED), partition_by="band")
        later = Stage(newest.df.join(wanted.df.select(*keys), keys, "left_anti").unionByName(wanted.df.select(*keys, F.lit(len(versions)).alias("version"))))
        versions.append(done)
        newest.drop()
        wanted.drop()
        newest = later


def reach_relaxed(cells: DataFrame, max_time: float, cell_len: float = 1.0) -> DataFrame:
    """The same by rounds of joins alone, one step of all frontiers a round; for
    checking the other plans."""
    straight, diagonal = step_lengths(cell_len)
    spark = cells.sparkSession
    steps = spark.createDataFrame([(i, j, float(diagonal if s else straight)) for i, j, s in NEIGHBOURS], "di int, dj int, length float")
    open_ = cells.where("friction > 0 AND NOT isnan(friction) AND NOT coalesce(source, false)").select("aoi_id", "row_i", "col_j", F.col("friction").cast("float").alias("friction"))
    best = Stage(cells.where("source").select("aoi_id", "row_i", "col_j", F.lit(0.0).cast("float").alias("t")))
    front = best
    key = ["aoi_id", "row_i", "col_j"]
    while not front.df.isEmpty():
        moved = front.df.join(F.broadcast(steps)).select("aoi_id", (F.col("row_i") + F.col("di")).alias("row_i"), (F.col("col_j") + F.col("dj")).alias("col_j"), "t", "length")
        new = moved.join(open_, key).select(*key, (F.col("t") + F.col("friction") * F.col("length")).alias("t")).where(F.col("t") <= F.lit(float(np.float32(max_time))).cast("float")).groupBy(*key).agg(F.min("t").alias("t"))
        better = Stage(new.join(best.df.withColumnRenamed("t", "was"), key, "left").where("was IS NULL OR t < was").drop("was"))
        best = Stage(best.df.unionByName(better.df).groupBy(*key).agg(F.min("t").alias("t")))
        front = better
    return best.df
