"""Terrain flow on a grid of elevations: pit filling, flats, multiple-flow directions,
reachability and weighted accumulation.

Cells are ``row_i, col_j, elev`` (one grid; NULL elevations are outside).  Flow goes
to every lower neighbour, in shares by slope (Quinn and others, 1991).  A cell inside the
grid without a lower neighbour lies in a flat; its water goes towards the flat's outlets
and away from higher terrain (Barnes, Lehman and Mulla, 2014).

Reachability and accumulation take a tile at a time: a tile leaves a map from the cells
where water may enter to those where it leaves, the maps are joined in rounds that follow
tile crossings, and a last pass fills the tiles.  So the cells are read a fixed number of
times, however long a flow path is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascape.model import NEIGHBOURS
from terrascape.operators.reach import GROUP_CELLS, choose_plan, least_values
from terrascape.sources.durable import Growing, Stage

#: Cells of a side of the tiles of flow: a task holds 4 * FLOW_TILE values for each cell.
FLOW_TILE = 64


def _around(cells: DataFrame, keep: list[str]) -> DataFrame:
    """Each cell beside its 8 neighbour places ``ni, nj``."""
    steps = F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj"), F.lit(s).alias("slant")) for i, j, s in NEIGHBOURS])
    return cells.select(*keep, F.explode(steps).alias("s")).select(*keep, (F.col("row_i") + F.col("s.di")).alias("ni"), (F.col("col_j") + F.col("s.dj")).alias("nj"), F.col("s.slant").alias("slant"))


class Steps:
    """The rule of counting steps."""

    dtype = np.float32

    def __call__(self, steps: np.ndarray, cost: np.ndarray, slant) -> np.ndarray:
        return steps + np.float32(1)


#: Cells beyond its own that a tile of elevations is given: a neighbour's neighbours.
HALO = 2
_NEAR = "kind string, row_i int, col_j int, to_i int, to_j int, drop {elev}, slant boolean, walled boolean, open boolean"


def _neighbourhood(dem: DataFrame, by: list[str], tile: int, slopes: bool = True) -> DataFrame:
    """What tiles of elevations tell, each seeing HALO cells around it.  Rows of a kind:
    ``slope`` (an edge to a lower neighbour), ``flat`` (a cell with 8 neighbours, none
    lower; ``walled``: one is higher, ``open``: one is as high and not flat itself) and
    ``outlet`` (an edge from a flat cell to such a neighbour).  Without ``slopes`` those
    of flat cells only."""
    kind = dem.schema["elev"].dataType.simpleString()
    dealt = _dealt(dem, [*by, "row_i", "col_j", "elev"], HALO, tile)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i0, j0 = int(rows["tr"].iloc[0]) * tile - HALO, int(rows["tc"].iloc[0]) * tile - HALO
        side = tile + 2 * HALO
        z, there = np.zeros((side + 2, side + 2), rows["elev"].dtype), np.zeros((side + 2, side + 2), bool)
        at = rows["row_i"].to_numpy(np.int64) - i0 + 1, rows["col_j"].to_numpy(np.int64) - j0 + 1
        z[at], there[at] = rows["elev"].to_numpy(), True
        shift = lambda m, i, j: m[1 + i : side + 1 + i, 1 + j : side + 1 + j]
        own, known = shift(z, 0, 0), shift(there, 0, 0)
        count, lower, higher = np.zeros((side, side), int), np.zeros((side, side), bool), np.zeros((side, side), bool)
        for i, j, _ in NEIGHBOURS:
            near, seen = shift(z, i, j), shift(there, i, j)
            count += seen
            lower |= seen & (near < own)
            higher |= seen & (near > own)
        flat = np.zeros_like(there)
        flat[1:-1, 1:-1] = known & (count == 8) & ~lower
        still, inner = shift(flat, 0, 0), np.zeros((side, side), bool)
        inner[HALO:-HALO, HALO:-HALO] = known[HALO:-HALO, HALO:-HALO]
        open_, parts = np.zeros((side, side), bool), []

        def edges(name: str, where: np.ndarray, i: int, j: int, slant: bool, drop: np.ndarray) -> None:
            r, c = np.nonzero(where)
            parts.append(pd.DataFrame({"kind": name, "row_i": r + i0, "col_j": c + j0, "to_i": r + i0 + i, "to_j": c + j0 + j, "drop": drop[r, c], "slant": slant, "walled": False, "open": False}))

        for i, j, slant in NEIGHBOURS:
            near, seen = shift(z, i, j), shift(there, i, j)
            if slopes:
                edges("slope", inner & seen & (near < own), i, j, slant, own - near)
            out = still & seen & (near == own) & ~shift(flat, i, j)
            open_ |= out
            if slopes:
                edges("outlet", inner & out, i, j, slant, np.full_like(own, 2))
        r, c = np.nonzero(inner & still)
        parts.append(pd.DataFrame({"kind": "flat", "row_i": r + i0, "col_j": c + j0, "to_i": 0, "to_j": 0, "drop": own[r, c] * 0, "slant": False, "walled": higher[r, c], "open": open_[r, c]}))
        found = pd.concat([p for p in parts if len(p)] or parts[:1])
        return found.assign(**{c: rows[c].iloc[0] for c in by})[[*by, "kind", "row_i", "col_j", "to_i", "to_j", "drop", "slant", "walled", "open"]]

    ddl = ", ".join([*[f"`{c}` {dem.schema[c].dataType.simpleString()}" for c in by], _NEAR.format(elev=kind)])
    return dealt.groupBy(*by, "tr", "tc").applyInPandas(run, ddl)


def flat_gradients(flat: DataFrame, by: list[str], plan: str | None = None, tile: int = 256, group_cells: int = GROUP_CELLS) -> DataFrame:
    """``row_i, col_j, level`` of the cells that lie in flats with an outlet.

    ``flat``: ``row_i, col_j, walled, open`` of the cells of flats; as none has a lower
    neighbour, two of them that touch are equally high and of one flat.  ``level``: twice
    the steps from an outlet less the steps from higher terrain (0 without any): lower
    towards outlets, and off the walls where that is a tie.
    """
    area = F.concat_ws("/", *[F.col(c).cast("string") for c in by]) if by else F.lit("dem")
    named = flat.withColumn("area", area)

    def steps(first: str) -> DataFrame:
        cells = named.select(F.col("area").alias("aoi_id"), "row_i", "col_j", F.lit(1.0).alias("cost"), F.lit(False).alias("closed"), F.when(F.col(first), 1.0).alias("v"))
        return least_values(cells, Steps(), plan or choose_plan(cells, group_cells), tile).withColumnsRenamed({"aoi_id": "area", "v": first})

    where = ["area", "row_i", "col_j"]
    found = named.select(*by, *where).join(steps("open"), where).join(steps("walled"), where, "left")
    return found.select(*by, "row_i", "col_j", (2 * F.col("open") - F.coalesce("walled", F.lit(0.0))).cast("long").alias("level"))


def flow_edges(dem: DataFrame, by: list[str] | None = None, plan: str | None = None, tile: int = 256) -> DataFrame:
    """``row_i, col_j, to_i, to_j, drop, slant, flat``: flow to every lower neighbour (of
    the same grid, where the columns ``by`` tell grids apart), and in flats (``flat``) to
    outlets and to neighbours whose gradient is lower; there ``drop`` is that of the
    gradient, 2 to an outlet.  Flats without an outlet, as pits have, don't flow.  Cells
    travel once, by tile, with their neighbours at the tile's border."""
    by = by or []
    key = [*by, "row_i", "col_j"]
    near = Stage(_neighbourhood(dem.where("elev IS NOT NULL"), by, tile)).df
    columns = [*key, "to_i", "to_j", "drop", "slant"]
    edges = near.where("kind <> 'flat'").select(*columns, (F.col("kind") == "outlet").alias("flat"))
    flat = near.where("kind = 'flat'").select(*key, "walled", "open")
    if flat.isEmpty():
        return edges
    level = Stage(flat_gradients(flat, by, plan, tile)).df
    there = level.select(*by, F.col("row_i").alias("ni"), F.col("col_j").alias("nj"), F.col("level").alias("next"))
    inside = _around(level, [*key, "level"]).join(there, [*by, "ni", "nj"]).where("level > next")
    fall = (F.col("level") - F.col("next")).cast(near.schema["drop"].dataType)
    return edges.unionByName(inside.select(*key, F.col("ni").alias("to_i"), F.col("nj").alias("to_j"), fall.alias("drop"), "slant", F.lit(True).alias("flat")))


def flow_shares(edges: DataFrame) -> DataFrame:
    """Flow edges with ``share``: slope over the sum of the cell's slopes."""
    slope = F.col("drop") / F.when(F.col("slant"), F.sqrt(F.lit(2.0))).otherwise(1.0)
    sloped = edges.withColumn("slope", slope)
    total = F.sum("slope").over(Window.partitionBy("row_i", "col_j"))
    return sloped.select("row_i", "col_j", "to_i", "to_j", (F.col("slope") / total).alias("share"))


def _tile_of(i: str, j: str, tile: int) -> list[Column]:
    return [F.floor(F.col(i) / tile).cast("int").alias("tr"), F.floor(F.col(j) / tile).cast("int").alias("tc")]


class _Paths:
    """The flow edges of one tile, in an order in which all that flows into a cell comes
    before what flows out of it."""

    def __init__(self, tr: int, tc: int, tile: int, row_i, col_j, to_i, to_j, share: np.ndarray) -> None:
        self.tile, self.i0, self.j0 = tile, tr * tile, tc * tile
        start = self.at(row_i, col_j)
        inner = (to_i // tile == tr) & (to_j // tile == tc)
        self.out = start[~inner], to_i[~inner], to_j[~inner], share[~inner]
        start, stop, share = start[inner], self.at(to_i[inner], to_j[inner]), share[inner]
        level = self._levels(start, stop)
        order = np.lexsort((stop, level[stop]))
        self.start, self.stop, self.share = start[order], stop[order], share[order]
        self.cuts = self._cut(level[self.stop])

    @classmethod
    def of(cls, rows: pd.DataFrame, tile: int) -> _Paths:
        edge = rows[rows["kind"] == "edge"]
        to_i, to_j = edge["to_i"].to_numpy(np.int64), edge["to_j"].to_numpy(np.int64)
        return cls(int(rows["tr"].iloc[0]), int(rows["tc"].iloc[0]), tile, edge["row_i"], edge["col_j"], to_i, to_j, edge["share"].to_numpy(np.float64))

    @staticmethod
    def _cut(level: np.ndarray) -> list[int]:
        return [*np.flatnonzero(np.diff(level, prepend=-1)).tolist(), len(level)]

    def packed(self) -> dict[str, bytes]:
        """The inner edges, as ``unpacked`` takes them."""
        cuts = np.asarray(self.cuts, np.int32)
        return {"start": self.start.astype(np.int32).tobytes(), "stop": self.stop.astype(np.int32).tobytes(), "share": self.share.tobytes(), "cuts": cuts.tobytes()}

    @classmethod
    def unpacked(cls, row, tile: int) -> _Paths:
        self = cls.__new__(cls)
        self.tile, self.i0, self.j0 = tile, int(row.tr) * tile, int(row.tc) * tile
        self.start, self.stop, self.share = np.frombuffer(row.start, np.int32), np.frombuffer(row.stop, np.int32), np.frombuffer(row.share, np.float64)
        self.cuts = np.frombuffer(row.cuts, np.int32).tolist()
        return self

    def at(self, i, j) -> np.ndarray:
        return (np.asarray(i, np.int64) - self.i0) * self.tile + np.asarray(j, np.int64) - self.j0

    def _levels(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        n = self.tile * self.tile
        level, left = np.zeros(n, np.int64), np.bincount(stop, minlength=n)
        order = np.argsort(start, kind="stable")
        first = np.searchsorted(start[order], np.arange(n + 1))
        ready, k, done = np.flatnonzero((left == 0) & (np.diff(first) > 0)), 0, 0
        while len(ready):
            size = first[ready + 1] - first[ready]
            done += int(size.sum())
            k += 1
            e = order[np.repeat(first[ready] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            np.subtract.at(left, stop[e], 1)
            reached = np.unique(stop[e])
            ready = reached[left[reached] == 0]
            level[ready] = k
        if done < len(start):
            raise ValueError("flow edges have a cycle")
        return level

    def flow(self, value: np.ndarray, weighed: bool) -> np.ndarray:
        """``value`` (cells, columns) and all that flows in, in shares (or as marks)."""
        for a, b in zip(self.cuts, self.cuts[1:]):
            stop = self.stop[a:b]
            first = np.flatnonzero(np.diff(stop, prepend=-1))
            come = value[self.start[a:b]]
            if weighed:
                value[stop[first]] += np.add.reduceat(come * self.share[a:b, None], first, axis=0)
            else:
                value[stop[first]] |= np.logical_or.reduceat(come, first, axis=0)
        return value


_MAP = "row_i int, col_j int, to_i int, to_j int, flow double"


def _edge_rows(links: DataFrame, by: list[str], tile: int) -> DataFrame:
    none = F.lit(None).cast("double")
    return links.select(*by, F.lit("edge").alias("kind"), *_tile_of("row_i", "col_j", tile), "row_i", "col_j", "to_i", "to_j", "share", none.alias("w"))


def _cell_rows(cells: DataFrame, by: list[str], kind: str, tile: int) -> DataFrame:
    none = F.lit(None)
    weight = F.col("w").cast("double") if "w" in cells.columns else F.lit(1.0)
    return cells.select(*by, F.lit(kind).alias("kind"), *_tile_of("row_i", "col_j", tile), "row_i", "col_j", none.cast("int").alias("to_i"), none.cast("int").alias("to_j"), none.cast("double").alias("share"), weight.alias("w"))


def _crossings(links: DataFrame, by: list[str], tile: int) -> DataFrame:
    """The cells where water may enter a tile."""
    other = (F.floor(F.col("row_i") / tile) != F.floor(F.col("to_i") / tile)) | (F.floor(F.col("col_j") / tile) != F.floor(F.col("to_j") / tile))
    return links.where(other).select(*by, F.col("to_i").alias("row_i"), F.col("to_j").alias("col_j")).distinct()


def _map_rows(paths: _Paths, row_i: np.ndarray, col_j: np.ndarray, weighed: bool) -> pd.DataFrame:
    """``row_i, col_j, to_i, to_j, flow`` from the given cells of a tile to other tiles'."""
    value = np.zeros((paths.tile * paths.tile, len(row_i)), np.float64 if weighed else bool)
    value[paths.at(row_i, col_j), np.arange(len(row_i))] = 1
    value = paths.flow(value, weighed)
    start, to_i, to_j, share = paths.out
    leave = value[start] * share[:, None] if weighed else value[start]
    k, e = np.nonzero(leave)
    found = pd.DataFrame({"row_i": row_i[e], "col_j": col_j[e], "to_i": to_i[k], "to_j": to_j[k], "flow": leave[k, e].astype(np.float64)})
    return found.groupby(["row_i", "col_j", "to_i", "to_j"], as_index=False)["flow"].sum() if len(found) else found


def _tile_maps(links: DataFrame, by: list[str], tile: int, weighed: bool) -> DataFrame:
    """``row_i, col_j, to_i, to_j, flow``: from a cell where water may enter a tile to a
    cell of another tile that it comes to next, and which share of it does."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        enter = rows[rows["kind"] == "enter"]
        found = _map_rows(_Paths.of(rows, tile), enter["row_i"].to_numpy(), enter["col_j"].to_numpy(), weighed)
        return found.assign(**{c: rows[c].iloc[0] for c in by})[[*by, "row_i", "col_j", "to_i", "to_j", "flow"]]

    rows = _edge_rows(links, by, tile).unionByName(_cell_rows(_crossings(links, by, tile), by, "enter", tile))
    ddl = ", ".join([*[f"`{c}` {links.schema[c].dataType.simpleString()}" for c in by], _MAP])
    return rows.groupBy(*by, "tr", "tc").applyInPandas(run, ddl)


def reachable(edges: DataFrame, start: DataFrame, by: list[str] | None = None, tile: int = FLOW_TILE) -> DataFrame:
    """``row_i, col_j`` of the cells that flow from ``start`` reaches, start included;
    apart for each value of the columns ``by`` of ``start`` (and of ``edges``, where it
    has them).  Edges that form a cycle are an error."""
    by = by or []
    key = [*by, "row_i", "col_j"]
    on = [c for c in by if c in edges.columns]
    links = Stage(edges.select(*on, "row_i", "col_j", "to_i", "to_j", F.lit(1.0).alias("share")))
    start = Stage(start.select(*key).distinct())
    ddl = ", ".join([*[f"`{c}` {start.df.schema[c].dataType.simpleString()}" for c in by], "row_i int, col_j int, outside boolean"])

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        paths = _Paths.of(rows, tile)
        mark = rows[rows["kind"] == "mark"]
        value = np.zeros((tile * tile, 1), bool)
        value[paths.at(mark["row_i"], mark["col_j"])] = True
        value = paths.flow(value, False)[:, 0]
        own = np.flatnonzero(value)
        begin, to_i, to_j, _ = paths.out
        gone = value[begin]
        i, j = np.concatenate([own // tile + paths.i0, to_i[gone]]), np.concatenate([own % tile + paths.j0, to_j[gone]])
        found = pd.DataFrame({"row_i": i, "col_j": j, "outside": np.arange(len(i)) >= len(own)}).drop_duplicates()
        return found.assign(**{c: rows[c].iloc[0] for c in by})[[*by, "row_i", "col_j", "outside"]]

    def spread_all(marks: DataFrame) -> DataFrame:
        busy = marks.select(*by, *_tile_of("row_i", "col_j", tile)).distinct()
        own = _edge_rows(links.df, on, tile).join(F.broadcast(busy), [*on, "tr", "tc"]).select(*by, "kind", "tr", "tc", "row_i", "col_j", "to_i", "to_j", "share", "w")
        return own.unionByName(_cell_rows(marks, by, "mark", tile)).groupBy(*by, "tr", "tc").applyInPandas(spread, ddl)

    first = spread_all(start.df).where("outside").select(*key).distinct()
    entered = Growing(first)
    maps = None
    while not entered.front.isEmpty():
        maps = maps or Stage(_tile_maps(links.df, on, tile, False))
        to = entered.beside.join(maps.df, [*on, "row_i", "col_j"]).select(*by, F.col("to_i").alias("row_i"), F.col("to_j").alias("col_j")).distinct()
        entered.add(to.join(entered.df, key, "left_anti"))
    marks = start.df.unionByName(entered.df).distinct()
    found = Stage(spread_all(marks).where("NOT outside").select(*key).unionByName(marks).distinct())
    for old in (links, start, *([maps] if maps else [])):
        old.drop()
    entered.drop()
    return found.df


_POURED = "kind string, tr int, tc int, row_i int, col_j int, to_i int, to_j int, flow double, cells binary, water binary, start binary, stop binary, share binary, cuts binary"


def _poured(paths: _Paths, tr: int, tc: int, cells: np.ndarray, w: np.ndarray, row_i: np.ndarray, col_j: np.ndarray) -> pd.DataFrame:
    """What a tile tells of its flow, rows of a kind: ``sent`` (its own water to a cell of
    another tile), ``map`` (as ``_map_rows``, from the cells where water may enter) and
    ``tile`` (its cells, their water and its paths, packed)."""
    own = np.zeros(paths.tile * paths.tile)
    np.add.at(own, cells, w)
    value = paths.flow(own.copy()[:, None], True)[:, 0]
    start, to_i, to_j, share = paths.out
    sent = pd.DataFrame({"kind": "sent", "row_i": to_i, "col_j": to_j, "flow": value[start] * share})
    seen = np.unique(np.concatenate([cells, paths.stop])).astype(np.int32)
    packed = pd.DataFrame([{"kind": "tile", "cells": seen.tobytes(), "water": own[seen].tobytes(), **paths.packed()}])
    parts = [sent[sent["flow"] != 0], _map_rows(paths, row_i, col_j, True).assign(kind="map"), packed]
    found = pd.concat([p for p in parts if len(p)]).assign(tr=tr, tc=tc).reindex(columns=[f.split()[0] for f in _POURED.split(", ")])
    return found.astype({c: "Int32" for c in ("row_i", "col_j", "to_i", "to_j")})


def _gathered(poured: DataFrame, tile: int) -> DataFrame:
    """``row_i, col_j, acc`` from what the tiles tell: water goes through the maps in rounds,
    then each tile adds what entered it."""
    key = ["row_i", "col_j"]
    told = Stage(poured, partition_by="kind")
    entered = Growing(told.df.where("kind = 'sent'").groupBy(*key).agg(F.sum("flow").alias("w")))
    maps = told.df.where("kind = 'map'").select(*key, "to_i", "to_j", "flow")
    while not entered.front.isEmpty():
        to = entered.beside.join(maps, key).select(F.col("to_i").alias("row_i"), F.col("to_j").alias("col_j"), (F.col("w") * F.col("flow")).alias("w"))
        entered.add(to.groupBy(*key).agg(F.sum("w").alias("w")))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        held = rows["kind"].to_numpy() == "tile"
        come, value = rows[~held], np.zeros((tile * tile, 1))
        if not held.any():
            raise ValueError("water enters a tile without cells")
        row = next(rows[held].itertuples())
        paths, cells = _Paths.unpacked(row, tile), np.frombuffer(row.cells, np.int32)
        value[cells, 0] = np.frombuffer(row.water)
        at = paths.at(come["row_i"], come["col_j"])
        np.add.at(value[:, 0], at, come["flow"].to_numpy(np.float64))
        value = paths.flow(value, True)[:, 0]
        cells = np.union1d(cells, at)
        return pd.DataFrame({"row_i": cells // tile + paths.i0, "col_j": cells % tile + paths.j0, "acc": value[cells]})

    come = entered.df.select(F.lit("come").alias("kind"), *_tile_of("row_i", "col_j", tile), *key, F.col("w").alias("flow"))
    rows = told.df.where("kind = 'tile'").unionByName(come, allowMissingColumns=True)
    whole = Stage(rows.groupBy("tr", "tc").applyInPandas(fill, "row_i int, col_j int, acc double"))
    told.drop()
    entered.drop()
    return whole.df


def accumulate(shares: DataFrame, weights: DataFrame, tile: int = FLOW_TILE) -> DataFrame:
    """``row_i, col_j, acc``: own weight plus the shares of what flows in, for cells that
    have a weight or inflow.  Edges that form a cycle are an error."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        paths, water, enter = _Paths.of(rows, tile), rows[rows["kind"] == "water"], rows[rows["kind"] == "enter"]
        return _poured(paths, int(rows["tr"].iloc[0]), int(rows["tc"].iloc[0]), paths.at(water["row_i"], water["col_j"]), water["w"].to_numpy(np.float64), enter["row_i"].to_numpy(), enter["col_j"].to_numpy())

    links = Stage(shares.select("row_i", "col_j", "to_i", "to_j", F.col("share").cast("double").alias("share")))
    own = weights.groupBy("row_i", "col_j").agg(F.sum(F.col("w").cast("double")).alias("w"))
    rows = _edge_rows(links.df, [], tile).unionByName(_cell_rows(own, [], "water", tile)).unionByName(_cell_rows(_crossings(links.df, [], tile), [], "enter", tile))
    found = _gathered(rows.groupBy("tr", "tc").applyInPandas(run, _POURED), tile)
    links.drop()
    return found


def flow_accumulation(dem: DataFrame, weights: DataFrame, plan: str | None = None, tile: int = 256, flow_tile: int = FLOW_TILE) -> DataFrame:
    """``accumulate(flow_shares(flow_edges(dem)), weights)`` without edges as rows: a tile
    finds them from its elevations, its flats' levels and one cell around it.  A null
    weight counts as 0."""
    key = ["row_i", "col_j"]
    dem = dem.where("elev IS NOT NULL").select(*key, "elev")
    flat = Stage(_neighbourhood(dem, [], tile, slopes=False))
    level = None if flat.df.isEmpty() else Stage(flat_gradients(flat.df.select(*key, "walled", "open"), [], plan, tile))
    none = F.lit(0).cast(dem.schema["elev"].dataType).alias("elev")
    rows = dem.select(*key, F.lit(0).cast("byte").alias("kind"), "elev", F.lit(0.0).alias("v"))
    if level:
        rows = rows.unionByName(level.df.select(*key, F.lit(1).cast("byte").alias("kind"), none, F.col("level").cast("double").alias("v")))
    seen = _dealt(rows, rows.columns, 1, flow_tile)
    water = weights.select(*_tile_of("row_i", "col_j", flow_tile), *key, F.lit(2).cast("byte").alias("kind"), none, F.coalesce(F.col("w").cast("double"), F.lit(0.0)).alias("v"))
    side = flow_tile + 2

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tr, tc = int(rows["tr"].iloc[0]), int(rows["tc"].iloc[0])
        i0, j0, kind = tr * flow_tile - 1, tc * flow_tile - 1, rows["kind"].to_numpy()
        r, c = rows["row_i"].to_numpy(np.int64) - i0, rows["col_j"].to_numpy(np.int64) - j0
        elev, v = rows["elev"].to_numpy(), rows["v"].to_numpy(np.float64)
        z, there, grade = np.zeros((side, side), elev.dtype), np.zeros((side, side), bool), np.full((side, side), np.nan)
        at = r[kind == 0], c[kind == 0]
        z[at], there[at] = elev[kind == 0], True
        grade[r[kind == 1], c[kind == 1]] = v[kind == 1]
        enter, begin, parts = np.zeros((side, side), bool), np.zeros((side, side)), []
        for i, j, slant in NEIGHBOURS:
            # from the cells that have such a neighbour in the tile's box to that neighbour
            a = slice(max(0, -i), side - max(0, i)), slice(max(0, -j), side - max(0, j))
            b = slice(max(0, i), side - max(0, -i)), slice(max(0, j), side - max(0, -j))
            both, had = there[a] & there[b], ~np.isnan(grade[a])
            drop = np.where(both & (z[b] < z[a]), z[a] - z[b], 0).astype(np.float64)
            flat = both & (z[b] == z[a]) & had
            drop[flat & np.isnan(grade[b])] = 2
            lower = flat & (grade[b] < grade[a])
            drop[lower] = (grade[a] - grade[b])[lower]
            y, x = np.nonzero(drop > 0)
            slope = drop[y, x] / (np.sqrt(2.0) if slant else 1.0)
            y, x = y + a[0].start, x + a[1].start
            own = (y > 0) & (y <= flow_tile) & (x > 0) & (x <= flow_tile)
            enter[y[~own] + i, x[~own] + j] = True
            begin[y[own], x[own]] += slope[own]
            parts.append((y[own], x[own], y[own] + i, x[own] + j, slope[own]))
        y, x, to_y, to_x, slope = (np.concatenate(p) for p in zip(*parts))
        enter[[0, -1]] = enter[:, [0, -1]] = False
        paths = _Paths(tr, tc, flow_tile, y + i0, x + j0, to_y + i0, to_x + j0, slope / begin[y, x])
        y, x = np.nonzero(enter)
        return _poured(paths, tr, tc, paths.at(r[kind == 2] + i0, c[kind == 2] + j0), v[kind == 2], y + i0, x + j0)

    found = _gathered(seen.select(water.columns).unionByName(water).groupBy("tr", "tc").applyInPandas(run, _POURED), flow_tile)
    for old in (flat, *([level] if level else [])):
        old.drop()
    return found


def _dealt(cells: DataFrame, keep: list[str], halo: int, tile: int) -> DataFrame:
    """Each cell in its tile ``tr, tc`` and in those that see it within ``halo`` cells."""
    corners = [F.struct(F.floor((F.col("row_i") + i) / tile).cast("int").alias("tr"), F.floor((F.col("col_j") + j) / tile).cast("int").alias("tc")) for i in (-halo, 0, halo) for j in (-halo, 0, halo)]
    return cells.select(*keep, F.explode(F.array_distinct(F.array(*corners))).alias("t")).select("t.*", *keep)


def _bordered(dem: DataFrame, tile: int) -> DataFrame:
    """The cells as ``least_values`` takes them: those that lack a neighbour are closed
    seeds of their own elevation.  A tile sees one cell around it, so a cell travels
    once, not once for each neighbour."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i0, j0 = int(rows["tr"].iloc[0]) * tile, int(rows["tc"].iloc[0]) * tile
        r, c = rows["row_i"].to_numpy(np.int64) - i0 + 1, rows["col_j"].to_numpy(np.int64) - j0 + 1
        there = np.zeros((tile + 2, tile + 2), bool)
        there[r, c] = True
        own = (r > 0) & (r <= tile) & (c > 0) & (c <= tile)
        r, c = r[own], c[own]
        edge = ~np.logical_and.reduce([there[r + i, c + j] for i, j, _ in NEIGHBOURS])
        return rows.loc[own, ["aoi_id", "row_i", "col_j", "cost"]].assign(closed=edge, v=np.where(edge, rows.loc[own, "cost"], np.nan))

    cells = dem.select("aoi_id", "row_i", "col_j", F.col("elev").cast("double").alias("cost"))
    return _dealt(cells, cells.columns, 1, tile).groupBy("aoi_id", "tr", "tc").applyInPandas(run, "aoi_id string, row_i int, col_j int, cost double, closed boolean, v double")


def fill_pits(dem: DataFrame, plan: str | None = None, tile: int = 256, group_cells: int = GROUP_CELLS) -> DataFrame:
    """``row_i, col_j, elev`` where every cell drains to the border: the smallest level
    over paths from the border of the highest cell on the path (Barnes and others, 2014).
    Border cells (a neighbour is missing) keep their elevation.  ``plan``: ``group``
    (one task) up to ``group_cells`` cells, else ``tiles``, as in ``reach``.  A column
    ``aoi_id`` tells grids apart."""
    named = "aoi_id" in dem.columns
    key = ["aoi_id", "row_i", "col_j"]
    dem = dem.where("elev IS NOT NULL").select((F.col("aoi_id") if named else F.lit("dem")).alias("aoi_id"), "row_i", "col_j", "elev")
    plan = plan or choose_plan(dem, group_cells)
    kind = dem.schema["elev"].dataType.simpleString()
    return least_values(_bordered(dem, tile), Rise(), plan, tile).select(*key[not named :], F.col("v").cast(kind).alias("elev"))


class Rise:
    """The rule of filling: the higher of the level and the cell."""

    dtype = np.float64

    def __call__(self, level: np.ndarray, elevation: np.ndarray, slant) -> np.ndarray:
        return np.maximum(level, elevation)
