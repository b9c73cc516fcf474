"""Drainage networks: closures, terminal sinks, partitions and greedy selection.

A network is ``edges(hybas_id, next_down)``; 0 or null ends at an outlet.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.sources.durable import Growing, Stage

_DOWN = "coalesce(next_down, 0) <> 0"


def downstream_closure(seeds: DataFrame, edges: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Ids reachable downstream from the seeds, themselves included, with ids that
    have no row of their own.  ``key``: columns of the seeds under which closures are
    apart (such as ``aoi_id``).  A node has one way down, so pointers are doubled: what
    is within 2^k steps is joined with jumps of 2^k steps, and rounds are the logarithm
    of the longest path; cycles end.  A node with several rows must have one way down."""
    key = key or []
    cols = [*key, "hybas_id"]
    seen = Stage(seeds.select(*cols).where("hybas_id IS NOT NULL AND hybas_id <> 0").distinct())
    jump = Stage(edges.where(_DOWN).groupBy("hybas_id").agg(F.min("next_down").alias("next_down")))
    while True:
        below = seen.df.join(jump.df, "hybas_id").select(*key, F.col("next_down").alias("hybas_id"))
        new = Stage(below.join(seen.df, cols, "left_anti").distinct())
        if new.df.isEmpty():
            new.drop()
            jump.drop()
            return seen.df
        grown = Stage(seen.df.unionByName(new.df))
        far = Stage(jump.df.join(jump.df.select(F.col("hybas_id").alias("next_down"), F.col("next_down").alias("to")), "next_down").select("hybas_id", F.col("to").alias("next_down")))
        for old in (seen, new, jump):
            old.drop()
        seen, jump = grown, far


def _closure(seeds: DataFrame, edges: DataFrame, cols: list[str]) -> DataFrame:
    """The same where a node has several ways: one round a step."""
    links = Stage(edges.where(_DOWN).select("hybas_id", "next_down").distinct())
    key = cols[:-1]
    seen = Growing(seeds.select(*cols).where("hybas_id IS NOT NULL AND hybas_id <> 0").distinct())
    while not seen.front.isEmpty():
        below = seen.front.join(links.df, "hybas_id").select(*key, F.col("next_down").alias("hybas_id")).distinct()
        seen.add(below.join(seen.df, cols, "left_anti"))
    links.drop()
    return seen.settle()


def upstream_closure(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``seed, hybas_id``: what drains into each seed, itself included."""
    turned = edges.where(_DOWN).select(F.col("next_down").alias("hybas_id"), F.col("hybas_id").alias("next_down"))
    start = seeds.select(F.col("hybas_id").alias("seed"), "hybas_id")
    return _closure(start, turned, ["seed", "hybas_id"])


def terminal_sinks(edges: DataFrame) -> DataFrame:
    """``hybas_id, next_sink``: the last node downstream, by pointer doubling: rounds
    are the logarithm of the longest path.  A node on a cycle has sink null."""
    ids = edges.select("hybas_id", F.when(F.expr(_DOWN), F.col("next_down")).otherwise(F.col("hybas_id")).alias("p"))
    absent = edges.where(_DOWN).select(F.col("next_down").alias("hybas_id")).distinct().join(edges, "hybas_id", "left_anti").select("hybas_id", F.col("hybas_id").alias("p"))
    outlets = edges.where(f"NOT ({_DOWN})").select("hybas_id").unionByName(absent.select("hybas_id")).distinct()
    state = Stage(ids.unionByName(absent))
    rounds = max(1, state.df.count()).bit_length()
    for _ in range(rounds):
        up = state.df.select(F.col("hybas_id").alias("p"), F.col("p").alias("pp"))
        step = Stage(state.df.join(up, "p").select("hybas_id", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")))
        still = not step.df.where("moved").isEmpty()
        state.drop()
        state = step
        if not still:
            break
    ends = state.df.select("hybas_id", "p")
    own = outlets.select(F.col("hybas_id").alias("p"), F.lit(True).alias("end"))
    return ends.join(own, "p", "left").select("hybas_id", F.when(F.col("end"), F.col("p")).alias("next_sink"))


def members(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``hybas_id, next_sink`` of the seeds' downstream closure, a node once; null where
    ``edges`` (with ``next_sink``) tells none."""
    return downstream_closure(seeds, edges).join(edges.groupBy("hybas_id").agg(F.min("next_sink").alias("next_sink")), "hybas_id", "left")


def members_by_sink(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``members``, of which none may lack a sink."""
    found = members(seeds, edges)
    check_sinks(found)
    return found


def partitions_by_sink(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``next_sink, n, first_id, last_id``: the members of each partition counted."""
    found = members_by_sink(seeds, edges)
    return found.groupBy("next_sink").agg(F.count("*").alias("n"), F.min("hybas_id").alias("first_id"), F.max("hybas_id").alias("last_id"))


def without_sink(next_sink: Column) -> Column:
    """Whether a member lacks a terminal sink."""
    return next_sink.isNull()


def check_sinks(members: DataFrame) -> None:
    """Raise if a member has no sink."""
    bad = members.where(without_sink(F.col("next_sink"))).select("hybas_id").orderBy("hybas_id").limit(5).collect()
    if bad:
        raise ValueError(f"watersheds without a terminal sink: {', '.join(str(r['hybas_id']) for r in bad)}")


def upstream_adjacency(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``hybas_id, n_up, upstream``: direct upstream ids, restricted to known ids."""
    ids = known.select("hybas_id").distinct()
    into = edges.where(_DOWN).join(ids, "hybas_id", "left_semi").join(ids.withColumnRenamed("hybas_id", "next_down"), "next_down", "left_semi")
    return into.groupBy(F.col("next_down").alias("hybas_id")).agg(F.count("*").alias("n_up"), F.concat_ws(",", F.transform(F.sort_array(F.collect_set("hybas_id")), lambda x: x.cast("string"))).alias("upstream"))


def seed_ranking(candidates: DataFrame) -> DataFrame:
    """Seeds by population, largest first; ties by id.  Seeds are dealt by range of
    (population, id), so that many seeds of one population share out, too; a task ranks
    its range, and the ranges before it are added as one number each."""
    from pyspark.sql import Window

    dealt = candidates.select("hybas_id", "pop_sum").repartitionByRange(F.desc("pop_sum"), F.asc("hybas_id"))
    parted = Stage(dealt.withColumn("part", F.spark_partition_id())).df
    sizes = parted.groupBy("part").agg(F.count("*").alias("n"))  # a row for each range
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("pop_sum"), "hybas_id"))
    return parted.join(F.broadcast(before), "part").select("hybas_id", "pop_sum", (F.col("before") + own).cast("long").alias("seed_rank"))


def first_rows(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Of each group the first row in the given order (nulls first)."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("f")).select(*by, "f.*")


def selection_totals(chosen: DataFrame, key: str = "focal_id") -> DataFrame:
    """``key, n_visited, n_selected, pop_sum, area_ha`` of a greedy selection."""
    return chosen.groupBy(key).agg(F.count("*").alias("n_visited"), F.sum(F.col("selected").cast("long")).alias("n_selected"), F.sum("pop_sum").alias("pop_sum"), F.sum("area_ha").alias("area_ha"))


def greedy_selection(candidates: DataFrame, max_area: float, key: str = "focal_id") -> DataFrame:
    """Order-dependent choice, one focal area a task: ``focal_id, step, hybas_id,
    selected, pop_sum, area_ha`` of every watershed visited.

    While the selected area is below ``max_area`` the unvisited seed of largest
    population (ties: smallest id) starts a breadth-first walk upstream.  Every visited
    watershed's population counts; the first that lies in the priority place
    (``hits_pp`` and a positive ``pp_area_ha``) is selected and ends the walk.  The
    budget is looked at between seeds only, so it may be overshot.  A task holds some ten
    numbers for each watershed of its focal area.
    """

    kept = [key, "hybas_id", "next_down", "pop_sum", "hits_pp", "pp_area_ha"]

    def run(group: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("hybas_id")
        ids = rows["hybas_id"].to_numpy()
        first = np.diff(ids, prepend=ids[0] - 1) != 0
        rows, ids = rows.filter(pa.array(first)), ids[first]
        area = rows["pp_area_ha"].cast(pa.float64()).fill_null(0.0).to_numpy()
        hit = rows["hits_pp"].fill_null(False).to_numpy() & (area > 0)
        # upstream ids of the k-th are ids[up[at[k] : at[k + 1]]], ascending
        down = rows["next_down"]
        below = down.fill_null(0).to_numpy()
        place = np.minimum(np.searchsorted(ids, below), len(ids) - 1)
        up = np.flatnonzero((ids[place] == below) & down.is_valid().to_numpy())
        up = up[np.argsort(place[up], kind="stable")]
        at = np.searchsorted(place[up], np.arange(len(ids) + 1))
        order = pc.sort_indices(rows, sort_keys=[("pop_sum", "descending"), ("hybas_id", "ascending")]).to_numpy()
        seen, total, visited = np.zeros(len(ids), bool), 0.0, []
        for seed in order:
            if not total < max_area:
                break
            queue = deque([seed])
            while queue:
                here = queue.popleft()
                if seen[here]:
                    continue
                seen[here] = True
                visited.append(here)
                if hit[here]:
                    total += float(area[here])
                    break
                near = up[at[here] : at[here + 1]]
                queue.extend(near[~seen[near]])
        way = np.array(visited, np.int64)
        out = [pa.array([group[0].as_py()] * len(way), group[0].type), pa.array(np.arange(len(way)), pa.int32()), pa.array(ids[way], pa.int64())]
        out += [pa.array(hit[way]), rows["pop_sum"].take(pa.array(way)), pa.array(np.where(hit[way], area[way], 0.0))]
        return pa.table(out, names=[key, "step", "hybas_id", "selected", "pop_sum", "area_ha"])

    kind = candidates.schema[key].dataType.simpleString()
    return candidates.select(*kept).groupBy(key).applyInArrow(run, f"{key} {kind}, step int, hybas_id bigint, selected boolean, pop_sum {candidates.schema['pop_sum'].dataType.simpleString()}, area_ha double")
