"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Vectors are assigned to the nearest of the cell centres; a vector that lies near the
boundary of another cell visits that cell too, so pairs that a boundary separates
still meet at the home of one of the two.  Cells that stay large are split again in the same way, level by level.
Products are computed block by block within a cell in double precision.  A block pair
returns counts and a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import Scratch, components, durable

#: Vectors of a cell on average; least and most cells of a split; vectors that a split
#: is fitted on, for each of its cells and at most.
CELL, FEWEST, CELLS, PER_CENTRE, FIT_ROWS = 128, 64, 4096, 16, 65_536
#: Vectors of a cell that is split again; levels of splits at most; rows of a block;
#: bytes of vectors that a task assigns at once.
SPLIT, LEVELS, BLOCK, PIECE = 8192, 5, 1024, 16 << 20
#: Standard deviations by which a boundary may separate a pair that still meets.
SLACK = 2.2


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision of a list column without nulls."""
    flat = pa.compute.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True) if x.size else np.ones((len(x), 1))
    x = x / np.where(top > 0, top, 1)  # no overflow in the squares
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of k cells of the unit rows ``x``; deterministic."""
    rng = np.random.default_rng(0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([(x[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        empty = np.bincount(own, minlength=len(centres)) == 0
        centres = np.where(empty[:, None], centres, _unit(sums))
    return centres


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array of double) of the vectors that can link with others."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda e: e != 0) & F.col(f"`{id_col}`").isNotNull())


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, slack: float = SLACK) -> DataFrame:
    """One row per vector: ``id, n_links`` (other rows linked directly),
    ``component_id`` (smallest id that links reach) and ``kept`` (that is the id).

    Links are pairs found with cosine >= threshold; a pair is missed only if a cell
    boundary separates it by more than ``slack`` standard deviations (of a difference
    along the boundary's normal, as the cells' own spread tells); an infinite ``slack``
    misses none, at the cost of more visits.  Null vectors, zero vectors and vectors
    with a null or non-finite component link with nothing, nor do vectors of different
    lengths.  Rows with equal vectors are one node, so many copies cost no more than
    one.  Rows with a null id have a null component and are kept.  Rows of one id with
    several vectors share the component of all of them and count the links of the
    vector with most.  An empty table gives an empty result; other columns are not read.
    """
    good = valid(vectors, id_col, vector_col)
    # equal vectors: one node that knows its copies
    scratch = Scratch()
    nodes = scratch.keep(good.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies")))
    edges, counts = _cell_links(nodes.select("node", "copies", "v"), threshold, slack, scratch)
    labels = scratch.table(components(edges))
    more = counts.groupBy("node").agg(F.sum("more").cast("long").alias("more"))
    named = nodes.join(more, "node", "left").join(labels, "node", "left")
    named = named.select("v", "copies", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("component", "node").alias("component"))
    named = scratch.keep(named)
    # every id finds its node through its vector; the vectors that make a thousandth of
    # all rows each (so a thousand at most) are sent to the rows, not the rows to them
    total = good.count()
    hot = F.broadcast(named.where(F.col("copies") * 1000 > F.lit(total)).withColumn("__hot", F.lit(True)))
    split = good.join(hot, "v", "left")
    found = (F.col("copies") - 1 + F.col("more")).alias("n_links")
    ids = split.where("__hot").select("id", found, "component")
    ids = ids.unionByName(split.where("__hot IS NULL").select("id", "v").join(named.where(F.col("copies") * 1000 <= F.lit(total)), "v").select("id", found, "component"))
    ids = ids.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    joined = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id")).join(ids, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.least(F.coalesce("component", "id"), "id"))
    return scratch.result(joined.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


_PLACED = "cell string, home array<int>, seen array<array<int>>, node long, copies long, v array<double>"


def _fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Centres of one cell's split and, for each pair of directions, how its vectors spread."""
    x = np.stack(rows.sort_values("node")["v"].to_numpy())
    x = _unit(x)
    centres = spherical_kmeans(x, int(rows["k"].iloc[0]))
    own = np.concatenate([(x[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(x), 4096)])
    rest = x - centres[own]
    spread = rest.T @ rest / max(1e-300, float((rest * rest).sum()))
    return pd.DataFrame({"cell": [key[0]], "centres": [centres.ravel()], "spread": [spread.ravel()]})


def _assign(centres: np.ndarray, spread: np.ndarray, apart: float, slack: float):
    """A function from unit rows to their homes (the nearest cells) and the (row, cell) of
    all places that they take.  Of a pair that a boundary separates one end is no farther
    from it than half the pair's extent along the normal, so half the slack will do."""
    d = centres.shape[1]
    along = centres @ spread

    def place(unit: np.ndarray):
        near = unit @ centres.T
        home = near.argmax(axis=1)
        first, back = np.unique(home, return_inverse=True)
        c = centres[first]
        gap = np.sqrt(np.maximum(2 - 2 * c @ centres.T, 0))
        gap = np.where(gap > 0, gap, 1e-12)
        # variance of a difference of unit length along the boundary's normal, at least that of one equal in all directions
        own = (along[first] * c).sum(1)[:, None]
        across = (own + (along * centres).sum(1)[None, :] - along[first] @ centres.T - c @ along.T) / gap**2
        reach = np.minimum(apart, slack * apart * np.sqrt(np.maximum(across, 1 / d))) / 2 if math.isfinite(slack) else np.full_like(gap, apart)
        at = np.arange(len(unit))
        # distance from the plane between the own cell and each other one
        margin = (near[at, home][:, None] - near) / gap[back]
        visit = margin <= reach[back]
        visit[at, home] = True
        return home, *np.nonzero(visit)

    return place


def _split(placed: DataFrame, crowd: DataFrame, apart: float, slack: float) -> DataFrame:
    """Deal the vectors of the cells of ``crowd`` (``cell, n, d``) into smaller cells.

    A cell's split is fitted by one task on a bounded sample of it; its vectors are
    assigned in pieces of bounded size, each of which meets the centres."""
    k = F.least(F.greatest(F.ceil(F.col("n") / CELL), F.lit(FEWEST)), F.lit(CELLS)).cast("int")
    sized = crowd.withColumn("k", k).withColumn("pieces", F.ceil(F.col("n") * F.col("d") * 8 / PIECE).cast("int"))
    rows = placed.join(sized, "cell")
    share = F.least(F.lit(1.0), F.least(F.col("k") * PER_CENTRE, F.lit(FIT_ROWS)) / F.col("n"))
    sample = rows.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share * 1_000_000 + 1).select("cell", "k", "node", "v")
    fitted = durable(sample.groupBy("cell").applyInPandas(_fit, "cell string, centres array<double>, spread array<double>"))
    sent = fitted.join(sized.select("cell", "d", "pieces"), "cell").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("node", F.lit(1)), F.col("pieces")).cast("int")).select("cell", "piece", "home", "seen", "node", "copies", "v")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["cell", "home", "seen", "node", "copies", "v"]
        ints = pa.list_(pa.int32())
        kinds = [pa.string(), ints, pa.list_(ints), pa.int64(), pa.int64(), pa.list_(pa.float64())]
        if not right.num_rows or not left.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        d = right.column("d")[0].as_py()
        centres = right.column("centres").combine_chunks().flatten().to_numpy().reshape(-1, d)
        place = _assign(centres, right.column("spread").combine_chunks().flatten().to_numpy().reshape(d, d), apart, slack)
        within = right.column("cell")[0].as_py()
        labels = pa.array([f"{within}.{c}" for c in range(len(centres))])
        parts = []
        left = left.combine_chunks()
        for at in range(0, left.num_rows, 512):
            piece = left.slice(at, 512).combine_chunks()
            unit = _matrix(piece.column("v").combine_chunks())
            home, row, cell = place(unit)
            ends = np.searchsorted(row, np.arange(len(unit) + 1))
            visits = np.split(cell.astype(np.int32), ends[1:-1])
            homes = pa.array([[*h, n] for h, n in zip(piece.column("home").to_pylist(), home.tolist())], ints)
            seen = pa.array([[*w, n] for w, n in zip(piece.column("seen").to_pylist(), visits)], pa.list_(ints))
            offsets = pa.array(np.arange(0, len(row) * d + 1, d, dtype=np.int32))
            at_row = pa.array(row)
            parts.append(pa.table([labels.take(pa.array(cell)), homes.take(at_row), seen.take(at_row), piece.column("node").take(at_row), piece.column("copies").take(at_row), pa.ListArray.from_arrays(offsets, pa.array(unit[row].ravel()))], names))
        return pa.concat_tables(parts)

    return dealt.groupBy("cell", "piece").cogroup(sent.groupBy("cell", "piece")).applyInArrow(run, _PLACED)


def _cell_links(nodes: DataFrame, threshold: float, slack: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(a, b)`` forest edges and ``(node, more)`` link counts of the nodes.

    All vectors of one length begin as one cell.  ``home`` and ``seen`` tell each level's
    home of a vector and the cells that it is placed in.  A pair counts in a cell that at
    each level is the home of one of the two, and of two such cells in the one of smaller
    number, so it counts once."""
    apart = math.sqrt(max(0.0, 2 - 2 * threshold))  # |u - v| of a linked pair, at most
    unit = F.expr("transform(v, x -> x / array_max(transform(v, y -> abs(y))))")  # no overflow in the squares
    placed = scratch.keep(nodes.select(F.size("v").cast("string").alias("cell"), F.expr("cast(array() as array<int>)").alias("home"), F.expr("cast(array() as array<array<int>>)").alias("seen"), "node", "copies", unit.alias("v")))
    done = []
    crowd = scratch.keep(placed.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.size("v")).alias("d")).withColumn("was", F.lit(1 << 62).cast("long")))
    for _ in range(LEVELS):
        # a cell that its split hardly made smaller is one cluster: it is compared by blocks
        large = (F.col("n") > SPLIT) & (F.col("n") * 2 < F.col("was"))
        big = scratch.keep(crowd.where(large).select("cell", "n", "d"))
        if big.isEmpty():
            break
        done.append(placed.join(crowd.where(~large).select("cell"), "cell", "left_semi"))
        placed = scratch.keep(_split(placed, big, apart, slack))
        sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.size("v")).alias("d"))
        within = F.regexp_replace("cell", "\\.[0-9]+$", "")
        crowd = scratch.keep(sizes.withColumn("within", within).join(big.select(F.col("cell").alias("within"), F.col("n").alias("was")), "within").select("cell", "n", "d", "was"))
    for part in done:
        placed = placed.unionByName(part)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    dealt = placed.join(sizes, "cell").withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "home", "seen", "node", "copies", "v")
    found = scratch.keep(dealt.groupBy("cell", "i", "j").applyInArrow(_products(threshold), "a long, b long, more long, edge boolean"))
    return found.where("edge").select("a", "b"), found.where("NOT edge").select(F.col("a").alias("node"), "more")


def _products(threshold: float):
    """Links of a pair of blocks: forest edges (a, b), and for each node (a) the copies
    that it links with (more)."""

    def counts_here(rows: pa.Table, cells: list[int]):
        """A function of two arrays of rows: which pairs count in this cell."""
        n, levels = rows.num_rows, len(cells)
        if not levels:
            return lambda p, q: np.ones(len(p), bool)
        homes = rows.column("home").combine_chunks().flatten().to_numpy().reshape(n, levels)
        inner = rows.column("seen").combine_chunks().flatten()
        known = []  # sorted keys of (row, cell that it is placed in), for each level
        for level in range(levels):
            lists = inner.take(pa.array(np.arange(level, n * levels, levels)))
            owner = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
            known.append(np.sort(owner << 32 | lists.flatten().to_numpy()))

        def test(p, q):
            good = np.ones(len(p), bool)
            for level, here in enumerate(cells):
                hp, hq = homes[p, level], homes[q, level]
                own, guest = np.where(hp == here, p, q), np.where(hp == here, hq, hp)
                key = own << 32 | guest
                at = np.minimum(np.searchsorted(known[level], key), len(known[level]) - 1)
                elsewhere = (guest < here) & (known[level][at] == key)
                good &= ((hp == here) | (hq == here)) & ~elsewhere
            return good

        return test

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        i, j = key[1].as_py(), key[2].as_py()
        mine, node, copies = (rows.column(c).to_numpy() for c in ("mine", "node", "copies"))
        x = _matrix(rows.column("v").combine_chunks())
        here = counts_here(rows, [int(c) for c in key[0].as_py().split(".")[1:]])
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        edges_a, edges_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        more = np.zeros(len(node), np.int64)
        group = np.arange(len(node))
        for a in range(0, len(left), 256):
            part = left[a : a + 256]
            hit = x[part] @ x[right].T >= threshold
            if i == j:
                hit &= node[right][None, :] > node[part][:, None]
            p, q = np.nonzero(hit)
            p, q = part[p], right[q]
            once = here(p, q)
            p, q = p[once], q[once]
            np.add.at(more, p, copies[q])
            np.add.at(more, q, copies[p])
            keep = []
            for t in np.flatnonzero(group[p] != group[q]).tolist():
                if (s := group[p[t]]) != (u := group[q[t]]):
                    group[group == max(s, u)] = min(s, u)
                    keep.append(t)
            edges_a.append(node[p[keep]]), edges_b.append(node[q[keep]])
        ea, eb, counted = np.concatenate(edges_a), np.concatenate(edges_b), np.flatnonzero(more)
        n, m = len(ea), len(counted)
        return pa.table({"a": np.r_[ea, node[counted]], "b": np.r_[eb, np.full(m, -1, np.int64)], "more": np.r_[np.zeros(n, np.int64), more[counted]], "edge": np.r_[np.ones(n, bool), np.zeros(m, bool)]})

    return run
