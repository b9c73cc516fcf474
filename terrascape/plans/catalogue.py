"""The registered queries over the derived rasters, networks and areas, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.functions import crs
from terrascape.model import NEIGHBOURS
from terrascape.operators import erode, focal, grid, hydro, masks, network, reach, vector
from terrascape.plans import workflow
from terrascape.sources import chunks
from terrascape.sources.fixtures import AOI, BOXES, CELLS, DEM, EDGES, FOCAL, load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
CELL = ["row_i", "col_j"]
MAX_TIME = 30.0


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


_STRAIGHT, _DIAGONAL = reach.step_lengths(1.0)
_STEPS = "(VALUES " + ", ".join(f"({i}, {j}, cast({float(_DIAGONAL if s else _STRAIGHT)!r} AS FLOAT))" for i, j, s in NEIGHBOURS) + ") AS nbr(di, dj, len)"


def _reach_sql(source: str, keys: str = "") -> str:
    """Recursive reach; ``source``: a query of the covered start cells."""
    k = f"{keys}, " if keys else ""
    same = " AND ".join(f"o.{c} = x.{c}" for c in [*([keys] if keys else []), *CELL])
    rk = f"r.{keys}, " if keys else ""
    notsrc = f"NOT EXISTS (SELECT 1 FROM src s WHERE s.row_i = c.row_i AND s.col_j = c.col_j{f' AND s.{keys} = r.{keys}' if keys else ''})"
    return f"""WITH RECURSIVE cells AS MATERIALIZED ({CELLS}), src AS MATERIALIZED ({source}),
reached({k}row_i, col_j, t) USING KEY ({k}row_i, col_j) AS (
  SELECT {k}row_i, col_j, cast(0 AS FLOAT) AS t FROM src
  UNION
  SELECT {', '.join('x.' + c for c in [*([keys] if keys else []), *CELL])}, min(x.t) FROM (
    SELECT {rk}c.row_i, c.col_j, r.t + c.friction * nbr.len AS t FROM reached r, {_STEPS}, cells c
    WHERE c.row_i = r.row_i + nbr.di AND c.col_j = r.col_j + nbr.dj AND c.friction > 0 AND {notsrc}) x
  LEFT JOIN recurring.reached o ON {same}
  WHERE x.t <= cast({MAX_TIME} AS FLOAT) AND (o.t IS NULL OR x.t < o.t) GROUP BY ALL)
"""


_SRC = "SELECT row_i, col_j FROM cells WHERE source"
_AOI_SRC = f"SELECT a.aoi_id, c.row_i, c.col_j FROM cells c JOIN ({AOI}) a ON c.row_i BETWEEN a.row_lo AND a.row_hi AND c.col_j BETWEEN a.col_lo AND a.col_hi"


def _travel_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "fx_cells").withColumn("aoi_id", F.lit("all"))


def _aoi_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each area's cells: its box and as far around as a travel of MAX_TIME goes."""
    cells = load(spark, sf_dir, "fx_cells").drop("source")
    around = int(MAX_TIME) + 1  # the least friction is 1 a cell
    inside = F.col("row_i").between(F.col("row_lo"), F.col("row_hi")) & F.col("col_j").between(F.col("col_lo"), F.col("col_hi"))
    return grid.cells_of_boxes(cells, load(spark, sf_dir, "fx_aoi"), around).select("aoi_id", *CELL, "friction", "pop", inside.alias("source"))


@query(_reach_sql(_SRC) + "SELECT row_i, col_j, t FROM reached")
def travel_time_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reach.reach(_travel_cells(spark, sf_dir), MAX_TIME).select(*CELL, "t")


@query(_reach_sql(_SRC) + "SELECT row_i, col_j, t FROM reached")
def travel_time_reach_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reach.reach(_travel_cells(spark, sf_dir), MAX_TIME, plan="tiles", tile=64).select(*CELL, "t")


@query(_reach_sql(_SRC) + "SELECT cast(sum(CASE WHEN c.pop > 0 THEN c.pop ELSE 0 END) AS BIGINT) AS pop_sum, count(*) AS n_cells FROM reached r JOIN cells c USING (row_i, col_j)")
def travel_time_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _travel_cells(spark, sf_dir)
    found = reach.reach(cells, MAX_TIME).select(*CELL, F.lit(1).alias("m"))
    got = found.join(cells, CELL).select(masks.covered_by_reach(F.col("m"), F.col("pop")).alias("pop"))
    return got.agg(F.sum("pop").cast("long").alias("pop_sum"), F.count("*").alias("n_cells"))


@query(_reach_sql(_AOI_SRC, "aoi_id") + "SELECT r.aoi_id, cast(sum(CASE WHEN c.pop > 0 THEN c.pop ELSE 0 END) AS BIGINT) AS pop_sum, count(*) AS n_cells FROM reached r JOIN cells c ON r.row_i = c.row_i AND r.col_j = c.col_j GROUP BY r.aoi_id")
def travel_time_by_aoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _aoi_cells(spark, sf_dir)
    found = reach.reach(cells, MAX_TIME).select("aoi_id", *CELL)
    got = found.join(cells, ["aoi_id", *CELL]).select("aoi_id", masks.covered_by_reach(F.lit(1), F.col("pop")).alias("pop"))
    return got.groupBy("aoi_id").agg(F.sum("pop").cast("long").alias("pop_sum"), F.count("*").alias("n_cells"))


@query(f"SELECT row_i, col_j, CASE WHEN cond IS NOT NULL AND cond > 0 AND cond < 50000 THEN 1 ELSE 0 END AS hit FROM ({CELLS})")
def condition_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.condition(load(spark, sf_dir, "fx_cells"), "(value > 0) & (value < 50000)", "cond")


@query(f"SELECT row_i, col_j, cast(CASE WHEN cond > 0 AND pop > 0 THEN pop ELSE 0 END AS BIGINT) AS pop FROM ({CELLS})")
def masked_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load(spark, sf_dir, "fx_cells")
    hit = masks.condition(cells, "value > 0", "cond").select(*CELL, F.col("hit").alias("m"))
    return masks.mask_population(cells.select(*CELL, "pop"), hit, masks.covered_downstream)


_LAYERS = f"""layers AS (
  SELECT 'positive' AS mask_id, n_name AS aoi_id, row_i, col_j, CASE WHEN cond > 0 AND pop > 0 THEN pop ELSE 0 END AS pop FROM ({CELLS}), nation WHERE row_i % 25 = n_nationkey
  UNION ALL SELECT 'slow', n_name, row_i, col_j, CASE WHEN friction >= 5 AND pop > 0 THEN pop ELSE 0 END FROM ({CELLS}), nation WHERE row_i % 25 = n_nationkey AND col_j < 80)"""


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two masks of unequal extent; rows of the grid belong to areas in turn."""
    cells = load(spark, sf_dir, "fx_cells")
    names = F.broadcast(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("aoi_id"), "n_nationkey"))  # 25 rows
    keyed = cells.join(names, F.col("row_i") % 25 == F.col("n_nationkey"))
    pop = F.when(F.col("pop") > 0, F.col("pop")).otherwise(0).cast("long")
    one = keyed.select(F.lit("positive").alias("mask_id"), "aoi_id", *CELL, F.when(F.col("cond") > 0, pop).otherwise(0).alias("pop"))
    two = keyed.where("col_j < 80").select(F.lit("slow").alias("mask_id"), "aoi_id", *CELL, F.when(F.col("friction") >= 5, pop).otherwise(0).alias("pop"))
    return one.unionByName(two)


@query(f"WITH {_LAYERS} SELECT row_i, col_j, max(pop) AS pop FROM layers GROUP BY ALL")
def combine_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.combine(_layers(spark, sf_dir))


@query(f"""WITH {_LAYERS}, each AS (SELECT aoi_id, mask_id, sum(pop) AS s FROM layers GROUP BY ALL),
  most AS (SELECT aoi_id, sum(pop) AS s FROM (SELECT aoi_id, row_i, col_j, max(pop) AS pop FROM layers GROUP BY ALL) GROUP BY ALL)
  SELECT aoi_id AS aoi, coalesce(cast(cast(max(CASE WHEN mask_id = 'positive' THEN s END) AS BIGINT) AS VARCHAR), 'n/a') AS positive,
    coalesce(cast(cast(max(CASE WHEN mask_id = 'slow' THEN s END) AS BIGINT) AS VARCHAR), 'n/a') AS slow, cast(cast(max(most.s) AS BIGINT) AS VARCHAR) AS "combined pop"
  FROM each JOIN most USING (aoi_id) GROUP BY aoi_id""".replace("each.s", "s").replace("THEN s END", "THEN each.s END"))
def population_by_mask_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.wide(masks.sums(_layers(spark, sf_dir), ["aoi_id"]), ["positive", "slow"])


#: Populations with fractions of eighths, whose sums are exact in any order.
_PEOPLE = "CASE WHEN pop > 0 THEN pop + (3 * col_j + row_i) % 8 / 8.0::DOUBLE ELSE 0.0::DOUBLE END"


def _people() -> Column:
    return F.when(F.col("pop") > 0, F.col("pop") + (3 * F.col("col_j") + F.col("row_i")) % 8 / 8).otherwise(0.0)


@query(f"""WITH c AS (SELECT row_i, col_j, cond, friction, n_name AS aoi_id, {_PEOPLE} AS pop FROM ({CELLS}), nation WHERE row_i % 25 = n_nationkey),
  layers AS (SELECT 'positive' AS mask_id, aoi_id, row_i, col_j, CASE WHEN cond > 0 THEN pop ELSE 0 END AS pop FROM c UNION ALL SELECT 'slow', aoi_id, row_i, col_j, CASE WHEN friction >= 5 THEN pop ELSE 0 END FROM c WHERE col_j < 80)
  SELECT aoi_id, mask_id, sum(pop) AS pop_sum FROM layers GROUP BY ALL UNION ALL SELECT aoi_id, 'combined pop', sum(pop) FROM (SELECT aoi_id, row_i, col_j, max(pop) AS pop FROM layers GROUP BY ALL) GROUP BY aoi_id""")
def fractional_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of fractional populations by area and mask, and of the combined mask."""
    people = load(spark, sf_dir, "fx_cells").select(*CELL, _people().alias("people"))
    layers = _layers(spark, sf_dir).withColumn("hit", F.col("pop") > 0).join(people, CELL)
    return masks.sums(layers.select("mask_id", "aoi_id", *CELL, F.when(F.col("hit"), F.col("people")).otherwise(0.0).alias("pop")), ["aoi_id"])


@query(f"SELECT cast(floor(row_i / 32) AS INT) AS trow, cast(floor(col_j / 32) AS INT) AS tcol, cast(sum(pop) AS BIGINT) AS block_sum, count(*) AS n FROM ({CELLS}) GROUP BY ALL")
def block_partial_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.block_sums(load(spark, sf_dir, "fx_cells"), tile=32)


#: Closures start where the account, from which watersheds' populations come, is in debt.
_SEED = f"SELECT hybas_id FROM ({FOCAL}) WHERE pop_sum < 1000"
_CLOSED = f"""WITH RECURSIVE e AS ({EDGES}), c(hybas_id) AS ({_SEED}
  UNION SELECT e.next_down FROM c JOIN e USING (hybas_id) WHERE e.next_down <> 0)"""
_SINKS = f"""WITH RECURSIVE e AS ({EDGES}), s(hybas_id, next_sink) AS (SELECT hybas_id, hybas_id FROM e WHERE next_down = 0
  UNION ALL SELECT e.hybas_id, s.next_sink FROM s JOIN e ON e.next_down = s.hybas_id)"""


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "fx_focal").where("pop_sum < 1000").select("hybas_id")


@query(_CLOSED + " SELECT hybas_id FROM c")
def downstream_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.downstream_closure(_seeds(spark, sf_dir), load(spark, sf_dir, "fx_edges"))


@query(_SINKS + " SELECT hybas_id, next_sink FROM s")
def terminal_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.terminal_sinks(load(spark, sf_dir, "fx_edges"))


@query(_SINKS + f", c(hybas_id) AS ({_SEED} UNION SELECT e.next_down FROM c JOIN e USING (hybas_id) WHERE e.next_down <> 0) SELECT next_sink, count(*) AS n, min(hybas_id) AS first_id, max(hybas_id) AS last_id FROM c JOIN s USING (hybas_id) GROUP BY next_sink")
def drain_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = load(spark, sf_dir, "fx_edges")
    return network.partitions_by_sink(_seeds(spark, sf_dir), edges.join(network.terminal_sinks(edges), "hybas_id"))


@query(_CLOSED + " SELECT e.hybas_id, e.next_down FROM e WHERE hybas_id IN (SELECT hybas_id FROM c)")
def watershed_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = load(spark, sf_dir, "fx_edges")
    return edges.join(network.downstream_closure(_seeds(spark, sf_dir), edges), "hybas_id", "left_semi")


@query(_SINKS + f", c(hybas_id) AS ({_SEED} UNION SELECT e.next_down FROM c JOIN e USING (hybas_id) WHERE e.next_down <> 0) SELECT hybas_id, CASE WHEN hybas_id % 13 <> 0 THEN next_sink END AS next_sink, hybas_id % 13 = 0 AS absent FROM c JOIN s USING (hybas_id)")
def missing_sink_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of drain partitions that lack a sink, where the network tells none for
    every 13th watershed."""
    edges = load(spark, sf_dir, "fx_edges")
    told = edges.join(network.terminal_sinks(edges), "hybas_id").withColumn("next_sink", F.expr("CASE WHEN hybas_id % 13 <> 0 THEN next_sink END"))
    found = network.members(_seeds(spark, sf_dir), told)
    return found.select("hybas_id", "next_sink", network.without_sink(F.col("next_sink")).alias("absent"))


@query(f"WITH e AS ({EDGES}) SELECT next_down AS hybas_id, count(*) AS n_up, string_agg(cast(hybas_id AS VARCHAR), ',' ORDER BY hybas_id) AS upstream FROM e WHERE next_down <> 0 AND next_down IN (SELECT hybas_id FROM e) GROUP BY next_down")
def upstream_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = load(spark, sf_dir, "fx_edges")
    return network.upstream_adjacency(edges, edges)


@query(f"WITH RECURSIVE e AS ({EDGES}), u(seed, hybas_id) AS (SELECT hybas_id, hybas_id FROM e UNION ALL SELECT u.seed, e.hybas_id FROM u JOIN e ON e.next_down = u.hybas_id) SELECT seed, hybas_id FROM u")
def upstream_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = load(spark, sf_dir, "fx_edges")
    return network.upstream_closure(edges, edges)


_DISC = "SELECT cast(i AS INT) AS di, cast(j AS INT) AS dj FROM range(-6, 7) a(i), range(-6, 7) b(j) WHERE i * i + j * j <= 36"


@query("WITH r AS (SELECT n_nationkey, cast(round_even(450.0 * n_nationkey / 900, 0) AS INT) AS r FROM nation) SELECT n_nationkey, cast(i AS INT) AS di, cast(j AS INT) AS dj FROM r, range(-12, 13) a(i), range(-12, 13) b(j) WHERE i * i + j * j <= r * r")
def disc_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of a buffer of each nation, of 450 m a number."""
    radii = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", (F.col("n_nationkey") * 450.0).alias("metres"))
    return focal.disc_cells(radii, "n_nationkey", "metres", 900.0)


@query(f"WITH k AS ({_DISC}) SELECT cast(row_i + di AS INT) AS row_i, cast(col_j + dj AS INT) AS col_j, count(*) AS hits FROM ({CELLS}), k WHERE source GROUP BY ALL")
def disc_dilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.dilate(load(spark, sf_dir, "fx_cells").where("source"), 6)


_D2 = f"WITH c AS ({CELLS}), s AS (SELECT row_i AS si, col_j AS sj FROM c WHERE source), d AS (SELECT row_i, col_j, cast(min((row_i - si) * (row_i - si) + (col_j - sj) * (col_j - sj)) AS BIGINT) AS d2 FROM c, s GROUP BY ALL)"


@query(_D2 + " SELECT row_i, col_j, d2 FROM d")
def distance_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.distance(load(spark, sf_dir, "fx_cells"), "source")


@query(_D2 + " SELECT row_i, col_j FROM d WHERE d2 > 0 AND d2 <= 100")
def max_distance_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = focal.distance(load(spark, sf_dir, "fx_cells"), "source")
    return d.where(masks.within_distance(F.lit(1), F.sqrt("d2"), 900.0, 9000.0)).select(*CELL)


def _beside(z: str, name: str = "n") -> str:
    """Cells of the relation ``z`` beside their neighbours ``bi, bj``."""
    return f"{name} AS MATERIALIZED (SELECT a.row_i, a.col_j, b.row_i AS bi, b.col_j AS bj, slant FROM {z} a, (SELECT *, di <> 0 AND dj <> 0 AS slant FROM {_STEPS}), {z} b WHERE b.row_i = a.row_i + di AND b.col_j = a.col_j + dj)"


def _directed(z: str) -> str:
    """``l``: flow edges over the elevations ``z`` with the neighbours ``n``, flats
    included: steps from outlets and from walls, breadth first, then lower gradients."""

    def steps(name: str, first: str) -> str:
        return f"""{name}(row_i, col_j, k) USING KEY (row_i, col_j) AS (SELECT row_i, col_j, 1 AS k FROM ({first})
  UNION SELECT x.row_i, x.col_j, min(x.k) FROM (SELECT n.bi AS row_i, n.bj AS col_j, {name}.k + 1 AS k FROM {name} JOIN n ON n.row_i = {name}.row_i AND n.col_j = {name}.col_j SEMI JOIN still s ON s.row_i = n.bi AND s.col_j = n.bj) x
  LEFT JOIN recurring.{name} o ON o.row_i = x.row_i AND o.col_j = x.col_j WHERE o.k IS NULL OR x.k < o.k GROUP BY ALL)"""

    return f"""w AS MATERIALIZED (SELECT n.*, a.elev, b.elev AS low FROM n JOIN {z} a USING (row_i, col_j) JOIN {z} b ON b.row_i = n.bi AND b.col_j = n.bj),
  still AS MATERIALIZED (SELECT row_i, col_j, max(low) > min(elev) AS walled FROM w GROUP BY row_i, col_j HAVING count(*) = 8 AND min(low) >= min(elev)),
  {steps('near', 'SELECT DISTINCT w.row_i, w.col_j FROM w SEMI JOIN still s ON s.row_i = w.row_i AND s.col_j = w.col_j ANTI JOIN still t ON t.row_i = w.bi AND t.col_j = w.bj WHERE low = elev')},
  {steps('far', 'SELECT row_i, col_j FROM still WHERE walled')},
  g AS MATERIALIZED (SELECT row_i, col_j, 2 * near.k - coalesce(far.k, 0) AS level FROM near LEFT JOIN far USING (row_i, col_j)),
  l AS MATERIALIZED (SELECT row_i, col_j, bi AS to_i, bj AS to_j, elev - low AS "drop", slant, false AS flat FROM w WHERE elev > low
    UNION ALL SELECT w.row_i, w.col_j, bi, bj, cast(CASE WHEN t.level IS NULL THEN 2 ELSE g.level - t.level END AS BIGINT), slant, true FROM w JOIN g USING (row_i, col_j) LEFT JOIN g t ON t.row_i = w.bi AND t.col_j = w.bj
      WHERE elev = low AND (t.level IS NULL OR g.level > t.level))"""


_FLOW = f"""d AS MATERIALIZED ({DEM}), {_beside('d')}, {_directed('d')}"""


@query(f'WITH RECURSIVE {_FLOW} SELECT row_i, col_j, to_i, to_j, "drop", slant, flat FROM l')
def flow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hydro.flow_edges(load(spark, sf_dir, "fx_dem"))


@query(f"WITH RECURSIVE {_FLOW}, r(row_i, col_j) AS (SELECT row_i, col_j FROM d WHERE elev >= 320 UNION SELECT l.to_i, l.to_j FROM r JOIN l USING (row_i, col_j)) SELECT row_i, col_j FROM r")
def flow_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    dem = load(spark, sf_dir, "fx_dem")
    return hydro.reachable(hydro.flow_edges(dem), dem.where("elev >= 320"))


_POURED = """s AS MATERIALIZED (SELECT row_i, col_j, to_i, to_j, slope / sum(slope) OVER (PARTITION BY row_i, col_j) AS share FROM (SELECT *, "drop" / (CASE WHEN slant THEN sqrt(2.0::DOUBLE) ELSE 1.0::DOUBLE END) AS slope FROM l)),
  p(step, row_i, col_j, acc) AS (SELECT 0, row_i, col_j, 1.0::DOUBLE FROM d UNION ALL SELECT p.step + 1, s.to_i, s.to_j, sum(p.acc * s.share) FROM p JOIN s USING (row_i, col_j) GROUP BY p.step, s.to_i, s.to_j)
  SELECT row_i, col_j, cast(round(sum(acc) * 100000) AS BIGINT) AS acc_1e5 FROM p GROUP BY row_i, col_j"""


@query(f"WITH RECURSIVE {_FLOW}, {_POURED}")
def flow_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    dem = load(spark, sf_dir, "fx_dem")
    got = hydro.flow_accumulation(dem, dem.select(*CELL, F.lit(1).alias("w")))
    return got.select(*CELL, F.round(F.col("acc") * 100_000).cast("long").alias("acc_1e5"))


_FILLED = f"""d AS MATERIALIZED ({DEM}), {_beside('d')},
border AS (SELECT row_i, col_j FROM n GROUP BY ALL HAVING count(*) < 8),
f(row_i, col_j, elev) USING KEY (row_i, col_j) AS (SELECT row_i, col_j, elev FROM d SEMI JOIN border USING (row_i, col_j)
  UNION SELECT x.row_i, x.col_j, min(x.elev) FROM (SELECT n.bi AS row_i, n.bj AS col_j, greatest(f.elev, d.elev) AS elev FROM f JOIN n ON n.row_i = f.row_i AND n.col_j = f.col_j JOIN d ON d.row_i = n.bi AND d.col_j = n.bj) x
  LEFT JOIN recurring.f o ON o.row_i = x.row_i AND o.col_j = x.col_j WHERE o.elev IS NULL OR x.elev < o.elev GROUP BY ALL)"""


@query(f"WITH RECURSIVE {_FILLED} SELECT row_i, col_j, elev FROM f")
def pit_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hydro.fill_pits(load(spark, sf_dir, "fx_dem"))


@query(f"WITH RECURSIVE {_FILLED} SELECT row_i, col_j, elev FROM f")
def pit_fill_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hydro.fill_pits(load(spark, sf_dir, "fx_dem"), plan="tiles", tile=40)


_DOWN = f"z AS MATERIALIZED (SELECT row_i, col_j, elev FROM f), {_directed('z')}"


@query(f'WITH RECURSIVE {_FILLED}, {_DOWN} SELECT row_i, col_j, to_i, to_j, "drop", slant, flat FROM l')
def fill_then_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow directions of filled terrain."""
    return hydro.flow_edges(hydro.fill_pits(load(spark, sf_dir, "fx_dem")))


@query(f"WITH RECURSIVE {_FILLED}, {_DOWN}, {_POURED}")
def filled_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water of all cells over filled terrain, through the flats that filling makes."""
    dem = load(spark, sf_dir, "fx_dem")
    got = hydro.flow_accumulation(hydro.fill_pits(dem), dem.select(*CELL, F.lit(1).alias("w")))
    return got.select(*CELL, F.round(F.col("acc") * 100_000).cast("long").alias("acc_1e5"))


@query(f"""WITH RECURSIVE {_FILLED}, {_DOWN}, cells AS MATERIALIZED ({CELLS}),
  r(row_i, col_j) AS (SELECT row_i, col_j FROM cells SEMI JOIN d USING (row_i, col_j) WHERE cond > 95000 UNION SELECT l.to_i, l.to_j FROM r JOIN l USING (row_i, col_j)),
  wide AS (SELECT DISTINCT row_i + i AS row_i, col_j + j AS col_j FROM r, range(-2, 3) a(i), range(-2, 3) b(j) WHERE i * i + j * j <= 4)
  SELECT cast(coalesce(sum(CASE WHEN pop > 0 AND w.row_i IS NOT NULL THEN pop ELSE 0 END), 0) AS BIGINT) AS pop_sum, count(*) AS n_cells FROM cells c LEFT JOIN wide w ON w.row_i = c.row_i AND w.col_j = c.col_j""")
def downstream_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load(spark, sf_dir, "fx_cells")
    hit = masks.condition(cells, "value > 95000", "cond")
    got = workflow.downstream_population(load(spark, sf_dir, "fx_dem"), hit, cells.select(*CELL, "pop"), 1800, 900, None)
    return got.agg(F.sum("pop").cast("long").alias("pop_sum"), F.count("*").alias("n_cells"))


@query(f"""WITH RECURSIVE {_FILLED}, {_DOWN}, cells AS MATERIALIZED ({CELLS}),
  start AS MATERIALIZED (SELECT row_i, col_j FROM cells SEMI JOIN d USING (row_i, col_j) WHERE cond > 95000),
  r(row_i, col_j) AS (SELECT row_i, col_j FROM start UNION SELECT l.to_i, l.to_j FROM r JOIN l USING (row_i, col_j)),
  wide AS (SELECT DISTINCT row_i + i AS row_i, col_j + j AS col_j FROM r, range(-2, 3) a(i), range(-2, 3) b(j) WHERE i * i + j * j <= 4),
  apart AS (SELECT d.row_i, d.col_j, min((d.row_i - s.row_i) * (d.row_i - s.row_i) + (d.col_j - s.col_j) * (d.col_j - s.col_j)) AS d2 FROM d, start s GROUP BY ALL),
  within AS (SELECT row_i, col_j FROM wide JOIN apart USING (row_i, col_j) WHERE d2 > 0 AND d2 <= 9)
  SELECT c.row_i, c.col_j, cast(CASE WHEN pop > 0 AND w.row_i IS NOT NULL THEN pop ELSE 0 END AS BIGINT) AS pop FROM cells c LEFT JOIN within w ON w.row_i = c.row_i AND w.col_j = c.col_j""")
def downstream_population_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells downstream of a condition, at most 2.7 km from it."""
    cells = load(spark, sf_dir, "fx_cells")
    hit = masks.condition(cells, "value > 95000", "cond")
    return workflow.downstream_population(load(spark, sf_dir, "fx_dem"), hit, cells.select(*CELL, "pop"), 1800, 900, 2700)


_NEST = "SELECT n_regionkey AS k, cast(n_nationkey AS DOUBLE) AS minx, cast(n_nationkey AS DOUBLE) / 2 AS miny, cast(n_nationkey + 20 + n_regionkey AS DOUBLE) AS maxx, cast(30 - n_regionkey * 4 AS DOUBLE) AS maxy FROM nation"


@query(f"SELECT k, max(minx) AS minx, max(miny) AS miny, min(maxx) AS maxx, min(maxy) AS maxy, max(minx) >= min(maxx) OR max(miny) >= min(maxy) AS empty FROM ({_NEST}) GROUP BY k")
def extent_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = spark.sql(_NEST.replace("FROM nation", "FROM {nation}"), nation=spark.read.parquet(f"{sf_dir}/nation.parquet"))
    return vector.extent(boxes, "intersection", ["k"])


@query(f"SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, false AS empty FROM ({BOXES})")
def total_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector.extent(load(spark, sf_dir, "fx_boxes"))


@query(f"SELECT a.box_id AS left_id, b.box_id AS right_id FROM ({BOXES}) a JOIN ({BOXES}) b ON a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy")
def spatial_intersects_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = load(spark, sf_dir, "fx_boxes")
    return vector.box_join(boxes.withColumnRenamed("box_id", "left_id"), boxes.withColumnRenamed("box_id", "right_id"), 8.0, "left_id", "right_id")


@query(f"SELECT aoi_id, cast(coalesce(sum(pop), 0) AS BIGINT) AS pop_sum, count(pop) AS n FROM ({AOI}) a LEFT JOIN (SELECT row_i, col_j, CASE WHEN pop > 0 THEN pop END AS pop FROM ({CELLS})) c ON c.row_i BETWEEN row_lo AND row_hi AND c.col_j BETWEEN col_lo AND col_hi GROUP BY aoi_id")
def zonal_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = load(spark, sf_dir, "fx_aoi").select("aoi_id", F.explode(F.sequence("row_lo", "row_hi")).alias("row_i"), "col_lo", "col_hi").select("aoi_id", "row_i", F.explode(F.sequence("col_lo", "col_hi")).alias("col_j"))
    cells = load(spark, sf_dir, "fx_cells").select(*CELL, F.when(F.col("pop") > 0, F.col("pop")).alias("pop"))
    return vector.zonal_sums(zones, cells, "aoi_id")


#: A triangle for each nation, in cells.
_TRIANGLE = ["n_nationkey % 5 * 18 + 3.25", "floor(n_nationkey / 5) * 18 + 2.5", "n_nationkey % 5 * 18 + 16.75", "floor(n_nationkey / 5) * 18 + 7.125", "n_nationkey % 5 * 18 + 8.5 + n_nationkey % 3", "floor(n_nationkey / 5) * 18 + 15.75"]


def _triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x1, y1, x2, y2, x3, y3 = (f"cast({e} AS DOUBLE)" for e in _TRIANGLE)
    point = lambda x, y: f"named_struct('x', {x}, 'y', {y})"
    ring = f"array({point(x1, y1)}, {point(x2, y2)}, {point(x3, y3)})"
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey AS fid", f"array({ring}) AS rings")


_TRI_EDGES = "t AS (SELECT n_nationkey AS fid, " + ", ".join(f"cast({e} AS DOUBLE) AS {n}" for e, n in zip(_TRIANGLE, ("ax", "ay", "bx", "by_", "cx", "cy"))) + " FROM nation), e AS (SELECT fid, ax AS x1, ay AS y1, bx AS x2, by_ AS y2 FROM t UNION ALL SELECT fid, bx, by_, cx, cy FROM t UNION ALL SELECT fid, cx, cy, ax, ay FROM t)"


@query(f"""WITH {_TRI_EDGES}, r AS (SELECT fid, i AS row_i, x1 + (i + 0.5 - y1) * (x2 - x1) / (y2 - y1) AS x FROM e, range(0, 100) g(i) WHERE least(y1, y2) <= i + 0.5 AND i + 0.5 < greatest(y1, y2)),
  s AS (SELECT fid, row_i, min(x) AS u, max(x) AS v FROM r GROUP BY ALL)
  SELECT fid, cast(row_i AS INT) AS row_i, cast(j AS INT) AS col_j FROM s, range(0, 100) g(j) WHERE j + 0.5 >= u AND j + 0.5 < v""")
def rasterize_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector.rasterize(_triangles(spark, sf_dir), ["fid"], 100, 100)


@query(f"""WITH {_TRI_EDGES}, r AS (SELECT fid, i AS row_i, x1 + (i + 0.5 - y1) * (x2 - x1) / (y2 - y1) AS x FROM e, range(0, 100) g(i) WHERE least(y1, y2) <= i + 0.5 AND i + 0.5 < greatest(y1, y2)),
  s AS (SELECT fid, row_i, min(x) AS u, max(x) AS v FROM r GROUP BY ALL),
  k AS (SELECT fid, i, x1, y1, x2, y2, greatest(least(y1, y2), i) AS ya, least(greatest(y1, y2), i + 1) AS yb FROM e, range(0, 100) g(i) WHERE floor(least(y1, y2)) <= i AND i <= floor(greatest(y1, y2))),
  b AS (SELECT fid, i AS row_i, x1 + (ya - y1) * (x2 - x1) / (y2 - y1) AS p, x1 + (yb - y1) * (x2 - x1) / (y2 - y1) AS q FROM k)
  SELECT fid, cast(row_i AS INT) AS row_i, cast(j AS INT) AS col_j FROM s, range(0, 100) g(j) WHERE j + 0.5 >= u AND j + 0.5 < v
  UNION SELECT fid, cast(row_i AS INT), cast(j AS INT) FROM b, range(0, 100) g(j) WHERE floor(least(p, q)) <= j AND j <= floor(greatest(p, q))""")
def rasterize_all_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector.touched(_triangles(spark, sf_dir), ["fid"], 100, 100)


_TOUCHED = f"""{_TRI_EDGES}, r AS (SELECT fid, i AS row_i, x1 + (i + 0.5 - y1) * (x2 - x1) / (y2 - y1) AS x FROM e, range(0, 100) g(i) WHERE least(y1, y2) <= i + 0.5 AND i + 0.5 < greatest(y1, y2)),
  s AS (SELECT fid, row_i, min(x) AS u, max(x) AS v FROM r GROUP BY ALL),
  k AS (SELECT fid, i, x1, y1, x2, y2, greatest(least(y1, y2), i) AS ya, least(greatest(y1, y2), i + 1) AS yb FROM e, range(0, 100) g(i) WHERE floor(least(y1, y2)) <= i AND i <= floor(greatest(y1, y2))),
  b AS (SELECT fid, i AS row_i, x1 + (ya - y1) * (x2 - x1) / (y2 - y1) AS p, x1 + (yb - y1) * (x2 - x1) / (y2 - y1) AS q FROM k),
  zones AS (SELECT fid, row_i, j AS col_j FROM s, range(0, 100) g(j) WHERE j + 0.5 >= u AND j + 0.5 < v UNION SELECT fid, row_i, j FROM b, range(0, 100) g(j) WHERE floor(least(p, q)) <= j AND j <= floor(greatest(p, q)))"""


@query(f"WITH {_TOUCHED} SELECT fid, coalesce(sum(people), 0.0::DOUBLE) AS pop_sum, count(people) AS n FROM zones z LEFT JOIN (SELECT row_i, col_j, {_PEOPLE} AS people FROM ({CELLS})) c ON c.row_i = z.row_i AND c.col_j = z.col_j GROUP BY fid")
def touched_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional populations of all cells that a feature touches."""
    zones = vector.touched(_triangles(spark, sf_dir), ["fid"], 100, 100)
    return vector.zonal_sums(zones, load(spark, sf_dir, "fx_cells").select(*CELL, _people().alias("pop")), "fid")


@query("WITH t AS (SELECT n_nationkey AS fid, " + ", ".join(f"cast({e} AS DOUBLE) AS {n}" for e, n in zip(_TRIANGLE, ("ax", "ay", "bx", "by_", "cx", "cy"))) + """ FROM nation)
  SELECT fid, cast(round(abs((bx - ax) * (cy - ay) - (cx - ax) * (by_ - ay)) / 2 * 1000) AS BIGINT) AS area_milli, cast(round((ax + bx + cx) / 3 * 1000) AS BIGINT) AS cx_milli, cast(round((ay + by_ + cy) / 3 * 1000) AS BIGINT) AS cy_milli FROM t""")
def polygon_area_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    milli = lambda c: F.round(F.col(c) * 1000).cast("long")
    return vector.measures(_triangles(spark, sf_dir), ["fid"]).select("fid", milli("area").alias("area_milli"), milli("cx").alias("cx_milli"), milli("cy").alias("cy_milli"))


_MEETS = f"""{_TRI_EDGES}, m AS (SELECT fid, x1 + 4.5 AS x1, y1 + 3.75 AS y1, x2 + 4.5 AS x2, y2 + 3.75 AS y2 FROM e),
  side AS (SELECT e.fid AS a, m.fid AS b, sign((e.x2 - e.x1) * (m.y1 - e.y1) - (e.y2 - e.y1) * (m.x1 - e.x1)) AS p, sign((e.x2 - e.x1) * (m.y2 - e.y1) - (e.y2 - e.y1) * (m.x2 - e.x1)) AS q,
    sign((m.x2 - m.x1) * (e.y1 - m.y1) - (m.y2 - m.y1) * (e.x1 - m.x1)) AS r, sign((m.x2 - m.x1) * (e.y2 - m.y1) - (m.y2 - m.y1) * (e.x2 - m.x1)) AS s FROM e, m),
  within AS (SELECT a.fid AS a, b.fid AS b FROM e b, m a GROUP BY a.fid, b.fid, a.x1, a.y1 HAVING sum(CASE WHEN (b.y1 > a.y1) <> (b.y2 > a.y1) AND a.x1 < (b.x2 - b.x1) * (a.y1 - b.y1) / (b.y2 - b.y1) + b.x1 THEN 1 ELSE 0 END) % 2 = 1),
  holds AS (SELECT a.fid AS a, b.fid AS b FROM m b, e a GROUP BY a.fid, b.fid, a.x1, a.y1 HAVING sum(CASE WHEN (b.y1 > a.y1) <> (b.y2 > a.y1) AND a.x1 < (b.x2 - b.x1) * (a.y1 - b.y1) / (b.y2 - b.y1) + b.x1 THEN 1 ELSE 0 END) % 2 = 1),
  pairs AS (SELECT a, b FROM side WHERE p * q < 0 AND r * s < 0 UNION SELECT b, a FROM within UNION SELECT a, b FROM holds)"""


def _moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 4.5).alias("x"), (p["y"] + 3.75).alias("y")))
    return _triangles(spark, sf_dir).withColumn("rings", F.transform("rings", shift))


@query(f"WITH {_MEETS} SELECT a AS left_id, b AS right_id FROM pairs")
def polygon_intersects_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _triangles(spark, sf_dir).withColumnRenamed("fid", "left_id"), _moved(spark, sf_dir).withColumnRenamed("fid", "right_id")
    return vector.intersects_join(left, right, 10.0, "left_id", "right_id")


@query(f"WITH {_MEETS} SELECT n_nationkey AS fid, n_nationkey IN (SELECT a FROM pairs WHERE b % 3 = 0) AS hits_pp FROM nation")
def intersects_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which features meet any of a layer."""
    return vector.mark_intersecting(_triangles(spark, sf_dir), _moved(spark, sf_dir).where("fid % 3 = 0"), 10.0, "fid", "hits_pp")


_LON = "c_custkey * 7.5 - 3000"


@query(f"SELECT c_custkey, cast((({_LON} + 180) % 360 + 360) % 360 - 180 AS DOUBLE) AS lon FROM customer")
def normalize_lon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", crs.normalize_lon(F.expr(_LON).cast("double")).alias("lon"))


@query(f"""WITH b AS (SELECT *, ((minx + maxx) / 2 + 540) % 360 - 180 AS lon0, (miny + maxy) / 2 AS lat0 FROM ({BOXES}))
  SELECT box_id, CASE WHEN maxx - minx <= 6 THEN 'EPSG:' || cast((CASE WHEN lat0 >= 0 THEN 32600 ELSE 32700 END) + cast(floor((lon0 + 180) / 6) AS INT) + 1 AS VARCHAR)
    ELSE '+proj=aeqd +lat_0=' || printf('%.8f', lat0) || ' +lon_0=' || printf('%.8f', lon0) || ' +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs' END AS crs FROM b""")
def choose_crs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crs.choose_crs(load(spark, sf_dir, "fx_boxes"), "box_id").select("box_id", "crs")


def _grids(height: int):
    from terrascape.model import Grid

    return Grid(0, height, 1, -1, 100, height), Grid(10.3, height - 1.2, 1.5, -1.5, 50, 12)


@query(f"""WITH c AS ({CELLS}), h AS (SELECT max(row_i) + 1 AS n FROM c), t AS (SELECT cast(i AS INT) AS row_i, cast(j AS INT) AS col_j, 10.3 + (j + 0.5) * 1.5 AS x, n - 1.2 + (i + 0.5) * -1.5 AS y, n FROM range(0, 12) a(i), range(0, 50) b(j), h)
  SELECT t.row_i, t.col_j, c.pop FROM t JOIN c ON c.row_i = cast(floor((y - n) / -1) AS INT) AND c.col_j = cast(floor(x) AS INT)""")
def nearest_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load(spark, sf_dir, "fx_cells").select(*CELL, "pop")
    height = cells.agg(F.max("row_i")).first()[0] + 1
    source, target = _grids(height)
    return grid.resample(cells, source, target)


@query(f"SELECT hybas_id, pop_sum, row_number() OVER (ORDER BY pop_sum DESC, hybas_id) AS seed_rank FROM ({FOCAL})")
def seed_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.seed_ranking(load(spark, sf_dir, "fx_focal"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderstatus")
    return network.first_rows(orders, ["o_custkey"], ["o_orderkey"])


@query()
def greedy_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    focus = load(spark, sf_dir, "fx_focal").withColumn("focal_id", F.concat(F.lit("f"), (F.col("hybas_id") % 3).cast("string")))
    return network.greedy_selection(focus, 100.0)


@query()
def selection_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.selection_totals(greedy_selection(spark, sf_dir))


@query()
def erode_to_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = load(spark, sf_dir, "fx_cells").where("friction > 0 OR cond > 0").select(*CELL)
    return erode.erode_to_area(area, area.count() / 2, area.count() / 4)


@query("SELECT cast(i AS INT) AS idx, (i - 1) * 65536 AS \"offset\", greatest(0, least(65536, n - (i - 1) * 65536)) AS size FROM (SELECT cast(sum(octet_length(encode(text))) AS BIGINT) AS n FROM documents) t, range(1, 100000) r(i) WHERE i <= greatest(1, cast(ceil(n / 65536.0) AS BIGINT))")
def chunk_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of a file of all texts."""
    size = spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return chunks.ranges(spark, size, 65536)
