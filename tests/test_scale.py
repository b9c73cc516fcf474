"""What grows with the input stays in tasks: no broadcast, no driver, no whole group."""

from pyspark.sql import functions as F

from terrascape.model import Grid
from terrascape.operators import grid, hydro, masks, network, reach
from terrascape.plans import catalogue_files
from terrascape.sources import chunks
from terrascape.sources.durable import Stage
from terrascape.sources.fixtures import load


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_made_target_cells_are_not_broadcast(spark):
    cells = spark.range(400).select((F.col("id") / 20).cast("int").alias("row_i"), (F.col("id") % 20).cast("int").alias("col_j"), F.col("id").alias("pop"))
    fine, coarse = Grid(0, 0, 1, -1, 20, 20), Grid(-0.7, 0.4, 1.5, -1.5, 8, 8)
    got = grid.align_layers({"fine": (cells, fine), "coarse": (cells.where("row_i < 8 AND col_j < 8"), coarse)}, 0.8, 0.8)
    assert "Broadcast" not in plan_of(got)
    assert got.where("mask_id = 'fine'").groupBy("pop").count().count() == 400


def test_fixture_tables_are_joined_by_shuffle(spark, small):
    assert "Broadcast" not in plan_of(load(spark, small, "fx_cells"))
    assert "Broadcast" not in plan_of(load(spark, small, "fx_focal"))


def test_filling_moves_a_cell_once_to_find_the_border(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(hydro, "least_values", lambda cells, *a: seen.append(cells) or cells)
    dem = spark.range(36).select((F.col("id") / 6).cast("int").alias("row_i"), (F.col("id") % 6).cast("int").alias("col_j"), F.col("id").alias("elev"))
    hydro.fill_pits(dem.where("id <> 14"), tile=4)
    plan = plan_of(seen[0])
    assert plan.count("Exchange") == 1 and "Join" not in plan
    inner = {(r["row_i"], r["col_j"]) for r in seen[0].where("NOT closed").collect()}
    border = {(i, j) for i in range(6) for j in range(6) if i in (0, 5) or j in (0, 5)} | {(i, j) for i in (1, 2, 3) for j in (1, 2, 3)}
    assert inner == {(i, j) for i in range(6) for j in range(6)} - border


def test_written_cells_are_joined_by_shuffle(spark):
    cells = Stage(spark.range(3_000_000).select((F.col("id") / 3000).cast("int").alias("row_i"), (F.col("id") % 3000).cast("int").alias("col_j")))
    assert cells.bytes < 10 << 20  # Spark's own limit
    assert "Broadcast" not in plan_of(cells.df.join(cells.df, ["row_i", "col_j"], "left_semi"))
    few = Stage(spark.range(10).select(F.col("id").cast("int").alias("row_i")))
    assert "Broadcast" in plan_of(few.df.join(few.df.distinct(), "row_i"))


def test_masks_meet_population_by_shuffle(spark):
    pop = spark.range(50).select(F.col("id").cast("int").alias("row_i"), F.lit(0).alias("col_j"), F.col("id").alias("pop"))
    assert "Broadcast" not in plan_of(masks.mask_population(pop, pop.select("row_i", "col_j", F.lit(1).alias("m"))))


def test_lines_are_written_by_tasks(spark, small, tmp_path, monkeypatch):
    def no_rows(*_):
        raise AssertionError("lines pass the driver")

    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", no_rows)
    assert catalogue_files.chunk_digests(spark, small).count() == 1
    lines = spark.range(5000).repartition(7).select(F.col("id").alias("k"), F.concat(F.lit("zeile é "), F.col("id").cast("string")).alias("line"))
    path = chunks.write_lines(lines, "k", tmp_path / "whole.txt")
    assert path.read_bytes() == "".join(f"zeile é {i}\n" for i in range(5000)).encode()
    assert chunks.write_lines(lines.where("k < 0"), "k", tmp_path / "none.txt").read_bytes() == b""


def test_selection_holds_numbers_only(spark):
    rows = [("a", 1, 0, 5, False, 2), ("a", 2, 1, 9, True, 3), ("a", 3, 1, 9, None, 1), ("a", 4, 3, None, True, None), ("a", 5, None, 1, True, 4), ("a", 5, None, 1, True, 4)]
    focus = spark.createDataFrame(rows, "focal_id string, hybas_id long, next_down long, pop_sum long, hits_pp boolean, pp_area_ha long").withColumn("outline", F.lit("polygon"))
    got = network.greedy_selection(focus, 7.0)
    plan = plan_of(got)
    assert "FlatMapGroupsInArrow" in plan and "outline" not in plan.split("Exchange")[0]
    assert [tuple(r)[1:] for r in got.orderBy("step").collect()] == [(0, 2, True, 9, 3.0), (1, 3, False, 9, 0.0), (2, 4, False, None, 0.0), (3, 1, False, 5, 0.0), (4, 5, True, 1, 4.0)]


def test_rounds_and_accumulation_move_tiles_not_cells(spark, monkeypatch):
    written = []

    class Counted(Stage):
        def __init__(self, df, partition_by=None):
            super().__init__(df, partition_by)
            written.append(self.df.count())

    rows = [(i, j, i * 7 % 5 + j * 11 % 4 + abs(j - 9)) for i in range(36) for j in range(20) if (i, j) != (17, 4)]
    dem = spark.createDataFrame(rows, "row_i int, col_j int, elev long")
    alone = hydro.fill_pits(dem, plan="group")
    monkeypatch.setattr(reach, "Stage", Counted)
    filled = hydro.fill_pits(dem, plan="tiles", tile=12)
    assert not filled.exceptAll(alone).count() and filled.count() == len(rows)
    assert max(written[:-1]) <= 6 * (2 + 8) and written[-1] == len(rows)
    weights = dem.selectExpr("row_i", "col_j", "row_i % 3 + 1 AS w").unionByName(spark.createDataFrame([(99, 99, 5), (0, 0, 2)], dem.schema).withColumnRenamed("elev", "w"))
    want = {(r.row_i, r.col_j): r.acc for r in hydro.accumulate(hydro.flow_shares(hydro.flow_edges(filled)), weights).collect()}
    written.clear()
    monkeypatch.setattr(hydro, "Stage", Counted)
    monkeypatch.setattr(hydro, "flow_shares", None)
    got = {(r.row_i, r.col_j): r.acc for r in hydro.flow_accumulation(filled, weights, flow_tile=8).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and got[99, 99] == 5
