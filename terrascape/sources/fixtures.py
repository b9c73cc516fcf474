"""Rasters, networks and areas derived from the star-schema tables, as SQL that Spark
and DuckDB both read; each is a table expression over the directory's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CELLS = """SELECT cast(floor(e.event_id / 100) AS INT) AS row_i, cast(e.event_id % 100 AS INT) AS col_j,
  CASE WHEN e.event_id % 53 = 0 THEN cast(-9999 AS BIGINT) ELSE cast(floor(e.value) AS BIGINT) END AS pop,
  CASE WHEN e.event_id % 17 = 0 THEN cast(0 AS FLOAT) ELSE cast(1 + e.event_id % 7 AS FLOAT) END AS friction,
  CASE WHEN e.event_id % 41 = 0 THEN NULL ELSE o.o_totalprice - 400000 END AS cond, e.event_id % 1009 = 0 AS source
  FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id"""
EDGES = """SELECT c_custkey + 1 AS hybas_id,
  CASE WHEN c_custkey + 1 <= 8 THEN cast(0 AS BIGINT) ELSE cast(floor((c_custkey + 1) / 2) AS BIGINT) END AS next_down FROM customer"""
AOI = """SELECT n_name AS aoi_id, cast(n_nationkey % 5 AS INT) * 20 + 5 AS col_lo, cast(n_nationkey % 5 AS INT) * 20 + 8 AS col_hi,
  cast(floor(n_nationkey / 5) AS INT) * 2 AS row_lo, cast(floor(n_nationkey / 5) AS INT) * 2 + 1 AS row_hi FROM nation"""
DEM = """SELECT cast(floor(o_orderkey / 100) AS INT) AS row_i, cast(o_orderkey % 100 AS INT) AS col_j,
  cast(floor(o_totalprice / 10000) AS BIGINT) + 3 * (100 - cast(o_orderkey % 100 AS BIGINT)) AS elev FROM orders"""
FOCAL = f"""SELECT hybas_id, next_down, cast(floor(c_acctbal) AS BIGINT) + 1000 AS pop_sum, hybas_id % 13 = 0 AS hits_pp,
  cast(1 + hybas_id % 5 AS BIGINT) AS pp_area_ha FROM ({EDGES}) JOIN customer ON c_custkey + 1 = hybas_id"""
#: A box of degrees for each supplier, and a polygon (with a notch) for each nation.
BOXES = """SELECT s_suppkey AS box_id, cast(s_suppkey * 37 % 360 AS DOUBLE) - 180 AS minx, cast(s_suppkey * 17 % 160 AS DOUBLE) - 80 AS miny,
  cast(s_suppkey * 37 % 360 AS DOUBLE) - 180 + 1 + s_suppkey % 7 AS maxx, cast(s_suppkey * 17 % 160 AS DOUBLE) - 80 + 1 + s_suppkey % 5 AS maxy FROM supplier"""
TABLES = {"fx_cells": CELLS, "fx_edges": EDGES, "fx_aoi": AOI, "fx_dem": DEM, "fx_focal": FOCAL, "fx_boxes": BOXES}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture over the tables of a directory, without registering global views.
    Tables that grow are joined by shuffles: read for few columns, many rows seem small
    enough for a broadcast."""
    sql, tables = TABLES[name], {}
    for t in ("events", "orders", "customer", "nation", "supplier"):
        if f"FROM {t}" in sql or f"JOIN {t}" in sql:
            rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            tables[t] = rows.hint("merge") if t in ("events", "orders", "customer") else rows
            sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **tables)
