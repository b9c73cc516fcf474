"""Reading and writing rasters, vector layers and results.

A raster on disk is a folder of Parquet tiles partitioned by ``raster_id`` with a
header table beside it; a vector layer is Parquet with rings and box columns, so a box
filter reaches the scan as row-group statistics.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.model import HEADERS, TILE, Grid, require
from terrascape.operators import grid as grids
from terrascape.operators import vector


def write_raster(cells: DataFrame, grid: Grid, path: str, raster_id: str, value: str = "v", tile: int = TILE, nodata: float | None = None) -> None:
    """Tiles and header of one raster; other rasters under ``path`` stay.  The header
    keeps the values' type and ``nodata``, cells of which are missing in the tiles."""
    kind = cells.schema[value].dataType.simpleString()
    if nodata is not None:
        cells = cells.where(F.col(value).isNull() | (F.col(value).cast("double") != float(nodata)))
    tiles = grids.to_tiles(cells, value, tile).withColumn("raster_id", F.lit(raster_id))
    tiles.write.mode("append").partitionBy("raster_id").parquet(f"{path}/tiles")
    row = (raster_id, *map(float, (grid.x0, grid.y0, grid.dx, grid.dy)), grid.width, grid.height, None if nodata is None else float(nodata), grid.crs, kind)
    cells.sparkSession.createDataFrame([row], HEADERS).coalesce(1).write.mode("append").parquet(f"{path}/headers")


def read_raster(spark: SparkSession, path: str, raster_id: str, tile: int = TILE, bounds=None) -> tuple[DataFrame, Grid]:
    """Cells, of the type that was written, and grid; with ``bounds`` only the tiles that
    meet them are read."""
    h = spark.read.schema(HEADERS).parquet(f"{path}/headers").where(F.col("raster_id") == raster_id).first()
    if h is None:
        raise FileNotFoundError(f"no raster {raster_id!r} under {path}")
    grid = Grid(h["x0"], h["y0"], h["dx"], h["dy"], h["width"], h["height"], h["crs"])
    tiles = spark.read.parquet(f"{path}/tiles").where(F.col("raster_id") == raster_id)
    typed = lambda cells: cells.withColumn("v", F.col("v").cast(h["dtype"] or "double"))
    if bounds is None:
        return typed(grids.from_tiles(tiles, tile)), grid
    r0, r1, c0, c1 = grids.window(grid, bounds)
    tiles = tiles.where(F.col("trow").between(r0 // tile, r1 // tile) & F.col("tcol").between(c0 // tile, c1 // tile))
    return typed(grids.clip(grids.from_tiles(tiles, tile), (r0, r1), (c0, c1))), grid


def raster_header(spark: SparkSession, path: str, raster_id: str) -> dict:
    """The header of a raster: its grid, ``nodata`` and ``dtype``."""
    found = spark.read.schema(HEADERS).parquet(f"{path}/headers").where(F.col("raster_id") == raster_id).first()
    if found is None:
        raise FileNotFoundError(f"no raster {raster_id!r} under {path}")
    return found.asDict()


def open_raster(spark: SparkSession, path: str, bounds=None) -> tuple[DataFrame, Grid]:
    """Cells and grid of the only raster under ``path``."""
    ids = [r["raster_id"] for r in spark.read.schema(HEADERS).parquet(f"{path}/headers").select("raster_id").limit(2).collect()]
    if len(ids) != 1:
        raise ValueError(f"{path} holds {'no' if not ids else 'more than one'} raster")
    return read_raster(spark, path, ids[0], bounds=bounds)


def matching(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Paths that match the patterns, wherever Spark reads them, each once, sorted."""
    found = set()
    for pattern in patterns:
        place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        for status in place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place) or []:
            found.add(status.getPath().toString())
    return sorted(found)


def write_features(features: DataFrame, path: str, key: str = "fid") -> None:
    features.join(vector.boxes(features, [key]), key, "left").write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str | list[str], bounds=None, columns: list[str] | None = None, fields: list[str] | None = None) -> DataFrame:
    """Features, of the given columns, whose box meets ``bounds``; ``fields`` must exist."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if fields:
        require(df, fields, str(path))
    if bounds is not None:
        minx, miny, maxx, maxy = bounds
        df = df.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
    return df.select(*columns) if columns else df


def areas(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Areas of interest: a file's features under its stem as ``aoi_id``; a stem that
    two files have, or no file at all, is an error."""
    stems = [p.rstrip("/").rsplit("/", 1)[-1].split(".")[0] for p in paths]
    if not stems:
        raise FileNotFoundError("no file matches the area patterns")
    twice = sorted({s for s in stems if stems.count(s) > 1})
    if twice:
        raise ValueError(f"areas share a name: {', '.join(twice)}")
    out = None
    for stem, path in zip(stems, paths):
        one = spark.read.parquet(path).withColumn("aoi_id", F.lit(stem))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def write_result(table: DataFrame, folder: str, run_name: str, now: datetime | None = None) -> str:
    """One CSV named by run and time; a row an area."""
    path = f"{folder}/{run_name}_{(now or datetime.now()):%Y_%m_%d_%H_%M_%S}.csv"
    table.coalesce(1).write.option("header", True).csv(path)
    return path


def write_partitions(members: DataFrame, path: str) -> None:
    """One folder for each terminal sink (below one for each area, where members have
    ``aoi_id``)."""
    by = [c for c in ("aoi_id", "next_sink") if c in members.columns]
    members.write.mode("overwrite").partitionBy(*by).parquet(path)
