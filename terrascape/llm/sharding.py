"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard is a function of its key and the shard count alone, computed without
a ring table; with one more shard a row either stays or goes to the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the parts into which a shard's rows are dealt to number them.
PART_ROWS = 20_000


def jump(key: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to shards - 1) of each unsigned 64-bit key."""
    key = key.astype(np.uint64)
    found, ahead = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        found[live] = ahead[live]
        ahead[live] = np.minimum((found[live] + 1) * (2.0**31 / ((k >> np.uint64(33)).astype(np.float64) + 1)), 2.0**62).astype(np.int64)
        live = live[ahead[live] < shards]
    return found


def stable_key(column) -> F.Column:
    """60 bits of the MD5 of the key's text; null counts as its own key."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("\0null"))), 1, 15), 16, 10).cast("long")


def shard_of(column, shards: int) -> F.Column:
    """Shard of a key column, for a fixed number of shards."""

    @F.pandas_udf(T.IntegerType())
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return run(stable_key(column))


def assign(rows: DataFrame, key: str = "doc_id", shards: int = 40, order: list[str] | None = None) -> DataFrame:
    """Add ``law`` ('key'), ``shard``, ``grown_shard`` (with one more shard) and
    ``slot`` (gapless from 0 in the shard) to the rows.

    Equal keys share a shard, whatever else the rows hold; a null key is a key of its
    own; repeated rows get a slot each.  Slots follow a hash of the row, then
    ``order`` (default: all columns).  A shard is numbered in parts of about PART_ROWS
    rows, as many as the rows ask for, whose sizes are added up first; so no task sees a
    whole shard.  Columns named as the results are replaced; no other name clashes.
    """
    rows = rows.drop("law", "shard", "grown_shard", "slot")  # results replace columns of their names
    order = order or rows.columns
    parts = max(1, -(-rows.count() // (shards * PART_ROWS)))
    column = F.col(f"`{key}`")
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    both = rows.select(whole, shard_of(column, shards).alias("shard"), shard_of(column, shards + 1).alias("grown_shard"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(parts)).alias("part"))
    sizes = both.groupBy("shard", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy(*[F.col(f"row.`{c}`") for c in order])
    placed = both.withColumn("number", F.row_number().over(inside) - 1).join(offsets, ["shard", "part"])
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in rows.columns], F.lit("key").alias("law"), "shard", (F.col("number") + F.col("offset")).cast("long").alias("slot"), "grown_shard")
