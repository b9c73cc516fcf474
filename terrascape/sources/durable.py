"""Cutting lineage in iterative operators: tables in the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a written table that may be broadcast.  Cells take a byte or two on disk and
#: many times that in memory, so Spark's own limit would let millions of rows through.
SMALL = 256 << 10


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a local folder of this session, but
    only for a local master: executors elsewhere could not read it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("terrascape.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="terrascape-")
        spark.conf.set("terrascape.shared.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a written table, wherever Spark wrote it."""
    with contextlib.suppress(Exception):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def written_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a written table, wherever Spark wrote it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(place).getLength()


class Stage:
    """A durable table: ``df`` reads what was written; ``drop()`` deletes it.  Beyond
    SMALL bytes, joins shuffle it."""

    def __init__(self, df: DataFrame, partition_by: str | None = None) -> None:
        self.path = f"{shared_dir(df.sparkSession)}/terrascape-{uuid.uuid4().hex}"
        df.write.parquet(self.path, partitionBy=partition_by)
        self.bytes = written_bytes(df.sparkSession, self.path)
        rows = df.sparkSession.read.schema(df.schema).parquet(self.path)
        self.df = rows if self.bytes <= SMALL else rows.hint("merge")

    def drop(self) -> None:
        delete(self.df.sparkSession, self.path)


class Growing:
    """A durable table that grows by rounds: ``front`` is the last part, ``df`` reads
    all parts; a round writes its own rows only."""

    def __init__(self, first: DataFrame) -> None:
        stage = Stage(first)
        self.paths, self.schema, self.front, self.sizes = [stage.path], first.schema, stage.df, [stage.bytes]

    def add(self, rows: DataFrame) -> None:
        stage = Stage(rows.select(*self.schema.names))
        self.paths.append(stage.path)
        self.sizes.append(stage.bytes)
        self.front = stage.df

    @property
    def df(self) -> DataFrame:
        rows = self.front.sparkSession.read.schema(self.schema).parquet(*self.paths)
        return rows if sum(self.sizes) <= SMALL else rows.hint("merge")

    @property
    def beside(self) -> DataFrame:
        """The last part, to be joined with a large table: that stays where it is while
        the part is small."""
        return F.broadcast(self.front) if self.sizes[-1] <= SMALL else self.front

    def drop(self) -> None:
        """Delete all parts."""
        for path in self.paths:
            delete(self.front.sparkSession, path)

    def settle(self) -> DataFrame:
        """All rows as one durable table; the parts are deleted."""
        whole = Stage(self.df).df
        self.drop()
        return whole
