"""Plumbing that the training-data operators share: table reading, durable
intermediate tables, bounded Arrow batches and distributed components.

Lineage is cut with Parquet tables in the folder that ``spark.checkpoint.dir``
names, which every executor can read, so a lost executor costs a re-read only.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from terrascape.sources.durable import shared_dir

#: Rows and text bytes that one Python step of an Arrow batch holds at most
#: (a single longer text is a step of its own).
STEP_ROWS, STEP_BYTES = 512, 2 << 20
#: Bits of a bitmap of keys: 4 MiB at any size of the input; a full one only filters less.
FILTER_BITS = 1 << 25
#: Edges that a task joins at once: its memory.
EDGES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory, by a path that Spark's reader opens."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/terrascape-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._terrascape_path = path
    return out


def size_of(df: DataFrame) -> int:
    """The planner's estimate of a frame's bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_for(df: DataFrame, size: int = 64 << 20) -> int:
    """Partitions of about ``size`` bytes for a frame that travels whole: by the
    planner's estimate of its size, and no fewer than the session's shuffles have."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    estimate = size_of(df)
    return max(1, most, min(1_000_000, -(-estimate // size)) if estimate < 1 << 60 else 0)


def discard(*tables: DataFrame) -> None:
    """Delete durable tables that no later plan reads."""
    for df in tables:
        with contextlib.suppress(Exception):
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(df._terrascape_path)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Scratch(list):
    """Durable tables of one computation, deleted together when its result is written."""

    def keep(self, df: DataFrame) -> DataFrame:
        self.append(durable(df))
        return self[-1]

    def table(self, written: DataFrame) -> DataFrame:
        """A table that is durable already, to be deleted with the others."""
        self.append(written)
        return written

    def result(self, df: DataFrame) -> DataFrame:
        out = durable(df)
        discard(*self)
        return out


def steps(batch: pa.RecordBatch, text: int) -> Iterator[list[list]]:
    """The columns of a batch as Python lists, a bounded step at a time.
    ``text``: index of the column whose bytes bound the step."""
    column, at, n = batch.column(text), 0, batch.num_rows
    sizes = pc.binary_length(column).fill_null(0).to_pylist()
    while at < n:
        end, size = at, 0
        while end < n and end - at < STEP_ROWS and (end == at or size + sizes[end] <= STEP_BYTES):
            size += sizes[end]
            end += 1
        yield [c.slice(at, end - at).to_pylist() for c in batch.columns]
        at = end


def map_text(df: DataFrame, columns: list[str], schema: T.StructType, make: Callable[[], Callable[[list[list]], list[list]]]) -> DataFrame:
    """Apply a Python function to ``columns`` (the last one the text), a step at a
    time.  ``make()`` runs once a task and returns the function: input columns as
    lists in, output columns as lists out."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        function = make()
        for batch in batches:
            for step in steps(batch, len(columns) - 1):
                out = function(step)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, arrow)], schema=arrow)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def filter_text(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of ``df``, whole, for whose text a Python function says so; no join, no
    exchange.  ``make()`` runs once a task."""

    def run(batches):
        keep = make()
        for batch in batches:
            text = batch.select([text_col])
            said = [k for step in steps(text, 0) for k in keep(step[0])]
            yield batch.filter(pa.array(said, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def marks(keys: DataFrame) -> bytes:
    """A bitmap of fixed size with a bit set for each of the (text) keys in the only
    column of ``keys``."""

    def mark(batches):
        own = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = np.array([_slot(k) for k in batch.column(0).to_pylist()], np.int64)
            np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        full = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(own[full].astype(np.int16))], ["at", "bits"])

    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    parts = keys.mapInArrow(mark, "at int, bits short").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    for r in parts.toLocalIterator():  # at most FILTER_BITS / 8 rows, whatever the input
        bits[r["at"]] = r["bits"]
    return bits.tobytes()


def _slot(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key) % FILTER_BITS


def marked(held: bytes, key: str) -> bool:
    at = _slot(key)
    return bool(held[at >> 3] >> (at & 7) & 1)


def rows_of(df: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` (long) and ``text`` of the rows whose id is in the only column of ``ids``;
    null ids are out, null texts count as empty.

    A bitmap keeps most other rows from travelling; where it is full (it does not grow)
    the exact join that follows still lets no other row through."""
    held = marks(ids.select(F.col(ids.columns[0]).cast("string")))
    sent = df.sparkSession.sparkContext.broadcast(held)

    def make():
        def run(step):
            found = [(i, t or "") for i, t in zip(*step) if i is not None and marked(sent.value, str(i))]
            return [[i for i, _ in found], [t for _, t in found]]

        return run

    d = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    few = map_text(d, ["id", "text"], schema("id long, text string"), make)
    return few.join(ids.select(F.col(ids.columns[0]).alias("id")), "id", "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (bigint): a durable table ``node,
    component`` with the smallest node of the component, for nodes that have an edge.

    First every partition of the edges, dealt by range, joins its own edges, which
    leaves a root for each node there; where a node has several roots these are the
    edges of a graph of roots, nearly always a tiny one.  That one is contracted in
    rounds: every node hooks to its smallest neighbour, pointer jumping flattens the
    hooks, and edges are renamed until none joins two roots; a round at least halves
    the roots of a component.  All state stays in tables; a partition is bounded by
    the exchange, and hubs meet only as partial minima.  Dealing by range reads the
    edges twice, so they are best a durable table.
    """
    fields = pa.schema([("n", pa.int64()), ("r", pa.int64())])

    def join_own(batches):
        root: dict[int, int] = {}

        def find(n):
            while (r := root.setdefault(n, n)) != n:
                root[n] = root[r]
                n = root[n]
            return n

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (x := find(a)) != (y := find(b)):
                    root[max(x, y)] = min(x, y)
        nodes = list(root)
        for at in range(0, len(nodes), 50_000):
            part = nodes[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(n) for n in part], pa.int64())], schema=fields)

    edges = edges.where("a <> b").select("a", "b")
    parts = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-edges.count() // EDGES))
    stars = durable(edges.repartitionByRange(parts, "a", "b").mapInArrow(join_own, "n long, r long"))
    roots = stars.groupBy("n").agg(F.min("r").alias("p"))
    several = stars.groupBy("n").agg(F.min("r").alias("p"), F.max("r").alias("q")).where("p <> q").select("n", "p")
    between = stars.join(several, "n").where("r <> p").select(F.col("p").alias("a"), F.col("r").alias("b"))
    upper = _contract(between)
    if upper is None:
        out = durable(roots.select(F.col("n").alias("node"), F.col("p").alias("component")))
    else:
        named = roots.join(upper.select(F.col("n").alias("p"), F.col("p").alias("top")), "p", "left")
        out = durable(named.select(F.col("n").alias("node"), F.coalesce("top", "p").alias("component")))
        discard(upper)
    discard(stars)
    return out


def _contract(edges: DataFrame) -> DataFrame | None:
    """``n, p``: the smallest node of the component of each node; None without edges."""
    live = durable(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels, old = None, []
    while not live.isEmpty():
        both = live.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(live.select(F.col("b").alias("n"), F.col("a").alias("m")))
        hooks = durable(both.groupBy("n").agg(F.least("n", F.min("m")).alias("p")))
        while True:  # pointer jumping: p becomes p's p, until nothing moves
            up = hooks.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            jumped = durable(hooks.join(up, "p").select("n", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            discard(hooks)
            hooks = jumped.select("n", "p")
            hooks._terrascape_path = jumped._terrascape_path
            if not moved:
                break
        if labels is None:
            labels = hooks
        else:
            step = hooks.select(F.col("n").alias("p"), F.col("p").alias("q"))
            new = durable(labels.join(step, "p", "left").select("n", F.coalesce("q", "p").alias("p")))
            old += [labels, hooks]
            labels = new
        a, b = hooks.select(F.col("n").alias("a"), F.col("p").alias("ra")), hooks.select(F.col("n").alias("b"), F.col("p").alias("rb"))
        new = durable(live.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        discard(live)
        live = new
    discard(live, *old)
    return labels


def crc_sql(e: str) -> str:
    """DuckDB SQL for the CRC-32 of an ASCII text, bit by bit."""
    bits = f"list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({e}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])))"
    return f"xor(list_reduce({bits}, lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
