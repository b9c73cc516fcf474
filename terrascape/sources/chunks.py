"""Large files in zipped parts with a manifest, and their reassembly.

Byte ranges are dealt to tasks; each task streams its range, so files must lie where
all executors read and write (a shared file system).
"""

from __future__ import annotations

import hashlib
import json
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.functions.scalars import part_count
from terrascape.sources.durable import Stage

BUFFER = 1 << 20
# Names of a manifest's keys, its mode, and the parts' names.
SCHEMA = "idx int, offset bigint, size bigint, zip_filename string, member_name string, compressed_size bigint, sha256 string"


def ranges(spark: SparkSession, size: int, chunk: int) -> DataFrame:
    """``idx`` (from 1), ``offset``, ``size`` of the parts of a file of so many bytes."""
    n = part_count(size, chunk)
    return spark.range(1, n + 1, numPartitions=min(n, 1000)).selectExpr("cast(id AS int) AS idx", f"(id - 1) * {chunk} AS offset", f"greatest(0, least({chunk}, {size} - (id - 1) * {chunk})) AS size")


def file_sha256(path: str | Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(BUFFER):
            h.update(block)
    return h.hexdigest()


def write_lines(lines: DataFrame, order: str, path: str | Path) -> Path:
    """Write the column ``line`` to one file, by ``order``.  Rows are dealt by range, and
    each task writes its range where those before it end: the driver sees a size for
    each range, no line."""
    path = Path(path).resolve()
    path.parent.mkdir(parents=True, exist_ok=True)
    target, spark = str(path), lines.sparkSession
    dealt = Stage(lines.select(F.col(order).alias("k"), "line").repartitionByRange("k").withColumn("part", F.spark_partition_id()), partition_by="part")
    sizes = dealt.df.groupBy("part").agg(F.sum(F.octet_length(F.coalesce("line", F.lit(""))) + 1).alias("size")).orderBy("part").collect()  # a row a range
    begin, starts = 0, []
    for r in sizes:
        starts.append((r["part"], begin))
        begin += r["size"]
    with open(path, "wb") as whole:
        whole.truncate(begin)

    def run(batches):
        at: dict[int, int] = {}  # a task holds whole ranges, each in order
        with open(target, "r+b") as whole:
            for d in batches:
                for (part, start), rows in d.groupby(["part", "start"], sort=False):
                    data = "".join(f"{line or ''}\n" for line in rows["line"]).encode()
                    whole.seek(at.get(part, start))
                    whole.write(data)
                    at[part] = whole.tell()
        yield pd.DataFrame({"part": list(at), "stop": list(at.values())}).astype("int64")

    known = spark.createDataFrame(starts, "part int, start long")
    sorted_ = dealt.df.join(F.broadcast(known), "part").repartition("part").sortWithinPartitions("part", "k").select("part", "start", "line")
    stops = sorted_.mapInPandas(run, "part long, stop long").agg(F.max("stop").alias("stop")).first()["stop"]
    dealt.drop()
    if (stops or 0) != begin:
        raise ValueError(f"{path}: {stops} bytes were written of {begin}")
    return path


def split_file(spark: SparkSession, source: str | Path, folder: str | Path, chunk: int, prefix: str | None = None, manifest_name: str | None = None) -> Path:
    """Write the parts in parallel, then the manifest; returns its path."""
    source, folder = Path(source).resolve(), Path(folder).resolve()
    folder.mkdir(parents=True, exist_ok=True)
    prefix = prefix or source.stem
    size = source.stat().st_size
    origin, target = str(source), str(folder)

    def run(batches):
        for d in batches:
            made = []
            for idx, offset, n in d[["idx", "offset", "size"]].itertuples(index=False):
                name = f"{prefix}.part{idx:06d}"
                h, todo = hashlib.sha256(), int(n)
                path = Path(target, f"{name}.zip")
                with open(origin, "rb") as f, zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open(f"{name}.bin", "w", force_zip64=True) as out:
                    f.seek(int(offset))
                    while todo and (block := f.read(min(BUFFER, todo))):
                        h.update(block)
                        out.write(block)
                        todo -= len(block)
                with zipfile.ZipFile(path) as z:
                    packed = z.getinfo(f"{name}.bin").compress_size
                made.append((f"{name}.zip", f"{name}.bin", packed, h.hexdigest()))
            yield d.assign(**{c: [m[k] for m in made] for k, c in enumerate(("zip_filename", "member_name", "compressed_size", "sha256"))})

    parts = ranges(spark, size, chunk).mapInPandas(run, SCHEMA).orderBy("idx").collect()  # a row a part
    manifest = {
        "schema_version": 2,
        "mode": "zip_per_chunk",
        "original_filename": source.name,
        "original_size": size,
        "original_sha256": file_sha256(source),
        "chunk_size": chunk,
        "total_parts": len(parts),
        "zip_compression": "DEFLATED",
        "parts": [{"zip_filename": p["zip_filename"], "member_name": p["member_name"], "raw_size": p["size"], "compressed_size": p["compressed_size"], "raw_sha256": p["sha256"]} for p in parts],
    }
    path = folder / (manifest_name or f"{prefix}.manifest.json")
    path.write_text(json.dumps(manifest, indent=2), encoding="utf-8")
    return path


def join_file(manifest: str | Path, out: str | Path | None = None, verify: bool = True) -> Path:
    """Concatenate the parts in the manifest's order; with ``verify`` each part's and
    the whole's size and digest must be those of the manifest."""
    manifest = Path(manifest)
    told = json.loads(manifest.read_text(encoding="utf-8"))
    out = Path(out) if out is not None else manifest.parent / told["original_filename"]
    out.parent.mkdir(parents=True, exist_ok=True)
    lost = [p["zip_filename"] for p in told["parts"] if not (manifest.parent / p["zip_filename"]).exists()]
    if lost:
        raise FileNotFoundError(f"parts are missing: {', '.join(lost)}")
    whole, size = hashlib.sha256(), 0
    with open(out, "wb") as f:
        for p in told["parts"]:
            h = hashlib.sha256()
            with zipfile.ZipFile(manifest.parent / p["zip_filename"]) as z:
                if p["member_name"] not in z.namelist():
                    raise FileNotFoundError(f"{p['zip_filename']} has no member {p['member_name']}")
                with z.open(p["member_name"]) as part:
                    while block := part.read(BUFFER):
                        f.write(block)
                        h.update(block)
                        whole.update(block)
                        size += len(block)
            if verify and h.hexdigest() != p["raw_sha256"]:
                raise ValueError(f"{p['zip_filename']}: digest differs from the manifest's")
    if verify and (size != told["original_size"] or whole.hexdigest() != told["original_sha256"]):
        raise ValueError("the joined file's size or digest differs from the manifest's")
    return out
