"""A Merkle manifest of a dataset: a tree of digests for each group of rows, a tree over
the groups, proofs for every row and their verification.

Leaves are dealt by range of (group, order), so a task holds a stretch of a group, and
their places in the group are numbered from the ranges' counts.  Digests then move as
events: a partial parent gathers the digests of its children by their place, the size of
the group tells how many it waits for, and once these are there it becomes a digest
itself and goes to its own parent.  A task resolves nearly all parents of its stretch;
children of parents that it can't complete, the frontier, are dealt anew by the subtree
of ``8 ** (BAND * round)`` leaves that holds them, until each group has one node left.

Completed parents leave links (their children's digests).  Read from the top down, a
band of BAND levels at a time, the links give every node the siblings on its way to the
root; the last band meets the leaves and yields their proofs.

No task holds more than a subtree of ``8 ** BAND`` nodes and their links; rounds are the
logarithm of the largest group over BAND.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascape.llm.common import Scratch, crc_sql, parts_for

#: Children of a full node; levels that a task resolves at once.
FANOUT, BAND = 8, 3
SHIFT = 3  # log2 of FANOUT
#: Digests of unresolved parents that a task holds before it passes them on.
OPEN = 100_000
NODES = "kind int, g string, n long, level int, idx long, data binary"
LINK, TOP, FRONTIER = 0, 1, 2
STEP = 4096


def canonical(columns: list[Column]) -> Column:
    """One text for several values: each ``-`` if null, else its UTF-8 byte count, a
    colon and the value (numbers as decimals)."""
    shown = [c.cast("string") for c in columns]
    return F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in shown])


def digest(columns: list[Column]) -> Column:
    """SHA-256 (binary) of several values."""
    return F.unhex(F.sha2(canonical(columns).cast("binary"), 256))


def joined(digests: list[bytes]) -> bytes:
    """The digest of nodes in order: SHA-256 of their hex texts."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _split(data: bytes) -> list[bytes]:
    return [data[k : k + 32] for k in range(0, len(data), 32)]


def _out(rows: list[tuple], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), STEP):
        part = zip(*rows[at : at + STEP])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, shape.types)], schema=shape)


_NODES = pa.schema([("kind", pa.int32()), ("g", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("data", pa.binary())])


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes ``g, n, level, idx, data`` in any order: parents that are complete become
    links, the last node of a group its top; children whose parents are not complete
    here stay the frontier."""
    waiting: dict[tuple, dict[int, bytes]] = {}
    held = 0
    for batch in batches:
        found: list[tuple] = []
        for g, n, level, idx, data in zip(*(c.to_pylist() for c in batch.columns)):
            while True:
                count = -(-n // FANOUT**level)
                if count == 1:
                    found.append((TOP, g, n, level, idx, data))
                    break
                parent, at = divmod(idx, FANOUT)
                key = (g, n, level, parent)
                partial = waiting.setdefault(key, {})
                partial[at] = data
                held += 1
                arity = min(FANOUT, count - FANOUT * parent)
                if len(partial) < arity:
                    break
                del waiting[key]
                held -= arity
                children = [partial[k] for k in range(arity)]
                level, idx, data = level + 1, parent, joined(children)
                found.append((LINK, g, n, level, idx, b"".join(children)))
        if held > OPEN:
            found += _rest(waiting)
            waiting, held = {}, 0
        yield from _out(found, _NODES)
    yield from _out(_rest(waiting), _NODES)


def _rest(waiting: dict) -> list[tuple]:
    return [(FRONTIER, g, n, level, parent * FANOUT + at, data) for (g, n, level, parent), held in waiting.items() for at, data in held.items()]


def number(scratch: Scratch, rows: DataFrame, order: list[str]) -> DataFrame:
    """The durable ``rows`` with ``pos``, from 0 without gaps in the group ``g``, and
    ``n``, the group's rows.  A group is dealt by range of ``order`` too, so one that
    holds most rows shares out; ``order`` ends with a column that tells equal rows apart."""
    key = ["g", *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(parts_for(rows), *key).sortWithinPartitions(*key)
    placed = scratch.keep(dealt.withColumn("at", F.monotonically_increasing_id()))  # part << 33, then the row there
    part = F.shiftright("at", 33).alias("part")
    counts = placed.groupBy("g", part).agg(F.min("at").alias("first"), F.count("*").alias("rows"))  # ranges + groups rows
    every = Window.partitionBy("g")
    before = F.sum("rows").over(every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(every).alias("n"))
    met = placed.withColumn("part", part).join(offsets, ["g", "part"])
    return scratch.keep(met.withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop("part", "at", "first", "before"))


@dataclass
class Tree:
    """Numbered leaves ``g, pos, n, leaf, ...``, links and tops (``g, data``) of all groups."""

    leaves: DataFrame
    links: DataFrame
    tops: DataFrame
    levels: int


def grow(scratch: Scratch, rows: DataFrame, order: list[str]) -> Tree:
    """The trees of the groups ``g`` of ``rows`` (``g, leaf`` and columns to order by)."""
    leaves = number(scratch, rows, order)
    levels = height(leaves.agg(F.max("n")).first()[0] or 0)
    start = leaves.select("g", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("data"))
    made = [scratch.keep(start.sortWithinPartitions("g", "idx").mapInArrow(combine, NODES))]
    for k in range(1, -(-levels // BAND) + 1):
        left = made[-1].where(f"kind = {FRONTIER}").drop("kind")
        if left.isEmpty():
            break
        block = F.expr(f"shiftright(shiftleft(idx, {SHIFT} * level), {SHIFT * BAND * k})")
        made.append(scratch.keep(left.repartition("g", block).mapInArrow(combine, NODES)))
    every = made[0]
    for m in made[1:]:
        every = every.unionByName(m)
    return Tree(leaves, every.where(f"kind = {LINK}").drop("kind"), every.where(f"kind = {TOP}").select("g", "n", "data"), levels)


def _entry(children: list[bytes], at: int) -> bytes:
    """A step of a proof: place in the run, size of the run, the others' digests."""
    return bytes([at, len(children)]) + b"".join(children[:at] + children[at + 1 :])


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The place and the siblings on each level of a packed path."""
    at = 0
    while at < len(path):
        place, size = path[at], path[at + 1]
        end = at + 2 + 32 * (size - 1)
        yield place, _split(path[at + 2 : end])
        at = end


def fold(start: bytes, path: bytes) -> bytes:
    """The root that a digest and the siblings on its path give."""
    for place, others in steps(path):
        start = joined([*others[:place], start, *others[place:]])
    return start


def siblings(path: bytes) -> bytes:
    """The hex texts of all siblings of a path, level by level."""
    return b"".join(d for _, others in steps(path) for d in others).hex().encode()


def _descend(tree: Tree, above: DataFrame, band: int, leaves: DataFrame | None, finish, ddl: str, shape: pa.Schema) -> DataFrame:
    """Paths through one band of levels.  ``above``: ``g, block, path`` of the subtrees'
    tops.  ``finish(nodes)`` makes result rows from ``(leaf row or node, path)`` pairs."""
    low, high = band * BAND, (band + 1) * BAND
    links = tree.links.where(f"level > {low} AND level <= {high}")
    block = F.expr(f"shiftright(idx, {SHIFT} * ({high} - level))")
    nothing = F.lit(None).cast("long")
    none = F.lit(None).cast("binary")
    rows = above.select("g", "block", F.lit(99).alias("level"), F.lit(0).cast("long").alias("idx"), "n", F.col("path").alias("data"), none.alias("other"), nothing.alias("id"))
    rows = rows.unionByName(links.select("g", block.alias("block"), "level", "idx", "n", "data", none.alias("other"), nothing.alias("id")))
    if leaves is not None:
        rows = rows.unionByName(leaves.select("g", F.shiftright("pos", SHIFT * BAND).alias("block"), F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", F.col("leaf").alias("data"), "other", "id"))

    last = leaves is not None

    def run(batches):
        current, paths, runs = None, {}, {}
        for batch in batches:
            out = []
            for g, block, level, idx, n, data, other, id_ in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, block) != current:
                    current, paths, runs = (g, block), {}, {}
                if level == 99:
                    paths[(min(height(n), high), block)] = data
                elif level:
                    path, children = paths.pop((level, idx)), _split(data)
                    if level - 1 == low and last:
                        runs[idx] = (children, path)
                        continue
                    for at in range(len(children)):
                        own = _entry(children, at) + path
                        if level - 1 == low:
                            out += finish([(g, idx * FANOUT + at, n, own)])
                        else:
                            paths[(level - 1, idx * FANOUT + at)] = own
                elif n == 1:
                    out += finish([(g, id_, n, data, other, [data], 0, paths[(0, 0)])])
                else:
                    children, path = runs[idx >> SHIFT]
                    out += finish([(g, id_, n, data, other, children, idx % FANOUT, path)])
            yield from _out(out, shape)

    dealt = rows.repartition("g", "block").sortWithinPartitions("g", "block", F.desc("level"), "idx")
    return dealt.mapInArrow(run, ddl)


_PATHS = "g string, idx long, n long, path binary"
_PATH_SHAPE = pa.schema([("g", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("path", pa.binary())])


def _paths_above(scratch: Scratch, tree: Tree, base: DataFrame) -> DataFrame:
    """``g, block, n, path`` of all subtrees of BAND levels above the leaves; ``base``:
    ``g, n, path`` of the groups' tops."""
    above = base.select("g", "n", F.lit(0).cast("long").alias("block"), "path")
    size = lambda levels: F.col("n") > FANOUT**levels
    for band in range(-(-tree.levels // BAND) - 1, 0, -1):
        here = above.where(size(band * BAND))
        met = _descend(tree, here, band, None, lambda nodes: nodes, _PATHS, _PATH_SHAPE)
        lower = scratch.keep(met).select("g", "n", F.col("idx").alias("block"), "path")
        above = above.where(~size(band * BAND)).unionByName(lower)
    return above


_PROOF = "g string, id long, leaf binary, subroot binary, root binary, proof string, folded binary"
_PROOF_SHAPE = pa.schema([("g", pa.string()), ("id", pa.int64()), ("leaf", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary()), ("proof", pa.string()), ("folded", pa.binary())])


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``.

    A leaf is the digest of the columns ``fields``; leaves of a group (``group_col``,
    null is a group, the first) ascend by ``id_col`` (null first); equal ids are ordered
    by their leaves, so rows that are equal give equal results in some order.  Groups
    ascend by the bytes of their names.  ``proof_sha256`` is the digest of all siblings'
    hex texts on the way up, ``folded_root`` the root that these give with the row's own
    digest, taken with the expressions ``changed`` in place of columns: what a verifier
    who holds a changed row computes.  A dataset of one row has no siblings, its leaf is
    the root.  An empty table gives an empty result; other columns are not read, so
    their names can't clash.
    """
    scratch = Scratch()
    column = lambda c: F.col(f"`{c}`")
    changed = changed or {}
    group = column(group_col).cast("string")
    leaf = digest([column(c) for c in fields])
    other = digest([changed.get(c, column(c)) for c in fields])
    rows = docs.select(F.when(group.isNull(), "").otherwise(F.concat(F.lit("."), group)).alias("g"), column(id_col).cast("long").alias("id"), leaf.alias("leaf"), other.alias("other"))
    rows = scratch.keep(rows.withColumn("salt", F.monotonically_increasing_id()))
    tree = grow(scratch, rows, ["id", "leaf", "salt"])
    groups = scratch.keep(tree.tops.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("n").alias("rows"), F.col("data").alias("leaf")))
    upper = grow(scratch, groups, ["name"])
    start = upper.tops.select("g", "n", F.lit(b"").alias("path"))
    # the places of the groups in the tree over them, and from there their paths
    named = upper.leaves.select(F.lit("").alias("g"), "pos", "n", "leaf", F.lit(None).cast("binary").alias("other"), F.col("pos").alias("id"))
    found = _descend(upper, _paths_above(scratch, upper, start), 0, named, _group_path, _PATHS, _PATH_SHAPE)
    base = scratch.keep(upper.leaves.select("name", "rows", "pos").join(found.select(F.col("idx").alias("pos"), "path"), "pos").select(F.col("name").alias("g"), F.col("rows").alias("n"), "path"))

    def proofs(nodes):
        for g, id_, n, data, changed_leaf, children, at, path in nodes:
            own = (_entry(children, at) if n > 1 else b"") + path
            proof = hashlib.sha256(siblings(own)).hexdigest()
            top, run = data, list(steps(own))
            levels = height(n)
            for k, (place, others) in enumerate(run):
                if k == levels:
                    break
                top = joined([*others[:place], top, *others[place:]])
            root = top
            for place, others in run[levels:]:
                root = joined([*others[:place], root, *others[place:]])
            yield g, id_, data, top, root, proof, root if changed_leaf == data else fold(changed_leaf, own)

    every = _descend(tree, _paths_above(scratch, tree, base), 0, tree.leaves, proofs, _PROOF, _PROOF_SHAPE)
    text = lambda c: F.lower(F.hex(c))
    done = every.select(F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), F.col("proof").alias("proof_sha256"), text("folded").alias("folded_root"), F.col("folded").eqNullSafe(_root(upper)).alias("verified"))
    return scratch.result(done)


def _group_path(nodes):
    for g, id_, n, data, _, children, at, path in nodes:
        yield g, id_, n, (_entry(children, at) if n > 1 else b"") + path


def _root(upper: Tree) -> Column:
    """The root that the manifest publishes: one digest."""
    top = upper.tops.first()
    return F.lit(bytes(top["data"]) if top else None).cast("binary")


def tampered(id_col: str, text: str) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC-32 of the decimal id."""
    hit = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(hit, F.translate(F.col(f"`{text}`"), upper, lower)).otherwise(F.col(f"`{text}`"))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in fields) + ")"


#: The query's result in DuckDB: both trees and both folds as recursions over levels.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text, CASE WHEN {crc_sql('doc_id::VARCHAR')} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS bad FROM documents),
n AS MATERIALIZED (SELECT doc_id, leaf, other, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, coalesce('.' || lang, '') AS g, {_leaf_sql('text')} AS leaf, {_leaf_sql('bad')} AS other FROM d)),
t(lvl, g, pos, h) AS (SELECT 0, g, pos, leaf FROM n
  UNION ALL SELECT lvl + 1, g, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM t) WHERE c > 1 GROUP BY lvl, g, pos // 8),
s AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY g) - 1 AS pos FROM (SELECT g, max(lvl) AS top, arg_max(h, lvl) AS subroot FROM t GROUP BY g)),
u(lvl, pos, h) AS (SELECT 0, pos, subroot FROM s
  UNION ALL SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS c FROM u) WHERE c > 1 GROUP BY lvl, pos // 8),
b AS MATERIALIZED (SELECT max(lvl) AS top, arg_max(h, lvl) AS root FROM u),
tr AS MATERIALIZED (SELECT lvl, g, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM t GROUP BY ALL),
ur AS MATERIALIZED (SELECT lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM u GROUP BY ALL),
f(lvl, g, doc, pos, h, proof) AS (SELECT 0, g, pos, pos, other, '' FROM n
  UNION ALL SELECT f.lvl + 1, f.g, doc, f.pos // 8, sha256(array_to_string(hs[:f.pos % 8] || [f.h] || hs[f.pos % 8 + 2:], '')), proof || array_to_string(hs[:f.pos % 8] || hs[f.pos % 8 + 2:], '')
  FROM f JOIN s ON s.g = f.g AND f.lvl < s.top JOIN tr ON tr.lvl = f.lvl AND tr.g = f.g AND tr.run = f.pos // 8),
k(lvl, g, doc, pos, h, proof) AS (SELECT 0, f.g, doc, s.pos, f.h, proof FROM f JOIN s ON s.g = f.g AND f.lvl = s.top
  UNION ALL SELECT k.lvl + 1, k.g, doc, k.pos // 8, sha256(array_to_string(hs[:k.pos % 8] || [k.h] || hs[k.pos % 8 + 2:], '')), proof || array_to_string(hs[:k.pos % 8] || hs[k.pos % 8 + 2:], '')
  FROM k JOIN b ON k.lvl < b.top JOIN ur ON ur.lvl = k.lvl AND ur.run = k.pos // 8)
SELECT n.doc_id, n.leaf, s.subroot, b.root, sha256(k.proof) AS proof_sha256, k.h AS folded_root, k.h = b.root AS verified
FROM n JOIN s USING (g) JOIN b ON true JOIN k ON k.g = n.g AND k.doc = n.pos AND k.lvl = b.top
"""
