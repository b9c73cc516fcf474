"""Near-duplicate documents by HyperMinHash (Yu and Weber, 2017).

A document's set of word shingles is hashed into buckets; of each bucket's least hash
a register keeps the count of leading zeros and some mantissa bits, 16 bits in all.
Bands of registers are keys under which similar documents meet.  Pairs whose Jaccard
estimate, corrected for chance collisions of registers, is out of reach are dropped;
the others are confirmed on the full sets.

No group is expanded into its pairs: equal sets are one node; a node is first compared
with the head (the smallest member) that most of its buckets share, then with heads of
other components that several share; what buckets that still hold several components leave is compared
last: pairs alone in a bucket one by one, larger buckets blockwise, for pairs of different components.
"""

from __future__ import annotations


import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import Scratch, components, durable, map_text, rows_of, schema

#: Words of a shingle; buckets (2 to a power); mantissa bits of a register; bands of registers.
WORDS, BUCKET_BITS, MANTISSA, BANDS, ROWS = 5, 7, 10, 25, 5
#: Standard errors by which an estimate may miss the threshold before a pair is dropped.
SLACK = 4.0
#: Shared buckets that make a head worth a comparison before the blocks (at a similarity
#: of 0.8 a pair shares 8 of 25 on average).
SEVERAL = 5
#: Members of a block of a bucket that is compared blockwise.
BLOCK = 1024
#: Distinct words that a task remembers before it starts anew.
MEMORY = 300_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PRIME = np.uint64(0x9FB21C651E98DF25)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _PRIME
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, words: dict | None = None, width: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles: ``width`` consecutive
    words (split at ASCII white space, A-Z lower-cased), of fewer words the whole
    sequence; empty without words."""
    words = _Words() if words is None else words
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, n)
    w = min(width, n)
    out = np.full(n - w + 1, w, np.uint64)
    for k in range(w):
        out = _mix(out * _PRIME + h[k : n - w + 1 + k])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a sorted set; 0 stands for an empty bucket."""
    out = np.zeros(1 << BUCKET_BITS, np.uint16)
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # sorted: each bucket's least hash
        rest = hashes[first] << np.uint64(BUCKET_BITS)
        bits = np.maximum(rest, 1).astype(np.float64).view(np.uint64)
        zeros = np.minimum(63 - ((bits >> np.uint64(52)).astype(np.int64) - 1023), 62)
        mantissa = (bits >> np.uint64(52 - MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
        out[bucket[first]] = (np.maximum(zeros, 0) << MANTISSA | mantissa) + 1
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates and their standard errors at the estimate's resolution, of
    rows of registers: the share of agreeing registers, corrected for registers that
    agree by chance (2 to the power of minus the mantissa bits)."""
    either = np.maximum(1, ((a > 0) | (b > 0)).sum(-1))
    same = ((a == b) & (a > 0)).sum(-1)
    chance = 2.0**-MANTISSA
    return (same / either - chance) / (1 - chance), either


def reachable(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose similarity may reach the threshold."""
    found, size = estimate(a, b)
    return found >= threshold - SLACK * np.sqrt(threshold * (1 - threshold) / size)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = WORDS) -> DataFrame:
    """``id, n_shingles, set_key`` (digest of the set) and ``registers`` of each row."""

    def make():
        words = _Words()

        def run(step):
            sets = [shingles(t, words, width) for t in step[1]]
            return [step[0], [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [registers(s).tobytes() for s in sets]]

        return run

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_text(d, ["id", "text"], schema("id long, n_shingles long, set_key binary, registers binary"), make)


def bands(classes: DataFrame) -> DataFrame:
    """``band, rep``: a 64-bit key of each band of registers that isn't empty."""
    fields = pa.schema([("band", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                reg = np.frombuffer(b"".join(piece.column(1).to_pylist()), np.uint16).reshape(-1, 1 << BUCKET_BITS)
                reg = reg[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), reg.shape[:2])
                for k in range(ROWS):
                    key = _mix(key * _PRIME + reg[:, :, k])
                full = reg.any(-1)
                rep = np.broadcast_to(piece.column(0).to_numpy()[:, None], full.shape)
                yield pa.RecordBatch.from_arrays([pa.array(key[full].view(np.int64)), pa.array(rep[full])], schema=fields)

    return classes.select("rep", "registers").mapInArrow(run, "band long, rep long")


def _screen(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose estimate may reach the threshold."""
    r = classes.select("rep", "registers")
    both = pairs.join(r.withColumnsRenamed({"rep": "a", "registers": "ra"}), "a").join(r.withColumnsRenamed({"rep": "b", "registers": "rb"}), "b").select("a", "b", "ra", "rb")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(piece.column(k).to_pylist()), np.uint16).reshape(-1, 1 << BUCKET_BITS) for k in (2, 3))
                yield piece.select(["a", "b"]).filter(pa.array(reachable(x, y, threshold)))

    return both.mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int, width: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    few = rows_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), id_col, text_col).groupBy("id").agg(F.min("text").alias("text"))
    both = pairs.join(few.withColumnsRenamed({"id": "a", "text": "ta"}), "a").join(few.withColumnsRenamed({"id": "b", "text": "tb"}), "b").select("a", "b", "ta", "tb")

    def run(batches):
        words = _Words()
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 64):
                for a, ta, tb in zip(*[batch.slice(at, 64).column(c).to_pylist() for c in ("a", "ta", "tb")]):
                    if last[0] != a:
                        last = (a, shingles(ta, words, width))
                    x, y = last[1], shingles(tb, words, width)
                    n = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * n >= percent * (len(x) + len(y) - n))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _named(band: DataFrame, labels: DataFrame) -> DataFrame:
    """``band, rep, c``: each member of a bucket with its component so far."""
    return band.join(labels.withColumnsRenamed({"node": "rep", "component": "c"}), "rep", "left").select("band", "rep", F.coalesce("c", "rep").alias("c"))


def _other_heads(band: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of a bucket's smallest member and its members of other components that
    meet in SEVERAL buckets; what meets in fewer is left to the blocks."""
    named = _named(band, labels)
    heads = named.groupBy("band").agg(F.min(F.struct("rep", "c")).alias("h"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("band", "h")
    return named.join(heads, "band").where("c <> h.c").groupBy(F.col("h.rep").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("n")).where(F.col("n") >= SEVERAL).select("a", "b")


def _left_over(band: DataFrame, classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """What may still link: a spanning forest (a, b) of the pairs of different components
    that share a bucket of three or more members and may reach the threshold."""
    named = _named(band, labels)
    open_ = named.groupBy("band").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 2 AND lo <> hi").select(F.col("band").alias("g"), "n")
    members = named.withColumnRenamed("band", "g").join(open_, "g").join(classes.select("rep", "registers"), "rep").withColumn("text", F.lit(None).cast("string"))

    def compare(rep, c, reg, texts, pairs):
        group = np.arange(len(rep))
        for k, right in pairs:
            at = right[(c[right] != c[k]) & (group[right] != group[k])]
            at = at[reachable(reg[k], reg[at], threshold)] if len(at) else at
            while len(at):
                t = at[0]
                yield rep[k], rep[t]
                group[group == group[t]] = group[k]
                at = at[group[at] != group[k]]

    return _blockwise(members, BLOCK, compare).distinct()


def _alone(band: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that are the only two members of a bucket."""
    pair = _named(band, labels).groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("a"), F.max("rep").alias("b"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    return pair.where("n = 2 AND lo <> hi").select("a", "b").distinct()


def _confirm_groups(forest: DataFrame, docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, labels: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) between the components of each tree of ``forest``, confirmed on the
    full sets: enough of them to join what is linked, none where components are joined."""
    threshold = percent / 100
    tree = durable(components(forest).select(F.col("component").alias("g"), F.col("node").alias("rep")))
    few = rows_of(docs, tree.select("rep"), id_col, text_col).groupBy("id").agg(F.min("text").alias("text"))
    named = tree.join(labels.withColumnsRenamed({"node": "rep", "component": "c"}), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    members = named.join(classes.select("rep", "registers"), "rep").join(few.withColumnRenamed("id", "rep"), "rep").join(tree.groupBy("g").agg(F.count("*").alias("n")), "g")

    def compare(rep, c, reg, texts, pairs):
        words, sets = _Words(), {}
        joined = c.copy()

        def full(k):
            if k not in sets:
                sets[k] = shingles(texts[k].as_py(), words, width)
            return sets[k]

        for k, right in pairs:
            at = right[joined[right] != joined[k]]
            for t in at[reachable(reg[k], reg[at], threshold)].tolist() if len(at) else ():
                if joined[t] == joined[k]:
                    continue
                x, y = full(k), full(t)
                n = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * n >= percent * (len(x) + len(y) - n):
                    yield rep[k], rep[t]
                    joined[joined == joined[t]] = joined[k]

    return _blockwise(members, BLOCK // 4, compare)


def _blockwise(members: DataFrame, block: int, compare) -> DataFrame:
    """Deal the members of groups (``g, n, rep, c, registers, text``; n: their number)
    into blocks and give each pair of blocks of a group to ``compare``, whose links
    (a, b) are returned.  A pair of blocks has about 2 * ``block`` rows, however large
    the group is; a task streams its pairs of blocks in order."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "c", "registers", "text")

    def run(batches):
        fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held = None  # rows of the group that a batch may have cut
        for batch in itertools.chain(batches, [None]):
            table = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            g, i, j, own, rep, c = (table.column(n).to_numpy() for n in ("g", "i", "j", "own", "rep", "c"))
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *cuts.tolist(), *([table.num_rows] if batch is None else [])]
            done = bounds[-1]
            reg = np.frombuffer(b"".join(table.column("registers").slice(0, done).to_pylist()), np.uint16).reshape(-1, 1 << BUCKET_BITS)
            found = []
            for s, e in zip(bounds, bounds[1:]):
                left, right = np.flatnonzero(own[s:e] == i[s]), np.flatnonzero(own[s:e] == j[s])
                r = rep[s:e]
                pairs = ((k, right[r[right] > r[k]] if i[s] == j[s] else right) for k in left.tolist())
                found += compare(r, c[s:e], reg[s:e], table.column("text").slice(s, e - s), pairs)
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=fields)
            held = table.slice(done)

    return dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = WORDS) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id`` (the smallest id that
    links reach, its own included) and ``kept`` (the id is that of its component).

    Documents link where 100 * intersection >= percent * union of their shingle sets.
    Null, empty and blank texts have the empty set and link with nothing.  Rows of a
    null id take no part: their component is null and they are kept.  Rows that share
    an id are one node, whose links are those of its smallest text.  An empty table gives an empty result; other columns are not
    read.
    """
    threshold = percent / 100
    scratch = Scratch()
    sketch = scratch.keep(sketches(docs, id_col, text_col, width))
    classes = scratch.keep(sketch.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_key").agg(F.min("id").alias("rep"), F.first("registers").alias("registers")))
    band = scratch.keep(bands(classes))
    # first each class with the head that it shares most buckets with: a pair a class
    heads = band.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    met = band.join(heads, "band").where("rep <> head").groupBy(F.col("head").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("n"))
    first = scratch.keep(met.groupBy("b").agg(F.min_by("a", F.struct(-F.col("n"), F.col("a"))).alias("a")).select("a", "b"))
    edges = scratch.keep(_confirm(scratch.keep(_screen(first, classes, threshold)), docs, id_col, text_col, percent, width))
    # then with heads of other components that it shares several buckets with
    labels = scratch.table(components(edges))
    second = scratch.keep(_other_heads(band, labels).join(first, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        edges = scratch.keep(edges.unionByName(_confirm(scratch.keep(_screen(second, classes, threshold)), docs, id_col, text_col, percent, width)))
        labels = scratch.table(components(edges))
    # last, within the buckets that hold several components still; a pair alone in its bucket needs no block
    alone = scratch.keep(_alone(band, labels).join(first.unionByName(second), ["a", "b"], "left_anti"))
    third = scratch.keep(_left_over(band, classes, labels, threshold).unionByName(_screen(alone, classes, threshold)).distinct())
    if not third.isEmpty():
        labels = scratch.table(components(scratch.keep(edges.unionByName(_confirm_groups(third, docs, id_col, text_col, classes, labels, percent, width)))))
    named = labels.withColumnsRenamed({"node": "rep", "component": "c"})
    of_class = classes.select("set_key", "rep").join(named, "rep", "left").select("set_key", F.coalesce("c", "rep").alias("c"))
    out = sketch.join(of_class, "set_key", "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"))
    return scratch.result(out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows, whole, less those that are not the first of their component."""
    name = "gone_" + "_" * max(map(len, docs.columns))  # a name that no column has
    gone = near_duplicates(docs, id_col, text_col, percent).where("NOT kept").select(F.col("id").alias(name)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")
