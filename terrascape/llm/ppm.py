"""Language-model scores by prediction by partial matching over bytes.

A text is its lower-cased words, each followed by one blank, and a line feed in place of
the last blank; it is predicted byte by byte.  The model is a trie of the contexts of up
to ``order`` bytes that the training texts hold, with the count of each byte that
followed.  A byte that followed its longest context has the share of its count, less one
half, among all counts; the halves are the share of the escape (method D).  After an
escape the next shorter context answers, without the bytes that the longer one offered
(symbol exclusion); contexts that training never saw are passed over for free; what no
context holds is shared evenly by the bytes left.  Probabilities over all texts add to 1.

The cost of a byte depends on itself and ``order`` bytes before it, its gram.  So a task
makes its texts one chunk: the numbers of their words, and the distinct words and grams
of the chunk with their training counts.  These are added up over the corpus; contexts
and escapes are joins and groups of at most 256 bytes; and every chunk gets back the
counts of its words and the costs of its grams, with which its texts are scored.  Texts
don't travel, only the numbers of their words.  Chunks are bounded in bytes, and a
word or gram occurs once a chunk, however frequent it is.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import Scratch, size_of, steps

#: Bytes of the longest context.
ORDER = 5
#: Bytes of text and distinct words after which a chunk is closed; input of a task.
CHUNK, WORDS, TASK = 128 << 20, 1_000_000, 32 << 20
#: Distinct grams, with counts still apart, that a task keeps before it adds them up.
LOOSE = 1_000_000
DOC, WORD, GRAM = 2, 1, 0
ROWS = "kind int, chunk long, key long, n long, held boolean, data binary"
_SHAPE = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("held", pa.bool_()), ("data", pa.binary())])
STEP = 100_000


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: what ASCII white space separates, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def grams(texts: list[list[bytes]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams at all bytes of several texts of words, one text after another, and
    the bytes of each text.  The context of a text's first bytes is filled with blanks,
    which never stand together in a text."""
    pad = b" " * order
    lines = [b" ".join(w) + b"\n" for w in texts]
    size = np.array([len(t) for t in lines])
    whole = np.frombuffer(pad + pad.join(lines), np.uint8)
    found = whole.astype(np.int64)
    for back in range(1, order + 1):
        found[back:] |= whole[:-back].astype(np.int64) << (8 * back)
    own = np.ones(len(whole), bool)  # the bytes of texts, not those between them
    first = np.cumsum(size + order) - size
    for back in range(1, order + 1):
        own[first - back] = False
    return found[own], size


class Lookup:
    """Values of distinct keys, by an open hash table: each key in the first free slot
    from its hash on."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several for one slot, one stays
            mine = self.keys[slot] == keys
            self.values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that all are in the table."""
        slot = self._slot(keys)
        missed = np.flatnonzero(self.keys[slot] != keys)
        while len(missed):
            slot[missed] = (slot[missed] + 1) & self.last
            missed = missed[self.keys[slot[missed]] != keys[missed]]
        return self.values[slot]


class Chunk:
    """Texts of a task: numbers of words, and training counts of words and grams."""

    def __init__(self, order: int) -> None:
        self.order, self.number, self.counts = order, {}, np.zeros(1024, np.int64)
        self.grams = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        self.bytes = self.loose = 0

    def add(self, texts: list[list[bytes]], held: list[bool]) -> list[np.ndarray]:
        """The word numbers of each text."""
        number = self.number
        ids = [np.array([number.setdefault(w, len(number)) for w in t], np.uint32) for t in texts]
        if len(number) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(max(len(number), len(self.counts)), np.int64)])
        learned = [i for i, h in zip(ids, held) if not h]
        if learned:
            seen = np.bincount(np.concatenate(learned).astype(np.int64))
            self.counts[: len(seen)] += seen
        found, size = grams(texts, self.order)
        # the lowest bit tells texts that are not learned from
        own, n = np.unique(found << 1 | np.repeat(np.array(held, np.int64), size), return_counts=True)
        self.grams.append((own, n))
        self.bytes += len(found)
        self.loose += len(own)
        if self.loose > LOOSE:
            self.grams = [self.settled()]
            self.loose = len(self.grams[0][0]) // 2
        return ids

    def settled(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.grams])
        order = np.argsort(keys, kind="stable")  # runs in order already
        keys, n = keys[order], np.concatenate([n for _, n in self.grams])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        return keys[first], (np.add.reduceat(n, first) if len(first) else n)

    def rows(self, chunk: int):
        """Record batches of the distinct grams and words."""
        keys, n = self.settled()
        self.grams = []
        gram, learned = keys >> 1, np.where(keys & 1, 0, n)
        del keys, n
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.empty(0, np.int64)
        gram, learned = gram[first], (np.add.reduceat(learned, first) if len(first) else learned)
        for at in range(0, len(gram), STEP):
            yield _batch(GRAM, chunk, gram[at : at + STEP], learned[at : at + STEP], None, None)
        words = list(self.number)
        for at in range(0, len(words), STEP):
            part = words[at : at + STEP]
            yield _batch(WORD, chunk, np.arange(at, at + len(part)), self.counts[at : at + len(part)], None, part)


def _batch(kind: int, chunk: int, key, n, held, data) -> pa.RecordBatch:
    size = len(key)
    nothing = lambda t: pa.nulls(size, t)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), pa.array(np.full(size, chunk, np.int64)), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
         nothing(pa.bool_()) if held is None else pa.array(held, pa.bool_()), nothing(pa.binary()) if data is None else pa.array(data, pa.binary())],
        schema=_SHAPE,
    )


def packed(ids: np.ndarray) -> bytes:
    """Word numbers by byte planes, of which the higher ones are nearly all 0, compressed."""
    return pa.compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data, 4 * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def gather(docs: DataFrame, order: int) -> DataFrame:
    """``docs(id, held, text)`` as chunks: rows of texts, words and grams."""

    def run(batches):
        part, chunk, own = TaskContext.get().partitionId(), 0, Chunk(order)
        for batch in batches:
            for ids, held, texts in steps(batch, 2):
                numbers = []
                for a in range(0, len(ids), 128):  # grams take 8 bytes a byte of text, several times
                    numbers += own.add([words_of(t) for t in texts[a : a + 128]], held[a : a + 128])
                yield _batch(DOC, part << 24 | chunk, pa.array(ids, pa.int64()), [len(n) + 1 for n in numbers], held, [packed(n) for n in numbers])
                if own.bytes > CHUNK or len(own.number) > WORDS:
                    yield from own.rows(part << 24 | chunk)
                    chunk, own = chunk + 1, Chunk(order)
        yield from own.rows(part << 24 | chunk)

    return docs.mapInArrow(run, ROWS)


def _shorter(counts: DataFrame, order: int) -> DataFrame:
    """Counts of grams of ``order + 1`` bytes from those with a longer context."""
    return counts.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).alias("gram")).agg(F.sum("n").alias("n"))


def _escapes(scratch: Scratch, rows: DataFrame, counts: DataFrame, order: int) -> list[DataFrame]:
    """``gram, cost`` of the grams in ``rows(gram)`` that training texts don't hold, by
    what is left after each shorter context; ``counts``: the training grams."""
    none = F.expr("cast(array() as array<int>)")
    rows = rows.select("gram", F.lit(0.0).alias("cost"), none.alias("gone"))
    found = []
    for k in range(order, -1, -1):
        if k < order:
            counts = scratch.keep(_shorter(counts, k))
        byte = lambda c: F.col(c).bitwiseAND(F.lit(255)).cast("int")
        nodes = counts.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.collect_list(F.struct(byte("gram").alias("byte"), "n")).alias("next"))  # at most 256
        context = F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)), 8).alias("context")
        # contexts of at most a byte are at most 256 nodes of 256 bytes
        met = rows.withColumn("context", context).join(F.broadcast(nodes) if k < 2 else nodes, "context", "left")
        left = F.filter(F.coalesce("next", F.expr("cast(array() as array<struct<byte:int,n:bigint>>)")), lambda e: ~F.array_contains("gone", e["byte"]))
        met = met.withColumn("left", left)
        total = F.aggregate("left", F.lit(0).cast("long"), lambda s, e: s + e["n"])
        own = F.try_element_at(F.filter("left", lambda e: e["byte"] == byte("gram")), F.lit(1))["n"]
        share = F.when(F.size("left") == 0, F.lit(1.0)).otherwise(F.coalesce(own - 0.5, F.size("left") / 2) / total)
        gone = F.when(F.size("left") > 0, F.transform("next", lambda e: e["byte"])).otherwise(F.col("gone"))
        rows = scratch.keep(met.select("gram", (F.col("cost") + F.log10(share)).alias("cost"), gone.alias("gone"), own.isNotNull().alias("done")))
        found.append(rows.where("done").select("gram", "cost"))
        rows = rows.where("NOT done").drop("done")
    return [*found, rows.select("gram", (F.col("cost") - F.log10(256 - F.size("gone"))).alias("cost"))]


def costs(scratch: Scratch, chunks: DataFrame, order: int) -> DataFrame:
    """``gram, cost``: log10 of the probability of each gram's last byte after the others."""
    every = scratch.keep(chunks.where(f"kind = {GRAM}").groupBy(F.col("key").alias("gram")).agg(F.sum("n").alias("n")))
    learned = every.where("n > 0")
    context = F.shiftright("gram", 8).alias("context")
    nodes = learned.groupBy(context).agg(F.sum("n").alias("all"))
    known = learned.withColumn("context", context).join(nodes, "context").select("gram", F.log10((F.col("n") - 0.5) / F.col("all")).alias("cost"))
    for part in _escapes(scratch, every.where("n = 0"), learned, order):
        known = known.unionByName(part)
    return scratch.keep(known)


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    The model and the counts are learned from the rows where ``held`` is not true (rows
    with a null id or null ``held`` too).  Tokens are words (what ASCII white space
    separates, A-Z lower-cased) and one end; ``n_known`` are those that training holds;
    ``base_score`` is the text's log10 probability by single tokens with one added to
    each count, ``score`` that by the model.  A null text counts as empty: its one token
    is the end.  Rows are scored one by one, so ids may be null or repeat; equal texts
    get equal scores.  An empty table gives an empty result; without training rows every
    byte has one 256th and ``base_score`` is 0.  Only the id, the text and what ``held``
    reads are read, so other names can't clash.
    """
    scratch = Scratch()
    held = F.coalesce(held, F.lit(False))
    size, cores = size_of(docs), docs.sparkSession.sparkContext.defaultParallelism
    if size < 1 << 50:  # known: larger tasks make larger chunks, in which words and grams occur once
        docs = docs.coalesce(max(4 * cores, -(-size // TASK)))
    chunks = scratch.keep(gather(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), held.alias("held"), F.col(f"`{text_col}`").alias("text")), order))
    words = chunks.where(f"kind = {WORD}")
    known = scratch.keep(words.groupBy("data").agg(F.sum("n").alias("c")).where("c > 0"))
    all_ = known.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    ends = chunks.where(f"kind = {DOC} AND NOT held").count()
    n, v = all_["n"] + ends, all_["v"] + (ends > 0)
    cost = costs(scratch, chunks, order)
    nothing = F.lit(None).cast("double").alias("cost")
    flag = F.lit(None).cast("boolean").alias("held")
    reply = chunks.where(f"kind = {DOC}").select("chunk", "kind", "key", "n", nothing, "held", "data")
    reply = reply.unionByName(words.join(known, "data", "left").select("chunk", "kind", "key", F.coalesce("c", F.lit(0)).alias("n"), nothing, flag, "data"))
    asked = chunks.where(f"kind = {GRAM}").select("chunk", "kind", "key")
    gram = asked.join(cost.withColumnRenamed("gram", "key"), "key")
    reply = reply.unionByName(gram.select("chunk", "kind", "key", F.lit(0).cast("long").alias("n"), "cost", flag, F.lit(None).cast("binary").alias("data")))
    room = math.log10(n + v + 1)
    end = math.log10(ends + 1) - room
    shape = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        current, reader = None, None
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if chunk[a] != current:
                    current, reader = chunk[a], _Reader(order)
                for kind, part in reader.parts(batch.slice(a, b - a)):
                    if kind != DOC:
                        continue
                    for ids, tokens, told, data in zip(*([c.slice(k, 64).to_pylist() for k in range(0, len(c), 64)] for c in part)):
                        got = [reader.score([unpacked(d, k - 1) for d, k in zip(data, tokens)], room)]
                        for seen, base, whole in got:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(ids, pa.int64()), pa.array(told), pa.array(tokens, pa.int64()), pa.array(seen + (ends > 0), pa.int64()), pa.array(np.full(len(ids), n), pa.int64()), pa.array(base + end), pa.array(whole)], schema=shape
                            )

    dealt = reply.repartition("chunk").sortWithinPartitions("chunk", "kind", "key")
    return scratch.result(dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


class _Reader:
    """The replies of one chunk, in order: costs of grams, counts of words, texts."""

    def __init__(self, order: int) -> None:
        self.order, self.gram, self.cost, self.words, self.count = order, [], [], [], []
        self.ready = False

    def parts(self, batch: pa.RecordBatch):
        kinds = batch.column(1).to_numpy()
        cut = np.searchsorted(kinds, [GRAM, WORD, DOC, DOC + 1]).tolist()
        for kind, a, b in zip((GRAM, WORD, DOC), cut, cut[1:]):
            part = batch.slice(a, b - a)
            if a == b:
                continue
            if kind == GRAM:
                self.gram.append(part.column(2).to_numpy())
                self.cost.append(part.column(4).to_numpy())
            elif kind == WORD:
                self.words += part.column(6).to_pylist()
                self.count.append(part.column(3).to_numpy())
            yield kind, [part.column(k) for k in (2, 3, 5, 6)]

    def score(self, texts: list[np.ndarray], room: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known words, base score without the end, and score of each text."""
        if not self.ready:
            self.cost = Lookup(np.concatenate(self.gram), np.concatenate(self.cost))
            self.gram = []
            self.count = np.concatenate(self.count) if self.count else np.zeros(1, np.int64)
            self.base = np.log10(self.count + 1.0) - room
            self.ready = True
        found, size = grams([list(map(self.words.__getitem__, t.tolist())) for t in texts], self.order)
        cost = self.cost[found]
        whole = np.add.reduceat(cost, np.cumsum(size) - size)
        seen = np.array([np.count_nonzero(self.count[t]) for t in texts])
        base = np.array([self.base[t].sum() for t in texts])
        return seen, base, whole
