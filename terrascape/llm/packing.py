"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A piece goes where the sum over residual gaps of the squared number of open bins
with that gap becomes smallest (Csirik, Johnson, Kenyon, Orlin, Shor and Weber, 2006).
Only lengths and positions travel: token ids are counted and digested in the task
that reads the text.  Pieces as long as a sequence fill one alone; the others are
dealt evenly into packing groups of bounded size, each packed by one task.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import durable, map_text, schema

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 2048, 0
#: Pieces of a packing group: its memory, and how rarely a group leaves bins part-filled.
GROUP = 60_000
#: Distinct words of a generation: a task remembers the last two generations.
MEMORY = 250_000


def _ranges(kind: str) -> str:
    """The code points to U+FFFF whose general category begins with ``kind``, as the
    inside of a character class (which ``re`` looks up in a bitmap)."""
    out, start = [], None
    for c in range(0x10001):
        inside = c <= 0xFFFF and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


# The white space of split patterns.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def translate(pattern: str) -> str:
    """A split pattern in the syntax of ``re``, for texts without code points beyond
    U+FFFF: property classes become ranges, and the run of letters is tried first (no
    other alternative begins with a letter)."""
    parts = pattern.split("|")
    parts.sort(key=lambda p: p != "[\\p{L}]+")
    letters, numbers = _ranges("L"), _ranges("N")
    return "|".join(parts).replace("\\p{L}", letters).replace("\\p{N}", numbers).replace("\\s", WHITE)


class Tokens:
    """Token ids (little-endian unsigned 32-bit) of whole texts, by a tokenizer file
    that lower-cases, drops white space and splits texts into words, so that a text's
    ids are those of its words.  The words are the file's own (its normalizer and
    split pattern are read from it); words not met before go to the library."""

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            pattern = json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = re.compile(translate(pattern))
        self.split_any = regex.compile(pattern)
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        """As the file's normalizer: composed, white space blank, lower case by single
        code points."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return self.library.normalizer.normalize_str(text) if "İ" in text or "Σ" in text else text.lower()

    def words(self, text: str) -> list[str]:
        text = self.normal(text)
        plain = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (self.split if plain else self.split_any).findall(text)

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.memory) > MEMORY:
            self.memory, self.older = {}, self.memory
        memory, older = self.memory, self.older
        split = [self.words(t) for t in texts]
        new = set().union(*split).difference(memory)
        again = new.intersection(older)
        memory.update((w, older[w]) for w in again)
        new = list(new - again)
        for word, found in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
            memory[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)
        return [b"".join([memory[w] for w in words]) for words in split]


@functools.lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    """One reader, and its bounded memory of words, for all tasks of a Python worker."""
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """One row per piece: the id, ``piece`` (from 0), ``start``, ``length`` and
    ``ids_crc32``.  A document is its ids, then the id ``end``; only documents longer
    than ``capacity`` are cut.  Null and empty texts are the end id alone; repeated
    rows give repeated pieces."""
    kind = docs.schema[id_col].dataType.simpleString()
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def make():
        tokens = tokens_of(tokenizer)

        def run(step):
            out = [[], [], [], [], []]
            for i, data in zip(step[0], tokens.ids([t or "" for t in step[1]])):
                data = memoryview(data + tail)
                for k, a in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[a : a + 4 * capacity]
                    for c, v in zip(out, (i, k, a // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
            return out

        return run

    return map_text(docs, [id_col, text_col], schema(f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"), make)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (at most ``capacity``), placed in the given order.

    ``open_bins[g]`` counts bins with gap g.  Placing length s into a bin of gap g moves
    one bin from gap g to g - s, which changes the sum of squares by
    2 * (open[g - s] - open[g] + 1), by 1 - 2 * open[g] where the bin becomes full, and
    by 2 * open[capacity - s] + 1 where a new bin is opened.  Of equal changes the
    smallest gap is taken.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    never = np.int64(1) << 60
    for k, s in enumerate(lengths.tolist()):
        have = count[s:capacity]
        change = 2 * (count[: capacity - s] - have) + 2
        if s < capacity:
            change[0] = 1 - 2 * have[0]
        change[have == 0] = never
        best = int(change.argmin()) if len(change) else 0
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if len(change) and change[best] <= fresh and change[best] != never:
            gap = best + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, made
            made += 1
        bins[k], offsets[k] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            stacks[gap - s].append(b)
    return bins, offsets


def pack(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns ``piece``, ``length``).

    Within a group longer pieces are placed first, ties by id and piece.  A repeated
    row is a piece of its own; a null id is kept.  Empty input gives no row; columns
    named like results are replaced, other columns are kept.
    """
    names = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    cut = cut.select(*[F.col(f"`{c}`") for c in names])
    mark = "group_" + "_" * max(map(len, names))  # a name that no column has
    full = cut.where(F.col("length") >= capacity)
    rest = cut.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    # equal rows share a hash, so what deals them is the task and place they come from
    dealt = rest.withColumn(mark, F.pmod(F.hash(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.monotonically_increasing_id()), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", id_col, "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        return rows[names].assign(sequence_id=bins * groups + key[0], offset=offsets)

    packed = dealt.groupBy(mark).applyInPandas(run, f"{fields}, sequence_id long, offset long")
    # full pieces: numbers below 0, distinct by the task and place they come from
    alone = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """Tokenise, cut and pack whole documents; see ``pieces`` and ``pack``."""
    return pack(durable(pieces(docs, tokenizer, id_col, text_col, capacity, end)), id_col, capacity)
