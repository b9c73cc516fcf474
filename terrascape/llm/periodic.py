"""Runs of periodic word sequences: every maximal stretch that repeats its shortest
period often enough, found by the runs theorem (Bannai and others, 2017).

Each run holds the longest Lyndon word that begins at some place, under one of the two
orders of the words: the words between a place and the next place whose suffix is
smaller.  So the candidates of a text are two for each word: next smaller values of the
inverse suffix array, once for each order.  A candidate's root is extended to the right
by the longest common prefix of two suffixes (a range minimum over the LCP array by a
sparse table), to the left the same way on the reversed text; where both cover enough
periods, it is a run.

All texts of a step are one array: words of different texts get different numbers, so
suffixes of different texts never tie.  Suffixes are sorted by prefix doubling, where
only groups that still tie are sorted again; the ranks of each doubling also give the
LCP array.  Per word about 30 bytes and 4 for each doubling and each level of the table
are held: a text of a million words takes a task some 300 MB.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import crc_sql, map_text, schema

#: Words of the shortest run, and how often its period fits in at least.
LEAST_WORDS, LEAST_TIMES = 6, 4


def ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... symbols from each place, until no two
    places tie; the last are the places in the suffix array.  ``symbols``: numbers from
    1, and 0 after the end of each text; stretches of different texts never tie."""
    n = len(symbols)
    rank = _dense(symbols)
    every = [rank]
    width = 1
    while True:
        size = np.bincount(rank)
        tied = np.flatnonzero(size[rank] > 1)
        tied = tied[symbols[tied] > 0]
        if not len(tied):
            return every
        # within a group of ties, order by the rank of what follows; a rank is the number
        # of places with smaller stretches, so groups split without moving the others
        key = rank[tied].astype(np.int64) * (n + 1) + np.where(tied + width < n, rank[np.minimum(tied + width, n - 1)].astype(np.int64) + 1, 0)
        order = np.argsort(key)
        got, group = key[order], rank[tied][order]
        fresh = np.empty(len(got), bool)
        fresh[0], fresh[1:] = True, got[1:] != got[:-1]
        first = np.empty(len(got), bool)
        first[0], first[1:] = True, group[1:] != group[:-1]
        at = np.arange(len(got))
        into = at - np.maximum.accumulate(np.where(first, at, 0))  # place in the group of ties
        new = group + np.maximum.accumulate(np.where(fresh, at, 0)) - (at - into)
        rank = rank.copy()
        rank[tied[order]] = new
        every.append(rank)
        width *= 2


def _dense(symbols: np.ndarray) -> np.ndarray:
    """For each place the number of places with a smaller symbol; the ends tie with none."""
    ends = np.flatnonzero(symbols == 0)
    count = np.bincount(symbols)
    below = np.cumsum(count) - count
    rank = below[symbols].astype(np.int32)
    rank[ends] = np.arange(len(ends), dtype=np.int32)
    return rank


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value (the length, if none).

    All places jump over what is larger at once; a place's jump goes where the jump of
    the place it reached goes, so jumps grow as they are taken.  The few that are left
    then walk, from the right, over finished ones."""
    n = len(values)
    to = np.arange(1, n + 1)
    value = np.append(values, -1)
    open_ = np.arange(n)
    while True:
        open_ = open_[value[to[open_]] > value[open_]]
        if len(open_) <= n >> 6:
            break
        to[open_] = to[to[open_]]
    if len(open_):
        jump, seen = to.tolist(), value.tolist()
        for i in open_[::-1].tolist():
            own, j = seen[i], jump[i]
            while seen[j] > own:
                j = jump[j]
            jump[i] = j
        to = np.array(jump)
    return to


class Prefixes:
    """Longest common prefixes of suffixes, by range minima over the LCP array."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.rank = levels[-1]
        n = len(self.rank)
        suffix = np.empty(n, np.int32)
        suffix[self.rank] = np.arange(n, dtype=np.int32)
        a, b = suffix[:-1], suffix[1:]
        lcp = np.zeros(n, np.int32)  # of the suffixes at r and r + 1
        live = np.flatnonzero(levels[0][a] == levels[0][b])
        for k in range(len(levels) - 1, -1, -1):
            x, y = a[live] + lcp[live], b[live] + lcp[live]
            same = levels[k][x] == levels[k][y]
            lcp[live[same]] += 1 << k
        self.table = [lcp]
        span = 1
        while 2 * span <= n:
            below = self.table[-1]
            self.table.append(np.minimum(below[: len(below) - span], below[span:]))
            span *= 2

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``x`` and ``y`` (other places) share."""
        a, b = self.rank[x], self.rank[y]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(high - low).astype(np.int64)
        out = np.empty(len(low), np.int32)
        for k in np.unique(level).tolist():
            here = level == k
            out[here] = np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << k)])
        return out


def runs(symbols: np.ndarray, times: int = 2) -> np.ndarray:
    """Rows ``start, end, period`` of all runs that hold their shortest period at least
    ``times`` times (2 or more), in order.  ``symbols``: as in ``ranks``, the last is 0."""
    levels = ranks(symbols)
    top = int(symbols.max()) + 1
    backwards = ranks(np.where(symbols > 0, top - symbols, 0).astype(symbols.dtype))
    at, end = [], []
    for order in (levels[-1], backwards[-1]):
        stop = next_smaller(order)
        wanted = symbols > 0
        if times > 2:  # seen from its first root on, a run goes on as that root begins
            wanted &= symbols[np.minimum(stop, len(symbols) - 1)] == symbols
        i = np.flatnonzero(wanted)
        at.append(i)
        end.append(stop[i])
    i, e = np.concatenate(at), np.concatenate(end)
    del backwards
    if not len(i):
        return np.empty((0, 3), np.int64)
    period = e - i
    right = Prefixes(levels).common(i, e)
    near = right >= (times - 2) * period
    i, e, period, right = i[near], e[near], period[near], right[near]
    if not len(i):
        return np.empty((0, 3), np.int64)
    # to the left: the same on the texts that still have candidates, reversed
    text = np.cumsum(symbols == 0) - (symbols == 0)
    wanted = np.zeros(int(text[-1]) + 1, bool)
    wanted[text[i]] = True
    place = np.flatnonzero(wanted[text])
    where = np.full(len(symbols), -1, np.int64)
    reverse = symbols[place][::-1]  # ends come first: the last one closes the text before
    reverse = np.append(reverse[1:], reverse[:1])
    where[place] = (len(place) - 2 - np.arange(len(place))) % len(place)
    found = Prefixes(ranks(reverse.copy()))
    left = np.zeros(len(i), np.int64)
    inner = (i > 0) & (symbols[i - 1] > 0)
    left[inner] = found.common(where[i[inner] - 1], where[e[inner] - 1])
    start, stop = i - left, e + right
    full = stop - start >= times * period
    return np.unique(np.stack([start, stop, period], axis=1)[full], axis=0)


def symbols_of(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of several texts, different in each, with 0 after each text."""
    words = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    number = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), size)
    key = text * (len(words.dictionary) + 1) + number
    order = np.argsort(key)
    got = key[order]
    dense = np.empty(len(key), np.int32)
    if len(key):
        dense[order] = np.cumsum(np.concatenate([[1], got[1:] != got[:-1]]))
    out = np.zeros(len(key) + len(texts), np.int32)
    out[np.arange(len(key)) + text] = dense
    return out


def _describe(words: list[bytes], found: np.ndarray) -> tuple:
    """The result columns of one text from its runs (``start, end, period``)."""
    listed = sorted((s, e - s, q) for s, e, q in found.tolist())
    dropped = np.zeros(len(words), bool)
    for s, n, q in listed:
        dropped[s + q : s + n] = True
    kept = words if not listed else [w for w, d in zip(words, dropped.tolist()) if not d]
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest()
    best = min(listed, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if listed else (None, None, None)
    milli = 1000 * best[1] // best[2] if listed else None
    return (len(listed), *best, milli, digest, hashlib.sha256(b" ".join(kept)).hexdigest())


def describe(step: list[list[bytes]], least: int, times: int) -> list[tuple]:
    """``_describe`` of the words of several texts."""
    symbols = symbols_of(step)
    none = np.empty((0, 3), np.int64)
    found = runs(symbols, times) if len(symbols) > len(step) else none
    found = found[found[:, 1] - found[:, 0] >= least]
    begin = np.cumsum([0, *[len(w) + 1 for w in step]])
    cut = np.searchsorted(found[:, 0], begin)
    return [_describe(words, found[cut[k] : cut[k + 1]] - np.array([begin[k], begin[k], 0]) if cut[k] < cut[k + 1] else none) for k, words in enumerate(step)]


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, times: int = LEAST_TIMES, plant: bool = False) -> DataFrame:
    """``doc_id`` and, of the words of each text: ``n_runs``; ``start, length, period,
    exponent_milli`` of the run with the largest exponent (ties: smallest start, then
    period; null without runs); digests of all runs and of the text with runs cut to
    one period.

    A run has at least ``least`` words and ``times`` (2 or more) periods; its period is
    its shortest, and no neighbouring word extends it.  Words are what ASCII white space
    separates.  A null text counts as one without words; rows are taken one by one, so
    ids may be null or repeat; an empty table gives an empty result.  Only the two
    columns are read, so other names can't clash.  ``plant``: first make one text in ten
    periodic from some word on, by the checksum of its id.
    """

    def make():
        def run(step):
            ids, marks, texts = step
            words = [(t or "").encode().split() for t in texts]
            if plant:
                words = [periodic(w, m) for w, m in zip(words, marks)]
            return [ids, *map(list, zip(*describe(words, least, times)))]

        return run

    column = F.col(f"`{id_col}`").cast("long")
    d = docs.select(column.alias("id"), mark(column).alias("mark"), F.col(f"`{text_col}`").alias("text"))
    return map_text(d, ["id", "mark", "text"], schema(f"doc_id long, {RESULT}"), make)


def mark(id_: Column) -> Column:
    """The checksum that says what is planted."""
    return F.crc32(id_.cast("string").cast("binary"))


def periodic(words: list[bytes], mark: int | None) -> list[bytes]:
    """The words, periodic from one of them on where 10 divides ``mark``."""
    n = len(words)
    if not n or mark is None or mark % 10:
        return words
    g = mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[: n - a]


#: The query's result in DuckDB: stretches of words that equal the word a period on.
ORACLE = f"""
WITH d AS (SELECT doc_id, text, {crc_sql('doc_id::VARCHAR')} AS h, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w0 FROM documents),
o AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, w0, len(w0) AS n, h % 10 = 0 AND len(w0) > 0 AS hit, CASE WHEN len(w0) > 0 THEN (h // 10) % len(w0) END AS a, (h // 10) % 8 AS g8 FROM d),
t AS MATERIALIZED (SELECT d, doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i: w0[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END) + 1]) ELSE w0 END AS ws FROM o),
w AS MATERIALIZED (SELECT d, n, unnest(range(n)) AS i, unnest(ws) AS word FROM t),
e AS (SELECT x.d, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.d, y.i - x.i ORDER BY x.i) AS island FROM w x JOIN w y ON x.d = y.d AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT d, q, min(i) AS s, max(i) + 1 + q AS e FROM e GROUP BY d, q, island HAVING count(*) >= 3 * q AND count(*) + q >= {LEAST_WORDS}),
r AS MATERIALIZED (SELECT d, s AS start, e - s AS length, min(q) AS period FROM s GROUP BY d, s, e),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY d ORDER BY length::DECIMAL(38, 18) / period DESC, start, period) = 1),
l AS (SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY d),
x AS (SELECT DISTINCT d, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT w.d, string_agg(word, ' ' ORDER BY w.i) AS kept FROM w ANTI JOIN x ON x.d = w.d AND x.i = w.i GROUP BY w.d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (d) LEFT JOIN l USING (d) LEFT JOIN k USING (d)
"""
