"""Line deduplication by content-defined chunks, in DataFrame operations alone.

A document is its lines.  A hash that rolls over the hashes of WINDOW adjacent lines
ends a chunk where it falls into one residue class, so boundaries depend on nearby
content only and lines inserted elsewhere don't shift them.  FACTORS gives several such
hashes, each with chunks of its own: a passage of few lines that holds no whole chunk of
one holds one of another.  What is looked up in the corpus are these chunks of several
lines, and single lines of LONG characters, which are chunks by themselves, whatever
stands around them.

A chunk that occurs more than once is compared with its first occurrence, and the match
is extended line by line to both sides, MOST lines at most: beyond, the next whole chunk
is looked up itself.  Matches of several lines, or of one line of ``least`` characters,
go but for the first occurrence; matches that overlap or touch make one passage, and
passages of fewer than ``least`` characters stay.  Lines are compared by hashes first,
and the lines behind equal hashes byte by byte.

Only ids, places and hashes travel to be counted and compared; texts travel once by
document to meet their places, and candidate lines are made distinct within tasks first.
Chunks that hold more than a thousandth of all places each, at most a thousand, are
broadcast with their first occurrence, so no task gets all places of a common chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import Scratch

#: Lines that the rolling hash sees; mean lines of a chunk; most lines of a chunk and of
#: an extension; characters of the shortest passage that goes (50 words of three
#: letters), and of the shortest line that is looked up alone.
WINDOW, MEAN, MOST, LEAST, LONG = 2, 2, 8, 200, 40
# Factors of the rolling hashes, and the prime that they are reduced by.
FACTORS, PRIME = (31, 37, 41), 1_000_003
#: Chunks with more than this share of all places are hot; they are at most its inverse.
HOT = 0.001


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lines_of(text: Column) -> Column:
    """The lines of a text; null counts as empty."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(lines: Column) -> Column:
    """The hashes that boundaries are chosen by."""
    return F.transform(lines, lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long"))


def boundaries(hashes: Column, factor: int, window: int = WINDOW, mean: int = MEAN, most: int = MOST) -> Column:
    """The numbers (from 1) of the lines that end a chunk, the last line included.  Of
    adjacent numbers the first and the last end a chunk, so repeats of one line make
    chunks too."""

    def rolled(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for k in range(window):
            total = total + F.when(i > k, F.element_at(hashes, F.greatest(i - k, F.lit(1)))).otherwise(0) * factor**k
        return total % PRIME

    def bounded(stops: Column) -> Column:  # a chunk of more than ``most`` lines is cut
        def one(stop: Column, k: Column) -> Column:
            before = F.when(k > 0, F.element_at(stops, F.greatest(k, F.lit(1)))).otherwise(0)
            extra = F.when(stop - before > most, F.sequence(before + most, F.greatest(stop - 1, before + most), F.lit(most))).otherwise(F.expr("cast(array() as array<int>)"))
            return F.concat(extra, F.array(stop))

        return F.flatten(F.transform(stops, one))

    def merged(stops: Column) -> Column:  # adjacent chunks of one line are one chunk
        before = lambda k: F.when(k > 0, F.element_at(stops, F.greatest(k, F.lit(1)))).otherwise(0)
        after = lambda k: F.element_at(stops, F.least(k + 2, F.size(stops)))
        return F.filter(stops, lambda s, k: ~((s - before(k) == 1) & (after(k) - s == 1)))

    n = F.size(hashes)
    hit = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (rolled(i) % mean == 0))
    return _let(_let(hit, merged), bounded)


def chunks(lines: Column, window: int = WINDOW, mean: int = MEAN, most: int = MOST, long: int = LONG, pairs: bool = False) -> Column:
    """What is looked up of a text: its chunks of several lines and its long lines, as
    structs ``at`` (first line, from 1) and ``n`` (lines); with ``pairs`` every two
    adjacent lines, too."""

    def spans(stops: Column) -> Column:
        def one(stop: Column, k: Column) -> Column:
            before = F.when(k > 0, F.element_at(stops, F.greatest(k, F.lit(1)))).otherwise(0)
            return F.struct((before + 1).alias("at"), (stop - before).alias("n"))

        return F.filter(F.transform(stops, one), lambda c: c["n"] > 1)

    alone = F.filter(F.transform(lines, lambda line, k: F.when(F.length(line) >= long, F.struct((k + 1).alias("at"), F.lit(1).alias("n")))), lambda c: c.isNotNull())
    several = lambda hashes: F.concat(*[_let(boundaries(hashes, f, window, mean, most), spans) for f in FACTORS])
    two = F.slice(F.transform(lines, lambda line, k: F.struct((k + 1).alias("at"), F.lit(2).alias("n"))), F.lit(1), F.size(lines) - 1)
    return F.array_distinct(F.concat(_let(line_hashes(lines), several), alone, *([two] if pairs else [])))


def line_key(line: Column) -> Column:
    """The hash by which lines are told apart until their bytes are compared."""
    return F.xxhash64(line)


def _meet_first(scratch: Scratch, places: DataFrame, firsts: DataFrame, total: int) -> DataFrame:
    """Join places with the first occurrence of their chunk, the hot chunks by broadcast."""
    hot = scratch.keep(firsts.where(F.col("times") > HOT * total)).drop("times")  # fewer than 1 / HOT rows
    cold = firsts.where(F.col("times") <= HOT * total).drop("times")
    if hot.isEmpty():
        return places.join(cold, "key")
    own = F.broadcast(hot)
    return places.join(own, "key").unionByName(places.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key"))


def _places(base: DataFrame, key: Callable[[Column], Column], shape: tuple) -> DataFrame:
    """``id, h`` of a document and ``places``: its matches (``at, n, later``) with the
    first occurrence of a chunk, and those first occurrences (``later`` false)."""
    most, scratch = shape[2], Scratch()
    lines = base.withColumn("lines", lines_of(F.col("text"))).select("id", "h", F.transform("lines", key).alias("keys"), chunks(F.col("lines"), *shape).alias("chunks"))
    docs = scratch.keep(lines.dropDuplicates(["id", "h"]))
    spot = F.explode("chunks").alias("c")
    # a chunk's key is the hash of its lines' keys; where hashes fail, these are the lines
    own = F.slice("keys", F.col("c.at"), F.col("c.n"))
    every = scratch.keep(docs.select("id", "h", "keys", spot).select("id", "h", "c.at", "c.n", (F.xxhash64(own) if key is line_key else own).alias("key")))
    first = F.min(F.struct("id", "h", "at")).alias("first")
    repeated = every.groupBy("key").agg(F.count("*").alias("times"), first).where("times > 1")
    around = lambda at, n: [F.reverse(F.slice("keys", F.greatest(at - most, F.lit(1)), F.least(at - 1, F.lit(most)))), F.slice("keys", at + n, most)]
    keys = docs.select(F.col("id").alias("did"), F.col("h").alias("dh"), "keys")
    mine = lambda i, h: F.col(i).eqNullSafe(F.col("did")) & (F.col(h) == F.col("dh"))
    # firsts with the lines around them
    firsts = repeated.select("key", "times", F.col("first.id").alias("fid"), F.col("first.h").alias("fh"), F.col("first.at").alias("fat"))
    firsts = scratch.keep(firsts)
    flagged = _meet_first(scratch, every, firsts, every.count())
    later = flagged.where(~(F.col("id").eqNullSafe(F.col("fid")) & (F.col("h") == F.col("fh")) & (F.col("at") == F.col("fat"))))
    left, right = around(F.col("at"), F.col("n"))
    later = scratch.keep(later.join(keys, mine("id", "h")).select("key", "id", "h", "at", "n", left.alias("left"), right.alias("right")))
    known = firsts.join(keys, mine("fid", "fh"))
    size = later.groupBy("key").agg(F.first("n").alias("n"))  # equal for all places of a key
    fleft, fright = around(F.col("fat"), F.col("n"))
    known = scratch.keep(known.join(size, "key").select("key", "times", "fid", "fh", "fat", fleft.alias("fleft"), fright.alias("fright")))

    def shared(a: str, b: str) -> Column:  # equal lines from the chunk outwards
        same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
        stop = F.array_position(same, False)
        return F.when(stop > 0, stop.cast("int") - 1).otherwise(F.size(same))

    met = _meet_first(scratch, later, known, every.count()).withColumns({"l": shared("left", "fleft"), "r": shared("right", "fright")})
    met = scratch.keep(met.select("id", "h", "at", "n", "fid", "fh", "fat", "l", "r"))
    place = lambda at, l, r, later: F.struct((F.col(at) - F.col(l)).alias("at"), (F.col("n") + F.col(l) + F.col(r)).alias("n"), F.lit(later).alias("later")).alias("p")  # noqa: E731, E741
    gone = met.select("id", "h", place("at", "l", "r", True))
    kept = met.groupBy("fid", "fh", "fat", "n").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    both = gone.unionByName(kept.select(F.col("fid").alias("id"), F.col("fh").alias("h"), place("fat", "l", "r", False)))
    return scratch.result(both.groupBy("id", "h").agg(F.collect_set("p").alias("places")))  # of one document


def _covered(places: Column) -> Column:
    """The sorted numbers of the lines of all places."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p["at"], p["at"] + p["n"] - 1)))))


def _passages(covered: Column) -> Column:
    """Runs of adjacent numbers as structs ``a, b`` (both included)."""
    starts = F.filter(covered, lambda p, k: (k == 0) | (F.element_at(covered, F.greatest(k, F.lit(1))) != p - 1))
    ends = F.filter(covered, lambda p, k: (k + 1 == F.size(covered)) | (F.element_at(covered, F.least(k + 2, F.size(covered))) != p + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, window: int = WINDOW, mean: int = MEAN, most: int = MOST, long: int = LONG, pairs: bool = False) -> DataFrame:
    """The documents with repeated passages removed: all columns of ``docs``, the text
    without them, and ``n_lines``, ``n_removed`` (lines).

    The first occurrence of a chunk, by id (null first), text hash and place, stays.  Rows
    equal in id and text are one document: they keep and lose the same lines.  A null
    text stays null; a text that loses every line becomes empty; an empty table gives an
    empty result; no row is dropped.  Columns of ``docs`` named ``n_lines`` or
    ``n_removed`` are replaced; no other name clashes.  With ``pairs`` nothing that
    repeats is missed: a passage that holds no whole chunk is found by its pairs of lines.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.col(f"`{text_col}`")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    shape = (window, mean, most, long, pairs)

    def meet(places: DataFrame) -> DataFrame:
        own = places.select(F.col("id").alias("pid"), F.col("h").alias("ph"), "places")
        return base.join(own, F.col("id").eqNullSafe(F.col("pid")) & (F.col("h") == F.col("ph")), "left").withColumn("lines", lines_of(F.col("text")))

    met = meet(_places(base, line_key, shape))
    # byte comparison: candidate lines of equal hash that differ
    candidates = met.where("places IS NOT NULL").select(F.explode(F.transform(_covered(F.col("places")), lambda i: F.element_at("lines", i))).alias("line")).select(line_key(F.col("line")).alias("key"), "line")
    differ = candidates.distinct().groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    if not differ.isEmpty():  # hashes can't tell all lines apart: the lines themselves are the keys
        met = meet(_places(base, lambda line: line, shape))
    size = lambda at, n: F.length(F.array_join(F.slice("lines", at, n), "\n"))
    every = F.coalesce("places", F.expr("cast(array() as array<struct<at:int,n:int,later:boolean>>)"))
    later = F.filter(every, lambda p: p["later"] & ((p["n"] > 1) | (size(p["at"], p["n"]) >= least)))
    gone = _let(_covered(later), lambda covered: F.filter(_passages(covered), lambda p: size(p["a"], p["b"] - p["a"] + 1) >= least))
    out = met.withColumn("gone", gone)
    def between(p: Column, k: Column) -> Column:  # the lines before a passage, after the one before it
        after = F.when(k > 0, F.element_at("gone", F.greatest(k, F.lit(1)))["b"]).otherwise(0)
        return F.slice("lines", after + 1, p["a"] - after - 1)

    tail = F.slice("lines", F.element_at("gone", -1)["b"] + 1, F.size("lines"))
    stays = F.array_join(F.concat(F.flatten(F.transform("gone", between)), tail), "\n")
    shown = F.when(F.size("gone") == 0, F.col("text")).otherwise(stays)
    removed = F.aggregate("gone", F.lit(0).cast("long"), lambda n, p: n + p["b"] - p["a"] + 1)
    return out.select(*[shown.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept], F.size("lines").cast("long").alias("n_lines"), removed.alias("n_removed"))


def _rolled_sql(factor: int) -> str:
    return " + ".join(f"(CASE WHEN i > {k} THEN hs[i - {k}] ELSE 0 END) * {factor**k}" for k in range(WINDOW))


def _ends_sql() -> str:
    one = "SELECT d, lines, {f} AS f, list_filter(range(1, len(lines) + 1), lambda i: i = len(lines) OR ({rolled}) % {prime} % {mean} = 0) AS ends FROM h"
    return " UNION ALL ".join(one.format(f=f, rolled=_rolled_sql(f), prime=PRIME, mean=MEAN) for f in FACTORS)


def _shared_sql(own: str, first: str) -> str:
    """Equal lines outwards, at most MOST; ``own``, ``first``: numbers of the j-th line."""
    same = f"list_transform(range(1, {MOST + 1}), lambda j: coalesce({own} >= 1 AND {first} >= 1 AND y.lines[{own}] = x.lines[{first}], false))"
    return f"coalesce(nullif(list_position({same}, false), 0) - 1, {MOST})"


#: The query's result in DuckDB: the same chunks, compared by their text itself.
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS d, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
h AS (SELECT d, lines, list_transform(lines, lambda l: cast('0x' || substr(md5(l), 1, 7) AS BIGINT)) AS hs FROM d),
e0 AS ({_ends_sql()}),
e AS (SELECT d, lines, list_filter(ends, lambda s, k: NOT (k < len(ends) AND s - (CASE WHEN k > 1 THEN ends[k - 1] ELSE 0 END) = 1 AND ends[k + 1] - s = 1)) AS ends FROM e0),
s AS (SELECT d, lines, unnest(ends) AS stop, unnest(list_prepend(0, ends[:-2])) AS before FROM e),
c AS (SELECT d, lines, unnest(range(before, stop, {MOST})) AS a, stop FROM s),
k AS (SELECT DISTINCT d, a + 1 AS pos, least({MOST}, stop - a) AS n FROM c WHERE least({MOST}, stop - a) > 1
  UNION ALL SELECT d, pos, 1 FROM (SELECT d, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d) WHERE length(line) >= {LONG}),
f AS (SELECT k.*, first_value(k.d) OVER w AS fd, first_value(pos) OVER w AS fpos FROM k JOIN d USING (d) WINDOW w AS (PARTITION BY n, array_to_string(lines[pos:pos + n - 1], chr(10)) ORDER BY k.d, pos)),
m AS (SELECT f.d, f.pos, n, y.lines, {_shared_sql('f.pos - j', 'f.fpos - j')} AS l, {_shared_sql('f.pos + n - 1 + j', 'f.fpos + n - 1 + j')} AS r
  FROM f JOIN d y ON y.d = f.d JOIN d x ON x.d = f.fd WHERE (f.d, f.pos) <> (f.fd, f.fpos)),
p AS (SELECT DISTINCT d, unnest(range(pos - l, pos + n + r)) AS i FROM m WHERE n + l + r > 1 OR length(lines[pos]) >= {LEAST}),
g AS (SELECT d, i, i - row_number() OVER (PARTITION BY d ORDER BY i) AS island FROM p),
w AS (SELECT d, min(i) AS a, max(i) AS b FROM g GROUP BY d, island),
x AS (SELECT w.d, unnest(range(a, b + 1)) AS i FROM w JOIN d USING (d) WHERE length(array_to_string(lines[a:b], chr(10))) >= {LEAST}),
l AS (SELECT d, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
t AS (SELECT l.d, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (x.i IS NULL), '') AS joined, count(*) AS n_lines, count(x.i) AS n_removed
      FROM l LEFT JOIN x ON x.d = l.d AND x.i = l.i GROUP BY l.d)
SELECT doc_id, CASE WHEN n_removed = 0 THEN text ELSE joined END AS text, n_lines, n_removed FROM t JOIN d USING (d)
"""
_CHUNKS = f"SELECT DISTINCT d, a + 1 AS pos, least({MOST}, stop - a) AS n FROM c WHERE least({MOST}, stop - a) > 1\n"
#: The same with ``pairs``.
WHOLE = ORACLE.replace(_CHUNKS, f"SELECT d, a + 1 AS pos, least({MOST}, stop - a) AS n FROM c WHERE least({MOST}, stop - a) > 1 UNION SELECT d, unnest(range(1, len(lines))), 2 FROM d\n")
