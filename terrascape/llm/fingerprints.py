"""Canonical exact document fingerprints.

The canonical form of a text is its compatibility-composed, case-folded form with
white space folded to single blanks.  Its fingerprint is the 128-bit XXH3 digest;
digests held by several rows are grouped by (digest, canonical bytes), so different
texts never share a fingerprint, even where their digests are equal.
"""

from __future__ import annotations

import hashlib
import unicodedata

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrascape.llm.common import durable, map_text, marked, marks, parts_for, rows_of, schema


def canonical(text: str | None) -> str:
    """The canonical form; null counts as empty."""
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return " ".join(folded.split())


def digest(form: str) -> str:
    return xxhash.xxh3_128_hexdigest(form.encode("utf-8", "surrogatepass"))


def digests(texts: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` and the ``digest`` of the canonical text of each row."""
    fields = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in id_cols)
    return map_text(texts, [*id_cols, text_col], schema(f"{fields}, digest string"), lambda: lambda step: [*step[:-1], [digest(canonical(t)) for t in step[-1]]])


def forms_of(texts: DataFrame, held: bytes, text_col: str = "text") -> DataFrame:
    """``digest, form`` of the rows whose digest is marked; copies meet before the
    exchange that follows (``distinct`` groups within a task first)."""
    sent = texts.sparkSession.sparkContext.broadcast(held)

    def make():
        def run(step):
            names, forms = [], []
            for t in step[0]:
                d = digest(f := canonical(t))
                if marked(sent.value, d):
                    names.append(d), forms.append(f)
            return [names, forms]

        return run

    return map_text(texts, [text_col], schema("digest string, form string"), make).distinct()


def clashes(forms: DataFrame) -> DataFrame:
    """Byte comparison inside equal buckets: ``digest, form, variant`` of the digests
    that more than one of the distinct ``forms(digest, form)`` has, numbered from 0
    in order of the forms' bytes."""
    several = forms.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    order = Window.partitionBy("digest").orderBy(F.col("form").cast("binary"))
    return forms.join(several, "digest", "left_semi").withColumn("variant", F.row_number().over(order) - 1)


def _shared(light: DataFrame, *columns: str) -> DataFrame:
    rows = light.select(F.explode(F.array(*columns)).alias("digest")) if len(columns) > 1 else light.select(F.col(columns[0]).alias("digest"))
    return rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")


def _name(digest_col, variant_col) -> F.Column:
    return F.when(variant_col > 0, F.concat_ws(".", digest_col, variant_col.cast("string"))).otherwise(digest_col)


def fingerprint(texts: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """One row per row: ``id_cols`` and ``fingerprint``.

    Null and empty texts share the fingerprint of the empty form.  Rows are equal in
    fingerprint exactly if they are equal in canonical bytes: where digests collide
    the fingerprint is the digest, a dot and the variant.  Repeated rows are repeated;
    other columns are not read.
    """
    light = durable(digests(texts, id_cols, text_col))
    variants = durable(clashes(forms_of(texts, marks(_shared(light, "digest")), text_col)))
    if variants.isEmpty():  # no collision among all rows
        return light.withColumnRenamed("digest", "fingerprint")
    fields = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in id_cols)

    def make():
        def run(step):
            forms = [canonical(t) for t in step[-1]]
            return [*step[:-1], [digest(f) for f in forms], forms]

        return run

    full = map_text(texts, [*id_cols, text_col], schema(f"{fields}, digest string, form string"), make)
    named = full.join(variants, ["digest", "form"], "left")
    return named.select(*id_cols, _name(F.col("digest"), F.col("variant")).alias("fingerprint"))


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, checks: bool = False) -> DataFrame:
    """Each document beside its edit: the last quarter of its code points replaced by
    as many first ones of the next document in ascending id (after the last: the
    first).  Columns: ``id, next_id, n_chars, edited_sha256``, the digests ``digest,
    edited_digest, next_digest`` (with ``checks``, each digest is followed by a dot and
    the SHA-256 of the form) and ``same`` (the edit's form is the document's).

    Texts travel once, by range of id; a task streams its sorted range, holding two
    texts at a time, and leaves its first and last document, which meet those of the
    neighbouring ranges in a small second step.  Equal ids are ordered by a hash of the
    text, then by text; null ids come first; null texts count as empty.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = parts or parts_for(d)
    dealt = d.repartitionByRange(parts, "id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")
    names = "id long, next_id long, n_chars long, edited_sha256 string, digest string, edited_digest string, next_digest string, same boolean"
    texts = [pa.string()] * 4
    row = [("id", pa.int64()), ("next_id", pa.int64()), ("n_chars", pa.int64()), *zip(("edited_sha256", "digest", "edited_digest", "next_digest"), texts), ("same", pa.bool_())]
    ends = [("part", pa.int32()), ("first_id", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    fields = pa.schema([*row, *ends])

    def name(form):
        return digest(form) + (f".{hashlib.sha256(form.encode('utf-8', 'surrogatepass')).hexdigest()}" if checks else "")

    def beside(i, text, form, next_id, next_text, next_name):
        n, k = len(text), len(text) // 4
        edited = text[: n - k] + next_text[:k]
        made = canonical(edited)
        return i, next_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), name(form), name(made), next_name, made == form

    def shown(rows, schema):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    def run(batches):
        first = last = None  # id, text and form; the last one waits for the next row
        for batch in batches:
            out: list[tuple] = []
            for at in range(0, batch.num_rows, 64):
                for i, text in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]):
                    here = (i, text, canonical(text))
                    if last is not None:
                        out.append((*beside(*last, i, text, name(here[2])), None, None, None, None))
                    first, last = first or here, here
            yield shown(out, fields)
        if last is not None:  # the ends of the range
            yield shown([(last[0], *[None] * 7, TaskContext.get().partitionId(), first[0], first[1], last[1])], fields)

    streamed = durable(dealt.mapInArrow(run, T.StructType.fromDDL(f"{names}, part int, first_id long, first string, last string")))
    edge = streamed.where("part IS NOT NULL").select("part", "id", "first_id", "first", "last")
    order = Window.orderBy("part")  # a number for each range
    after = edge.select("part").withColumn("follows", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())))
    firsts = edge.select(F.col("part").alias("follows"), F.col("first_id").alias("next_id"), F.col("first").alias("next_text"))
    joined = edge.select("part", "id", "last").join(after, "part").join(firsts, "follows").select("id", "last", "next_id", "next_text")

    def close(batches):
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 64):
                rows = zip(*[c.to_pylist() for c in batch.slice(at, 64).columns])
                yield shown([beside(i, text, canonical(text), n, t, name(canonical(t))) for i, text, n, t in rows], pa.schema(row))

    columns = [c for c, _ in row]
    return streamed.where("part IS NULL").select(*columns).unionByName(joined.mapInArrow(close, T.StructType.fromDDL(names)))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``: likeness is 1 where fingerprints are equal, else 0."""
    light = durable(edits(docs, id_col, text_col))
    held = marks(_shared(light, "digest", "edited_digest"))
    forms = forms_of(docs, held, text_col)
    # edits whose digest is shared and whose form is not their document's: made again from the two texts
    repeat = light.where("NOT same").join(_shared(light, "digest", "edited_digest").withColumnRenamed("digest", "edited_digest"), "edited_digest", "left_semi")
    pairs = durable(repeat.select("id", "next_id", "n_chars"))
    if not pairs.isEmpty():
        few = rows_of(docs, pairs.select(F.explode(F.array("id", "next_id")).alias("id")).where("id IS NOT NULL").distinct(), id_col, text_col)
        both = pairs.join(few, "id").join(few.select(F.col("id").alias("next_id"), F.col("text").alias("next_text")), "next_id")
        kept = F.col("n_chars") - F.floor(F.col("n_chars") / 4)
        made = both.select(F.concat(F.substring("text", F.lit(1), kept.cast("int")), F.substring("next_text", F.lit(1), (F.col("n_chars") - kept).cast("int"))).alias("text"))
        forms = forms.unionByName(forms_of(made, held)).distinct()
    variants = durable(clashes(forms))
    columns = ("digest", "edited_digest", "next_digest")
    if not variants.isEmpty():  # name the variants by the forms' SHA-256
        light = edits(docs, id_col, text_col, checks=True)
        known = variants.where("variant > 0").select(F.concat_ws(".", "digest", F.sha2(F.col("form").cast("binary"), 256)).alias("full"), "variant")
        for c in columns:
            light = light.join(known.withColumnRenamed("full", c), c, "left").withColumn(c, _name(F.substring_index(c, ".", 1), F.col("variant"))).drop("variant")
    same = lambda c: F.when(F.col("digest") == F.col(c), 1.0).otherwise(0.0)
    return light.select("id", "n_chars", "edited_sha256", F.col("digest").alias("fingerprint"), F.col("edited_digest").alias("edited_fingerprint"), same("edited_digest").alias("near_edited"), same("next_digest").alias("near_next"))
