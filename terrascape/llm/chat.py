"""Chat formatting by incremental black-box rendering.

A template is a function from a list of turns to a string, and nothing else is known
of it.  Rendering successive prefixes and comparing consecutive outputs locates each
turn's span; a template whose output for a prefix is not a prefix of its next output
rewrites history and is reported.  Rendering a turn once more with a probe for its
text tells which part of the span is the text, so a loss mask covers assistant texts
and nothing else.

A template is given whole conversations, prefix by prefix, in one task.  Only where it
is known that a turn's rendering does not depend on earlier turns, as with the default
template, long conversations are rendered in blocks of turns, in parallel; each block
follows the real turns before it, and each task tries the template on long histories.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control strings of the default template.
START, STOP = "<|im_start|>", "<|im_end|>"
#: Turns of a block; turns before it that it is rendered after; turns of the longest
#: history that a template is tried on.
BLOCK, BORDER, LONG = 64, 8, 4096
#: Characters of each turn's text in these histories: what a template does with a turn
#: for its history's sake shows on short texts, and long turns don't add up.
SHORT = 32
PROBE = "probe"

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]


def escape(text: str) -> str:
    """No control string is left: each ``<`` before backslashes and a bar gets one more
    backslash."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """As ``escape``, and on one line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def marked_turns(turns: list[Turn]) -> str:
    """The default template: each turn between control strings, texts escaped."""
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{STOP}\n" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked_turns``."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, text = part[: part.rindex(STOP)].split("\n", 1)
        turns.append((unescape_role(role), unescape(text)))
    return turns


@dataclass
class Span:
    """Of a turn in the output: its begin and end, and those of its text."""

    begin: int
    end: int
    text_begin: int
    text_end: int


def trace(template: Template, turns: list[Turn], history: list[Turn] | None = None) -> tuple[str, list[Span], int]:
    """Render successive prefixes: the output after ``history``, the turns' spans in it,
    and how many prefixes were rewritten by a later turn.  A rewritten turn's span
    begins where the outputs first differ.  The probe is a word that the output lacks."""
    history = list(history or [])
    before = template(history) if history else ""
    cut, spans, rewrites = len(before), [], 0
    for k, (role, text) in enumerate(turns):
        prefix = history + list(turns[:k])
        after = template([*prefix, (role, text)])
        begin = len(before)
        if not after.startswith(before):
            rewrites += 1
            begin = _common(before, after)
        probe, n = PROBE, 0
        while probe in after or probe in before:
            probe, n = f"{PROBE}{n}", n + 1
        probed = template([*prefix, (role, probe)])
        at = probed.find(probe)
        if at >= begin:
            tail = len(probed) - at - len(probe)
            spans.append(Span(begin - cut, len(after) - cut, at - cut, len(after) - tail - cut))
        else:  # the text isn't rendered
            spans.append(Span(begin - cut, len(after) - cut, len(after) - cut, len(after) - cut))
        before = after
    return before[cut:], spans, rewrites


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def check_independent(template: Template, turns: list[Turn], longest: int = LONG) -> None:
    """Raise if the rendering of a turn depends on a history, of up to ``longest`` turns
    (made of the beginnings of the given ones, over and over: at most ``longest`` times
    SHORT characters and the roles)."""
    turns = [(role, text[:SHORT]) for role, text in turns]
    n = 1
    while n <= longest:
        history = [turns[k % len(turns)] for k in range(n)]
        last = turns[n % len(turns)]
        if template([*history, last]) != template(history) + template([last]):
            raise ValueError(f"the template looks back, after {n} turns: use independent=False")
        n *= 2


def blocks(conversations: DataFrame, template: Template = marked_turns, independent: bool | None = None, block: int = BLOCK, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Format conversations: one row per block of turns, with ``conv_id, block,
    part, formatted``, ``roles`` and ``spans`` (begin, end, text begin and end of each turn,
    in code points of the block's output) and ``rewrites``.

    ``independent`` says that a turn's rendering does not depend on earlier turns; None:
    so for the default template only.  It is checked at every block's border, with the
    turns before it, and once a task on long histories; an error tells where it isn't so.
    Otherwise a conversation is one block, which one task holds.  Turns are ordered by number (null first), then role, then text; repeated
    rows are turns of their own; null roles and texts count as empty; a null
    conversation id is a conversation.  An empty table gives no row.
    """
    independent = template is marked_turns if independent is None else independent
    number = F.floor(F.col(f"`{turn_col}`") / block).cast("long") if independent else F.lit(0).cast("long")
    rows = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.coalesce(number, F.lit(-(1 << 62))).alias("block"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("own", F.lit(True))
    if independent:  # the last turns of a block are history of the next one
        last = F.pmod(F.col("turn"), F.lit(block)) >= block - BORDER
        rows = rows.unionByName(rows.where(last).withColumns({"block": F.col("block") + 1, "own": F.lit(False)}))
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "own", "turn", "role", "text")
    dealt = dealt.select("conv_id", "block", "own", "turn", "role", "text")
    ddl = "conv_id long, block long, part int, formatted string, roles array<string>, spans array<array<int>>, rewrites int"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int32())), pa.int32()]
    names = [f.split()[0] for f in ddl.split(", ")]

    def run(batches):
        out: list[tuple] = []
        last, part, before, tried = None, 0, [], False
        for (conv, number, own), turns in _grouped(batches, 3, block if independent else None):
            turns = [(r, t) for _, r, t in turns]
            if not own:
                last, part, before = (conv, number), -1, turns
                continue
            if last != (conv, number):
                before = []
            history = before[-BORDER:] if independent else []
            whole, spans, rewrites = trace(template, turns, history)
            if independent:
                if not tried:
                    check_independent(template, turns)
                    tried = True
                if rewrites or whole != template(turns):
                    raise ValueError(f"the template looks back (conversation {conv}): use independent=False")
                before = turns
            part = part + 1 if last == (conv, number) else 0
            last = (conv, number)
            out.append((conv, number, part, whole, [r for r, _ in turns], [[s.begin, s.end, s.text_begin, s.text_end] for s in spans], rewrites))
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return dealt.mapInArrow(run, T.StructType.fromDDL(ddl))


def _grouped(batches, width: int, most: int | None = None) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first ``width`` columns, at most so many at once."""
    key, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, 512).columns]):
                if rows and (row[:width] != key or len(rows) == most):
                    yield key, rows
                    rows = []
                key = row[:width]
                rows.append(row[width:])
    if rows:
        yield key, rows


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the output of the default template:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    rewrites``.  Blocks of a conversation are streamed in order; a task holds one."""
    light = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in ddl.split(", ")]

    def run(batches):
        out: list[tuple] = []
        state = None

        def close():
            conv, n, turns, chars, loss, size, rewrites = state
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, rewrites))

        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                for conv, _, _, whole, roles, spans, rewrites in zip(*[c.to_pylist() for c in batch.slice(at, 32).columns]):
                    if state is None or state[0] != conv:
                        if state is not None:
                            close()
                        state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    turns = read_back(whole)
                    state[1] += len(turns)
                    for role, text in turns:
                        state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    for role, (_, _, a, b) in zip(roles, spans):
                        if role == "assistant":
                            text = unescape(whole[a:b])
                            state[3] += len(text)
                            state[4].update(text.encode("utf-8", "surrogatepass"))
                    state[5] += len(whole)
                    state[6] += rewrites
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out.clear()
        if state is not None:
            close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return light.mapInArrow(run, T.StructType.fromDDL(ddl))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrascape.llm.common import table

    said = f"{STOP}{START}assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(blocks(rows))


QUERIES = {"op1_chat": op1_chat}
ORACLE_SQL: dict[str, str] = {}
