"""Language identification by language-bitmask n-gram filters.

Every language has a Bloom filter of its frequent character n-grams.  The filters
are bit-sliced: slot ``s`` of all filters is one machine word whose bit ``l`` is
slot ``s`` of language ``l``, so the AND of an n-gram's slots is the set of all
languages whose filter holds it.  A document's popcount per language is corrected
for that filter's false-positive rate, and the largest corrected share decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import filter_text, map_text, schema

#: Bound of the fit: expected labelled rows per language (chosen by a hash of the id).
FIT_ROWS = 400
#: N-grams held per language and order; slots of the sliced filter; probes a lookup makes.
TOP, ORDERS, SLOT_BITS, PROBES = 3000, (3, 4), 18, 2
#: Code points handled at once; a longer text is counted in several such windows, which
#: share the n-grams' ends, so its counts are those of the whole text.
PIECE = 1 << 20
UNKNOWN = "und"


@dataclass
class Filters:
    """Fitted state: ``languages``, ``slots[slot, word]`` of 64-language words, and
    each language's false-positive rate."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray


_letters: np.ndarray | None = None


def _codes(text: str) -> np.ndarray:
    """Code points of lower-cased letters; everything else is 0."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters[codes], codes, 0).astype(np.uint64)


def _grams(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the n-grams of one order whose inner characters are letters
    (an end may be a word boundary)."""
    m = max(0, len(codes) - n + 1)
    h, inner = np.full(m, n, np.uint64), np.ones(m, bool)
    for i in range(n):
        h = (h ^ codes[i : m + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if 0 < i < n - 1:
            inner &= codes[i : m + i] > 0
    if n == 4:  # a 4-gram wholly inside or at one end of a word
        inner &= (codes[:m] > 0) | (codes[3 : m + 3] > 0)
    at = np.flatnonzero(inner)
    return h[at], at


def _probe(slots: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    found = slots[(h & mask).astype(np.int64)]
    for k in range(1, PROBES):
        found = found & slots[((h >> np.uint64(24 * k)) & mask).astype(np.int64)]
    return found


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS) -> Filters:
    """Fit on about ``rows`` labelled rows of each language, chosen by a hash of the
    id; rows with a null text or language take no part.  Only that bounded sample
    reaches the driver."""
    labelled = labelled.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    counts = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Filters([], np.zeros((1 << SLOT_BITS, 1), np.uint64), np.zeros(0))
    dice, chosen = F.pmod(F.xxhash64(F.col("i"), F.lit("fit")), F.lit(1_000_000)), F.lit(False)
    for name in languages:
        chosen = chosen | ((F.col("l") == name) & (dice < int(1_000_000 * min(1, rows / counts[name])) + 1))
    grams: dict[tuple[str, int], list[np.ndarray]] = {(name, n): [] for name in languages for n in ORDERS}
    for row in labelled.where(chosen).select("l", "t").toLocalIterator():
        codes = _codes(f" {row['t'].lower()} ")
        for n in ORDERS:
            grams[row["l"], n].append(_grams(codes, n)[0])
    words = -(-len(languages) // 64)
    slots = np.zeros((1 << SLOT_BITS, words), np.uint64)
    mask = np.uint64((1 << SLOT_BITS) - 1)
    for k, name in enumerate(languages):
        for n in ORDERS:
            if not grams[name, n]:
                continue
            h, times = np.unique(np.concatenate(grams[name, n]), return_counts=True)
            top = h[np.lexsort((h, -times))[:TOP]]
            for p in range(PROBES):
                np.bitwise_or.at(slots[:, k // 64], ((top >> np.uint64(24 * p)) & mask).astype(np.int64), np.uint64(1 << (k % 64)))
    set_bits = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return Filters(languages, slots, set_bits**PROBES)


def evidence(filters: Filters, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: corrected hits by language, n-grams, letters."""
    langs, n = len(filters.languages), len(texts)
    hits, total, letters = np.zeros((n, langs)), np.zeros(n), np.zeros(n, np.int64)
    pieces, ends, size = [" "], [0], 1
    where: list[int] = []

    def add(h: np.ndarray, of: np.ndarray, owner: np.ndarray) -> None:
        np.add.at(total, owner, np.bincount(of, minlength=len(owner)))
        found = _probe(filters.slots, h)
        for k in range(langs):
            bit = (found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            np.add.at(hits[:, k], owner, np.bincount(of, weights=bit, minlength=len(owner)))

    def count() -> None:
        nonlocal pieces, ends, size
        codes = _codes("".join(pieces))
        owner, starts = np.array(where), np.array(ends)
        letters_at = np.add.reduceat(np.append(codes > 0, 0).astype(np.int64), starts) if len(starts) else []
        np.add.at(letters, owner, letters_at)
        for n in ORDERS:
            h, at = _grams(codes, n)
            add(h, np.searchsorted(starts, at, "right") - 1, owner)
        pieces, ends, size = [" "], [0], 1
        where.clear()

    def count_long(i: int, text: str) -> None:  # a window at a time; n-grams begin in it and may end after it
        text = f" {text} "
        for a in range(0, len(text), PIECE):
            codes = _codes(text[a : a + PIECE + max(ORDERS) - 1])
            letters[i] += np.count_nonzero(codes[:PIECE])
            for n in ORDERS:
                h, _ = _grams(codes[: PIECE + n - 1], n)
                add(h, np.zeros(len(h), np.int64), np.array([i]))

    for i, text in enumerate(texts):
        text = (text or "").lower()
        if len(text) > PIECE:
            count_long(i, text)
        elif text:
            if where:
                ends.append(size - 1)  # a text's n-grams begin with the blank before it
            where.append(i)
            pieces += [text, " "]
            size += len(text) + 1
            if size >= PIECE:
                count()
    if where:
        count()
    rate = filters.false_rate if langs else np.zeros(0)
    fair = np.maximum(0, (hits - total[:, None] * rate) / np.maximum(1e-9, 1 - rate))
    return fair, total, letters


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``lang_pred``, ``score`` (0 to 1) and
    ``coverage`` (share of n-grams that the chosen language's filter holds).

    Null text, a text without a letter, or filters without a language give ``und``
    with score and coverage 0.  Ties go to the first language in order of name.
    Repeated rows give repeated results; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # size fixed by SLOT_BITS
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        filters = sent.value

        def run(step):
            ids, texts = step
            fair, total, letters = evidence(filters, texts)
            langs, scores, covers = [], [], []
            for i in range(len(ids)):
                if not letters[i] or not filters.languages:
                    langs.append(UNKNOWN), scores.append(0.0), covers.append(0.0)
                    continue
                best = int(np.argmax(fair[i]))
                share = (fair[i] / max(1.0, fair[i].max())) ** 4
                scores.append(float(share[best] / share.sum()) if share.sum() > 0 else 1.0 / len(filters.languages))
                langs.append(filters.languages[best])
                covers.append(float(min(1.0, fair[i][best] / max(1.0, total[i]))))
            return [ids, langs, scores, covers]

        return run

    return map_text(docs, [id_col, text_col], schema(f"`{id_col}` {kind}, lang_pred string, score double, coverage double"), make)


#: Share of a text's n-grams that its language must hold for the text to be of it.
COVERAGE = 0.05


def keep_identified(docs: DataFrame, filters: Filters, text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The rows, whole, whose text is in one of the languages: it has a letter, and
    at least ``coverage`` of its n-grams are in the best language's filter.  Filters
    without a language reject nothing that has a letter."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def make():
        filters = sent.value

        def run(texts):
            fair, total, letters = evidence(filters, texts)
            best = fair.max(axis=1) if filters.languages else total
            return [bool(n) and b >= coverage * t for n, b, t in zip(letters, best, total)]

        return run

    return filter_text(docs, text_col, make)


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
