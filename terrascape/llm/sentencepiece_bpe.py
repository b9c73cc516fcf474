"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Distinct words are laid out as one flat numpy array of symbol ids with a segment id
per symbol.  A round finds each word's pair of least rank (a segmented minimum),
merges all leftmost non-overlapping occurrences of that pair at once, and compacts
the arrays; words without a mergeable pair leave.  Where a merge would create a pair
that precedes the words' remaining merges, only the leftmost one is done in that
round, so the result is that of the sequential algorithm.

A text is cut where no piece of the vocabulary reaches across, so its ids are those of
its words, and a word met before is not merged again.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import map_text, schema

BLANK = "▁"
#: Distinct words of a generation: a task remembers the last two generations.
MEMORY = 200_000
#: Words merged together: their arrays stay in the processor's cache.
BATCH = 16_384
NONE = np.iinfo(np.int64).max


class Model:
    """Vocabulary of a BPE model file with byte fallback, read through the library."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.end, self.unknown = sp.eos_id(), sp.unk_id()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        special = self.control | set(self.byte_ids) | {self.unknown}
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in special}
        scores = {i: sp.get_score(i) for i in self.id_of.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # every way in which a piece is made of two pieces, sorted by the packed pair
        pairs = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (order[scores[i]], i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = keys
        self.pair_rank = np.array([pairs[int(k)][0] for k in keys], np.int64)
        self.pair_piece = np.array([pairs[int(k)][1] for k in keys], np.int64)
        # a hash index over the pairs: one probe decides nearly always
        self.bits = 20
        slot = self._slot(keys)
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.table[slot] = np.arange(len(keys))
        clash = self.table[slot] != np.arange(len(keys))
        self.clash_keys = keys[clash]
        self.clash_at = np.flatnonzero(clash)
        self.word = re.compile(self._word_pattern())

    def _word_pattern(self) -> str:
        """Where no piece joins the characters on both sides, a text can be cut: after
        and before characters that no longer piece has, before blanks, and (if the
        vocabulary has no piece across) between letters and other characters."""
        long = [p.lstrip(BLANK) for p in self.id_of if len(p) > 1]
        joined = set("".join(p for p in self.id_of if len(p) > 1))
        alone = "".join(re.escape(c) for c in sorted({*self.id_of, "\n"} - joined) if len(c) == 1 and c.isascii())
        letter = re.compile(r"[^\W\d_]")
        across = {(a, b) for p in long for a, b in zip(p, p[1:]) if bool(letter.match(a)) != bool(letter.match(b))}
        odd = {c for pair in across for c in pair if letter.match(c) and not c.isalpha()}  # such as superior digits
        still = {(a, b) for p in long for a, b in zip(p, p[1:]) if (bool(letter.match(a)) and a not in odd) != (bool(letter.match(b)) and b not in odd)}
        if still or not alone:
            return f" *[^ {alone}]+| +|[{alone}]" if alone else " *[^ ]+| +"
        more = "".join(re.escape(c) for c in sorted(odd))
        other = f"[^\\w {alone}]|[_{more}]|(?![0-9])\\d"
        return f" *[^\\W\\d_{more}]+| *(?:{other})+|[{alone}]| +|."

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where the pair makes no piece) and piece of adjacent symbols."""
        keys = left << 32 | right
        keys[(left < 0) | (right < 0)] = -1
        at = self.table[self._slot(keys)]
        hit = (self.pair_keys[at] == keys) & (at >= 0)
        if len(self.clash_keys):
            miss = np.flatnonzero(~hit)
            k = np.minimum(np.searchsorted(self.clash_keys, keys[miss]), len(self.clash_keys) - 1)
            found = self.clash_keys[k] == keys[miss]
            at[miss[found]] = self.clash_at[k[found]]
            hit[miss[found]] = True
        rank = np.where(hit, self.pair_rank[at], NONE)
        return rank, np.where(hit, self.pair_piece[at], -1)


def merge(model: Model, words: list[str]) -> list[list[int]]:
    """The piece ids of each word (blanks written as BLANK); unknown characters as
    their bytes."""
    ids = model.id_of
    text = "".join(words)
    chars = sorted(set(text))
    code = np.array([ids.get(c, -2 - k) for k, c in enumerate(chars)], np.int64)  # below 0: chars[-2 - code]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = code[np.searchsorted(np.array([ord(c) for c in chars], np.uint32), points)] if len(text) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done_owner, done_symbol = [], []

    def rank_all(symbol, owner):
        rank, piece = np.full(len(symbol), NONE), np.full(len(symbol), -1)
        if len(symbol) > 1:
            same = owner[1:] == owner[:-1]
            r, p = model.lookup(symbol[:-1], symbol[1:])
            rank[:-1], piece[:-1] = np.where(same, r, NONE), p
        return rank, piece

    rank, piece = rank_all(symbol, owner)
    while len(symbol):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[first, len(symbol)])
        least = np.minimum.reduceat(rank, first)
        live = np.repeat(least != NONE, size)
        if not live.all():  # compaction: words without a pair are done
            done_owner.append(owner[~live]), done_symbol.append(symbol[~live])
            symbol, owner, rank, piece = symbol[live], owner[live], rank[live], piece[live]
            continue
        least = np.repeat(least, size)
        at = np.flatnonzero(rank == least)
        head = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
        lead = np.repeat(piece[at[head]], np.diff(np.r_[np.flatnonzero(head), len(at)]))
        keep = piece[at] == lead  # of equal ranks the piece of the leftmost pair
        at, head = at[keep], head[keep]
        if len(at) > 1:  # in a run of overlapping occurrences every second one
            begins = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])]
            run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            odd = (np.arange(len(at)) - run) % 2 == 1
            at, head = at[~odd], head[~odd]
        # pairs that a merge creates while later occurrences still stand
        new, who, r = piece[at], owner[at], rank[at]
        before = symbol[np.maximum(at - 1, 0)].copy()
        if len(at) > 1:
            joined = np.r_[False, (at[1:] == at[:-1] + 2) & (who[1:] == who[:-1])]
            before = np.where(joined, np.r_[-1, new[:-1]], before)
        left_ok = (at > 0) & (owner[np.maximum(at - 1, 0)] == who)
        after_at = np.minimum(at + 2, len(symbol) - 1)
        right_ok = (at + 2 < len(symbol)) & (owner[after_at] == who)
        left_rank = np.where(left_ok, model.lookup(before, new)[0], NONE)
        right_rank = np.where(right_ok, model.lookup(new, symbol[after_at])[0], NONE)
        early = (left_rank <= r) | (right_rank <= r)
        if early.any() and len(at) > 1:
            bad = np.zeros(int(who.max()) + 1, bool)
            bad[who[early]] = True
            pick = head | ~bad[who]
            at, new = at[pick], new[pick]
        symbol[at] = new
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        # only pairs beside a merge change
        moved = np.zeros(len(symbol), bool)
        moved[at] = True
        moved[np.maximum(at - 1, 0)] = True
        gone = at - 1
        gone = gone[(gone >= 0)]
        moved[gone[~stay[gone]] - 1] = True
        symbol, owner, rank, piece, moved = symbol[stay], owner[stay], rank[stay], piece[stay], moved[stay]
        change = np.flatnonzero(moved)
        nxt = np.minimum(change + 1, len(symbol) - 1)
        same = (change + 1 < len(symbol)) & (owner[nxt] == owner[change])
        r2, p2 = model.lookup(symbol[change], symbol[nxt])
        rank[change], piece[change] = np.where(same, r2, NONE), p2
    out: list[list[int]] = [[] for _ in words]
    if done_owner:
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        order = np.argsort(owner, kind="stable")
        owner, symbol = owner[order], symbol[order]
        starts = np.searchsorted(owner, np.arange(len(words) + 1))
        flat = symbol.tolist()
        plain = symbol.min() >= 0 if len(symbol) else True
        for k in range(len(words)):
            part = flat[starts[k] : starts[k + 1]]
            if not plain and min(part, default=0) < 0:
                part = [i for s in part for i in ([s] if s >= 0 else [model.byte_ids[b] for b in chars[-2 - s].encode("utf-8", "surrogatepass")])]
            out[k] = part
    return out


class Codec:
    """Encodes and decodes whole texts; remembers a bounded number of words, each
    with what ``entry`` makes of its ids."""

    def __init__(self, path: str, entry=tuple) -> None:
        self.model, self.entry = Model(path), entry
        self.memory: dict = {}
        self.older: dict = {}

    def _words(self, text: str) -> list[str]:
        return self.model.word.findall(" " + text.replace(BLANK, " ")) if text else []

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Split the texts and merge the words not met yet, all in one set of rounds."""
        split = [self._words(t) for t in texts]
        if len(self.memory) > MEMORY:
            self.memory, self.older = {}, self.memory
        memory, older, entry = self.memory, self.older, self.entry
        new = set().union(*split).difference(memory)
        again = new.intersection(older)
        memory.update((w, older[w]) for w in again)
        new = sorted(new - again, key=len)
        for a in range(0, len(new), BATCH):
            part = new[a : a + BATCH]
            memory.update((w, entry(ids)) for w, ids in zip(part, merge(self.model, [w.replace(" ", BLANK) for w in part])))
        return split

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        split = self.learn(texts)
        memory = self.memory
        return [[i for w in words for i in memory[w]] + [self.model.end] for words in split]

    def decode(self, ids, begin: bool = True) -> str:
        """The text of the ids: control ids vanish, runs of byte ids are UTF-8 (each
        byte that isn't becomes U+FFFD), and the first piece loses its blank (not so
        where the ids don't ``begin`` a text)."""
        m = self.model
        out: list[str] = []
        run = bytearray()
        first = begin
        for i in ids:
            if (b := m.byte_of.get(i)) is not None:
                run.append(b)
                first = False
                continue
            if run:
                out.append(utf8(bytes(run)))
                run.clear()
            if i in m.control:
                continue
            piece = " ⁇ " if i == m.unknown else m.pieces[i].replace(BLANK, " ")
            out.append(piece[1:] if first and piece[:1] == " " and i != m.unknown else piece)
            first = False
        if run:
            out.append(utf8(bytes(run)))
        return "".join(out)


def utf8(data: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that is part of no character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@functools.lru_cache(maxsize=2)
def codec_of(path: str, shown: bool = False) -> Codec:
    """One codec, and its bounded memory of words, for all tasks of a Python worker.
    With ``shown`` a word is kept as the number of its ids, the ids as text, and their
    text: a word holds whole characters, so the text of its ids is part of that of all."""
    if not shown:
        return Codec(path)
    codec = Codec(path, lambda ids: (len(ids), " ".join(map(str, ids)), codec.decode(ids, begin=False)))
    return codec


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``ids`` (array of int, the end id last).
    Null and empty texts give the end id alone; repeated rows give repeated results."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        codec = codec_of(model_path)
        return lambda step: [step[0], codec.encode([t or "" for t in step[1]])]

    return map_text(docs, [id_col, text_col], schema(f"`{id_col}` {kind}, ids array<int>"), make)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: the id and ``text``; null ids give null."""
    kind = encoded.schema[id_col].dataType.simpleString()
    joined = encoded.select(F.col(id_col), F.concat_ws(" ", F.col(ids_col)).alias("__ids"), F.col(ids_col).isNull().alias("__null"))

    def make():
        codec = codec_of(model_path)

        def run(step):
            keys, nulls, ids = step
            return [keys, [None if n else codec.decode([int(i) for i in x.split()]) for x, n in zip(ids, nulls)]]

        return run

    return map_text(joined, [id_col, "__null", "__ids"], schema(f"`{id_col}` {kind}, text string"), make)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: the id, ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``, without ids leaving the task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        codec = codec_of(model_path, shown=True)
        model = codec.model

        def run(step):
            keys, texts = step
            split = codec.learn([t or "" for t in texts])
            shown = codec.memory
            counts, encoded, decoded = [], [], []
            for words in split:
                said = [shown[w] for w in words]
                counts.append(sum([x[0] for x in said]) + 1)
                joined = " ".join([*[x[1] for x in said], str(model.end)])
                encoded.append(hashlib.sha256(joined.encode()).hexdigest())
                text = "".join([x[2] for x in said])
                decoded.append(hashlib.sha256(text[text[:1] == " " :].encode("utf-8", "surrogatepass")).hexdigest())
            return [keys, counts, encoded, decoded]

        return run

    return map_text(docs, [id_col, text_col], schema(f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"), make)
