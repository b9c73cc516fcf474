"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the classes of a clause's words.  *Insult* emits a weight at its
words and *threat* at its words where the clause states an intent; *target*, *negation*
and *reported speech* change what they emit, from before or after.  As what stands after
a word counts too, the clause is read from both ends: the product of the transducers'
states (``compose``, built once) runs forwards and backwards, and the two states that
meet at a word give its factor.  What is scored is the accepted clause, never a word by
itself; a document's score is a logistic function of its clauses' evidence.

The vocabulary of the insult transducer is learned: words and word stems (a stem
stands for any inflection) that mark labelled documents, taken greedily by the
documents they newly explain, beside a short fixed list.  The other classes are closed
lists in four languages.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascape.llm.common import filter_text, map_text, schema

#: Bound of the fit: expected rows of label 1 and of label 0 (chosen by a hash of the id).
FIT_TOXIC, FIT_CLEAN = 1200, 2000
#: Lengths of learned stems; labelled documents that an entry needs at least.
STEM, SUPPORT = range(3, 9), 2
THRESHOLD = 0.3

# Seed words of each class (lower case), in English, German, French, Spanish.
SEEDS = {
    "insult": """idiot idiots moron morons stupid worthless pathetic disgusting loser losers scum trash imbecile vermin
        idiotin idioten dummkopf trottel arschloch abschaum versager
        idiote imbécile imbéciles abruti abrutie crétin connard connasse ordure
        idiota idiotas imbécil imbéciles estúpido estúpida escoria basura""",
    "threat": """kill hurt destroy beat shoot stab burn strangle
        töten umbringen verletzen verprügeln erschießen erwürgen
        tuer frapper détruire brûler égorger étrangler
        matar matarte golpear destruir quemar estrangular""",
    "intent": """will gonna shall going i'll we'll
        werde werden wird wollen
        vais vas allons vont
        voy vas vamos van""",
    "target": """you your you're u he she they them him her those these everyone
        du dich dir euch dein deine er sie
        tu toi vous il elle ils vos
        tú ti usted ustedes él ella ellos""",
    "negation": """not never no isn't aren't wasn't without hardly
        nicht kein keine keinen keiner nie niemals
        pas jamais aucun aucune nullement
        no nunca jamás ningún ninguna tampoco""",
    "report": """said says wrote claimed called quoted according reported alleged
        sagte sagt schrieb behauptete nannte zitierte laut angeblich
        dit écrivit affirme déclare selon appelle
        dijo dice escribió afirmó llamó según""",
}
# Weight of an accepted clause, and factors of the modifying transducers.
WEIGHT = {"insult": 1.0, "threat": 2.0, "target": 1.25, "negation": 0.5, "report": 0.5}

CLAUSE_ENDS = ".!?;\n|"
WORD = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)*")
END = re.compile("[.!?;\n|]")
CLASSES = ("other", "insult", "threat", "intent", "target", "negation", "report")
#: Words on either side that a negation reaches.
REACH = 3


@dataclass
class Grammar:
    """Fitted state: weights of whole words and of stems, and the logistic curve."""

    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 2.0
    base: float = -3.0
    off: frozenset = frozenset()  # names of transducers that are left out


def _latch(name: str):
    """Whether a word of the class was met."""
    return lambda state, c: 1 if CLASSES[c] == name else state


def _countdown(name: str):
    """The words that the class still reaches."""
    return lambda state, c: REACH if CLASSES[c] == name else max(0, state - 1)


#: Each transducer's step, from a state (0 at first) by a class to a state.
STEPS = {"insult": lambda state, c: 0, "threat": _latch("intent"), "target": _latch("target"), "negation": _countdown("negation"), "report": _latch("report")}


def emit(name: str, before: int, after: int, c: int) -> float:
    """What one transducer contributes at a word of class ``c`` between its two states:
    the weight that insult or threat emits there (0: none), the others' factor."""
    if name == "insult":
        return WEIGHT[name] * (CLASSES[c] == "insult")
    if name == "threat":
        return WEIGHT[name] * (CLASSES[c] == "threat" and bool(before or after))
    return WEIGHT[name] if before or after else 1.0


def compose(off: frozenset = frozenset()) -> tuple[list[list[int]], list[list[list[float]]]]:
    """The product: ``move[state][class]`` is the next state, for either direction, and
    ``factor[state before][state after][class]`` what a word emits (0: nothing)."""
    names = list(STEPS)
    start = (0,) * len(names)
    index, move, todo = {start: 0}, [], [start]
    while todo:
        state, row = todo.pop(0), []
        for c in range(len(CLASSES)):
            after = tuple(STEPS[n](s, c) for n, s in zip(names, state))
            if after not in index:
                index[after] = len(index)
                todo.append(after)
            row.append(index[after])
        move.append(row)

    def one(x: tuple, y: tuple, c: int) -> float:
        said = {n: emit(n, i, j, c) for n, i, j in zip(names, x, y) if n not in off}
        found = said.pop("insult", 0.0) + said.pop("threat", 0.0)
        return found * math.prod(said.values())

    return move, [[[one(x, y, c) for c in range(len(CLASSES))] for y in index] for x in index]


class Scorer:
    """Scores whole texts with a fitted grammar."""

    def __init__(self, grammar: Grammar) -> None:
        import ahocorasick

        self.g = grammar
        self.move, self.factor = compose(grammar.off)
        self.cls = {w: CLASSES.index(c) for c in ("report", "target", "intent", "negation", "threat") for w in SEEDS[c].split()}
        self.find = ahocorasick.Automaton()
        for w in {*grammar.words, *grammar.stems, *SEEDS["threat"].split()}:
            self.find.add_word(w, w)
        self.find.make_automaton()
        self.lengths = sorted({len(s) for s in grammar.stems})

    def weight(self, word: str) -> float:
        """Of a word that the insult machine accepts, else 0."""
        if (w := self.g.words.get(word)) is not None:
            return w
        return max((self.g.stems.get(word[:n], 0.0) for n in self.lengths if n <= len(word)), default=0.0)

    def clause(self, words: list[str]) -> float:
        """Evidence of one clause: the sum of what its words emit."""
        weights = [self.weight(w) for w in words]
        classes = [1 if w else self.cls.get(word, 0) for w, word in zip(weights, words)]
        after, state = [0] * len(words), 0
        for k in range(len(words) - 1, -1, -1):
            after[k] = state
            state = self.move[state][classes[k]]
        state, total = 0, 0.0
        for c, w, behind in zip(classes, weights, after):
            if c == 1 or c == 2:
                total += self.factor[state][behind][c] * (w or 1.0)
            state = self.move[state][c]
        return total

    def evidence(self, text: str | None) -> float:
        """Sum over the clauses that hold an insult or threat word."""
        text = (text or "").lower()
        total, done = 0.0, 0  # the text before ``done`` is read
        for end, word in self.find.iter(text):
            at = end - len(word) + 1
            if at < done or at and text[at - 1].isalpha():
                continue
            left = max([done, *(text.rfind(c, done, at) + 1 for c in CLAUSE_ENDS)])
            stop = END.search(text, end + 1)
            right = stop.start() if stop else len(text)
            total += self.clause(WORD.findall(text, left, right))
            done = right
        return total

    def score(self, text: str | None) -> float:
        x = self.g.slope * math.log1p(self.evidence(text)) + self.g.base
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _features(text: str, only: set | None = None) -> dict[tuple[str, bool], int]:
    """(word or stem, is a stem) with the times it occurs; of ``only`` where given."""
    out: dict[tuple[str, bool], int] = {}
    for word, n in Counter(w for w in WORD.findall(text.lower()) if w[0].isalpha()).items():
        for f in ((word, False), *((word[:k], True) for k in STEM if len(word) > k)):
            if only is None or f in only:
                out[f] = out.get(f, 0) + n
    return out


def _telling(new: int, against: int, toxic: int, clean: int) -> float:
    """Log-likelihood ratio of a feature of ``new`` of the toxic and ``against`` of the
    clean rows, over one that tells nothing."""
    n, share = new + against, toxic / (toxic + clean)
    p = new / n
    return sum(k * math.log(q / r) for k, q, r in ((new, p, share), (against, 1 - p, 1 - share)) if k) if p > share else 0.0


def fit_texts(toxic: list[str], clean: list[str], prior: float) -> Grammar:
    """Learn the vocabulary and the curve from two lists of texts; ``prior`` is the
    share of label 1 among all labelled rows.  An entry is taken while what it tells of
    the rows not explained yet is more than the best of all candidates would by chance
    (the logarithm of their number), so the vocabulary grows with what the rows show."""
    words = {w: 2.0 for w in SEEDS["insult"].split()}
    stems: dict[str, float] = {}
    toxic, clean = sorted(set(toxic)), sorted(set(clean))
    seeded = re.compile(rf"\b(?:{'|'.join(words)})\b")
    have = [_features(t) for t in toxic if not seeded.search(t.lower())]  # what the fixed words don't explain
    shared = Counter(itertools.chain.from_iterable(have))
    keep = {f for f, n in shared.items() if n >= SUPPORT}
    # candidates are (feature, least count): a stem that clean words also begin with may tell only where it recurs
    have = [{(f, k) for f, n in x.items() if f in keep for k in (1, 2) if n >= k} for x in have]
    against: Counter = Counter()
    for t in clean:
        against.update((f, k) for f, n in _features(t, keep).items() for k in (1, 2) if n >= k)
    scale = (1 - prior) / max(prior, 1e-6) * len(toxic) / max(1, len(clean))  # clean rows a sampled clean row stands for
    cover = Counter(itertools.chain.from_iterable(have))
    left = set(range(len(have)))
    owners: dict = {}
    for i, x in enumerate(have):
        for f in x:
            owners.setdefault(f, set()).add(i)
    chance = math.log(len(owners) + 1)
    while left and clean:
        best, best_gain = None, 0.0
        for f, who in owners.items():
            new = len(who & left)
            if new < SUPPORT or _telling(new, against[f], len(left), len(clean)) <= chance:
                continue
            wrong = scale * against[f]
            p = (cover[f] + 0.5) / (cover[f] + wrong + 1)
            gain = new * (1 + math.log(max(p, 1e-9))) - 2 * wrong
            gain -= 0.01 * len(f[0][0]) * (1 if f[0][1] else 2)  # of equals the shortest stem
            if p > 0.7 and gain > best_gain:
                best, best_gain = f, gain
        if best is None:
            break
        (text, is_stem), least = best
        p = (cover[best] + 0.5) / (cover[best] + scale * against[best] + 1)
        (stems if is_stem else words)[text] = min(2.0, max(0.5, math.log(p / (1 - p)) / 2)) / least
        left -= owners[best]
    grammar = Grammar(words, stems)
    scorer = Scorer(grammar)
    x = np.log1p([scorer.evidence(t) for t in toxic + clean])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    weight = np.r_[np.ones(len(toxic)), np.full(len(clean), scale)]
    if len(toxic) and len(clean) and x.any():
        a, b = 2.0, -3.0
        for _ in range(100):  # penalised Newton steps
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            r, s = weight * (y - p), weight * p * (1 - p) + 1e-9
            g = np.array([(r * x).sum() - 0.1 * (a - 2), r.sum() - 0.1 * (b + 3)])
            h = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum() + 0.1]])
            da, db = np.linalg.solve(h, g)
            a, b = a + float(np.clip(da, -1, 1)), b + float(np.clip(db, -1, 1))
        grammar.slope, grammar.base = max(0.5, a), b
    return grammar


def fit(labelled: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Grammar:
    """Fit on a bounded sample of the rows of ``labelled`` that have a label.  Null
    texts and labels take no part; of several labels of an id the largest holds;
    without labels the fixed words and curve remain."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where("i IS NOT NULL AND y IS NOT NULL").groupBy("i").agg(F.max("y").cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    dice, chosen = F.pmod(F.xxhash64(F.col("i"), F.lit("tox")), F.lit(1_000_000)), F.lit(False)
    for y, bound in ((1, FIT_TOXIC), (0, FIT_CLEAN)):
        chosen = chosen | ((F.col("y") == y) & (dice < int(1_000_000 * min(1, bound / max(1, counts.get(y, 0)))) + 1))
    picked = known.where(chosen)
    texts = labelled.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    found: dict[int, list[str]] = {0: [], 1: []}
    # the picked rows are bounded by FIT_TOXIC + FIT_CLEAN, so one side of this join is small at any size
    for r in texts.join(F.broadcast(picked), "i").select("y", "t").toLocalIterator():
        found[min(1, max(0, r["y"]))].append(r["t"])
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit_texts(found[1], found[0], min(0.9, max(0.001, prior)))


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the id, ``score`` (0 to 1) and ``predicted`` (1 where
    the score reaches the threshold).  Null and empty texts have no clause and get
    the base score; repeated rows get equal scores; other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        scorer = Scorer(grammar)

        def run(step):
            ids, texts = step
            scores = [scorer.score(t) for t in texts]
            return [ids, scores, [int(s >= threshold) for s in scores]]

        return run

    return map_text(docs, [id_col, text_col], schema(f"`{id_col}` {kind}, score double, predicted int"), make)


def keep_clean(docs: DataFrame, grammar: Grammar, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, whole, whose score stays below the threshold."""

    def make():
        scorer = Scorer(grammar)
        return lambda texts: [scorer.score(t) < threshold for t in texts]

    return filter_text(docs, text_col, make)
