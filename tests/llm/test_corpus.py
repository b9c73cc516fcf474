"""Merkle manifest, periodic runs and language-model scores against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrascape.llm import merkle, periodic, ppm
from terrascape.llm.common import table

DDL = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g string, id long, pos int, held boolean, kind string, data string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def frame(spark, rows):
    """Rows of (doc_id, text, lang), with columns of names that the operators use."""
    return spark.createDataFrame([(i, t, lang, "s" if i != 3 else None, len(t) if t else None, "x", "y", 1, 2, True, "k", "d") for i, t, lang in rows], DDL)


EDGE = [None, "", " ", "A b A b A b A b", "a " * 40, "Same text", "Same text", "\x1c word", "w" * 20_000, "y z\n" * 5000, "é É 日本語"]


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def leaf(row):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    groups = defaultdict(list)
    for r in rows:
        bad = r[:4] + (r[4],)
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
            bad = r[:4] + ("".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]),)
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), leaf(bad)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for pos, (known, id_, own, bad) in enumerate(sorted(groups[g])):
            proof, got = "", bad
            for levels, at in ((trees[g], pos), (top, k)):
                for level in levels[:-1]:
                    run = level[at // 8 * 8 : at // 8 * 8 + 8]
                    proof += "".join(run[: at % 8] + run[at % 8 + 1 :])
                    got = h("".join(run[: at % 8] + [got] + run[at % 8 + 1 :]))
                    at //= 8
            out.append((id_ if known else None, own, trees[g][-1][0], top[-1][0], h(proof), got, got == top[-1][0]))
    return sorted(map(repr, out))


def manifest_rows(docs):
    return merkle.manifest(docs, "doc_id", "lang", FIELDS, {"text": merkle.tampered("doc_id", "text")})


def test_manifest(spark, small):
    rng = random.Random(2)
    rows = [(i, t, None) for i, t in enumerate(EDGE)] + [(None, "Null id", "en"), (7, "Twice", "en"), (7, "Twice", "en"), (7, "Other", "en")]
    rows += [(rng.randrange(10_000), f"Text {k}", "fr") for k in range(700)] + [(k, f"L {k}", f"lang{k}") for k in range(30)] + [(-5, "one", "a")]
    docs = frame(spark, rows).repartition(7)
    want = brute_manifest([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert sorted(repr(tuple(r)) for r in manifest_rows(docs).collect()) == want
    assert manifest_rows(docs.limit(0)).count() == 0
    one = manifest_rows(frame(spark, [(1, "only", "en")])).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_manifest_passes_frontiers_on(spark, monkeypatch):
    """Parents whose children lie in different tasks are completed in later rounds."""
    monkeypatch.setattr(merkle, "parts_for", lambda df: 23)
    docs = frame(spark, [(k, f"Text {k}", "en" if k % 9 else "de") for k in range(1500)])
    want = brute_manifest([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert sorted(repr(tuple(r)) for r in manifest_rows(docs).collect()) == want


def test_unordered_nodes_wait_and_pass_on():
    """What a task gathers out of order is whole once all its children came; what is left
    is passed on, and completed with the rest."""
    import pyarrow as pa

    nodes = [("g", 70, 0, k, hashlib.sha256(str(k).encode()).digest()) for k in range(70)]
    random.Random(1).shuffle(nodes)
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], list("abcde"))
    whole = [r for b in merkle.combine([batch(nodes)]) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert Counter(r[0] for r in whole) == {merkle.LINK: 9 + 2 + 1, merkle.TOP: 1}
    first = [r for b in merkle.combine([batch(nodes[:30])]) for r in zip(*(c.to_pylist() for c in b.columns))]
    second = [r for b in merkle.combine([batch(nodes[30:])]) for r in zip(*(c.to_pylist() for c in b.columns))]
    left = [r[1:] for r in first + second if r[0] == merkle.FRONTIER]
    last = [r for b in merkle.combine([batch(left)]) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert [r for r in last if r[0] == merkle.TOP] == [r for r in whole if r[0] == merkle.TOP]


def brute_runs(words, times, least):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


@pytest.mark.parametrize("times,least", [(2, 2), (3, 3), (4, 6)])
def test_runs(times, least):
    rng = random.Random(times)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 6)):
            letters = rng.choice([1, 2, 2, 3, 6])
            words = [b"abcdef"[c : c + 1] for c in (rng.randrange(letters) for _ in range(rng.randint(0, 70)))]
            if words and rng.random() < 0.5:
                a, p = rng.randrange(len(words)), rng.randint(1, 9)
                words = words[:a] + (words[a : a + p] * 70)[: len(words) - a]
            texts.append(words)
        symbols = periodic.symbols_of(texts)
        found = periodic.runs(symbols, times).tolist() if len(symbols) > len(texts) else []
        want, begin = [], 0
        for w in texts:
            want += [(s + begin, s + n + begin, q) for s, n, q in brute_runs(w, times, least)]
            begin += len(w) + 1
        assert sorted((s, e, q) for s, e, q in found if e - s >= least) == sorted(want)


def test_next_smaller():
    import numpy as np

    for values in ([5, 4, 3, 2, 1, 0], [0, 9, 8, 7, 6, 5, 4, 3], list(range(50)), random.Random(4).sample(range(5000), 5000), [0, *range(4000, 1, -1), 1]):
        want = [next((j for j in range(i + 1, len(values)) if values[j] < values[i]), len(values)) for i in range(len(values))] if len(values) < 100 else None
        got = periodic.next_smaller(np.array(values)).tolist()
        if want is None:
            stack, want = [], [len(values)] * len(values)
            for i, v in enumerate(values):
                while stack and values[stack[-1]] > v:
                    want[stack.pop()] = i
                stack.append(i)
        assert got == want


@pytest.mark.parametrize("plant", [False, True])
def test_detect(spark, small, plant):
    rows = [(i, t, "en") for i, t in enumerate(EDGE)] + [(None, "a a a a a a a", "en"), (5, "b c " * 9, "en"), (5, "b c " * 9, "en")]
    rows += [(r.doc_id, r.text, r.lang) for r in table(spark, small, "documents").where("n_chars < 4000").collect()]
    docs = frame(spark, rows)
    got = sorted(repr(tuple(r)) for r in periodic.detect(docs, plant=plant).collect())
    want = []
    for i, t, _ in rows:
        words = (t or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if plant and i is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        found = brute_runs(words, 4, 6) if len(words) < 3000 else [(0, len(words), 2)]
        gone = {k for s, m, q in found for k in range(s + q, s + m)}
        best = sorted(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1] or [(None, None, None)]
        milli = 1000 * best[0][1] // best[0][2] if found else None
        digest = lambda b: hashlib.sha256(b).hexdigest()
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want.append((i, len(found), *best[0], milli, digest("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()), digest(kept)))
    assert got == sorted(map(repr, want))
    assert periodic.detect(docs.limit(0)).count() == 0


def brute_scores(rows, order):
    """rows: (doc_id, held, text); each context's counts in plain tables."""
    after = [defaultdict(Counter) for _ in range(order + 1)]
    texts, count = [], Counter()
    for _, held, t in rows:
        words = (t or "").encode().lower().split()
        line = b" " * order + b" ".join(words) + b"\n"
        texts.append((words, line))
        if not held:
            count.update([*words, None])
            for p in range(order, len(line)):
                for o in range(order + 1):
                    after[o][line[p - o : p]][line[p]] += 1
    n, v, cost = sum(count.values()), len(count), {}

    def byte(context, b):
        if (context, b) not in cost:
            logs, gone = 0.0, set()
            for o in range(order, -1, -1):
                node = after[o].get(context[order - o :], {})
                left = {x: c for x, c in node.items() if x not in gone}
                if not left:
                    continue
                if b in left:
                    logs += math.log10((left[b] - 0.5) / sum(left.values()))
                    break
                logs += math.log10(len(left) / 2 / sum(left.values()))
                gone = set(node)
            else:
                logs -= math.log10(256 - len(gone))
            cost[context, b] = logs
        return cost[context, b]

    out = []
    for (i, held, _), (words, line) in zip(rows, texts):
        tokens = [*words, None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((i, held, len(tokens), sum(count[w] > 0 for w in tokens), n, base, sum(byte(line[p - order : p], line[p]) for p in range(order, len(line)))))
    return out


@pytest.mark.parametrize("chunk,order", [(1 << 30, 5), (20_000, 3)])
def test_scores(spark, small, monkeypatch, chunk, order):
    monkeypatch.setattr(ppm, "CHUNK", chunk)
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, small, "documents").where("n_chars < 3000").collect()]
    rows += [(10_000 + i, t, "en") for i, t in enumerate(EDGE)] + [(None, "No id", "en"), (9, "twice", "en"), (9, "twice", "en")]
    docs = frame(spark, rows).repartition(3)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = sorted(ppm.score(docs, held, order=order).collect(), key=lambda r: (r[0] or -1, r[6]))
    told = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, t) for i, t, _ in rows]
    want = sorted(brute_scores(told, order), key=lambda r: (r[0] or -1, r[6]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9) and g.score == pytest.approx(w[6], rel=1e-9)
    assert ppm.score(docs.limit(0), held).count() == 0
    blank = ppm.score(frame(spark, [(1, "ab", "en"), (2, None, "en")]), F.lit(True)).collect()
    assert {(r.doc_id, round(r.score, 6), r.base_score, r.n_known) for r in blank} == {(1, round(-3 * math.log10(256), 6), 0.0, 0), (2, round(-math.log10(256), 6), 0.0, 0)}


def test_probabilities_add_up(spark):
    """After any context, the probabilities of all bytes add to 1."""
    from terrascape.llm.common import Scratch

    docs = spark.createDataFrame([(1, False, "banana bandana ban"), (2, False, "ab"), (3, True, "\x00zq")], "id long, held boolean, text string")
    for context in (b"banan", b"     ", b"zzzzz", b"an ba"):
        asked = [int.from_bytes(context + bytes([b]), "big") for b in range(256)]
        rows = spark.createDataFrame([(ppm.GRAM, 77, g, 0, None, None) for g in asked], ppm.ROWS)
        known = ppm.gather(docs, 5).unionByName(rows)
        got = {r.gram: r.cost for r in ppm.costs(Scratch(), known, 5).collect()}
        assert sum(10 ** got[g] for g in asked) == pytest.approx(1)
