"""Embeddings, packing, line dedup, MinHash, chat and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from terrascape.llm import chat, embeddings, line_dedup, minhash, packing
from terrascape.llm.common import components, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def join_all(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(30)]
    nodes = {n for e in links if e[0] != e[1] for n in e}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    assert got == {n: c for n, c in join_all(nodes, [e for e in links if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_near(rows, percent):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in join_all(ids, links).items()}


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash(spark, small, percent):
    rng = random.Random(1)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    made = [None, "", " \n ", "a", "A", "a b", "a b c d e", "A b c d e", "x " * 3000, "x " * 3000]
    for k in range(60):  # near copies that are not all alike
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(120)] = f"z{rng.randrange(50)}"
        made.append(" ".join(words))
    made += [" ".join(base[:40] + [f"u{k}_{j}" for j in range(30)]) for k in range(40)]  # a passage that many share
    rows += [(100_000 + k, t) for k, t in enumerate(made)]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, id long, component_id string")
    got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, percent=percent).collect()}
    assert got == brute_near(rows, percent)
    kept = {r.doc_id for r in minhash.keep_representatives(df, percent=percent).collect()}
    assert kept == {i for i, (_, c) in got.items() if c == i}


def test_minhash_edges(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None)], "doc_id long, text string")
    got = sorted((r.id if r.id is not None else -1, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, None, True), (1, 1, True), (1, 1, True), (2, 2, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_minhash_estimate():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.85, 0.95):
        both = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        n = int(len(both) * share)
        rest = len(both) - n
        a, b = np.unique(both[: n + rest // 2]), np.unique(np.r_[both[:n], both[n + rest // 2 :]])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(minhash.estimate(minhash.registers(a), minhash.registers(b))[0] - true) < 0.16


def test_minhash_blocks(spark, monkeypatch):
    """A bucket of many members of different components is compared in blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(4)
    rows = []
    for group in range(12):  # groups that share a start, each with a near copy
        words = ["s"] * 3 + [f"g{group}w{k}" for k in range(25)]
        rows += [(2 * group, " ".join(words)), (2 * group + 1, " ".join([*words, f"t{rng.randrange(9)}"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_near(rows, 80)
    classes = spark.createDataFrame([(i, bytearray(minhash.registers(minhash.shingles(t)).tobytes())) for i, t in rows], "rep long, registers binary")
    band = classes.selectExpr("cast(7 as long) as band", "rep")
    labels = spark.createDataFrame([], "node long, component long")
    pairs = {(r.a, r.b) for r in minhash._left_over(band, classes, labels, 0.8).collect()}
    assert {(2 * g, 2 * g + 1) for g in range(12)} <= pairs


def test_minhash_alone(spark):
    """A pair that meets in four buckets of its own only, while its second member is first
    compared with another head (chosen by search), is compared too."""

    def copy(seed):
        rng, words = random.Random(seed), [f"v{k}" for k in range(800)]
        for at in rng.sample(range(800), 12):
            words[at] = f"z{seed}x{at}"
        return " ".join(words)

    rows = [(1, copy(367)), (2, copy(4)), (3, " ".join(f"v{k}" for k in range(800)))]
    x, y, z = (minhash.registers(minhash.shingles(t))[: minhash.BANDS * minhash.ROWS].reshape(-1, minhash.ROWS) for _, t in rows)
    own, other = (x == z).all(1), (y == z).all(1)
    assert own.sum() == 4 < minhash.SEVERAL and other.sum() == 5 and not (own & other).any()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, percent=percent).collect()}
        assert got == brute_near(rows, percent) and {c for _, c in got.values()} == {1}


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    near = x[:80] + 0.05 * rng.normal(size=(80, 16))
    hot = x[5] + 0.01 * rng.normal(size=(60, 16))
    vectors = [*x, *near, *hot, *x[:20]]
    rows = [(k, [float(e) for e in v], 0) for k, v in enumerate(vectors)]
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [], [1.0] * 8]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    v = np.array(vectors, np.float32).astype(np.float64)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    comp = join_all(range(len(v)), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(hit)))])
    got = {r.id: r for r in embeddings.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for k in range(len(v)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (hit[k].sum(), comp[k], comp[k] == k)
    for k in range(len(odd)):
        assert (got[1000 + k].n_links, got[1000 + k].component_id) == (0, 1000 + k)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def linked_pairs(d, seed, falling):
    """Random vectors, each with a near copy; with ``falling`` most spread lies in few directions."""
    rng = np.random.default_rng(seed)
    scale = np.exp(-np.arange(d) / 8) if falling else np.ones(d)
    x = rng.normal(size=(400, d)) * scale
    noise = rng.normal(size=x.shape)
    near = x + 0.35 * np.linalg.norm(x, axis=1, keepdims=True) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    return np.concatenate([x, near]).astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("slack", [embeddings.SLACK, float("inf")])
def test_embeddings_cells(spark, monkeypatch, falling, slack):
    """With many cells, two levels and small blocks at least 0.98 of the links are found
    (all, where the slack is infinite), and none is false."""
    for name, value in {"CELL": 40, "FEWEST": 4, "BLOCK": 32, "SPLIT": 100, "PIECE": 20_000}.items():
        monkeypatch.setattr(embeddings, name, value)
    vectors = linked_pairs(32, 3, falling)
    df = spark.createDataFrame([(k, [float(e) for e in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    hit = links.sum(axis=1)
    got = {r.id: r for r in embeddings.near_duplicates(df, slack=slack).collect()}
    assert hit.sum() > 300 and all(got[k].n_links <= hit[k] for k in got)
    assert sum(r.n_links for r in got.values()) >= (1 if slack == float("inf") else 0.98) * hit.sum()
    if slack == float("inf"):
        comp = join_all(range(len(u)), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(links)))])
        assert {k: r.component_id for k, r in got.items()} == comp


def test_embeddings_of_many_lengths(spark):
    """Vectors of each length link among themselves only."""
    df = spark.createDataFrame([(2 * d + k, [1.0] * d) for d in range(1, 40) for k in (0, 1)] + [(500, [2.0, 2.0])], "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == {2 * d + k: (2 if d == 2 else 1, 2 * d) for d in range(1, 40) for k in (0, 1)} | {500: (2, 4)}


def test_tokens_are_the_library():
    tokens = packing.Tokens(TOKENIZER)
    rng = random.Random(2)
    letters = "ab's't 'll \n\té日½²٣İΣςßǅ😀é<|endoftext|>,.!?_-09ÀÉ ​\u0085\x1c "
    texts = ["", "I'LL don't", "<|endoftext|> x", "x" * 3000] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for _ in range(3000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokens.library.encode_batch(texts, add_special_tokens=False)]
    assert tokens.ids(texts) == want


def test_sum_of_squares_rule():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 33, 300)
    bins, offsets = packing.sum_of_squares(lengths, 32)
    gaps: dict[int, int] = {}
    for s, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):

        def cost(change):
            count = defaultdict(int)
            for g in {**gaps, **change}.values():
                count[g] += g > 0
            return sum(n * n for n in count.values())

        options = [cost({k: g - s}) for k, g in gaps.items() if g >= s] + [cost({max(gaps, default=-1) + 1: 32 - s})]
        assert 32 - gaps.get(b, 32) == o
        assert cost({b: gaps.get(b, 32) - s}) == min(options)
        gaps[b] = gaps.get(b, 32) - s
    assert min(gaps.values()) >= 0


def check_packing(rows, texts, capacity=2048):
    library = packing.Tokens(TOKENIZER).library
    want = {}
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[i, k] = (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(n for _, n, _ in want.values()) // capacity)


def test_packing(spark, small):
    docs = table(spark, small, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made, least = check_packing(packing.pack_documents(docs, TOKENIZER).collect(), texts)
    assert made <= least * 1.05 + 2
    edge = {1: None, 2: "", 3: "word " * 9000, 4: "a"}
    df = spark.createDataFrame([(i, t, 1) for i, t in edge.items()], "doc_id long, text string, length int")
    check_packing(packing.pack_documents(df, TOKENIZER).collect(), edge)
    assert packing.pack_documents(df.limit(0), TOKENIZER).count() == 0
    twice = df.unionByName(df)
    assert packing.pack_documents(twice, TOKENIZER).count() == 2 * packing.pack_documents(df, TOKENIZER).count()


LONG_LINE = "this is a long line of a passage that goes on for rather more than a hundred characters, as you see, yes." * 2


def test_line_dedup(spark):
    texts = [None, "", "a", f"x\n{LONG_LINE}\ny", f"{LONG_LINE}\nz", f"start\n{LONG_LINE}", "short\nshort\nshort", f"{LONG_LINE}\n{LONG_LINE}", "only\n" * 5000]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in enumerate(texts)], "doc_id long, text string, n_lines int, extra int, id int, places int")
    got = {r.doc_id: r for r in line_dedup.dedup(df).collect()}
    assert len(got) == len(texts) and got[0].text is None and got[1].text == "" and got[2].text == "a"
    assert got[3].text == texts[3] and got[4].text == "z" and got[5].text == "start" and got[6].text == texts[6] and got[7].text == ""
    assert (got[4].extra, got[4].id, got[4].places, got[4].n_lines, got[4].n_removed) == (2, 3, 4, 2, 1)
    again = line_dedup.dedup(df.unionByName(df)).collect()
    assert sorted((r.doc_id, r.text or "") for r in again) == sorted((i, got[i].text or "") for i in got for _ in (0, 1))
    assert line_dedup.dedup(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, LONG_LINE), (5, LONG_LINE)], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in line_dedup.dedup(nulls).collect()} == {(None, LONG_LINE), (5, "")}


def test_line_dedup_is_its_sql(spark, small):
    docs = table(spark, small, "documents")
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{small}/documents.parquet'")
    want = sorted(c.sql(line_dedup.ORACLE).select("doc_id, text, n_lines, n_removed").fetchall())
    assert sorted(tuple(r) for r in line_dedup.dedup(docs.select("doc_id", "text")).collect()) == want


@pytest.mark.parametrize("weak", [False, True])
def test_line_dedup_shift(spark, monkeypatch, weak):
    """Passages of few and many lines are found whole at another place, other lines stay;
    bytes decide, not hashes."""
    if weak:
        monkeypatch.setattr(line_dedup, "line_key", lambda line: line_dedup.F.length(line) % 3)
    rng = random.Random(8)
    words = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**4)}" for _ in range(n))
    docs, own = [], []
    for lines, size in [(1, 51), (2, 26), (3, 17), (4, 14), (5, 12), (6, 10), (7, 8), (12, 8), (40, 9)] * (1 if weak else 4):
        passage = [words(size) for _ in range(lines)]
        for _ in range(2):
            own.append([[words(9) for _ in range(rng.randrange(4))] for _ in range(2)])
            docs.append((len(docs), "\n".join([*own[-1][0], *passage, *own[-1][1]])))
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs:
        assert got[i].text == (text if i % 2 == 0 else "\n".join([*own[i][0], *own[i][1]]))


def test_representatives_clashing_names(spark):
    df = spark.createDataFrame([(k, "the same five words and more of them here", 1, 2) for k in range(3)] + [(None, None, 1, 2), (9, "x", 1, 2)], "doc_id long, text string, `__gone` int, gone_ int")
    got = minhash.keep_representatives(df)
    assert got.columns == df.columns and sorted(str(r.doc_id) for r in got.collect()) == ["0", "9", "None"]


def test_line_dedup_chunks_decide(spark):
    """Passages of short lines are found through chunks: other boundaries give other
    chunks, and without boundaries a shifted passage is not found."""
    rng = random.Random(5)
    short = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**4)}" for _ in range(4))
    docs, own = [], []
    for k in range(12):
        passage = [short() for _ in range(14)]
        for _ in range(2):
            own.append([[short() for _ in range(rng.randrange(1, 7))] for _ in range(2)])
            docs.append((len(docs), "\n".join([*own[-1][0], *passage, *own[-1][1]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup(df).collect()}
    for i, text in docs:
        assert got[i].text == (text if i % 2 == 0 else "\n".join([*own[i][0], *own[i][1]]))
    chunks = lambda mean: {(r.doc_id, c.at, c.n) for r in df.select("doc_id", line_dedup.chunks(line_dedup.lines_of(df.text), mean=mean).alias("c")).collect() for c in r.c}
    assert chunks(2) != chunks(3)
    fixed = line_dedup.dedup(df, mean=10**7).where("n_removed > 0").count()  # cut after every MOST lines only
    assert fixed < 6


def test_chat(spark, small):
    rows = table(spark, small, "conversations").collect()
    got = {r.conv_id: r for r in chat.op1_chat(spark, small).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    by[-1] = [(0, "user", said), (1, "assistant", said)]
    assert set(got) == set(by)
    for i, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[i].n_turns == len(turns) and got[i].rewrites == 0
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[i].loss_chars, got[i].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[i].formatted_chars == len(chat.marked_turns([(r, t) for _, r, t in turns]))


def test_chat_blocks_and_edges(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(200)]
    rows += [(2, 0, None, None), (2, 0, "a\nb%", "<\\|x <|im_end|>"), (None, None, "user", "n"), (3, 5, "assistant", "x" * 9000), (3, 5, "assistant", "x" * 9000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", chat.F.lit(9))
    got = {r.conv_id: r for r in chat.digests(chat.blocks(df)).collect()}
    assert got[1].n_turns == 200 and got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:200]).encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256("\n\na\nb%\n<\\|x <|im_end|>\n".encode()).hexdigest()
    assert got[None].n_turns == 1 and got[3].loss_chars == 18000
    assert chat.digests(chat.blocks(df.limit(0))).count() == 0
    nulls = [(4, None, "user", "b"), (4, None, "assistant", "a"), (4, 0, "user", "c"), (4, 1, "assistant", chat.PROBE + " d")]
    found = chat.digests(chat.blocks(spark.createDataFrame(nulls, "conv_id long, turn long, role string, text string"))).collect()[0]
    assert (found.n_turns, found.loss_chars) == (4, len("a" + chat.PROBE + " d"))


def test_chat_long_texts(spark):
    """Turns of a megabyte: the template is tried on short histories."""
    import tracemalloc

    turns = [("user" if k % 2 else "assistant", "ab<|c " * 170_000) for k in range(3)]
    tracemalloc.start()
    chat.check_independent(chat.marked_turns, turns)
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.blocks(df)).collect()[0]
    assert (got.n_turns, got.loss_chars) == (3, 2 * len(turns[0][1]))

    def late(turns):  # looks back after 3000 turns
        return "".join(f"[{r}]{t}\n" if k < 3000 else "[late]\n" for k, (r, t) in enumerate(turns))

    with pytest.raises(ValueError):
        chat.check_independent(late, turns)


def test_chat_templates(spark):
    def forgets(turns):  # drops assistant texts of earlier turns
        return "".join(f"[{r}]{t if r != 'assistant' or k == len(turns) - 1 else '...'}\n" for k, (r, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "thinking hard"), ("user", "more"), ("assistant", "yes")]
    whole, spans, rewrites = chat.trace(forgets, turns)
    assert rewrites == 1 and whole == forgets(turns) and whole[spans[3].text_begin : spans[3].text_end] == "yes"
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    assert chat.blocks(df, forgets, independent=False).collect()[0].rewrites == 1
    assert chat.blocks(df, forgets).collect()[0].rewrites == 1
    with pytest.raises(Exception, match="looks back"):
        chat.blocks(df, forgets, independent=True).collect()
    # a template that keeps the last 100 turns rewrites each longer prefix
    long = [("assistant" if k % 2 else "user", f"t{k} {chat.PROBE}") for k in range(200)]
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(long)], "conv_id long, turn long, role string, text string")
    short = lambda turns: chat.marked_turns(turns[-100:])
    assert chat.blocks(df, short).collect()[0].rewrites == 100
    with pytest.raises(Exception, match="looks back"):
        chat.blocks(df, short, independent=True).collect()
    whole, spans, rewrites = chat.trace(chat.marked_turns, long)
    assert rewrites == 0 and [whole[s.text_begin : s.text_end] for s in spans] == [t for _, t in long]
    for text in ("<|im_start|>", "<\\|", "<<|", "\\<|", "<|" * 5, ""):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    columns = set(docs.columns)
    before, total = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small).persist()
        assert set(after.columns) == columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) > 0.7 * total
        if name == "near duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert ids == {i for i, (_, c) in brute_near(rows, 80).items() if c == i}
        before = after
    texts = {r.doc_id: r.text for r in before.collect()}
    check_packing(corpus_pipeline.STAGES[-1][1](spark, before, small).collect(), texts)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
