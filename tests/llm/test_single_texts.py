"""SentencePiece, sharding, fingerprints, language identification and toxicity against
brute force, on small tables with every edge case."""

import hashlib
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import unicodedata
from pyspark.sql import functions as F

from terrascape.llm import fingerprints, language_id, sentencepiece_bpe, sharding, toxicity
from terrascape.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, digest string"
EDGE = [None, "", " ", "a", "Ab c", "é É", "x" * 5000, "one two\nthree  four", "日本語 текст 😀", "same text here", "same text here"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 7, "x") for i, t in enumerate(texts)], DDL)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, EDGE)


def test_sentencepiece_is_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(5)
    letters = "abeinorst  \n\tàé日▁<>=-_/.,0123²٣😀"
    texts = [t or "" for t in EDGE] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [" " * 70, "ab" * 300, "aaaa" * 100, "x² ².", "<s></s><0x0A>", "a\x00b\r\n"]
    codec = sentencepiece_bpe.Codec(MODEL)
    ids = codec.encode(texts)
    assert ids == library.encode(texts, add_eos=True)
    assert [codec.decode(i) for i in ids] == [library.decode(i) for i in ids]
    for t in texts:
        if t:
            assert "".join(codec._words(t)) == " " + t.replace("▁", " ")


def test_sentencepiece_tables(spark, docs):
    encoded = sentencepiece_bpe.encode(docs, MODEL)
    back = {r.doc_id: r.text for r in sentencepiece_bpe.decode(encoded, MODEL).collect()}
    assert back == {i: t or "" for i, t in enumerate(EDGE)}
    rows = {r.doc_id: r for r in sentencepiece_bpe.digests(docs, MODEL).collect()}
    for r in encoded.collect():
        assert rows[r.doc_id].n_tokens == len(r.ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256((EDGE[r.doc_id] or "").encode()).hexdigest()
    assert sentencepiece_bpe.digests(docs.limit(0), MODEL).count() == 0


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_sharding(spark, docs):
    rows = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, "x", None, None, None, None, None, None)], docs.schema))
    got = sharding.assign(rows, "doc_id", 40).collect()
    assert len(got) == len(EDGE) + 4
    for r in got:
        key = int(hashlib.md5(("\0null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16)
        assert (r.shard, r.grown_shard) == (jump(key, 40), jump(key, 41))
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign(docs.limit(0), "doc_id", 40).count() == 0


def test_sharding_moves_little(spark):
    got = sharding.assign(spark.range(20000).withColumnRenamed("id", "doc_id"), "doc_id", 40).collect()
    assert 0.015 < sum(r.shard != r.grown_shard for r in got) / 20000 < 0.035


def canonical(t):
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold()).split())


def test_fingerprints(spark, docs):
    got = {r.id: r for r in fingerprints.fingerprint_edits(docs).collect()}
    texts = [t or "" for t in EDGE]
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == float(canonical(edited) == canonical(t))
        assert r.near_next == float(canonical(nxt) == canonical(t))
    for i in got:
        for j in got:
            assert (got[i].fingerprint == got[j].fingerprint) == (canonical(texts[i]) == canonical(texts[j]))
    assert fingerprints.fingerprint_edits(docs.limit(0)).count() == 0


def test_fingerprints_compare_bytes(spark, docs, small, monkeypatch):
    """With a digest of four bits, nearly all of which collide, forms still decide, for
    documents and for edits, their own document's included."""
    forms = spark.createDataFrame([("d", "a"), ("d", "b"), ("e", "c")], "digest string, form string")
    found = {(r.digest, r.form): r.variant for r in fingerprints.clashes(forms).collect()}
    assert found == {("d", "a"): 0, ("d", "b"): 1}
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs, ["doc_id"]).collect()}
    assert plain[9] == plain[10] and len(set(plain.values())) == len({canonical(t) for t in EDGE})
    whole = fingerprints.digest
    monkeypatch.setattr(fingerprints, "digest", lambda form: whole(form)[:1])
    rows = sorted((r.doc_id, r.text or "") for r in table(spark, small, "documents").where("doc_id < 80").collect())
    few = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    light = {r.id: r for r in fingerprints.edits(few).collect()}
    assert all(len(r.digest) == 1 for r in light.values()) and any(r.digest == r.edited_digest and not r.same for r in light.values())
    names: dict[str, str] = {}
    for r in fingerprints.fingerprint_edits(few).collect():
        k = [i for i, _ in rows].index(r.id)
        text, nxt = rows[k][1], rows[(k + 1) % len(rows)][1]
        n = len(text) // 4
        for shown, form in ((r.fingerprint, canonical(text)), (r.edited_fingerprint, canonical(text[: len(text) - n] + nxt[:n]))):
            assert names.setdefault(shown, form) == form
        assert r.near_edited == float(r.fingerprint == r.edited_fingerprint)
    assert len(names) == len(set(names.values()))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_edits_by_range(spark, parts):
    """The ranges' ends meet; equal ids and null ids are documents of their own."""
    texts = [(None, "null here"), *[(k * k, f"text {k} " * (k % 5)) for k in range(30)], (4, "again"), (4, "again")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = fingerprints.edits(df, parts=parts).collect()
    order = [i for i, _ in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))]
    assert sorted(((r.id is not None, r.id or 0), (r.next_id is not None, r.next_id or 0)) for r in got) == sorted(((i is not None, i or 0), (n is not None, n or 0)) for i, n in zip(order, order[1:] + order[:1]))


def test_language(spark, small, docs):
    data = table(spark, small, "documents")
    filters = language_id.fit(data.where(~language_id.held_out()))
    found = language_id.identify(data, filters).join(data.select("doc_id", "lang"), "doc_id").where(language_id.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    edge = {r.doc_id: r for r in language_id.identify(docs, filters).collect()}
    assert len(edge) == len(EDGE)
    assert [edge[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in edge.values()) and edge[6].lang_pred != "und"
    kept = {r.doc_id for r in language_id.keep_identified(data, filters).collect()}
    assert len(kept) >= 0.97 * data.count()
    none = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_language_mask_counts(spark):
    """The sliced filter answers as the plain sets do, but for false positives."""
    texts = spark.createDataFrame([(1, "the cat and the hat " * 9, "en"), (2, "der hund und die katze " * 9, "de")], "doc_id long, text string, lang string")
    filters = language_id.fit(texts)
    assert filters.languages == ["de", "en"]
    fair, total, _ = language_id.evidence(filters, ["the cat", "und die katze", "the cat" + " x" * 100])
    assert fair[0].argmax() == 1 and fair[1].argmax() == 0 and total[2] > total[0]


def test_language_against_plain_sets(spark, small):
    """Hits by language, totals, corrections and scores, from sets of n-grams instead of
    sliced filters: each n-gram's languages are those whose set has it, or a false positive."""
    docs = table(spark, small, "documents")
    filters = language_id.fit(docs.where(~language_id.held_out()))
    texts = [r.text for r in docs.where("text IS NOT NULL").limit(20).collect()] + ["", "Über die 12 Häuser"]
    langs = len(filters.languages)
    fair, total, letters = language_id.evidence(filters, texts)
    for k, text in enumerate(texts):
        codes = language_id._codes(f" {text.lower()} ")
        grams = [h for n in language_id.ORDERS for h in language_id._grams(codes, n)[0].tolist()]
        assert total[k] == len(grams) and letters[k] == sum(c.isalpha() for c in text.lower())
        plain = [0.0] * langs
        for h in grams:
            bits = (1 << langs) - 1
            for p in range(language_id.PROBES):
                bits &= int(filters.slots[(h >> (24 * p)) & ((1 << language_id.SLOT_BITS) - 1), 0])
            for j in range(langs):
                plain[j] += bits >> j & 1
        for j in range(langs):
            rate = filters.false_rate[j]
            assert fair[k][j] == pytest.approx(max(0.0, (plain[j] - len(grams) * rate) / (1 - rate)))
    # a filter of few n-grams holds what its language's rows hold, and little else
    got = language_id.identify(docs, filters).where("lang_pred <> 'und'").collect()
    assert all(0 < r.score <= 1 and 0 <= r.coverage <= 1 for r in got)


def plain_grams(text, n):
    """n-grams as strings: other characters are blanks, inner ones letters."""
    line = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    found = [line[k : k + n] for k in range(len(line) - n + 1)]
    return [g for g in found if " " not in g[1:-1] and (n == 3 or g[0] != " " or g[-1] != " ")]


def test_language_filters_hold_the_frequent_grams(spark, small):
    """Which n-grams are held, from sets built of the rows' strings; a row of one letter,
    and an empty one, change nothing else."""
    known = table(spark, small, "documents").where(~language_id.held_out())
    filters = language_id.fit(known)
    odd = spark.createDataFrame([(9_000_000 + k, t, "de") for k, t in enumerate(["x", "", "!", "ab"])], "doc_id long, text string, lang string")
    assert (language_id.fit(known.select("doc_id", "text", "lang").unionByName(odd)).slots != filters.slots).sum() <= 4 * 2 * language_id.PROBES
    rows = known.where("text IS NOT NULL AND lang IS NOT NULL").collect()
    for k, name in enumerate(filters.languages):
        for n in language_id.ORDERS:
            count = Counter(g for r in rows if r.lang == name for g in plain_grams(r.text, n))
            ranked = sorted(count.values(), reverse=True)
            least = ranked[language_id.TOP - 1] if len(ranked) > language_id.TOP else 0
            frequent = [g for g, c in count.items() if c > least]
            assert frequent
            rare = [g for g, c in count.items() if c < least]
            held = lambda g: bool(int(language_id._probe(filters.slots, language_id._grams(language_id._codes(g), n)[0])[0, 0]) >> k & 1)
            assert all(map(held, frequent))
            assert sum(map(held, rare)) <= 0.05 * len(rare) + 5  # false positives


def test_language_windows_of_long_texts(spark, small, monkeypatch):
    """A text counted in windows has the counts of the whole text."""
    filters = language_id.fit(table(spark, small, "documents").where(~language_id.held_out()))
    texts = ["the quick brown fox " * 40, "x", None, "übermäßig lange wörter " * 33]
    want = language_id.evidence(filters, texts)
    for size in (1, 5, 64, 701):
        monkeypatch.setattr(language_id, "PIECE", size)
        for a, b in zip(language_id.evidence(filters, texts), want):
            assert a == pytest.approx(b)


def test_toxicity(spark, docs):
    data, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    known = ~language_id.held_out()
    grammar = toxicity.fit(data.where(known), labels.where(known))
    rows = toxicity.score(data, grammar).join(labels, "doc_id").where(language_id.held_out()).collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    edge = toxicity.score(docs, grammar).collect()
    assert len(edge) == len(EDGE) and all(0 <= r.score < 0.3 for r in edge)
    assert toxicity.keep_clean(docs, grammar).count() == len(EDGE)
    bare = toxicity.fit(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs, bare).count() == len(EDGE)


def test_toxicity_grammar():
    scorer = toxicity.Scorer(toxicity.Grammar({"idiot": 2.0}, {"achl": 1.0}))
    plain = scorer.evidence("what an idiot.")
    assert scorer.evidence("you idiot.") > plain > scorer.evidence("not an idiot.")
    assert scorer.evidence("i will hurt you") > 0 == scorer.evidence("it does hurt")
    assert scorer.evidence("achlich") == 1.0 and scorer.evidence("xachlich") == 0
    assert scorer.evidence("idiot. " * 3) == pytest.approx(3 * plain)
    assert scorer.evidence("word " * 50000 + "idiot") > 0 == scorer.evidence(None)
    far = "you " + "word " * 50000  # a clause without an end is read whole
    assert scorer.evidence(far + "idiot") == 1.25 * plain == scorer.evidence("idiot " + "word " * 50000 + "you")


@pytest.mark.parametrize(
    "bare, negated, reported, aimed",
    [
        ("an idiot here", "never an idiot here", '"an idiot here", a man said', "idiot that you are"),
        ("ein idiot ist", "kein idiot ist", "ein idiot, sagte man, ist", "ein idiot bist du"),
        ("un idiot ici", "pas un idiot ici", "un idiot ici, dit la dame", "quel idiot tu es"),
        ("un idiota es", "nunca un idiota es", "un idiota es, dijo la gente", "qué idiota eres tú"),
    ],
)
def test_toxicity_transducers(bare, negated, reported, aimed):
    """Each modifying transducer changes what it is about, in every language, on either side."""
    score = lambda text, *off: toxicity.Scorer(toxicity.Grammar({"idiot": 2.0, "idiota": 2.0}, {}, off=frozenset(off))).score(text)
    assert score(bare) > score(negated) == pytest.approx(score(reported)) and score(aimed) > score(bare)
    for name, text in (("negation", negated), ("report", reported), ("target", aimed)):
        assert score(text, name) == pytest.approx(score(bare)) and score(bare, name) == score(bare)
    assert score(bare, "insult") < score(bare)


@pytest.mark.parametrize("text", ["i will hurt you", "ich werde dich töten", "töten werde ich", "je vais te tuer", "voy a matarte"])
def test_toxicity_threats(text):
    scorer, without = (toxicity.Scorer(toxicity.Grammar({}, {}, off=frozenset(off))) for off in ((), ("threat",)))
    assert scorer.evidence(text) >= toxicity.WEIGHT["threat"] and without.evidence(text) == 0


def test_toxicity_product_is_the_machines():
    """One walk through the product gives what the transducers say one by one."""
    rng = random.Random(4)
    scorer = toxicity.Scorer(toxicity.Grammar({"idiot": 2.0, "scum": 0.5}, {}))
    said = {c: toxicity.SEEDS[c].split() for c in ("threat", "intent", "target", "negation", "report")}
    for _ in range(2000):
        words = [rng.choice(["x", "y", "idiot", "scum", *(rng.choice(v) for v in said.values())]) for _ in range(rng.randint(1, 14))]
        want = 0.0
        for k, w in enumerate(words):
            others = words[:k] + words[k + 1 :]
            near = words[max(0, k - toxicity.REACH) : k] + words[k + 1 : k + 1 + toxicity.REACH]
            base = {"idiot": 2.0, "scum": 0.5}.get(w, 0.0) or (2.0 if w in said["threat"] and set(others) & set(said["intent"]) - set(said["target"]) else 0.0)
            base *= 1.25 if set(others) & set(said["target"]) else 1
            base *= 0.5 if set(others) & set(said["report"]) else 1
            want += base * (0.5 if set(near) & set(said["negation"]) else 1)
        assert scorer.evidence(" ".join(words)) == pytest.approx(want)


def test_op4_columns(spark, small):
    from terrascape.llm.queries_text import op4_sharding

    texts = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    for r in op4_sharding(spark, small).collect():
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    assert op4_sharding(spark, small).select(F.col("slot")).schema[0].dataType.simpleString() == "bigint"


def test_sharding_clashing_names_and_many_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 3)
    rows = spark.createDataFrame([(k, 7, 8, 9, 10, "p") for k in range(500)] + [(3, 7, 8, 9, 10, "p")] * 40, "doc_id long, part int, offset int, `__part` int, number int, size string").withColumn("row", F.lit(5))
    got = sharding.assign(rows, "doc_id", 4).collect()
    assert len(got) == 540 and {(r.part, r.offset, r["__part"], r.number, r["size"], r.row) for r in got} == {(7, 8, 9, 10, "p", 5)}
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.assign(rows.limit(0), "doc_id", 4).count() == 0
