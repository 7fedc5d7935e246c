"""Language ID: code lengths against a dictionary-based partial matcher; held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
from postlens.llm import langid

ROWS = [
    (1, "der die und das nicht", "de"), (2, "the and of that this", "en"), (3, None, "en"), (4, "12 !?", "en"),
    (5, "the of", None), (None, "und der die", "de"), (6, "", None), (7, "the the the", "en"), (7, "the the the", "en"),
    (8, "und " * 700_000, "de"),
]


def plain_bits(train, text):
    """Walk the contexts of each byte from the longest one, paying for an escape where it was not seen."""
    counts = Counter()
    for t in train:
        data = bytes(4) + t.encode().lower()
        counts.update((data[i - k : i], data[i]) for i in range(4, len(data)) for k in range(5))
    after = {}
    for (context, byte), n in counts.items():
        after.setdefault(context, {})[byte] = n
    total, data = 0.0, bytes(4) + text.encode().lower()
    for i in range(4, len(data)):
        for k in (4, 3, 2, 1, 0):
            here = after.get(data[i - k : i], {})
            if data[i] in here:
                total -= math.log2(here[data[i]] / (sum(here.values()) + len(here)))
                break
            if here:
                total -= math.log2(len(here) / (sum(here.values()) + len(here)))
        else:
            total += 8
    return total


TEXTS = ["the und", "Die Der that?", "xyz üö", "", "a", "日本語 \x00 und", "the " * 40]


def test_code_lengths_equal_plain_matcher(spark):
    docs = spark.createDataFrame(ROWS[:2], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert [t.lang for t in model] == ["de", "en"]
    want = [[plain_bits([ROWS[i][1]], text) for i in (0, 1)] for text in TEXTS]
    assert np.allclose(langid.code_lengths(TEXTS, model), want, rtol=1e-5)


def test_slices_change_nothing(spark, monkeypatch):
    model = langid.train(spark.createDataFrame(ROWS[:2], "doc_id long, text string, lang string"))
    whole = langid.code_lengths(TEXTS, model)
    monkeypatch.setattr(langid, "SLICE", 7)
    assert np.allclose(langid.code_lengths(TEXTS, model), whole)


def composed(rng, alphabet, n):
    """Words of syllables: each language prefers other letters after each other."""
    follows = {c: rng.sample(alphabet, 4) for c in alphabet}
    texts = []
    for _ in range(n):
        words = []
        for _ in range(25):
            word = [rng.choice(alphabet)]
            while len(word) < rng.randint(2, 7):
                word.append(rng.choice(follows[word[-1]]))
            words.append("".join(word))
        texts.append(" ".join(words))
    return texts


def test_scripts_beyond_the_latin_one(spark):
    """Six languages of composed texts: three share the Cyrillic letters, two the same ideographs."""
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x430, 0x450)]
    signs = [chr(c) for c in range(0x4E00, 0x4E60)]
    alphabets = {"c1": letters, "c2": letters, "c3": letters, "z1": signs, "z2": signs, "latin": list("abcdefghijklmno")}
    rows = [(i, text, lang) for lang, alphabet in alphabets.items() for i, text in enumerate(composed(rng, alphabet, 120))]
    rows = [(i, text, lang) for i, (_, text, lang) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs).where("held_out").collect()}
    right = sum(found.get(i) == lang for i, _, lang in rows if i in found)
    assert len(found) > 100 and right >= 0.98 * len(found)


def test_memory_of_a_hundred_languages():
    """A tree is bounded, whatever was seen; a hundred fit a Python worker."""
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << 40, 400_000))
    own = langid.tree("x", grams, np.ones(len(grams), np.int64), largest=50_000)
    assert len(own.levels[0].grams) == 50_000
    text = np.frombuffer((" ".join(composed(random.Random(4), list("abcdefghijklmnopqrstuvwxyz"), 1_000))).encode(), np.uint8)
    gram, n = np.unique(langid._grams(text), return_counts=True)
    own = langid.tree("x", gram, n)
    size = sum(a.nbytes for level in own.levels for a in (level.grams, level.bits, level.contexts, level.escapes))
    assert 100 * size < 300 << 20


def test_junk_is_no_language(spark):
    rng = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    junk = "".join(rng.choice("bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ#%&0123456789") for _ in range(2_000))
    foreign = " ".join(composed(rng, [chr(c) for c in range(0x5D0, 0x5EA)], 10))
    schema = docs.select("doc_id", "text", "lang", "source", "n_chars").schema
    odd = spark.createDataFrame([(-1, junk, None, None, 0), (-2, foreign, None, None, 0)], schema)
    kept = {r.doc_id for r in langid.with_language(docs.select(*schema.names).union(odd)).collect()}
    assert not kept & {-1, -2} and len(kept) >= 0.95 * docs.count()


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumn("v", langid.F.lit(1))
    rows = langid.identify(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (3, 4, 6)] == ["und"] * 3
    assert by_id[8].lang_pred == by_id[None].lang_pred == "de" and by_id[7].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows)
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    empty = langid.identify(docs.limit(0))
    assert empty.count() == 0
    untaught = langid.identify(docs.withColumn("lang", langid.F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert total > 200 and right / total > 0.98
