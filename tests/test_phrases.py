"""Phrase dictionaries as tables: leftmost, longest matches, inside the cleaning chain."""

import random

import pytest
from postlens.functions import lexicon
from postlens.operators import cleaning, phrases
from pyspark.sql import functions as F


def plain(text, table, cut):
    """Walk the segments of a text from the left and take the longest phrase at each."""
    if text is None:
        return None
    known = {}
    for phrase, replacement in table:
        if cut(phrase):
            old = known.get(tuple(cut(phrase)))
            known[tuple(cut(phrase))] = max((r for r in (old, replacement) if r is not None), default=None)
    longest = max(map(len, known), default=0)
    own, out, at = cut(text), [], 0
    while at < len(own):
        n = next((n for n in range(min(longest, len(own) - at), 0, -1) if tuple(own[at : at + n]) in known), 0)
        out.append((known[tuple(own[at : at + n])] or "") if n else own[at])
        at += n or 1
    return "".join(out)


def spaced(text):
    return [s for part in text.split(" ") for s in (part, " ")][:-1] if text else []


@pytest.mark.parametrize("hot_share", [1e-4, 0.02, 2.0])
def test_random_texts_equal_a_plain_walk(spark, hot_share):
    rng = random.Random(1)
    word = lambda: rng.choice("abcdefg")
    texts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, "", " ", "a  b", "a b " * 3_000]
    texts += ["a b c d"] * 50
    table = [(" ".join(word() for _ in range(rng.randint(1, 5))), rng.choice(["X", "Y Z", "", None])) for _ in range(60)]
    table += [("a", "1"), ("a", "2"), ("", "empty"), ("b c", None)]
    cut = lambda t: [s for s in spaced(t) if s]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    found = phrases.rewrite_phrases(rows, "text", spark.createDataFrame(table, "phrase string, replacement string"), hot_share=hot_share)
    assert found.columns == ["i", "text"]
    assert {r.i: r.text for r in found.collect()} == {i: plain(t, table, cut) for i, t in enumerate(texts)}


def test_no_rows_no_entries(spark):
    rows = spark.createDataFrame([(1, "a b")], "i int, text string")
    none = spark.createDataFrame([], "phrase string, replacement string")
    some = spark.createDataFrame([("a", "x")], "phrase string, replacement string")
    assert [r.text for r in phrases.rewrite_phrases(rows, "text", none).collect()] == ["a b"]
    assert phrases.rewrite_phrases(rows.limit(0), "text", some).count() == 0


def test_table_chain_equals_inlined_chain(spark):
    """With the small dictionaries as tables the chain gives what it gives inlined."""
    texts = ["I don’t think it's you're 👍🏽 ok ❤️x", "The batteries of MY phones  aren't\there", None, "", "RT x", "can't-won't 😡😡", "he's children's #tag @user a@b.co"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")

    def table(entries):
        return spark.createDataFrame(list(entries.items()), "phrase string, replacement string")

    words = cleaning.Lexicon(
        stop_words=spark.createDataFrame([(w,) for w in set(lexicon.STOP_WORDS)], "phrase string"),
        contractions=table(lexicon.CONTRACTIONS),
        emoji=table(lexicon.EMOJI),
        lemmas=table(lexicon.LEMMAS),
    )
    want = cleaning.clean(rows, steps=cleaning.ALL_STEPS).collect()
    assert sorted(cleaning.clean(rows, steps=cleaning.ALL_STEPS, words=words).collect(), key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        cleaning.clean_stages(rows, "text", words=words)


def test_rows_are_made_once_for_all_readings(spark):
    """Chained dictionaries: each row of the source is computed once, not at every reading of every step."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, f"a b c {i}") for i in range(20)], "i int, text string").mapInArrow(count, "i int, text string")
    table = spark.createDataFrame([("a b", "x"), ("x c", "y")], "phrase string, replacement string")
    done = rows
    for _ in range(2):
        done = phrases.rewrite_phrases(done, "text", table)
    assert {r.i: r.text for r in done.collect()} == {i: f"y {i}" for i in range(20)}
    assert made.value == 20


def test_long_phrases_take_no_more_jobs(spark):
    """Windows of all lengths meet the phrases at once."""
    rows = spark.createDataFrame([(i, f"a b c d e f {i}") for i in range(20)], "i int, text string")

    def jobs(phrase):
        spark.sparkContext.setJobGroup(f"phrases {phrase}", "")
        found = phrases.rewrite_phrases(rows, "text", spark.createDataFrame([(phrase, "x")], "phrase string, replacement string")).collect()
        assert {r.text for r in found} == {f"a b c d e f {i}".replace(phrase, "x") for i in range(20)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"phrases {phrase}"))

    try:
        assert jobs("a b c d e") <= jobs("a b") + 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
