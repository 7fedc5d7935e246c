import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.functions import lexicon, text
from postlens.operators.cleaning import ALL_STEPS, MASKING_STEPS, clean, clean_stages

GOLDEN = [
    ("Hi @bob and x@y.com #LG!", "hi HANDLE and EMAIL HASHTAG"),
    ("@a @b", "HANDLE HANDLE"),
    ("See https://t.co/a#frag now", "see URL HASHTAG now"),
    ('<b class="x">Hi</b>, snake_case', "MARKUPhiMARKUP snake_case"),
    ("café  ok", "café ok"),
    ("No", "no"),
    ("", ""),
    (None, None),
]

# The masking rules, restated with Python's own regular expressions.
RULES = [
    (r"[\w.+-]+@[\w-]+(\.[\w-]+)+", "{{EMAIL}}"),
    (r"(^|[^@\w])@(\w{1,15})\b", " {{HANDLE}}"),
    (r"#(\w+)", " {{HASHTAG}}"),
    (r"https?://\S+|www\.\S+", "{{URL}}"),
    (r"<(\"[^\"]*\"|'[^']*'|[^'\">])*>", "{{MARKUP}}"),
    (r"[^\w\s]", ""),
]


def masked(value):
    value = value.lower()
    for pattern, mark in RULES:
        value = re.sub(pattern, mark, value)
    return " ".join(value.split())


def run_clean(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [row.prepped_text for row in clean(rows, **options).orderBy("i").collect()]


def test_golden_rows(spark):
    given_texts, expected = zip(*GOLDEN)
    assert run_clean(spark, given_texts, steps=MASKING_STEPS) == list(expected)


FRAGMENTS = st.sampled_from(
    ["@bob", "@", "#", "tag", "x@y.com", "+d@e.f", "a.b@c-d.co.uk", "http://t.co/a", "www.x", "<b>",
     "<a href='x>'>", "<", ">", "'", '"', " ", "\n", " ", "é", "日本", "_", ".", "-", "!", "No", "@seventeen_letters_x",
     "{{URL}}", "..", "@@", "#é", "x#y", " ", "½", "١"]
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(FRAGMENTS, max_size=12).map("".join), min_size=40, max_size=80))
def test_masking_agrees_with_python(spark, texts):
    assert run_clean(spark, texts, steps=MASKING_STEPS) == [masked(t) for t in texts]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(FRAGMENTS, max_size=12).map("".join), min_size=20, max_size=40))
def test_cleaned_text_stays_clean(spark, texts):
    once = [t.lower() for t in run_clean(spark, texts, steps=MASKING_STEPS)]
    assert [t.lower() for t in run_clean(spark, once, steps=MASKING_STEPS)] == once


def test_long_texts_take_linear_time(spark):
    long = 200_000
    texts = ["a" * long, "<" + "a" * long, "a." * (long // 2) + "@", "<" + "'x'" * (long // 3),
             "x@" + "a." * (long // 2), "#" * long, "@" * long]
    start = time.time()
    cleaned = run_clean(spark, texts)
    assert time.time() - start < 60
    assert len(cleaned) == len(texts) and cleaned[0] == "a" * long


def test_stop_words(apply):
    texts = ["i love the phone, panasonic", "the, end", "  the ", "", None]
    # Punctuation is removed later, so a word with a comma is not a stop word yet.
    assert apply(text.remove_stop_words, texts) == ["love phone,", "the, end", "", "", None]


def test_contractions(apply):
    texts = ["it isn't on, (can't) won’t", "dogs' isn'tx", "plain", "", None]
    assert apply(text.expand_contractions, texts) == [
        "it is not on, (cannot) will not", "dogs' isn'tx", "plain", "", None]


def test_emoji(apply):
    texts = ["no 👍🏽 yes👍 ❤️", "😡😡", "日本 ☃ ok", "plain", "", None]
    assert apply(text.describe_emoji, texts) == [
        "no :thumbs up: medium skin tone: yes:thumbs up: :red heart:",
        ":enraged face::enraged face:", "日本 ☃ ok", "plain", "", None]


def test_lemmas(apply):
    assert apply(text.lemmatize, ["two  phones phones,", "", None]) == ["two  phone phones,", "", None]
    assert apply(lambda c: text.lemmatize(c, {"ran": "run"}), ["he ran"]) == ["he run"]


def test_large_dictionary_is_refused(apply):
    with pytest.raises(ValueError, match="rewrite_tokens"):
        apply(lambda c: text.lemmatize(c, {str(i): "x" for i in range(text.MAX_INLINE_ENTRIES + 1)}), ["a"])


def test_unicode(apply):
    texts = ["cafÃ©", "café", "Ã", "日本", "plain", "é©", "", None]
    assert apply(text.fix_unicode, texts) == ["café", "café", "Ã", "日本", "plain", "é©", "", None]


def test_labels(apply):
    assert apply(text.label_code, ["No", "Yes", "no", "", None]) == [0, 1, None, None, None]


def test_email_after_email(apply):
    assert apply(text.mask_email, ["a@b.c+d@e.f x@y.com,z@w.org @b.c"]) == [
        "{{EMAIL}}{{EMAIL}} {{EMAIL}},{{EMAIL}} @b.c"]


def test_retweets_are_dropped_only_on_request(spark):
    rows = spark.createDataFrame([("RT a",), ("rt b",), (None,)], "text string")
    assert clean(rows).count() == 3
    assert [r.prepped_text for r in clean(rows, steps=ALL_STEPS).collect()] == ["rt b", None]


def test_unknown_step(spark):
    with pytest.raises(ValueError, match="unknown"):
        clean(spark.createDataFrame([("a",)], "text string"), steps=["cases"])


def test_stages_end_where_clean_ends(spark):
    rows = spark.createDataFrame([("RT @a It's #x 😡 phones",), ("The <b>A</b>",)], "text string")
    staged = clean_stages(rows, "text")
    last = staged.select("text", text.squeeze_space(F.col("punctuation")).alias("prepped_text"))
    assert sorted(last.collect()) == sorted(clean(rows).select("text", "prepped_text").collect())


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([("a",)], "text string")
    plan = clean(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_fixed_lists():
    assert "panasonic" in lexicon.STOP_WORDS and lexicon.LABEL_CODES == {"No": 0, "Yes": 1}


def test_texts_of_ascii_alone_are_matched_like_others(spark):
    """The table-looked-up classes match what the classes of all scripts do."""
    texts = [chr(i) for i in range(128)] + [f"a{chr(i)}@bc{chr(i)} {chr(i)}  #d{chr(i)}" for i in range(128)] + ["", None, "@a @b@c", "\t a \n b "]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    pairs = [
        (text.mask_handle, lambda t: F.regexp_replace(t, text.HANDLE, " {{HANDLE}}")),
        (text.strip_punctuation, lambda t: F.regexp_replace(t, text.PUNCTUATION, "")),
        (text.squeeze_space, lambda t: F.trim(F.regexp_replace(t, f"[{text.SPACE}]+", " "))),
    ]
    for ours, plain in pairs:
        assert rows.where(~ours(F.col("text")).eqNullSafe(plain(F.col("text")))).count() == 0
    plan = rows.select(text.strip_punctuation(F.col("text")))._jdf.queryExecution().toString()
    assert r"[\x00" in plan
