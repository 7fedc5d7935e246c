import math
from collections import Counter
from datetime import datetime

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from postlens import queries
from postlens.functions.text import words
from postlens.operators import cleaning, rows, stats

TEXTS = ["ut eu ut", "eu vel  ut", "", "ut", None, "nec"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_word_count(texts):
    expected = Counter(w for t in TEXTS if t for w in t.split())
    ranked = sorted(expected.items(), key=lambda item: (-item[1], item[0]))
    assert [tuple(r) for r in stats.word_count(texts).collect()] == ranked
    assert [tuple(r) for r in stats.top_words(texts, 2).collect()] == ranked[:2]


def test_corpus_stats_counts_empty_words(texts):
    staged = texts.withColumn("start", F.col("text")).withColumn("case", F.upper("text"))
    corpus = " ".join(t for t in TEXTS if t is not None).split(" ")
    found = {r.step: (r.total_words, r.unique_words) for r in stats.corpus_stats(staged, ["start", "case"]).collect()}
    assert found == {"start": (len(corpus), len(set(corpus))), "case": (len(corpus), len(set(corpus)))}


def test_tfidf_agrees_with_the_ml_stage(texts):
    tokens = texts.where("text is not null").select("id", words(F.col("text")).alias("words"))
    vectorizer = CountVectorizer(inputCol="words", outputCol="counts").fit(tokens)
    counted = vectorizer.transform(tokens)
    vectors = IDF(inputCol="counts", outputCol="weights").fit(counted).transform(counted).collect()
    expected = {(v.id, vectorizer.vocabulary[i]): w for v in vectors for i, w in zip(v.weights.indices, v.weights.values)}
    found = {(r.id, r.term): r.tfidf for r in stats.tfidf(texts.where("text is not null"), "id", "text").collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], abs_tol=1e-12) for k in found)


def test_counters(texts):
    counted = rows.count_stages(texts, {"all": F.lit(True), "ut": F.col("text").contains("ut")})
    assert {r.counter: r.n for r in counted.collect()} == {"all": 6, "ut": 3}
    with pytest.raises(ValueError):
        rows.count_stages(texts, {})


def test_samples_are_fixed_and_nested(spark):
    ids = spark.range(5000)
    pick = lambda fraction, n=3: {r.id for r in rows.hash_sample(ids.repartition(n), "id", fraction).collect()}
    tenth, half = pick(0.1), pick(0.5)
    assert tenth == pick(0.1, 7) and tenth < half and abs(len(tenth) - 500) < 100
    assert pick(0) == set() and len(pick(1)) == 5000


def test_days_merge_and_are_counted_once(spark, tmp_path):
    from datetime import date

    steps, path, seen = ("start", "case", "cut"), str(tmp_path / "state"), []

    def stage(rows):
        seen.append(sorted({r.day for r in rows.collect()}))
        return rows.withColumn("start", F.col("text")).withColumn("case", F.upper("text")).withColumn("cut", F.when(F.length("text") > 3, F.col("case")))

    rows = [(date(2024, 1, 1 + i % 4), t) for i, t in enumerate(TEXTS * 3)] + [(None, "lost")]
    whole = spark.createDataFrame(rows, "day date, text string")
    for last in (2, 2, 4):
        stats.add_days(whole.where(F.col("day").isNull() | (F.dayofmonth("day") <= last)), stage, steps, path)
    assert seen == [[date(2024, 1, 1), date(2024, 1, 2)], [date(2024, 1, 3), date(2024, 1, 4)]]
    merged = stats.summed_steps(spark.read.parquet(path), steps).collect()
    want = stats.corpus_stats(stage(whole.where("day is not null")), steps).collect()
    assert sorted(merged) == sorted(want) and len(want) == 3
    assert stats.add_days(whole.limit(0), stage, steps, str(tmp_path / "none")) == []


def test_windows_do_not_put_all_posts_together_again(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    plain = spark.createDataFrame([(datetime(2024, 1, 1 + i % 30, 5), f"The cat's {i}") for i in range(40)], "ts timestamp_ntz, text string")
    monkeypatch.setattr(queries.derived, "posts", lambda *_: plain.mapInArrow(count, plain.schema))
    found = queries.corpus_stats_by_day(spark, "").collect()
    # Once for the last day, and once for the posts of all windows.
    assert made.value == 2 * 40
    want = stats.corpus_stats(cleaning.clean_stages(plain, "text", cleaning.ALL_STEPS), queries.STEPS).collect()
    assert sorted(found) == sorted(want)
