import pytest
from pyspark.sql import functions as F

from postlens.operators import lexicon, skew


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows share one key."""
    return spark.range(6000).select("id", F.expr("if(id % 3 = 0, 'hot', concat('k', id % 50))").alias("key"))


@pytest.fixture(scope="module")
def lookup(facts):
    return facts.where("key <> 'k7'").groupBy("key").agg(F.count("*").alias("n")).withColumn("value", F.upper("key"))


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_keys_join_like_any_other(spark, facts, lookup, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for how in ("left", "inner"):
            expected = sorted(facts.join(lookup, "key", how).select("id", "key", "value").collect())
            salted = skew.salted_join(facts, lookup, "key", spread="id", how=how)
            assert sorted(salted.select("id", "key", "value").collect(), key=str) == sorted(expected, key=str)
        known = facts.where("key <> 'k7'")
        expected = sorted(known.join(lookup, "key").select("id", "key", "value").collect())
        for share in (0.1, 1e-9, 2.0):
            weighted = skew.weighted_join(known, lookup, "key", "n", "value", spread="id", hot_share=share)
            assert sorted(weighted.select("id", "key", "value").collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unknown_join_type(facts, lookup):
    with pytest.raises(ValueError):
        skew.salted_join(facts, lookup, "key", spread="id", how="full")


def test_rewrite_tokens(spark):
    texts = spark.createDataFrame(
        [(1, "the cats  the dogs"), (2, ""), (3, None), (4, "the"), (5, "the cats " * 500)], "id int, text string")
    table = spark.createDataFrame(
        [("cats", "cat"), ("the", None), ("unused", "x")], "token string, replacement string")
    rewritten = {r.id: r.text for r in lexicon.rewrite_tokens(texts, "id", "text", table).collect()}
    assert rewritten == {1: "cat  dogs", 2: "", 3: None, 4: "", 5: " ".join(["cat"] * 500) + " "}
