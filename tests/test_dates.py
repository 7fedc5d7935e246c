from datetime import date, datetime

from pyspark.sql import functions as F

from postlens.functions import dates, params


def test_post_dates(apply):
    texts = ["Fri Feb 04 06:12:11 +0000 2022", "Fri Feb 04 23:30:00 -0200 2022", "Fre Feb 04 06:12:11 +0000 2022",
             "not a date", "Fri Feb 34 06:12:11 +0000 2022", "", None]
    assert apply(dates.partition_date, texts) == ["2022-02-04", "2022-02-05", None, None, None, None, None]
    assert apply(dates.post_datetime, texts)[0] == "2022-02-04 06:12:11.000"


def test_post_dates_do_not_depend_on_the_session_zone(spark, apply):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert apply(dates.post_datetime, ["Fri Feb 04 23:12:11 +0000 2022"]) == ["2022-02-04 23:12:11.000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso(apply):
    texts = ["2022-02-04T06:12:11", "2022-02-04 06:12:11.5", "2022-02-04", "junk", None]
    assert apply(dates.parse_iso, texts) == [
        datetime(2022, 2, 4, 6, 12, 11), datetime(2022, 2, 4, 6, 12, 11, 500000), datetime(2022, 2, 4), None, None]
    assert apply(lambda c: dates.format_utc(dates.parse_iso(c)), texts[:1]) == ["2022-02-04T06:12:11Z"]


def test_daily_includes_both_ends(spark):
    row = spark.sql("select timestamp_ntz'2022-02-27 12:00' a, timestamp_ntz'2022-03-01 01:00' b").select(
        dates.daily(F.col("a"), F.col("b")).alias("days")).first()
    assert row.days == [date(2022, 2, 27), date(2022, 2, 28), date(2022, 3, 1)]


def test_params_round_trip(spark):
    row = spark.sql("select timestamp_ntz'2022-02-27' a, timestamp_ntz'2022-02-28' b, 'x' brand").select(
        params.to_params(F.col("a"), F.col("b"), F.col("brand")).alias("p")).select(
        "p", params.start_of(F.col("p")).alias("a"), params.end_of(F.col("p")).alias("b"),
        params.param(F.col("p"), "brand").alias("brand"), params.param(F.col("p"), "none").alias("none")).first()
    assert row.p == '{"start_dt":"2022-02-27T00:00:00","end_dt":"2022-02-28T00:00:00","brand":"x"}'
    assert (row.a, row.b, row.brand, row.none) == (datetime(2022, 2, 27), datetime(2022, 2, 28), "x", None)
