"""Posts, places, catalogs, profiles and run ledgers derived from the given tables.

The tables hold no social posts, so they are composed here: every event becomes a post, and
every document is the whole text of one of them. ``POSTS_SQL`` is one text for both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions import params
from postlens.sources.files import read_table, read_texts

POSTS_SQL = """
select e.event_id as tweet_id, e.user_id as user_id, e.event_type as event_type, e.ts as ts,
 case when e.event_id % 17 = 0 then 'RT ' else '' end
 || '@user' || cast(e.user_id as {S}) || ' My ' || e.event_type || 's isn''t working, mail me u'
 || cast(e.user_id as {S}) || '@example.com #' || t.tag
 || case when e.event_id % 3 = 0 then ' https://t.co/' || cast(e.event_id as {S}) else '' end
 || case when e.event_id % 9 = 0 then '#top' else '' end
 || case when e.event_id % 5 = 0 then ' <b class="x">help</b>' else '' end
 || case when e.event_id % 7 = 0 then ' 😡' when e.event_id % 7 = 1 then ' 👍🏽 ❤️' else '' end
 || coalesce(' ' || d.text, '') as text,
 case when e.event_id % 97 = 0 then cast(null as {S}) when e.event_id % 101 = 0 then 'not a date'
  else {FMT} end as created_at,
 case when e.event_id % 4 = 0 then n.n_name when e.event_id % 4 = 1 then ''
  else cast(null as {S}) end as country_code,
 case when e.event_id % 6 = 0 then 12 + cast((e.event_id * 13) % 1000 as double) / 1000
  when e.event_id % 2 = 0 then cast((e.event_id * 7919) % 17989 as double) / 100 - 89.9 end as lat,
 case when e.event_id % 6 = 0 then 77 + cast((e.event_id * 29) % 1000 as double) / 1000
  when e.event_id % 2 = 0 then cast((e.event_id * 104729) % 35989 as double) / 100 - 179.9 end as lon,
 case when e.event_id % 11 = 0 then cast(null as {S})
  when e.event_id % 19 = 0 then '#' || t.tag else t.tag end as tag1,
 case when e.event_id % 10 = 0 then 'LG' else cast(null as {S}) end as tag2,
 case when e.event_id % 6 = 0 then 'SonySupport' else cast(null as {S}) end as rt_tag1
from {events} e
join (values (0,'panasonicindia'),(1,'sonyindia'),(2,'LGLiving'),(3,'xiaomi'),(4,'huawei'),
 (5,'LGLifeIsGood'),(6,'SonySupport'),(7,'panasonicsupport')) as t(i,tag) on t.i = e.event_id % 8
join {nation} n on n.n_nationkey = e.event_id % 25
left join {documents} d on d.doc_id = e.event_id
"""
SPARK_FORMAT = (
    "date_format(e.ts,'EEE MMM dd HH:mm:ss') || ' +0000 ' || date_format(e.ts,'yyyy')"
)
DUCKDB_FORMAT = "strftime(e.ts,'%a %b %d %H:%M:%S +0000 %Y')"


def posts(spark: SparkSession, folder: str) -> DataFrame:
    sql = POSTS_SQL.replace("{S}", "string").replace("{FMT}", SPARK_FORMAT)
    return spark.sql(
        sql,
        events=read_texts(spark, folder, "events"),
        nation=read_table(spark, folder, "nation"),
        documents=read_table(spark, folder, "documents"),
    )


def tagged_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with their tags as the arrays a payload has."""

    def tags(*names):
        return F.transform(
            F.array_compact(F.array(*names)), lambda tag: F.create_map(F.lit("text"), tag)
        )

    return posts(spark, folder).select(
        "*", tags("tag1", "tag2").alias("hashtags"), tags("rt_tag1").alias("rt_hashtag")
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``(tweet_id, value)``: posts as JSON bytes, some of them damaged."""
    # Field names of the payload.
    reposted = F.struct(
        F.struct(
            F.col("text").alias("full_text"), F.struct(F.col("rt_hashtag").alias("hashtags")).alias("entities")
        ).alias("extended_tweet")
    )
    payload = F.to_json(
        F.struct(
            "text",
            "created_at",
            F.struct("country_code").alias("place"),
            F.struct(F.concat(F.lit("user"), "user_id").alias("handle")).alias("user"),
            F.struct("hashtags").alias("entities"),
            F.when(F.col("lat").isNotNull(), F.struct(F.array("lon", "lat").alias("coordinates"))).alias(
                "coordinates"
            ),
            F.when(F.size("rt_hashtag") > 0, reposted).alias("retweeted_status"),
        )
    )
    damaged = F.concat(F.lit("not json "), payload)
    value = F.when(F.col("tweet_id") % 53 == 0, damaged).otherwise(payload)
    return tagged_posts(spark, folder).select("tweet_id", value.cast("binary").alias("value"))


def lake_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw posts as a document store would deliver them."""
    # Field names of the lake.
    return posts(spark, folder).select(
        F.concat(F.lit("b"), F.col("user_id") % 4).alias("brand"),
        F.col("event_type").alias("category"),
        F.struct(F.col("tweet_id").alias("id"), "text", F.col("ts").alias("created_at")).alias(
            "tweetInfo"
        ),
    )


def nation_places(spark: SparkSession, folder: str) -> DataFrame:
    """One place per nation."""
    key = F.col("n_nationkey")
    return read_table(spark, folder, "nation").select(
        F.col("n_name").alias("cc"),
        ((key * 37) % 180 - 90).cast("double").alias("lat"),
        ((key * 71) % 360 - 180).cast("double").alias("lon"),
    )


def customer_places(spark: SparkSession, folder: str) -> DataFrame:
    """One place per customer; every third lies in the same square degree."""
    key, crowded = F.col("c_custkey"), F.col("c_custkey") % 3 == 0
    return read_table(spark, folder, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("cc"),
        F.when(crowded, 12 + ((key * 17) % 1000).cast("double") / 1000)
        .otherwise(((key * 7907) % 17989).cast("double") / 100 - 89.9)
        .alias("lat"),
        F.when(crowded, 77 + ((key * 23) % 1000).cast("double") / 1000)
        .otherwise(((key * 104723) % 35989).cast("double") / 100 - 179.9)
        .alias("lon"),
    )


def supplier_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A brand catalog with one brand per supplier; brands of one nation share a tag."""
    key = F.col("s_suppkey").cast("string")
    shared = F.concat(F.lit("#N"), F.col("s_nationkey").cast("string"))
    own = F.array(F.concat(F.lit("#S"), key), F.concat(F.lit("#S"), key, F.lit("Support")), shared)
    other = F.struct(
        F.lit("Forum").alias("name"), F.array(F.lit("#none")).alias("hashtags"), key.alias("handle")
    )
    twitter = F.struct(
        F.lit("Twitter").alias("name"), own.alias("hashtags"), F.col("s_name").alias("handle")
    )
    return read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("position"),
        F.when(F.col("s_suppkey") % 10 != 7, F.col("s_suppkey") % 4 != 1).alias("active"),
        F.col("s_name").alias("name"),
        F.array(F.lit("Supplies")).alias("categories"),
        F.when(F.col("s_suppkey") % 6 == 5, F.array(other))
        .otherwise(F.array(other, twitter))
        .alias("platforms"),
    )


def supplier_catalog_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The supplier catalog as it was at the start and after two changes.

    With the first change every third supplier takes over its successor's tag and every fifth drops
    out; with the second, nations' tags go.
    """
    key = F.col("position")
    rows = supplier_catalog(spark, folder)
    tags = F.filter("platforms", lambda p: p["name"] == "Twitter")
    successor = F.array(F.concat(F.lit("#S"), (key + 1).cast("string")))

    def version(since: str | None, active: Column, own) -> DataFrame:
        platforms = F.transform(tags, lambda p: p.withField("hashtags", own(p["hashtags"])))
        return rows.select("position", active.alias("active"), "name", platforms.alias("platforms"), F.lit(since).cast("timestamp_ntz").alias("valid_from"))

    taken = lambda own: F.when(key % 3 == 0, successor).otherwise(own)
    return (
        version(None, F.col("active"), lambda own: own)
        .union(version("2024-01-11 06:30:00", F.col("active") & (key % 5 != 2), taken))
        .union(version("2024-01-21", F.col("active"), lambda own: F.filter(own, lambda t: ~t.startswith("#N"))))
    )


def supplier_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Posts that mention suppliers: an unknown tag, a supplier's, then a nation's."""

    def tag(*parts):
        return F.create_map(F.lit("text"), F.concat(*[p.cast("string") for p in parts]))

    user, post = F.col("user_id"), F.col("tweet_id")
    return posts(spark, folder).select(
        "tweet_id",
        "ts",
        F.when(
            post % 5 != 0, F.array(tag(F.lit("x"), post), tag(F.lit("S"), user))
        ).alias("hashtags"),
        F.when(post % 2 == 0, F.array(tag(F.lit("#n"), post % 25))).alias("rt_hashtag"),
    )


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Customer profiles with a list of web sites."""
    key = F.col("c_custkey")
    return read_table(spark, folder, "customer").select(
        F.concat(F.lit('"Suite '), key.cast("string"), F.lit('", Main St')).alias("address"),
        F.when(key % 2 == 0, "A-").otherwise("O+").alias("blood_group"),
        F.col("c_mktsegment").alias("company"),
        F.lit("clerk").alias("job"),
        F.col("c_name").alias("name"),
        F.when(key % 3 == 0, "F").otherwise("M").alias("sex"),
        F.concat(F.lit("user"), key.cast("string")).alias("username"),
        F.array("c_name", "c_mktsegment").alias("website"),
    )


def order_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run ledger with one run per order."""
    key, started = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    return read_table(spark, folder, "orders").select(
        F.when(key % 50 != 0, started).alias("run_started_at"),
        F.lpad(key.cast("string"), 12, "0").alias("run_id"),
        (started + F.expr("interval 1 hour")).alias("run_end_at"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("ERROR").alias("run_status"),
        F.col("o_orderpriority").alias("task_type"),
        params.to_params(
            started,
            started + F.expr("interval 1 day"),
            F.concat(F.lit("b"), (F.col("o_custkey") % 4).cast("string")),
        ).alias("source_query_param"),
        F.lit("store").alias("source"),
        F.lit("lake").alias("sink"),
        F.lit(None).cast("bigint").alias("n_rows"),
        F.lit(None).cast("string").alias("message"),
    ).to(schemas.LEDGER)


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a known quality as ``(doc_id, text, label)``; low quality is the target."""
    return (
        read_table(spark, folder, "labels")
        .join(read_texts(spark, folder, "documents"), "doc_id")
        .select("doc_id", "text", (1 - F.col("quality")).alias("label"))
    )
