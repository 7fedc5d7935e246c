"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import derived, schemas
from postlens.functions import dates, hashtags, params, text
from postlens.operators import brands, claims, cleaning, ledger, lexicon, places, rows, stats
from postlens.plans import enrich, ingest, score
from postlens.session import fresh_folder
from postlens.sinks import compact
from postlens.sinks.files import write_lake, write_parquet, write_profiles
from postlens.sources.external import stream_values
from postlens.sources.files import (
    JSON_OPTIONS,
    in_partitions,
    in_window,
    read_csv,
    read_json,
    read_lake,
    read_table,
    read_texts,
)
from postlens.streaming.enrich import Distinct, batch_log, enrich_stream, run_enrichment, write_stream

Query = Callable[[SparkSession, str], DataFrame]

# The days and ledger keys the queries ask for.
WINDOW = ("2024-01-08", "2024-01-15")
TASK, BRAND = "2-HIGH", "b1"
FIRST_DAY, INGEST_LENGTH, RAW_LENGTH = datetime(2024, 1, 1), timedelta(days=10), timedelta(days=20)
TOP_WORDS = 20
STEPS = ("start", *cleaning.ALL_STEPS)
PARTS, DELAY = ("2024-01-11", "2024-01-21"), timedelta(days=5)
# Columns of the enriched posts.
ENRICHED = ["text", "brand", "country", "occurred_on", "prepped_text"]


def _on_posts(function: Callable[[Column], Column], name: str = "text", lower: bool = False) -> Query:
    """A query that applies one Column function to every post."""

    def query(spark, folder):
        value = F.lower(name) if lower else F.col(name)
        return derived.posts(spark, folder).select("tweet_id", function(value).alias("out"))

    return query


def _moment(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def _tags(spark: SparkSession, limit: int = brands.MAX_INLINE_TAGS) -> brands.Tags:
    return brands.inline_tags(brands.brand_hashtags(brands.default_catalog(spark)), limit)


def _runs(spark: SparkSession, folder: str, length: timedelta) -> range:
    """As many windows as lead from the first day past the last post."""
    last = derived.posts(spark, folder).agg(F.max("ts")).first()[0]
    return range((last.date() - FIRST_DAY.date()) // length + 1)


# Sources, sinks and projections


def incremental_window(spark, folder):
    window = in_window(derived.posts(spark, folder), "ts", *map(_moment, WINDOW))
    return window.select("tweet_id", "text", F.lit(WINDOW[1]).cast("date").alias("created_at"))


def _lake(spark, folder) -> str:
    root = fresh_folder(spark, "lake")
    write_lake(ingest.label_by_day(derived.lake_posts(spark, folder)), root)
    return root


def lake_json_scan(spark, folder):
    return read_lake(spark, _lake(spark, folder)).select(
        F.col("tweetInfo.id").alias("tweet_id"),
        F.col("tweetInfo.text").alias("text"),
        "category",
        "brand",
        F.col("created_at").cast("date").alias("created_at"),
    )


def partition_range_scan(spark, folder):
    days = [F.lit(day).cast("date") for day in WINDOW]
    wanted = in_partitions(read_lake(spark, _lake(spark, folder)), "click", BRAND, *days)
    return wanted.groupBy("category", "brand", "created_at").agg(F.count("*").alias("n"))


def lake_compacted(spark, folder):
    """The lake in many small files, packed: its rows, and how many files each partition has."""
    root = fresh_folder(spark, "lake")
    posts = ingest.label_by_day(derived.lake_posts(spark, folder))
    # About four files a partition; a task holds no more rows in a larger lake.
    files = 4 * posts.select(*schemas.LAKE_PARTITIONS).distinct().count()
    per_file = -(-read_table(spark, folder, "events").count() // max(files, 1))
    small = posts.hint("rebalance", *schemas.LAKE_PARTITIONS).write.options(**JSON_OPTIONS)
    small.option("maxRecordsPerFile", max(per_file, 1)).partitionBy(*schemas.LAKE_PARTITIONS).json(root)
    compact.compact(spark, root)
    rows = compact.read_live(spark, root, schemas.LAKE).select("*", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("category", "brand", F.col("created_at").cast("date").alias("created_at")).agg(
        F.count("*").alias("n"), F.count_distinct("file").alias("n_files"), F.sum("tweetInfo.id").alias("ids")
    )


def lake_csv_scan(spark, folder):
    root = fresh_folder(spark, "profiles")
    write_profiles(_reshaped(spark, folder), root)
    return read_csv(spark, root, schemas.PROFILE, line_breaks=True)


def parquet_roundtrip(spark, folder):
    path = fresh_folder(spark, "cleaned")
    cleaned = cleaning.clean(read_texts(spark, folder, "documents"))
    write_parquet(cleaned.select("doc_id", "prepped_text"), path)
    return spark.read.parquet(path)


def raw_dataset(spark, folder):
    """All categories of one brand, under one task name, into one target."""
    lake, target = _lake(spark, folder), fresh_folder(spark, "raw")
    store = ledger.LedgerStore("parquet", {"path": fresh_folder(spark, "ledger")})
    posts = read_lake(spark, lake).where(F.col("brand") == BRAND)
    categories = sorted(row.category for row in posts.select("category").distinct().collect())
    runs = _runs(spark, folder, RAW_LENGTH)
    for category in categories:
        for run in runs:
            ingest.build_next_raw_dataset(
                spark, store, lake, target, "raw", f"{category}-{run}", category, BRAND, FIRST_DAY, RAW_LENGTH
            )
    return read_json(spark, target, schemas.RAW_DATASET)


def sql_over_views(spark, folder):
    posts = derived.tagged_posts(spark, folder)
    tagged = brands.detect_brand(posts, _tags(spark))
    return spark.sql(
        "select brand, cast(ts as date) as day, count(*) as n from {posts} group by 1, 2",
        posts=tagged,
    )


def profile_reshape(spark, folder):
    return _reshaped(spark, folder)


def _reshaped(spark, folder):
    profiles = derived.profiles(spark, folder)
    # Columns of a profile.
    return profiles.select(
        "address",
        "blood_group",
        "company",
        "job",
        "name",
        "sex",
        "username",
        F.concat_ws(" || ", "website").alias("website"),
        F.lit("2021-11-01").alias("created_at"),
    )


def tweet_parse(spark, folder):
    parsed = enrich.parse(derived.payloads(spark, folder), keep=("tweet_id",))
    return parsed.select(
        "tweet_id",
        "text",
        "country_code",
        "created_at",
        F.array_join(hashtags.tag_texts(F.col("hashtags")), " ").alias("hashtags"),
        F.array_join(hashtags.tag_texts(F.col("rt_hashtag")), " ").alias("rt_hashtag"),
        F.col("coordinates")[0].alias("lon"),
        F.col("coordinates")[1].alias("lat"),
    )


def quarantine_split(spark, folder):
    split = enrich.split_quality(derived.payloads(spark, folder), keep=("tweet_id",))
    return split.select("tweet_id", F.coalesce("reason", F.lit("usable")).alias("state"))


def retweet_filter(spark, folder):
    return rows.drop_retweets(derived.posts(spark, folder)).select("tweet_id", "text")


def hash_sample(spark, folder):
    return rows.hash_sample(derived.posts(spark, folder), "tweet_id", 0.1).select("tweet_id", "text")


# Lookups


def brand_hashtags(spark, folder):
    return brands.brand_hashtags(derived.supplier_catalog(spark, folder))


def brand_detect(spark, folder):
    found = brands.detect_brand(derived.tagged_posts(spark, folder), _tags(spark))
    return found.select("tweet_id", "brand")


def brand_detect_large(spark, folder):
    mentions = derived.supplier_mentions(spark, folder)
    tags = brands.brand_hashtags(derived.supplier_catalog(spark, folder))
    return brands.detect_brand(mentions, tags).select("tweet_id", "brand")


def brand_detect_asof(spark, folder):
    """Brands by the catalog as it was when the post was written; it changed twice in the month."""
    versions = brands.catalog_versions(derived.supplier_catalog_versions(spark, folder))
    return brands.detect_brand_asof(derived.supplier_mentions(spark, folder), versions, "ts").select("tweet_id", "brand")


def hashtag_union(spark, folder):
    tags = hashtags.all_tags(F.col("hashtags"), F.col("rt_hashtag"))
    return derived.tagged_posts(spark, folder).select(
        "tweet_id", F.array_join(F.transform(tags, hashtags.normal_tag), " ").alias("tags")
    )


def country_resolve(spark, folder):
    index = places.build_place_index(derived.customer_places(spark, folder))
    posts = derived.posts(spark, folder).select("tweet_id", "country_code", "lat", "lon")
    return places.resolve_country(posts, index).select("tweet_id", "country")


def country_resolve_shuffle(spark, folder):
    """The same with the index joined, as if it were too large to broadcast."""
    index = places.build_place_index(derived.customer_places(spark, folder))
    posts = derived.posts(spark, folder).select("tweet_id", "country_code", "lat", "lon")
    return places.resolve_country(posts, index, max_broadcast=0).select("tweet_id", "country")


def lemma_table(spark, folder):
    """Rewrite by a dictionary that grows with the data: plurals whose singular also occurs."""
    texts = read_texts(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    tokens = texts.select(F.explode(F.split("text", " ")).alias("token")).distinct()
    plurals = tokens.where(F.col("token").rlike("^[a-z]{3,}s$"))
    singular = F.regexp_replace("token", "s$", "")
    table = plurals.select("token", singular.alias("replacement")).join(
        tokens.select(F.col("token").alias("replacement")), "replacement", "left_semi"
    )
    return lexicon.rewrite_tokens(texts, "doc_id", "text", table)


def stopword_table(spark, folder):
    """Drop the tokens that occur in at least a tenth of all documents."""
    texts = read_texts(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    total = texts.select(F.count("*").alias("n")).scalar()
    common = (
        texts.select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") * 10 >= total)
        .select("token", F.lit(None).cast("string").alias("replacement"))
    )
    return lexicon.rewrite_tokens(texts, "doc_id", "text", common)


# Text


def mask_markup(spark, folder):
    return read_texts(spark, folder, "pages").select(
        "page_id", text.mask_markup(F.col("html")).alias("out")
    )


def unicode_fix(spark, folder):
    """Garble every document by decoding its bytes wrongly, then repair it."""
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return (
        read_texts(spark, folder, "documents")
        .select("doc_id", "text", garbled.alias("garbled"))
        .select(
            "doc_id",
            text.fix_unicode(F.col("garbled")).alias("repaired"),
            text.fix_unicode(F.col("text")).alias("untouched"),
        )
    )


def clean_text(spark, folder):
    return cleaning.clean(derived.posts(spark, folder)).select("tweet_id", "prepped_text")


def clean_documents(spark, folder):
    documents = read_texts(spark, folder, "documents")
    return cleaning.clean(documents).select("doc_id", "prepped_text")


def _neighbours(spark, folder) -> DataFrame:
    """Every lower-case word of the documents with the two tokens after it."""
    tokens = F.split(F.lower("text"), " ")
    texts = read_texts(spark, folder, "documents").select(tokens.alias("t"))
    runs = F.transform("t", lambda w, i: F.struct(w.alias("a"), F.get("t", i + 1).alias("b"), F.get("t", i + 2).alias("c")))
    word = "^[a-z]{2,}$"
    return texts.select(F.inline(runs)).where(F.col("a").rlike(word) & F.col("b").rlike(word)).withColumn(
        "c", F.when(F.col("c").rlike(word), F.col("c"))
    )


def clean_lexicon_tables(spark, folder):
    """The chain with dictionaries of phrases that grow with the data: pairs and triples of words."""
    runs = _neighbours(spark, folder)
    pair, triple = F.concat_ws(" ", "a", "b"), F.concat_ws(" ", "a", "b", "c")
    length = F.length("a") + F.length("b")
    contractions = runs.where(length % 5 == 0).select(pair.alias("phrase"), F.concat("a", F.lit("_"), "b").alias("replacement"))
    lemmas = runs.where(length % 11 == 0).select(pair.alias("phrase"), F.col("a").alias("replacement")).union(
        runs.where(F.col("c").isNotNull() & ((length + F.length("c")) % 7 == 0)).select(triple.alias("phrase"), F.col("b").alias("replacement"))
    )
    stop_words = runs.where(length % 8 == 0).select(pair.alias("phrase"))
    words = cleaning.Lexicon(stop_words.distinct(), contractions.distinct(), lemmas=lemmas.distinct())
    steps = ("case", "contractions", "lemmatization", "stopwords", "punctuation")
    cleaned = cleaning.clean(read_texts(spark, folder, "documents").select("doc_id", "text"), steps=steps, words=words)
    return cleaned.select("doc_id", "prepped_text")


def label_code(spark, folder):
    answer = F.when(F.col("quality") == 1, "Yes").when(F.col("toxic") == 0, "No")
    return (
        read_table(spark, folder, "labels")
        .withColumn("answer", answer)
        .select("doc_id", text.label_code(F.col("answer")).alias("code"))
    )


# Dates and run parameters


def iso_times(spark, folder):
    moment = F.date_format("o_orderdate", dates.ISO_TIME)
    return (
        read_table(spark, folder, "orders")
        .select("o_orderkey", dates.parse_iso(moment).alias("moment"))
        .select(
            "o_orderkey",
            dates.format_iso(F.col("moment")).alias("iso"),
            dates.format_utc(F.col("moment")).alias("utc"),
        )
    )


def date_spine(spark, folder):
    """Orders per day, days without any included."""
    orders = read_table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    spine = orders.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        F.explode(dates.daily(F.col("first"), F.col("last"))).alias("day")
    )
    counted = orders.groupBy("day").agg(F.count("*").alias("n"))
    return spine.join(counted, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def params_json(spark, folder):
    runs = derived.order_runs(spark, folder)
    return runs.select(
        "run_id",
        "source_query_param",
        params.param(F.col("source_query_param"), "brand").alias("brand"),
        dates.format_iso(params.start_of(F.col("source_query_param"))).alias("start_dt"),
    )


# Ledger


def _run_fields(runs: DataFrame, *more) -> DataFrame:
    return runs.select(
        *more, "run_id", dates.format_iso(F.col("run_started_at")).alias("run_started_at")
    )


def checkpoint_latest(spark, folder):
    return _run_fields(ledger.latest(derived.order_runs(spark, folder), TASK), "task_type")


def checkpoint_latest_brand(spark, folder):
    return _run_fields(ledger.latest(derived.order_runs(spark, folder), TASK, BRAND), "task_type")


def checkpoint_latest_all(spark, folder):
    runs = ledger.latest_of_all(derived.order_runs(spark, folder))
    return _run_fields(runs, "task_type", "brand")


def next_window(spark, folder):
    windows = ledger.next_windows(ledger.latest_of_all(derived.order_runs(spark, folder)))
    return windows.select(
        "task_type",
        "brand",
        dates.format_iso(F.col("start_dt")).alias("start_dt"),
        dates.format_iso(F.col("end_dt")).alias("end_dt"),
    )


def ingest_ledger(spark, folder):
    """Ingest all posts window by window; one row per ledger entry."""
    lake, source = fresh_folder(spark, "lake"), derived.lake_posts(spark, folder)
    store = ledger.LedgerStore("parquet", {"path": fresh_folder(spark, "ledger")})
    for run in _runs(spark, folder, INGEST_LENGTH):
        ingest.ingest_next(
            spark, store, source, lake, "ingest", f"run-{run}", FIRST_DAY, INGEST_LENGTH
        )
    return _ledger_days(store.read(spark))


def _ledger_days(entries: DataFrame) -> DataFrame:
    query = F.col("source_query_param")
    return entries.select(
        "run_id",
        "run_status",
        F.date_format(params.start_of(query), "yyyy-MM-dd").alias("start_day"),
        F.date_format(params.end_of(query), "yyyy-MM-dd").alias("end_day"),
        "n_rows",
    )


def ingest_claims(spark, folder):
    """Two drivers ingest all posts; each comes while the other copies a window, and is turned away."""
    lake, source = fresh_folder(spark, "lake"), derived.lake_posts(spark, folder)
    store = ledger.LedgerStore("parquet", {"path": fresh_folder(spark, "ledger")})
    root = fresh_folder(spark, "claims")
    drivers = [claims.Claims(spark, root, owner=name) for name in ("a", "b")]
    refused = []
    for run in _runs(spark, folder, INGEST_LENGTH):
        first, second = drivers[run % 2], drivers[1 - run % 2]

        def copy(start: datetime, end: datetime) -> int:
            status = ingest.ingest_next(spark, store, source, lake, "ingest", f"second-{run}", FIRST_DAY, INGEST_LENGTH, second)
            refused.append((f"second-{run}", status, f"{start:%Y-%m-%d}", f"{end:%Y-%m-%d}"))
            window = in_window(source, "tweetInfo.created_at", dates.moment(start), dates.moment(end))
            return write_lake(ingest.label_by_day(window), lake)

        ingest.run_window(spark, store, "ingest", f"run-{run}", FIRST_DAY, copy, length=INGEST_LENGTH, claims=first)
    turned_away = spark.createDataFrame(refused, "run_id string, run_status string, start_day string, end_day string")
    return _ledger_days(store.read(spark)).unionByName(turned_away, allowMissingColumns=True)


def ingest_late_rows(spark, folder):
    """Posts of every 23rd user come after their windows succeeded: rows per partition once copied again."""
    lake, source = fresh_folder(spark, "lake"), derived.lake_posts(spark, folder)
    late = F.col("tweetInfo.id") % 23 == 0
    store = ledger.LedgerStore("parquet", {"path": fresh_folder(spark, "ledger")})
    for run in _runs(spark, folder, INGEST_LENGTH):
        ingest.ingest_next(spark, store, source.where(~late), lake, "ingest", f"run-{run}", FIRST_DAY, INGEST_LENGTH)
    before = ingest.day_digests(read_lake(spark, lake)).select("category", "brand", "created_at", F.col("n").alias("n_before"))
    path = fresh_folder(spark, "before")
    before.write.parquet(path)
    ingest.copy_late_rows(spark, store, source, lake, "ingest", FIRST_DAY)
    after = ingest.day_digests(read_lake(spark, lake)).drop("digest")
    keys = ["category", "brand", "created_at"]
    return after.join(spark.read.parquet(path), keys, "left").select(*keys, "n", F.coalesce("n_before", F.lit(0)).alias("n_before"))


# Statistics


def corpus_stats(spark, folder):
    """Words after every step of the chain, over documents and posts."""
    texts = read_texts(spark, folder, "documents").select("text")
    texts = texts.union(derived.posts(spark, folder).select("text"))
    staged = cleaning.clean_stages(texts, "text", cleaning.ALL_STEPS)
    return stats.corpus_stats(staged, STEPS)


def corpus_stats_by_day(spark, folder):
    """The same over posts, whose days come window by window; each window counts its new days only."""
    path, days = fresh_folder(spark, "stats"), fresh_folder(spark, "days")
    posts = derived.posts(spark, folder).select("ts", "text", F.col("ts").cast("date").alias("day"))
    # Put together once: every window would join all documents again to reach its few days.
    posts.write.partitionBy("day").parquet(days)
    posts = spark.read.schema(posts.schema).parquet(days)
    for run in _runs(spark, folder, INGEST_LENGTH):
        end = F.lit(FIRST_DAY + INGEST_LENGTH * (run + 1)).cast("timestamp_ntz")
        so_far = posts.where(F.col("ts") < end)
        stats.add_days(so_far, lambda new: cleaning.clean_stages(new, "text", cleaning.ALL_STEPS), STEPS, path)
    return stats.summed_steps(spark.read.parquet(path), STEPS)


def _plain(spark, folder) -> DataFrame:
    """Documents in lower case without punctuation."""
    cleaned = cleaning.clean(
        read_texts(spark, folder, "documents"), steps=("case", "punctuation")
    )
    return cleaned.select("doc_id", F.col("prepped_text").alias("text"))


def word_count(spark, folder):
    return stats.word_count(_plain(spark, folder))


def word_count_top(spark, folder):
    return stats.top_words(_plain(spark, folder), TOP_WORDS)


def stage_counters(spark, folder):
    return rows.count_stages(
        brands.detect_brand(derived.tagged_posts(spark, folder), _tags(spark)),
        {
            "read": F.lit(True),
            "retweets": text.is_retweet(F.col("text")),
            "branded": F.col("brand").isNotNull(),
            "dated": dates.post_timestamp(F.col("created_at")).isNotNull(),
            "located": F.col("lat").isNotNull(),
        },
    )


def tfidf_terms(spark, folder):
    weights = stats.tfidf(_plain(spark, folder), "doc_id", "text")
    return weights.select(
        "doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf")
    )


# Jobs


def mentions_daily(spark, folder):
    """Posts per brand and day, straight from their JSON text."""
    parsed = brands.detect_brand(enrich.parse(derived.payloads(spark, folder)), _tags(spark))
    return (
        parsed.select("brand", dates.partition_date(F.col("created_at")).alias("occurred_on"))
        .groupBy("brand", "occurred_on")
        .agg(F.count("*").alias("n"))
    )


def _enriched(spark, folder, tags):
    index = places.build_place_index(derived.nation_places(spark, folder))
    parsed = enrich.parse(derived.payloads(spark, folder), keep=("tweet_id",))
    return enrich.enrich(parsed, tags, index).select("tweet_id", *ENRICHED)


def tweet_enrich(spark, folder):
    return _enriched(spark, folder, _tags(spark))


def tweet_enrich_large(spark, folder):
    """The same with the catalog as a table, as if it were too large to inline."""
    return _enriched(spark, folder, _tags(spark, limit=0))


def _streamed(spark, folder):
    """Post payloads as text files, through the stream, scoring included, into parquet."""
    source, sink = fresh_folder(spark, "payloads"), fresh_folder(spark, "enriched")
    derived.payloads(spark, folder).select(F.col("value").cast("string")).write.text(source)
    index = places.build_place_index(derived.nation_places(spark, folder))
    values = stream_values(spark, "text", {"path": source})
    stream = enrich_stream(values, _tags(spark), index, _model(spark, folder))
    write_stream(stream, f"{sink}/data", f"{sink}/state", available_now=True).awaitTermination()
    return spark.read.parquet(f"{sink}/data")


def stream_enrich(spark, folder):
    """The whole job of the stream: brand, country, date, clean text and complaint."""
    return _streamed(spark, folder).select(*ENRICHED, "Complaint")


def _enriched_by_batch(spark, folder, source: str, distinct=None):
    """The committed batches of a stream of payloads, with the catalog as a table."""
    sink = fresh_folder(spark, "enriched")
    index = places.build_place_index(derived.nation_places(spark, folder))
    run_enrichment(
        stream_values(spark, "text", {"path": source, "maxFilesPerTrigger": "1"} if distinct else {"path": source}),
        _tags(spark, limit=0),
        index,
        f"{sink}/good",
        f"{sink}/state",
        f"{sink}/bad",
        available_now=True,
        distinct=distinct,
    ).awaitTermination()
    return batch_log(spark, f"{sink}/good"), f"{sink}/good", f"{sink}/bad"


def _good_and_bad(good: DataFrame, bad: DataFrame) -> DataFrame:
    return good.select(F.lit("usable").alias("state"), *ENRICHED).union(
        bad.select(F.col("reason").alias("state"), *[F.lit(None).cast("string").alias(c) for c in ENRICHED])
    )


def stream_quarantine(spark, folder):
    """Payloads through the stream, with the catalog as a table: usable ones, and the others' reasons."""
    source = fresh_folder(spark, "payloads")
    derived.payloads(spark, folder).select(F.col("value").cast("string")).write.text(source)
    _, good, bad = _enriched_by_batch(spark, folder, source)
    return _good_and_bad(spark.read.parquet(good), spark.read.parquet(bad))


def stream_manifest(spark, folder):
    """The same by manifests, with folders of a batch that never was committed beside them."""
    source = fresh_folder(spark, "payloads")
    derived.payloads(spark, folder).select(F.col("value").cast("string")).write.text(source)
    log, good, bad = _enriched_by_batch(spark, folder, source)
    half = spark.read.parquet(f"{good}/batch=0")
    half.write.parquet(f"{good}/batch=999")
    return _good_and_bad(log.read("good", half.schema), log.read("bad", "value string, reason string"))


def stream_distinct(spark, folder):
    """Posts in three files by time; the second holds each tenth post of the first again, and each
    twelfth that belongs in the first comes with the third, too late."""
    source = fresh_folder(spark, "payloads")
    payloads = derived.payloads(spark, folder).join(derived.posts(spark, folder).select("tweet_id", "ts"), "tweet_id")
    first = F.col("ts") < _moment(PARTS[0])
    last = F.col("ts") >= _moment(PARTS[1])
    late = first & (F.col("tweet_id") % 12 == 0)
    again = first & ~late & (F.col("tweet_id") % 10 == 0)
    for wanted in (first & ~late, (~first & ~last) | again, last | late):
        # One file a batch, each later than the one before.
        payloads.where(wanted).select(F.col("value").cast("string")).coalesce(1).write.mode("append").text(source)
    log, good, _ = _enriched_by_batch(spark, folder, source, Distinct(DELAY))
    posts = log.read("good", spark.read.parquet(f"{good}/batch=0").schema)
    return _good_and_bad(posts, log.read("bad", "value string, reason string"))


def _model(spark, folder):
    """Fitted on all labelled documents, saved, and loaded again."""
    path = fresh_folder(spark, "model")
    stages = score.pipeline(NaiveBayes(smoothing=1.0))
    score.save(score.fit(derived.labelled_documents(spark, folder), stages), path)
    return score.load(path)


def batch_score(spark, folder):
    documents = read_texts(spark, folder, "documents").select("doc_id", "text")
    return score.batch_score(documents, _model(spark, folder))


def stream_score(spark, folder):
    return _streamed(spark, folder).select(*ENRICHED, "Complaint")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        incremental_window,
        lake_json_scan,
        lake_compacted,
        lake_csv_scan,
        partition_range_scan,
        parquet_roundtrip,
        raw_dataset,
        sql_over_views,
        profile_reshape,
        tweet_parse,
        quarantine_split,
        retweet_filter,
        hash_sample,
        brand_hashtags,
        brand_detect,
        brand_detect_large,
        brand_detect_asof,
        hashtag_union,
        country_resolve,
        country_resolve_shuffle,
        lemma_table,
        stopword_table,
        mask_markup,
        unicode_fix,
        clean_text,
        clean_documents,
        clean_lexicon_tables,
        label_code,
        iso_times,
        date_spine,
        params_json,
        checkpoint_latest,
        checkpoint_latest_brand,
        checkpoint_latest_all,
        next_window,
        ingest_ledger,
        ingest_claims,
        ingest_late_rows,
        corpus_stats,
        corpus_stats_by_day,
        word_count,
        word_count_top,
        stage_counters,
        tfidf_terms,
        mentions_daily,
        tweet_enrich,
        tweet_enrich_large,
        stream_enrich,
        stream_quarantine,
        stream_manifest,
        stream_distinct,
        batch_score,
        stream_score,
    )
} | {
    "text_lower": _on_posts(text.lower_case),
    "mask_email": _on_posts(text.mask_email),
    "mask_handle": _on_posts(text.mask_handle),
    "mask_hashtag": _on_posts(text.mask_hashtag),
    "mask_url": _on_posts(text.mask_url),
    "strip_punct": _on_posts(text.strip_punctuation),
    "squeeze_space": _on_posts(text.squeeze_space),
    "stopword_remove": _on_posts(text.remove_stop_words, lower=True),
    "contraction_expand": _on_posts(text.expand_contractions, lower=True),
    "emoji_describe": _on_posts(text.describe_emoji),
    "lemma_lookup": _on_posts(text.lemmatize, lower=True),
    "twitter_date": _on_posts(dates.partition_date, "created_at"),
    "twitter_datetime": _on_posts(dates.post_datetime, "created_at"),
}
