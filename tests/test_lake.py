from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions import dates
from postlens.operators import ledger
from postlens.plans import ingest
from postlens.sinks.files import write_lake, write_profiles
from postlens.sources.files import in_partitions, in_window, read_csv, read_json, read_lake

DAY = timedelta(days=1)
FIRST = datetime(2024, 1, 1)


@pytest.fixture
def source(spark):
    """Ten posts a day for four days; two thirds in one partition."""
    return spark.range(40).select(
        F.expr("if(id % 3 = 0, 'b1', 'b0')").alias("brand"),
        F.lit("tv").alias("category"),
        F.struct(
            "id", F.concat(F.lit("line\n\"post\" "), F.col("id").cast("string")).alias("text"),
            F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id * 2.4)").alias("created_at"),
        ).alias("tweetInfo"))


@pytest.fixture
def store(tmp_path):
    return ledger.LedgerStore("parquet", {"path": str(tmp_path / "ledger")})


def statuses(spark, store):
    rows = store.read(spark).orderBy("run_started_at", F.col("run_end_at").asc_nulls_first()).collect()
    return [(r.run_status, r.n_rows) for r in rows]


def test_rewriting_a_day_changes_nothing(spark, source, tmp_path):
    lake, posts = str(tmp_path / "lake"), ingest.label_by_day(source)
    write_lake(posts, lake)
    before = sorted(read_lake(spark, lake).collect(), key=str)
    write_lake(posts.where("created_at = date'2024-01-02'"), lake)
    assert sorted(read_lake(spark, lake).collect(), key=str) == before and len(before) == 40
    assert before[0].tweetInfo.text.startswith('line\n"post"')


def test_partition_predicates_prune(spark, source, tmp_path):
    lake = str(tmp_path / "lake")
    write_lake(ingest.label_by_day(source), lake)
    days = [F.lit(d).cast("date") for d in ("2024-01-02", "2024-02-01")]
    wanted = in_partitions(read_lake(spark, lake), "tv", "b1", *days)
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "DataFilters: []" in plan
    assert {r.created_at for r in wanted.collect()} == {date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 4)}
    assert in_partitions(read_lake(spark, lake), "tv", "absent", *days).count() == 0


def test_window_is_half_open_and_pushed_down(spark, source, tmp_path):
    path = str(tmp_path / "flat")
    source.select("tweetInfo.*").write.parquet(path)
    edges = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-02", "2024-01-03")]
    window = in_window(spark.read.parquet(path), "created_at", *edges)
    assert sorted(r.id for r in window.collect()) == list(range(10, 20))
    assert "GreaterThanOrEqual(created_at" in window._jdf.queryExecution().executedPlan().toString()


def test_json_keeps_microseconds(spark, tmp_path):
    moment = datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = spark.createDataFrame(
        [("b", "c", (1, " x\n", moment)), ("b", "c", (2, "y", datetime(2024, 1, 2)))],
        "brand string, category string, tweetInfo struct<id:bigint,text:string,created_at:timestamp_ntz>")
    write_lake(ingest.label_by_day(rows), str(tmp_path / "l"))
    back = read_lake(spark, str(tmp_path / "l")).orderBy("tweetInfo.id").collect()
    assert [tuple(r.tweetInfo) for r in back] == [(1, " x\n", moment), (2, "y", datetime(2024, 1, 2))]


def test_csv_keeps_quotes_and_commas(spark, tmp_path):
    row = ('"Suite 1",\n Main St ', "A-", "c,d", "j", 'n"', "F", "u", "a || b", "2021-11-01")
    names = "address, blood_group, company, job, name, sex, username, website, created_at".split(", ")
    rows = spark.createDataFrame([row], names)
    write_profiles(rows, str(tmp_path / "p"))
    back = read_csv(spark, str(tmp_path / "p"), schemas.PROFILE, line_breaks=True)
    assert back.select(*names).collect() == [row]


def test_ingest_moves_on_by_success_only(spark, source, store, tmp_path):
    lake = str(tmp_path / "lake")
    step = lambda run, frame=source: ingest.ingest_next(spark, store, frame, lake, "t", run, FIRST)
    assert step("r0") == ledger.SUCCESS
    broken = source.withColumn("tweetInfo", F.struct(
        F.col("tweetInfo.id"), F.raise_error(F.lit("no source")).cast("string").alias("text"),
        F.col("tweetInfo.created_at")))
    with pytest.raises(Exception, match="no source"):
        step("r1", broken)
    assert step("r2") == ledger.SUCCESS
    assert statuses(spark, store) == [
        ("RUNNING", None), ("SUCCESS", 10), ("RUNNING", None), ("ERROR", None), ("RUNNING", None), ("SUCCESS", 10)]
    assert sorted(r.id for r in read_lake(spark, lake).select("tweetInfo.id").collect()) == list(range(20))
    assert "no source" in store.read(spark).where("run_status = 'ERROR'").first().message
    assert ledger.next_window(store.read(spark), "t", FIRST) == (FIRST + 2 * DAY, FIRST + 3 * DAY)


def test_empty_window_is_a_success(spark, source, store, tmp_path):
    lake = str(tmp_path / "lake")
    assert ingest.ingest_next(spark, store, source, lake, "t", "r", datetime(2020, 1, 1)) == ledger.SUCCESS
    assert statuses(spark, store)[-1] == ("SUCCESS", 0)


def test_windows_are_whole_days(spark, source, store, tmp_path):
    for first, length in ((datetime(2024, 1, 1, 12), DAY), (FIRST, timedelta(hours=5)), (FIRST, timedelta(0))):
        with pytest.raises(ValueError, match="whole days"):
            ingest.ingest_next(spark, store, source, str(tmp_path), "t", "r", first, length)


def test_raw_dataset(spark, source, store, tmp_path):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "raw")
    write_lake(ingest.label_by_day(source), lake)
    for run in range(4):
        ingest.build_next_raw_dataset(spark, store, lake, target, "raw", f"r{run}", "tv", "b1", FIRST)
    rows = read_json(spark, target, schemas.RAW_DATASET).collect()
    assert sorted(r.id for r in rows) == list(range(0, 40, 3))
    assert {(r.source, r.brand, r.category) for r in rows} == {("Twitter", "b1", "tv")}
    # Brands keep windows of their own.
    assert ledger.next_window(store.read(spark), "raw", FIRST, "b0") == (FIRST, FIRST + DAY)


@pytest.mark.parametrize("tasks", [("raw", "raw"), ("raw-tv", "raw-phone")])
def test_raw_dataset_keeps_categories(spark, source, store, tmp_path, tasks):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "raw")
    posts = source.withColumn("brand", F.lit("b1")).withColumn(
        "category", F.expr("if(tweetInfo.id % 2 = 0, 'tv', 'phone')"))
    write_lake(ingest.label_by_day(posts), lake)
    for task, category in zip(tasks, ("tv", "phone")):
        for run in range(4):
            ingest.build_next_raw_dataset(spark, store, lake, target, task, f"{category}{run}", category, "b1", FIRST)
    rows = read_json(spark, target, schemas.RAW_DATASET).collect()
    assert sorted(r.id for r in rows) == list(range(40))
    assert {(r.category, r.id % 2) for r in rows} == {("tv", 0), ("phone", 1)}
    assert sorted(n for status, n in statuses(spark, store) if status == "SUCCESS") == [5] * 8


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_ledger_text_is_free_of_zones(spark, source, tmp_path, zone):
    store = ledger.LedgerStore("parquet", {"path": str(tmp_path / "ledger")})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The second window holds the hour that one of the zones skips.
        first = datetime(2024, 3, 9)
        posts = source.withColumn("tweetInfo", F.struct(
            "tweetInfo.id", "tweetInfo.text", F.expr("tweetInfo.created_at + make_dt_interval(68)").alias("created_at")))
        for run in ("r0", "r1"):
            ingest.ingest_next(spark, store, posts, str(tmp_path / "lake"), "t", run, first)
        texts = store.read(spark).where("run_status = 'SUCCESS'").select("source_query_param", "n_rows").collect()
        assert sorted(map(tuple, texts)) == [
            ('{"start_dt":"2024-03-09T00:00:00","end_dt":"2024-03-10T00:00:00"}', 10),
            ('{"start_dt":"2024-03-10T00:00:00","end_dt":"2024-03-11T00:00:00"}', 10)]
        gap = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' as t").select(dates.format_iso(F.col("t")))
        assert gap.first()[0] == "2024-03-10T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_null_text_survives(spark, tmp_path):
    rows = spark.createDataFrame(
        [("b", "c", None), ("b", "c", (1, None, FIRST))],
        "brand string, category string, tweetInfo struct<id:bigint,text:string,created_at:timestamp_ntz>")
    assert [r.text for r in ingest.extract_text(rows).collect()] == [None, None]
