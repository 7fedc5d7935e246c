"""Jobs that move posts: incremental ingest into the lake, and the raw data set made from it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.dates import moment
from postlens.operators import ledger as runs
from postlens.operators.claims import Claims
from postlens.sinks.files import write_lake, write_raw_dataset
from postlens.sources.files import in_partitions, in_window, read_lake

DAY = timedelta(days=1)


def label_by_day(posts: DataFrame, time: str = "tweetInfo.created_at") -> DataFrame:
    """Partition each post by its own day."""
    return posts.withColumn("created_at", F.col(time).cast("date"))


def extract_text(posts: DataFrame, source: str = "Twitter") -> DataFrame:
    """Lake rows to raw data set rows: the text, tagged with its source."""
    return (
        posts.withColumn("id", F.col("tweetInfo.id"))
        .withColumn("text", F.col("tweetInfo.text"))
        .drop("tweetInfo")
        .withColumn("source", F.lit(source))
    )


def ingest_next(
    spark: SparkSession,
    store: runs.LedgerStore,
    source: DataFrame,
    lake: str,
    task: str,
    run_id: str,
    first_start: datetime,
    length: timedelta = DAY,
    claims: Claims | None = None,
) -> str:
    """Copy the next window of ``source(brand, category, tweetInfo)`` into the lake."""

    def copy(start: datetime, end: datetime) -> int:
        window = in_window(source, "tweetInfo.created_at", moment(start), moment(end))
        return write_lake(label_by_day(window), lake)

    return run_window(spark, store, task, run_id, first_start, copy, length=length, sink=lake, claims=claims)


def build_next_raw_dataset(
    spark: SparkSession,
    store: runs.LedgerStore,
    lake: str,
    target: str,
    task: str,
    run_id: str,
    category: str,
    brand: str,
    first_start: datetime,
    length: timedelta = DAY,
) -> str:
    """Extract the next window of one brand and category from the lake.

    Brands and categories share a target and a task name: each pair has its own windows.
    """

    def copy(start: datetime, end: datetime) -> int:
        wanted = in_partitions(
            read_lake(spark, lake), category, brand, moment(start), moment(end)
        )
        return write_raw_dataset(extract_text(wanted), target)

    return run_window(
        spark, store, task, run_id, first_start, copy, brand, category, length, lake, target
    )


# Fields of a post that its digest covers.
DIGESTED = ("tweetInfo.id", "tweetInfo.text", "tweetInfo.created_at")


def day_digests(posts: DataFrame) -> DataFrame:
    """Rows and an order-free hash of each lake partition of ``category, brand, created_at, tweetInfo``."""
    row = F.xxhash64(*DIGESTED).cast("decimal(20,0)")
    return posts.groupBy("category", "brand", "created_at").agg(F.count("*").alias("n"), F.sum(row).alias("digest"))


def differing_days(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Partitions of ``source`` whose rows are not those of ``lake``: ``category, brand, created_at``."""
    keys = ["category", "brand", "created_at"]
    ours, theirs = day_digests(source), day_digests(lake)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "n", "digest")]
    return ours.alias("a").join(theirs.alias("b"), same, "left_anti").select(*keys)


def copy_late_rows(spark: SparkSession, store: runs.LedgerStore, source: DataFrame, lake: str, task: str, first_start: datetime) -> int:
    """Copy again the partitions to which rows came, or in which rows changed, after their window succeeded.

    Source and lake are compared by digests per partition, from the first day to the end of the last
    successful window; only partitions that differ are read again and replaced. Returns the rows written.
    """
    end = runs.next_window(store.read(spark), task, first_start)[0]
    done = label_by_day(in_window(source, "tweetInfo.created_at", moment(first_start), moment(end)))
    held = in_partitions(read_lake(spark, lake), None, None, moment(first_start), moment(end))
    # The lake is replaced below, so what differs is settled first: one row a partition.
    keys = differing_days(done, held).collect()
    if not keys:
        return 0
    wanted = spark.createDataFrame(keys, done.select("category", "brand", "created_at").schema)
    same = [done[c].eqNullSafe(wanted[c]) for c in wanted.columns]
    return write_lake(done.join(F.broadcast(wanted), same, "left_semi"), lake)


def run_window(
    spark: SparkSession,
    store: runs.LedgerStore,
    task: str,
    run_id: str,
    first_start: datetime,
    copy: Callable[[datetime, datetime], int],
    brand: str | None = None,
    category: str | None = None,
    length: timedelta = DAY,
    source: str | None = None,
    sink: str | None = None,
    claims: Claims | None = None,
) -> str:
    """Run ``copy`` over the next window and keep the ledger: RUNNING, then SUCCESS or ERROR.

    Windows are whole days, because a rerun replaces the day partitions it writes. A failed
    window is not skipped: it comes up again, since only successes move the ledger on.

    With ``claims`` several drivers may run the task. Where another one has the window, nothing is
    done and the answer is CLAIMED. A driver that has lost its claim meanwhile, because it took longer
    than a claim lasts, ends with an error and leaves success to the new owner.
    """

    def next_window() -> tuple[datetime, datetime]:
        return runs.next_window(store.read(spark), task, first_start, brand, length, category)

    start, end = next_window()
    if start.time() != datetime.min.time() or length % DAY or length <= timedelta(0):
        raise ValueError(f"the window {start} + {length} does not consist of whole days")
    if claims is None:
        return _run(spark, store, task, run_id, copy, start, end, brand, category, source, sink)
    window = "-".join([task, brand or "", category or "", f"{start:%Y%m%d}"])
    # The ledger may have moved on between its reading and the claim.
    if not claims.take(window):
        return runs.CLAIMED
    try:
        if next_window() != (start, end):
            return runs.CLAIMED

        def guarded(start: datetime, end: datetime) -> int:
            n_rows = copy(start, end)
            if not claims.holds(window):
                raise RuntimeError(f"the claim on {window} ended before the run did")
            return n_rows

        return _run(spark, store, task, run_id, guarded, start, end, brand, category, source, sink)
    finally:
        claims.release(window)


def _run(spark, store, task, run_id, copy, start, end, brand, category, source, sink) -> str:
    common = {
        "run_started_at": _now(),
        "run_id": run_id,
        "task_type": task,
        "source_query_param": runs.params_text(spark, start, end, brand, category),
        "source": source,
        "sink": sink,
    }
    store.append(runs.entry(spark, run_status=runs.RUNNING, **common))
    try:
        n_rows = copy(start, end)
    except Exception as error:
        store.append(
            runs.entry(
                spark, run_status=runs.ERROR, run_end_at=_now(), message=str(error), **common
            )
        )
        raise
    store.append(
        runs.entry(spark, run_status=runs.SUCCESS, run_end_at=_now(), n_rows=n_rows, **common)
    )
    return runs.SUCCESS


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
