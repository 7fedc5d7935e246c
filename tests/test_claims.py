"""Windows that several drivers want, and rows that come after their window."""

from datetime import datetime, timedelta

import pytest
from postlens.operators import ledger
from postlens.operators.claims import Claims
from postlens.plans import ingest
from postlens.sources.files import read_lake
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)


def test_a_claim_has_one_owner_until_it_ends(spark, tmp_path):
    now = [datetime(2024, 1, 1)]
    a, b = (Claims(spark, str(tmp_path), timedelta(hours=1), owner, lambda: now[0]) for owner in "ab")
    assert a.take("w") and not b.take("w") and not a.take("w") and b.take("other")
    now[0] += timedelta(hours=2)
    assert b.take("w") and not a.take("w") and b.holds("w") and not a.holds("w")
    a.release("w")
    assert b.holds("w")
    b.release("w")
    assert a.take("w")


def source(spark, days, extra=()):
    rows = [("b1", "click", (d * 10 + i, f"t{d}.{i}", START + timedelta(days=d, hours=i))) for d in days for i in range(3)]
    schema = "brand string, category string, tweetInfo struct<id: long, text: string, created_at: timestamp_ntz>"
    return spark.createDataFrame(rows + list(extra), schema)


def test_two_interleaved_runs_copy_each_window_once(spark, tmp_path):
    store = ledger.LedgerStore("parquet", {"path": str(tmp_path / "ledger")})
    a, b = (Claims(spark, str(tmp_path / "claims"), owner=owner) for owner in "ab")
    posts, lake, copies = source(spark, range(3)), str(tmp_path / "lake"), []

    def run(claims, name, inner=None):
        def copy(start, end):
            copies.append(start)
            if inner:
                inner()
            return 0

        return ingest.run_window(spark, store, "t", name, START, copy, claims=claims)

    refused = []
    assert run(a, "a0", lambda: refused.append(run(b, "b0"))) == ledger.SUCCESS
    assert run(b, "b1", lambda: refused.append(ingest.ingest_next(spark, store, posts, lake, "t", "a1", START, claims=a))) == ledger.SUCCESS
    assert refused == [ledger.CLAIMED] * 2 and copies == [START, START + timedelta(days=1)]
    # A window that fails is free again at once.
    with pytest.raises(ZeroDivisionError):
        ingest.run_window(spark, store, "t", "a2", START, lambda s, e: 1 // 0, claims=a)
    assert ingest.ingest_next(spark, store, posts, lake, "t", "b2", START, claims=b) == ledger.SUCCESS
    assert read_lake(spark, lake).count() == 3


def test_a_run_that_outlives_its_claim_is_no_success(spark, tmp_path):
    store = ledger.LedgerStore("parquet", {"path": str(tmp_path / "ledger")})
    now = [START]
    a, b = (Claims(spark, str(tmp_path / "claims"), timedelta(hours=1), owner, lambda: now[0]) for owner in "ab")

    def slow(start, end):
        now[0] += timedelta(hours=2)
        assert ingest.run_window(spark, store, "t", "b", START, lambda s, e: 7, claims=b) == ledger.SUCCESS
        return 5

    with pytest.raises(RuntimeError, match="ended before"):
        ingest.run_window(spark, store, "t", "a", START, slow, claims=a)
    done = store.read(spark).where(F.col("run_status") == ledger.SUCCESS).collect()
    assert [(r.run_id, r.n_rows) for r in done] == [("b", 7)]


def test_only_days_with_late_rows_are_copied_again(spark, tmp_path):
    store, lake = ledger.LedgerStore("parquet", {"path": str(tmp_path / "ledger")}), str(tmp_path / "lake")
    for day in range(3):
        ingest.ingest_next(spark, store, source(spark, range(3)), lake, "t", f"r{day}", START)
    args = spark, store, source(spark, range(3)), lake, "t", START
    assert ingest.copy_late_rows(*args) == 0
    late = ("b1", "click", (99, "late", START + timedelta(days=1, hours=5)))
    beyond = ("b1", "click", (98, "later", START + timedelta(days=3)))
    twice = ("b1", "click", (20, "t2.0", START + timedelta(days=2)))
    args = spark, store, source(spark, range(3), [late, beyond, twice]), lake, "t", START
    assert ingest.copy_late_rows(*args) == 4 + 4
    assert ingest.copy_late_rows(*args) == 0
    assert sorted(r.id for r in read_lake(spark, lake).select("tweetInfo.id").collect()) == sorted([0, 1, 2, 10, 11, 12, 99, 20, 20, 21, 22])
