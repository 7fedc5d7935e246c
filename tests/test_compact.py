"""Compaction of a lake: fewer files, the same rows, also when a run dies."""

import pytest
from postlens import derived, schemas
from postlens.plans import ingest
from postlens.sinks import commits, compact
from postlens.sources.files import JSON_OPTIONS, read_lake
from pyspark.sql import functions as F


@pytest.fixture
def lake(spark, folder, tmp_path):
    root = str(tmp_path / "lake")
    posts = ingest.label_by_day(derived.lake_posts(spark, folder)).where("brand = 'b1' AND category = 'click'").repartition(5)
    posts.write.options(**JSON_OPTIONS).partitionBy(*schemas.LAKE_PARTITIONS).json(root)
    return root


def files(spark, root):
    return compact.inventory(spark, root).groupBy("partition").count().select("count").toPandas()["count"]


def rows(frame):
    return sorted(map(str, frame.select("tweetInfo", "category", "brand", F.col("created_at").cast("string")).collect()))


def test_small_files_become_one_a_partition(spark, lake):
    before, n = rows(read_lake(spark, lake)), files(spark, lake).sum()
    assert files(spark, lake).max() > 1
    assert 0 < compact.compact(spark, lake) <= n
    assert files(spark, lake).max() == 1 and rows(read_lake(spark, lake)) == before
    assert compact.compact(spark, lake) == 0 and rows(compact.read_live(spark, lake, schemas.LAKE)) == before


def test_bins_hold_about_the_target_and_large_files_stay(spark):
    sizes = [("a", 90), ("a", 60), ("a", 50), ("a", 40), ("a", 10), ("b", 30), ("b", 200), ("c", 100)]
    given = spark.createDataFrame([(f"{p}{i}", p, s) for i, (p, s) in enumerate(sizes)], "path string, partition string, size long")
    bins = {}
    for r in compact.packed(given, 100).collect():
        bins.setdefault(r.bin, set()).add(r.path)
    assert sorted(map(sorted, bins.values())) == [["a0", "a1"], ["a3", "a4"]]


def test_a_run_that_dies_is_finished_or_forgotten(spark, lake, monkeypatch):
    before = rows(read_lake(spark, lake))
    publish, finish = commits.publish, compact.finish

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits, "publish", fail)
    with pytest.raises(RuntimeError):
        compact.compact(spark, lake)
    assert rows(read_lake(spark, lake)) == rows(compact.read_live(spark, lake, schemas.LAKE)) == before
    monkeypatch.setattr(commits, "publish", publish)
    monkeypatch.setattr(compact, "finish", lambda *_: None)
    assert compact.compact(spark, lake) > 0
    # The journal is out: old files still lie there, and only new ones count.
    assert len(compact.journals(spark, lake)) == 1
    assert rows(compact.read_live(spark, lake, schemas.LAKE)) == before
    # It dies again in the midst of finishing.
    (journal,) = compact.journals(spark, lake).values()
    commits.remove(spark, journal["old"][0])
    commits.move(spark, journal["folder"] + journal["new"][0], lake + journal["new"][0])
    assert rows(compact.read_live(spark, lake, schemas.LAKE)) == before
    finish(spark, lake)
    assert rows(read_lake(spark, lake)) == before and files(spark, lake).max() == 1 and not compact.journals(spark, lake)


def test_tasks_hold_about_the_target(spark, lake, monkeypatch):
    assert compact.dealt({"a": 60, "b": 30, "c": 20, "d": 250, "e": 10}, 100) == {"a": 0, "b": 0, "c": 1, "d": 2, "e": 3}
    move, written = commits.move, []
    monkeypatch.setattr(commits, "move", lambda s, source, to: (written.append(source.rpartition("/")[2][:10]), move(s, source, to)))
    before = rows(read_lake(spark, lake))
    compact.compact(spark, lake)
    # Names of written files begin with the number of their task.
    assert len({name for name in written if not name.startswith("part-bin")} & {f"part-{i:05}" for i in range(99)}) > 1
    assert rows(read_lake(spark, lake)) == before
