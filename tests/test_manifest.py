"""Commits of several sinks, and each post once, on streams that fail and start again."""

from datetime import timedelta

import pytest
from postlens import derived
from postlens.operators import brands, places
from postlens.sinks import commits
from postlens.sources.external import stream_values
from postlens.streaming import enrich as job
from pyspark.errors import StreamingQueryException

BAD = "value string, reason string"


@pytest.fixture(scope="module")
def parts(spark, folder):
    tags = brands.inline_tags(brands.brand_hashtags(brands.default_catalog(spark)))
    return tags, places.build_place_index(derived.nation_places(spark, folder))


def post(text, at):
    return f'{{"text":"{text}","created_at":"Fri Feb {at:02d} 06:12:11 +0000 2022"}}'


def run(spark, tmp_path, parts, distinct=None):
    values = stream_values(spark, "text", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"})
    good, state, bad = (str(tmp_path / name) for name in ("good", "state", "bad"))
    job.run_enrichment(values, *parts, good, state, bad, available_now=True, distinct=distinct).awaitTermination()


def committed(spark, tmp_path):
    log = job.batch_log(spark, str(tmp_path / "good"))
    return sorted(r.text for r in log.read("good", "text string").collect()), sorted((r.reason, r.value) for r in log.read("bad", BAD).collect())


def put(spark, tmp_path, number, values):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{number}.txt").write_text("\n".join(values))


def test_a_batch_counts_in_all_sinks_or_in_none(spark, tmp_path, parts, monkeypatch):
    put(spark, tmp_path, 0, [post("a", 1), "broken", post("b", 1)])
    failing = job.quarantined

    def fail(split):
        raise RuntimeError("lost")

    monkeypatch.setattr(job, "quarantined", fail)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, parts)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2
    assert committed(spark, tmp_path) == ([], [])
    monkeypatch.setattr(job, "quarantined", failing)
    run(spark, tmp_path, parts)
    want = (["a", "b"], [("malformed", "broken")])
    assert committed(spark, tmp_path) == want
    run(spark, tmp_path, parts)
    assert committed(spark, tmp_path) == want and spark.read.parquet(str(tmp_path / "good")).count() == 2


def test_each_post_once_and_late_ones_apart(spark, tmp_path, parts):
    once = job.Distinct(timedelta(days=3))
    put(spark, tmp_path, 0, [post("a", 5), post("a", 5), post("b", 8), "broken", "broken"])
    run(spark, tmp_path, parts, once)
    # Known, known, on the edge, late, new, and known bad.
    put(spark, tmp_path, 1, [post("b", 8), post("a", 5), post("c", 5), post("d", 4), post("e", 9), "broken"])
    run(spark, tmp_path, parts, once)
    run(spark, tmp_path, parts, once)
    # By now posts of the fifth are late; the one known is still told from them.
    put(spark, tmp_path, 2, [post("a", 5), post("late", 5), post("f", 6), post("e", 9)])
    run(spark, tmp_path, parts, once)
    good, bad = committed(spark, tmp_path)
    assert good == ["a", "b", "c", "e", "f"]
    assert [(r, v if r == "malformed" else "") for r, v in bad] == [("late", ""), ("late", ""), ("malformed", "broken")]


def test_files_appear_whole_and_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert commits.read_text(spark, path) is None and commits.names(spark, str(tmp_path / "log")) == []
    assert commits.publish(spark, path, "one é") and not commits.publish(spark, path, "two")
    assert commits.read_text(spark, path) == "one é" and commits.names(spark, str(tmp_path / "log")) == ["1.json"]
    commits.move(spark, path, str(tmp_path / "log" / "2.json"))
    assert commits.remove(spark, str(tmp_path / "log" / "2.json")) and not commits.remove(spark, path)


def test_a_batch_is_kept_in_files(spark, tmp_path, parts, monkeypatch):
    """Parsed once, and not cached: thousands of long texts would stand in memory at once."""
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_):
        raise AssertionError("cached")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    monkeypatch.setattr(DataFrame, "cache", refuse)
    put(spark, tmp_path, 0, [post("a", 1), "broken"])
    run(spark, tmp_path, parts, job.Distinct(timedelta(days=3)))
    assert committed(spark, tmp_path) == (["a"], [("malformed", "broken")])
    assert not list((tmp_path / "good" / "_split").iterdir())
