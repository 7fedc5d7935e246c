from datetime import datetime, timedelta

import pytest

from postlens import schemas
from postlens.operators import ledger
from postlens.sinks.external import append_jdbc
from postlens.sources import external


def runs(spark, *rows):
    fields = [(started, run, None, status, task, f'{{"start_dt":"2024-01-0{end - 1}","end_dt":"2024-01-0{end}","brand":"{brand}"}}',
               None, None, None, None) for started, run, status, task, brand, end in rows]
    return spark.createDataFrame(fields, schemas.LEDGER)


@pytest.fixture
def history(spark):
    day = lambda d: datetime(2024, 1, d)
    return runs(spark, (day(1), "a", "SUCCESS", "t", "x", 2), (day(3), "b", "ERROR", "t", "x", 4),
                (day(2), "c", "SUCCESS", "t", "y", 3), (None, "d", "SUCCESS", "t", "x", 9),
                (day(5), "e", "SUCCESS", "other", "x", 6), (None, "f", "SUCCESS", "late", "x", 7))


def test_latest(history):
    assert ledger.latest(history, "t").first().run_id == "c"
    assert ledger.latest(history, "t", "x").first().run_id == "a"
    assert ledger.latest(history, "late").first().run_id == "f"
    assert ledger.latest(history, "none").count() == 0


def test_latest_of_all(history):
    found = {(r.task_type, r.brand): r.run_id for r in ledger.latest_of_all(history).collect()}
    assert found == {("t", "x"): "a", ("t", "y"): "c", ("other", "x"): "e", ("late", "x"): "f"}


def test_next_window(spark, history):
    first = datetime(2023, 1, 1)
    assert ledger.next_window(history, "t", first) == (datetime(2024, 1, 3), datetime(2024, 1, 4))
    assert ledger.next_window(history, "none", first, length=timedelta(days=7)) == (first, datetime(2023, 1, 8))
    broken = history.where("run_id = 'a'").withColumn("source_query_param", ledger.F.lit("{}"))
    with pytest.raises(ValueError, match="end_dt"):
        ledger.next_window(broken, "t", first)


def test_ledger_starts_empty(spark, tmp_path):
    store = ledger.LedgerStore("parquet", {"path": str(tmp_path / "none")})
    assert store.read(spark).count() == 0
    store.append(ledger.entry(spark, run_id="r", run_status=ledger.RUNNING))
    assert [r.run_id for r in store.read(spark).collect()] == ["r"]


def test_connector_options_reach_the_reader(monkeypatch):
    """No database is started here; only the options handed to the connector are looked at."""
    calls = {}

    class Io:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **options):
            calls["options"] = options
            return self

        def mode(self, mode):
            calls["mode"] = mode
            return self

        def load(self):
            return "rows"

        def save(self):
            calls["saved"] = True

    class Session:
        read = Io()

    class Rows:
        write = Io()

    url = {"url": "jdbc:db", "user": "u"}
    assert external.read_jdbc_query(Session(), url, "select 1") == "rows"
    assert calls == {"format": "jdbc", "options": {**url, "query": "select 1"}}
    append_jdbc(Rows(), url, "s.runs")
    assert calls["options"] == {**url, "dbtable": "s.runs"} and calls["mode"] == "append" and calls["saved"]
    assert external.kafka_options("host:1", "posts")["startingOffsets"] == "latest"
