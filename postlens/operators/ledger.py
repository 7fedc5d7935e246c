"""Run ledger: which windows of which task were processed, and what comes next."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions import params
from postlens.functions.dates import moment

RUNNING, SUCCESS, ERROR = "RUNNING", "SUCCESS", "ERROR"
# The answer to a driver that came second; never a status in the ledger.
CLAIMED = "CLAIMED"


@dataclass(frozen=True)
class LedgerStore:
    """Where the ledger lives: a ``format`` with options. JDBC takes ``dbtable`` among them."""

    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.format == "jdbc":
            return reader.load()
        try:
            return reader.schema(schemas.LEDGER).load()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schemas.LEDGER)

    def append(self, entries: DataFrame) -> None:
        entries.write.format(self.format).options(**self.options).mode("append").save()


def successes(
    ledger: DataFrame, task: str, brand: str | None = None, category: str | None = None
) -> DataFrame:
    wanted = (F.col("task_type") == task) & (F.col("run_status") == SUCCESS)
    for name, value in (("brand", brand), ("category", category)):
        if value is not None:
            wanted &= params.param(F.col("source_query_param"), name) == value
    return ledger.where(wanted)


def latest(
    ledger: DataFrame, task: str, brand: str | None = None, category: str | None = None
) -> DataFrame:
    """The last successful run of a task, brand and category, as far as given: one row, or none."""
    return (
        successes(ledger, task, brand, category)
        .orderBy(F.desc_nulls_last("run_started_at"), F.desc("run_id"))
        .limit(1)
    )


def latest_of_all(ledger: DataFrame) -> DataFrame:
    """The last successful run of every task, brand and category.

    A maximum over structs: nulls sort lowest, and one hot task is reduced before the shuffle.
    """
    order = F.struct("run_started_at", "run_id")
    fields = [name for name in ledger.columns if name != "task_type"]
    return (
        ledger.where(F.col("run_status") == SUCCESS)
        .groupBy(
            "task_type",
            *[params.param(F.col("source_query_param"), n).alias(n) for n in ("brand", "category")],
        )
        .agg(F.max_by(F.struct(*fields), order).alias("run"))
        .select("task_type", "brand", "category", "run.*")
    )


def next_windows(runs: DataFrame, length: timedelta = timedelta(days=1)) -> DataFrame:
    """Add ``start_dt`` and ``end_dt`` of the window that follows each run."""
    previous_end = params.end_of(F.col("source_query_param"))
    return runs.withColumn("start_dt", previous_end).withColumn(
        "end_dt", previous_end + _interval(length)
    )


def next_window(
    ledger: DataFrame,
    task: str,
    first_start: datetime,
    brand: str | None = None,
    length: timedelta = timedelta(days=1),
    category: str | None = None,
) -> tuple[datetime, datetime]:
    """The window to process now; an empty ledger begins at ``first_start``."""
    row = next_windows(latest(ledger, task, brand, category), length).select("start_dt", "end_dt").first()
    if row is None:
        return first_start, first_start + length
    if row.start_dt is None:
        raise ValueError(f"the last run of {task!r} has no end_dt")
    return row.start_dt, row.end_dt


def entry(spark: SparkSession, **fields) -> DataFrame:
    """One ledger row; fields left out are null."""
    return spark.createDataFrame(
        [tuple(fields.get(name) for name in schemas.LEDGER.names)], schemas.LEDGER
    )


def params_text(
    spark: SparkSession,
    start: datetime,
    end: datetime,
    brand: str | None,
    category: str | None = None,
) -> str:
    """The run parameters of one window as JSON text."""
    window = spark.range(1).select(
        params.to_params(
            moment(start), moment(end), F.lit(brand), F.lit(category)
        )
    )
    return window.first()[0]


def _interval(length: timedelta) -> Column:
    return F.lit(length)
