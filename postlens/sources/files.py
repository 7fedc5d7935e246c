"""File sources. Partition columns stay in the result, and predicates on them prune the listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens import schemas

# Written and read alike, so that every value comes back as it was: quotes and outer blanks in
# CSV, microseconds in JSON.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows are costly to process.

    The setting ``spark.postlens.tasks`` deals it to so many tasks; ``session.local_session`` sets
    it for small tables in one file. Elsewhere it is unset, and nothing is shuffled here.
    """
    table = read_table(spark, folder, name)
    tasks = spark.conf.get("spark.postlens.tasks", None)
    return table.repartition(int(tasks)) if tasks else table


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    return read_json(spark, root, schemas.LAKE)


def read_json(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(root)


def read_csv(
    spark: SparkSession, root: str, schema: StructType, line_breaks: bool = False
) -> DataFrame:
    """With ``line_breaks`` values may hold them, and each file is read by one task."""
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return reader.option("multiLine", line_breaks).csv(root)


def in_partitions(
    lake: DataFrame, category: str | None, brand: str | None, start: Column, end: Column
) -> DataFrame:
    """Rows of the days ``start <= day < end``; a missing partition is simply absent."""
    day = F.col("created_at")
    wanted = (day >= start) & (day < end)
    if category is not None:
        wanted &= F.col("category") == category
    if brand is not None:
        wanted &= F.col("brand") == brand
    return lake.where(wanted)


def in_window(posts: DataFrame, moment: str, start: Column, end: Column) -> DataFrame:
    """Half-open time window; the comparison is pushed down to any source that can take it."""
    return posts.where((F.col(moment) >= start) & (F.col(moment) < end))
