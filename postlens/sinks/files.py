"""File sinks. Partitioned writes replace exactly the partitions they carry, so a rerun is safe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postlens import schemas
from postlens.sources.files import CSV_OPTIONS, JSON_OPTIONS

# Upper bound on rows per file, so that one large partition becomes many files. A CSV file with
# line breaks in its values is read by one task and stays smaller.
MAX_RECORDS_PER_FILE = {"json": 5_000_000, "csv": 500_000}


def write_lake(posts: DataFrame, root: str) -> int:
    wanted = posts.select("tweetInfo", *schemas.LAKE_PARTITIONS)
    return write_partitioned(wanted, root, "json", schemas.LAKE_PARTITIONS, JSON_OPTIONS)


def write_raw_dataset(dataset: DataFrame, root: str) -> int:
    return write_partitioned(dataset, root, "json", schemas.LAKE_PARTITIONS, JSON_OPTIONS)


def write_profiles(profiles: DataFrame, root: str) -> int:
    return write_partitioned(profiles, root, "csv", schemas.PROFILE_PARTITIONS, CSV_OPTIONS)


def write_partitioned(
    rows: DataFrame,
    root: str,
    format: str,
    partitions: Sequence[str],
    options: Mapping[str, str],
) -> int:
    """Replace the partitions present in ``rows`` and keep all others; returns the rows written.

    The rebalance hint gathers each partition's rows into few tasks and lets adaptive
    execution split the hot ones, so neither tiny files nor one giant task result.
    """
    written = Observation()
    # Observed in the last stage, where a repeated task is counted once.
    (
        rows.hint("rebalance", *partitions)
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.format(format)
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE[format])
        .partitionBy(*partitions)
        .mode("overwrite")
        .save(root)
    )
    return written.get.get("n") or 0


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
