from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from postlens.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def apply(spark):
    """Apply a Column function to a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        done = rows.select("i", function(F.col("text")).alias("out")).orderBy("i").collect()
        return [row.out for row in done]

    return run
