"""Session settings and shared folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", memory: str = "8g", partitions: int = 8, tasks: int = 8
) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own.

    ``tasks`` is the number of tasks that tables of texts are dealt to (``sources.files.read_texts``).
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postlens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.postlens.tasks", str(tasks))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _folder_of_local_run()


@cache
def _folder_of_local_run() -> str:
    folder = tempfile.mkdtemp(prefix="postlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
