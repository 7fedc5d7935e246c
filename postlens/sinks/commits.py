"""Small files that appear whole or not at all: commits, manifests and claims.

They go through Hadoop's file systems, as Spark's own output does, so any store that Spark writes to
will do; whether two creators at one moment can both succeed is the store's promise.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

EXISTS = "FileAlreadyExistsException"


# The Java class of paths and the file systems met, by session; each look-up costs several calls.
_KNOWN: dict = {}


def _path(spark: SparkSession, path: str):
    key = id(spark._jvm)
    if key not in _KNOWN:
        _KNOWN[key] = spark._jvm.org.apache.hadoop.fs.Path
    return _KNOWN[key](path)


def _system(spark: SparkSession, path: str):
    place = path[: path.find("/", path.find("://") + 3)] if "://" in path else path.partition(":")[0] if ":/" in path else ""
    key = (id(spark._jvm), place)
    if key not in _KNOWN:
        _KNOWN[key] = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    return _KNOWN[key]


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` by one rename; false, and nothing is changed, where it exists."""
    jvm, system = spark._jvm, _system(spark, path)
    draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    out = system.create(_path(spark, draft), False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    whole = system.makeQualified(_path(spark, path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(_path(spark, draft)), whole, options)
        return True
    except Py4JJavaError as error:
        system.delete(_path(spark, draft), False)
        if EXISTS not in error.java_exception.getClass().getName():
            raise
        return False


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in ``folder``, sorted; none where it is missing."""
    if not exists(spark, folder):
        return []
    found = [status.getPath().getName() for status in _system(spark, folder).listStatus(_path(spark, folder))]
    return sorted(name for name in found if not name.startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; null where it is missing."""
    system = _system(spark, path)
    if not exists(spark, path):
        return None
    stream = system.open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; false where it was missing."""
    return _system(spark, path).delete(_path(spark, path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a place that is free."""
    _system(spark, target).mkdirs(_path(spark, target).getParent())
    if not _system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"{source} was not moved to {target}")
