"""Compaction of a lake of line files: small files of a partition become few large ones.

Spark takes the inventory from file metadata, packs small files into bins and rewrites each bin as one
file, in a folder that listings pass over. One published journal then replaces old by new files at once
for readers that use ``read_live``. Afterwards old files are deleted and new ones moved to their
partitions, for all other readers; a run that dies before the journal changes nothing, one that dies
after it is finished by the next.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.sinks import commits
from postlens.sources.files import JSON_OPTIONS

TARGET = 128 << 20
FOLDER = "_compact"
# Partition folders at the end of a path.
PARTITION = r"((?:/[^/=]+=[^/]*)+)/[^/]*$"


def inventory(spark: SparkSession, root: str, suffix: str = "json") -> DataFrame:
    """``path, partition, size`` of the visible data files; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(root)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    )
    return files.select("path", F.regexp_extract("path", PARTITION, 1).alias("partition"), "size")


def packed(files: DataFrame, target: int = TARGET) -> DataFrame:
    """``path, partition, bin, size`` of the files under ``target`` that a bin has more than one of.

    Files go into bins in falling size, the next bin beginning where the sum passes ``target``.
    """
    order = Window.partitionBy("partition").orderBy(F.desc("size"), "path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.floor((F.sum("size").over(order) - F.col("size")) / F.lit(target))
    small = files.where(F.col("size") < target).withColumn("bin", F.md5(F.concat_ws("#", "partition", number.cast("string"))))
    shared = Window.partitionBy("bin")
    return small.withColumn("n", F.count("*").over(shared)).where("n > 1").select("path", "partition", "bin", "size")


def dealt(sizes: dict[str, int], limit: float) -> dict[str, int]:
    """The task of each bin: a task holds bins of ``limit`` bytes at most, or one larger bin."""
    tasks, number, held = {}, 0, 0
    for name, size in sizes.items():
        if held and held + size > limit:
            number, held = number + 1, 0
        tasks[name], held = number, held + size
    return tasks


def compact(spark: SparkSession, root: str, target: int = TARGET) -> int:
    """Pack the small files below ``root``; returns how many files went. Rows stay as they are.

    The driver holds the list of the files to replace, as it holds that of any files it scans. Nobody
    else may write to the same partitions meanwhile.
    """
    finish(spark, root)
    plan = packed(inventory(spark, root), target).collect()
    if not plan:
        return 0
    bins: dict[str, dict] = {}
    for row in plan:
        bins.setdefault(row["bin"], {"partition": row["partition"], "old": []})["old"].append(row["path"])
    sizes = dict.fromkeys(bins, 0)
    for row in plan:
        sizes[row["bin"]] += row["size"]
    # Every core has work; beyond that a task sorts about ``target`` bytes, however large the lake is.
    tasks = dealt(sizes, min(target, sum(sizes.values()) / spark.sparkContext.defaultParallelism))
    names = spark.createDataFrame([(r["path"], r["bin"], tasks[r["bin"]]) for r in plan], "path string, bin string, task int")
    lines = spark.read.text([r["path"] for r in plan]).select("value", F.col("_metadata.file_path").alias("path"))
    own = uuid.uuid4().hex
    staged, new = f"{root}/{FOLDER}/.{own}", f"{root}/{FOLDER}/{own}"
    # A bin is about ``target`` bytes, so it is in one task and one file.
    dealt_lines = lines.join(names, "path").repartitionById(max(tasks.values()) + 1, F.col("task"))
    dealt_lines.select("value", "bin").write.partitionBy("bin").text(staged)
    for name, row in bins.items():
        (part,) = (n for n in commits.names(spark, f"{staged}/bin={name}") if n.startswith("part-"))
        commits.move(spark, f"{staged}/bin={name}/{part}", f"{new}{row['partition']}/part-{name}.json")
    commits.remove(spark, staged)
    journal = {"folder": new, "old": [old for row in bins.values() for old in row["old"]], "new": [f"{row['partition']}/part-{name}.json" for name, row in bins.items()]}
    commits.publish(spark, f"{root}/{FOLDER}/journal-{own}.json", json.dumps(journal))
    finish(spark, root)
    return len(plan)


def journals(spark: SparkSession, root: str) -> dict[str, dict]:
    """Published journals that are not finished, by path."""
    found = [f"{root}/{FOLDER}/{n}" for n in commits.names(spark, f"{root}/{FOLDER}") if n.startswith("journal-")]
    return {path: json.loads(commits.read_text(spark, path)) for path in found}


def finish(spark: SparkSession, root: str) -> None:
    """Delete the old files of published journals and move the new ones in; each step may be repeated."""
    for path, journal in journals(spark, root).items():
        for old in journal["old"]:
            commits.remove(spark, old)
        for name in journal["new"]:
            if not commits.exists(spark, f"{root}{name}"):
                commits.move(spark, f"{journal['folder']}{name}", f"{root}{name}")
        commits.remove(spark, path)
        commits.remove(spark, journal["folder"])


def read_live(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of the lake; of a compaction under way either all old files or all new ones."""
    reader = spark.read.schema(schema).options(**JSON_OPTIONS)
    whole = reader.json(root)
    for journal in journals(spark, root).values():
        old = spark.createDataFrame([(name,) for name in journal["old"]], "_old string")
        whole = _without(whole, old)
        if commits.names(spark, journal["folder"]):
            whole = whole.unionByName(reader.option("basePath", journal["folder"]).json(journal["folder"]))
    return whole


def _without(rows: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of other files."""
    named = rows.select("*", F.col("_metadata.file_path").alias("_path"))
    return named.join(old, F.col("_path") == F.col("_old"), "left_anti").drop("_path")
