"""Line dedup over levelled sorted runs of line hashes, with DataFrame functions only.

Documents are added in batches of falling ids, so the batch that first shows a line holds the
largest document with it. A run lists lines with the largest document of each, sorted by hash.
A batch merge-anti-joins its lines with all runs and adds the rest as a run of level 0; as soon
as a level has ``FANOUT`` runs they are merged into one of the next level, so the number of runs
grows with the logarithm of the number of batches. Later batches need no earlier text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import BLANKS, ascii_lower
from postlens.session import fresh_folder

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
# 128 bits of hash: at 10^13 lines the chance of any collision is below 10^-12.
HASH = ["h1", "h2"]


class LineRuns:
    """The runs of one corpus below ``folder``; ``levels[i]`` lists the paths of level i."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, run: DataFrame) -> str:
        path = f"{self.folder}/run-{self.written}"
        self.written += 1
        run.sortWithinPartitions(*HASH).write.parquet(path)
        return path

    def paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def add(self, lines: DataFrame) -> None:
        """Add one batch of ``h1, h2, top``, one row per line, all new to earlier batches' ids."""
        for path in self.paths():
            run = self.spark.read.parquet(path).select(*HASH)
            lines = lines.join(run.hint("merge"), HASH, "left_anti")
        path, level = self._write(lines), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(path)
            if len(self.levels[level]) < FANOUT:
                return
            # Runs of one store share no line, so merging is a union in hash order.
            merged = self.spark.read.parquet(*self.levels[level]).repartition(*HASH)
            path, self.levels[level] = self._write(merged), []
            level += 1

    def lines(self) -> DataFrame:
        return self.spark.read.parquet(*self.paths())


def _row_id(text: Column) -> Column:
    """Tells rows apart that share a ``doc_id`` but not the text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, row_id, pos, h1, h2`` of each line whose key has ``min_chars`` code points."""
    stripped = F.btrim("line", F.lit(BLANKS))
    return (
        docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars))
        .select("doc_id", _row_id(F.col("text")).alias("row_id"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select("doc_id", "row_id", "pos", stripped.alias("line"))
        .where(F.length("line") >= min_chars)
        .select("doc_id", "row_id", "pos", ascii_lower(F.col("line")).alias("key"))
        .select("doc_id", "row_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def _cuts(docs: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into about equal batches; any cuts give the same result."""
    shares = [i / batches for i in range(1, batches)]
    found = docs.select(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else None
    return sorted(set(found or []))


def shared_lines(
    spark: SparkSession, docs: DataFrame, min_chars: int, min_docs: int, batches: int
) -> tuple[DataFrame, DataFrame]:
    """``(lines, shared)``: every long line, and ``h1, h2, top`` of those in ``min_docs`` documents."""
    folder = fresh_folder(spark, "lines")
    batch = F.lit(0)
    cuts = _cuts(docs, batches)
    for cut in cuts:
        batch = batch + F.when(F.col("doc_id") <= cut, 1).otherwise(0)
    long_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(
        "doc_id long, row_id long, pos int, h1 long, h2 long, batch int"
    ).parquet(f"{folder}/lines")
    runs, counts = LineRuns(spark, f"{folder}/runs"), []
    for number in range(len(cuts) + 1):
        counts.append(f"{folder}/counts-{number}")
        lines.where(F.col("batch") == number).groupBy(*HASH).agg(
            F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("top")
        ).write.parquet(counts[-1])
        runs.add(spark.read.parquet(counts[-1]).select(*HASH, "top"))
    # Batches share no document, so their counts add up.
    often = (
        spark.read.parquet(*counts)
        .groupBy(*HASH)
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
    )
    # Written, so that the join with all lines reads two plain shuffles and can split a hot line.
    often.join(runs.lines(), HASH).select(*HASH, "top").write.parquet(f"{folder}/shared")
    return lines, spark.read.parquet(f"{folder}/shared")


def _mark_dropped(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """``row``, each row of ``docs`` as a struct, and ``gone``, the numbers of its lines to drop.

    Rows travel as one struct, so no column of theirs can clash with a name used here.
    """
    ids = docs.select("doc_id", "text")
    lines, shared = shared_lines(docs.sparkSession, ids, min_chars, min_docs, batches)
    dropped = (
        lines.join(shared, HASH)
        .where(F.col("doc_id") < F.col("top"))
        .groupBy("doc_id", "row_id")
        .agg(F.collect_set("pos").alias("gone"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", _row_id(F.col("text")).alias("row_id")
    )
    return rows.join(dropped, ["doc_id", "row_id"], "left").select("row", "gone")


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _kept(lines: Column, gone: Column) -> Column:
    """``lines`` without those numbered in ``gone``, joined; in linear time."""
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")


def drop_shared_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` of each row: the text without lines shared by many.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose their lines except in
    the largest ``doc_id`` holding them. Rows with one ``doc_id`` are one document. A null text is
    one empty line. Rows with a null ``doc_id`` count for no key and keep all lines.
    """
    marked = _mark_dropped(docs.select("doc_id", "text"), min_chars, min_docs, batches)
    split = marked.select("row.doc_id", "row.text", "gone", _split(F.col("row.text")).alias("lines"))
    changed = F.col("gone").isNotNull()
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(changed, F.size("gone")).otherwise(0).cast("long").alias("n_dropped"),
        F.when(changed, _kept(F.col("lines"), F.col("gone"))).otherwise(F.coalesce("text", F.lit(""))).alias("kept"),
    )


def without_shared_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """``docs`` with the kept lines as ``text``, by the rules of ``drop_shared_lines``.

    All rows and columns stay; ``n_chars``, where there is one, follows the text, and a text
    without dropped lines stays as it is, null included.
    """
    marked = _mark_dropped(docs, min_chars, min_docs, batches)
    text = F.col("row.text")
    kept = F.when(F.col("gone").isNull(), text).otherwise(_kept(_split(text), F.col("gone")))
    marked = marked.select("row", "gone", kept.alias("kept"))
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.length("kept").cast("long"))
    return marked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
