"""Near duplicates by SimHash, with pivot distance tables to discard pairs.

Equal fingerprints are one node. Two fingerprints that differ in at most two bits agree in two of
their four 16-bit blocks at least, so nodes meet under the six pairs of blocks. Each node carries
a table of its Hamming distances to reference fingerprints; by the triangle inequality a pair
whose tables differ by more than two in any coordinate is no link and is discarded before the
survivors are compared bit by bit. Where very many nodes share two blocks, pairs would grow with
the square of the group: such nodes meet at hubs instead. A hub is a fingerprint at distance one
or zero; two nodes within two bits share one, and all nodes of a hub, 65 at most, are linked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.components import components
from postlens.llm.words import shingles
from postlens.session import fresh_folder

SHINGLE = 3
SEED = 42
RADIUS = 2
PIVOTS = 16
# Nodes under one pair of blocks that are still compared pair by pair.
PAIRED = 256


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half of the shingle hashes; 0 without any word."""
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=len(part)) for part in shingles(text, size))


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the hashes, which come in arrays."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch["text"]], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of each row; ``fp`` holds the 64 bits as a signed number."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_mark, "doc_id long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _block_keys(fp: Column) -> Column:
    """One key per pair of 16-bit blocks, tagged with the pair's number."""
    block = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    return F.array(
        *[F.lit(n << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j]) for n, (i, j) in enumerate(combinations(range(4), 2))]
    )


def _pivot_table(fp: Column, pivots: int) -> list[Column]:
    return [
        F.bit_count(fp.bitwiseXOR(F.lit(_signed(xxhash.xxh64_intdigest(b"pivot %d" % i, SEED)))))
        .cast("byte")
        .alias(f"d{i}")
        for i in range(pivots)
    ]


def links(nodes: DataFrame, folder: str, pivots: int = PIVOTS, paired: int = PAIRED) -> DataFrame:
    """``u, v``: links between the distinct fingerprints of ``nodes`` (``fp``) within two bits.

    Every link is there or follows from others: hubs link each node to the least one of the hub.
    """
    spark = nodes.sparkSession
    keys = nodes.select("fp", F.explode(_block_keys(F.col("fp"))).alias("key"))
    sizes = keys.groupBy("key").count().where(F.col("count") > 1)
    keys.join(sizes, "key").write.parquet(f"{folder}/keys")
    meeting = spark.read.parquet(f"{folder}/keys")
    tabled = meeting.where(F.col("count") <= paired).select("key", "fp", *_pivot_table(F.col("fp"), pivots))
    a, b = tabled.alias("a"), tabled.alias("b")
    near = F.lit(True)
    for i in range(pivots):
        near = near & (F.abs(F.col(f"a.d{i}") - F.col(f"b.d{i}")) <= RADIUS)
    differing = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    pairs = (
        a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near)
        .where(differing <= RADIUS)
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    )
    crowded = meeting.where(F.col("count") > paired).select("fp").distinct()
    masks = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    hubs = (
        crowded.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"))
        .groupBy("hub")
        .agg(F.collect_set("fp").alias("members"))
        .where(F.size("members") > 1)
        .select(F.explode("members").alias("u"), F.array_min("members").alias("v"))
        .where("u <> v")
    )
    return pairs.union(hubs)


def near_duplicates(docs: DataFrame, pivots: int = PIVOTS, paired: int = PAIRED) -> DataFrame:
    """``doc_id, fp, component_id`` of each row of ``doc_id, text``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most two differing
    bits; null ids are never the smallest, so it is null where no document of a component has an
    id. A text without words, null included, has fingerprint 0. Repeated rows stay repeated.
    """
    spark: SparkSession = docs.sparkSession
    folder = fresh_folder(spark, "simhash")
    fingerprints(docs).write.parquet(f"{folder}/marks")
    marks = spark.read.parquet(f"{folder}/marks")
    marks.groupBy("fp").agg(F.min("doc_id").alias("least")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    roots = components(links(nodes, folder, pivots, paired), f"{folder}/stars")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest ``doc_id``.

    All columns stay. Of rows that repeat a ``doc_id`` one stays. Rows without an id all stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    copies = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))
