"""Near copies by SimHash, and by exact similarity of word shingles: no pair at the threshold is lost.

A text is the set of hashes of its shingles; equal sets are one node, and its SimHash fingerprint is
taken of the set. Nodes whose fingerprints differ in two bits at most are found as in ``simhash``, by
pairs of blocks and pivot distance tables, and are linked if the similarity of their sets says so too.

Sets at the threshold may differ in far more bits, so others are found by their shingles. Two sets whose similarity
(shared over all) is at least t share one of their first ``n - ceil(t * n) + 1`` shingles in any
order common to all sets, so nodes meet under these; sizes and positions discard pairs that cannot
reach t, the others are compared shingle by shingle.

The first order is that of the hashes. Nodes under a shingle that very many share meet a second
time, in an order of all their shingles by the number of nodes that hold them, rare ones first, so
that what a template has in common comes last. There the smaller set of a pair is found under still
fewer shingles (``n - ceil(2t / (1 + t) * n) + 1``), which sets just under t no longer share.

Where very many small sets still meet, pairs would grow with the square of the group. Leaders are
chosen one by one and compared with the whole group; nodes at the threshold with one leader are
linked through it and not compared with each other. One minus the similarity is a metric, so a link
between a node of a leader and another node is at most twice as far from the leader as the threshold
allows; the rest is compared as usual.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm import simhash
from postlens.llm.common import sole_holder
from postlens.llm.components import components
from postlens.llm.words import shingles
from postlens.session import fresh_folder
from postlens.sinks import commits

SHINGLE = 5
SIMILARITY = 0.8
# Nodes under one shingle that are still compared pair by pair.
PAIRED = 64
# A crowded shingle gets leaders while each links this part of the nodes without one, and so many
# at most; the nodes left are compared pair by pair.
LINKED = 1 / 8
LEADERS = 16
# Rows that Python workers turn to sets at once, and hashes whose bits they count at once.
ROWS, HASHES = 128, 1 << 16


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct shingles."""
    digest = xxhash.xxh64_intdigest
    parts = [np.unique(np.fromiter(map(digest, part), np.uint64, len(part))) for part in shingles(text, size)]
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]))


def _node(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), len(own)) - (1 << 63)


def _fingerprint(own: np.ndarray) -> int:
    return simhash.majority(own[at : at + HASHES] for at in range(0, len(own), HASHES))


def _by_slices(batches: Iterator[pa.RecordBatch], made: Callable) -> Iterator[pa.RecordBatch]:
    """``made`` of few rows at a time, so that sets of a whole batch never stand in memory."""
    sole_holder("near")
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield made(batch.slice(at, ROWS))


def _needed(n: Column, least: float) -> Column:
    """The number of first shingles of which two sets at ``least`` share one."""
    return (n - F.ceil(n * F.lit(least) - 1e-9) + 1).cast("int")


def _marks(docs: DataFrame, size: int, least: float) -> DataFrame:
    """``doc_id, node, n, fp, first``: the set's size, its fingerprint and its first shingles by hash."""

    def mark(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py(), size) for t in part["text"]]
        first = [s[: len(s) - math.ceil(least * len(s) - 1e-9) + 1].view(np.int64) if len(s) else s.view(np.int64) for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                part["doc_id"],
                pa.array([_node(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(np.array([_fingerprint(s) for s in sets], np.uint64).view(np.int64)),
                pa.array(first, pa.list_(pa.int64())),
            ],
            ["doc_id", "node", "n", "fp", "first"],
        )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(lambda b: _by_slices(b, mark), "doc_id long, node long, n int, fp long, first array<long>")


# A mask has a bit per value of 26 bits, 8 MB in all; what passes by chance joins nothing later.
MASK_BITS = 26


def _mask(values: DataFrame):
    """A broadcast mask of the hashes in the one column of ``values``; it saves shuffling what meets none."""
    value = F.shiftrightunsigned(F.col(values.columns[0]), 64 - MASK_BITS)
    bit = F.expr("shiftleft(1L, cast(value & 63 AS int))")
    words = (
        values.select(value.alias("value")).groupBy(F.shiftrightunsigned("value", 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
    ).toArrow()  # a million rows at most, and no Python object a row
    mask = np.zeros(1 << (MASK_BITS - 6), np.int64)
    mask[words["at"].to_numpy()] = words["bits"].to_numpy()
    return values.sparkSession.sparkContext.broadcast(mask.astype("<i8").view(np.uint8))


def _may_be_in(mask, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) >> np.uint64(64 - MASK_BITS)
    return (mask.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _document_of_node(node: Column, doc: Column) -> Column:
    """A hash of a node and its first document, by bits that Python has too."""
    low = F.coalesce(doc, F.lit(0)).bitwiseAND(F.lit((1 << MASK_BITS) - 1))
    return node.bitwiseXOR(F.shiftleft(low, 64 - MASK_BITS))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> Callable[[Callable, str], DataFrame]:
    """What a function makes of ``node, own``, in batches, of the nodes in ``wanted`` (and of few others).

    ``own`` is the set as bytes. Sets hold more bytes than the texts, so they are made again for each use
    and not stored. ``wanted`` names one document of each node, so that copies do not send their sets too.
    """
    mask = _mask(wanted.select(_document_of_node(F.col("node"), F.col("least"))))

    def pick(part: pa.RecordBatch) -> pa.RecordBatch:
        owns = [shingle_set(t.as_py(), size) for t in part["text"]]
        nodes = np.array([_node(own) for own in owns], np.int64)
        docs = np.array([(d or 0) & ((1 << MASK_BITS) - 1) for d in part["doc_id"].to_pylist()], np.int64)
        at = np.flatnonzero(_may_be_in(mask, nodes ^ (docs << np.int64(64 - MASK_BITS))))
        return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array([owns[i].tobytes() for i in at], pa.binary())], ["node", "own"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return lambda made, schema: ids.mapInArrow(lambda b: map(made, _by_slices(b, pick)), schema)


def _first_documents(marks: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, first`` of one document of each node, the one that ``nodes`` names (and of few others)."""
    mask = _mask(nodes.select(_document_of_node(F.col("node"), F.col("least"))))

    def pick(part: pa.RecordBatch) -> pa.RecordBatch:
        part = part.filter(pa.array(_may_be_in(mask, part["name"].to_numpy())))
        return part.select(["node", "n", "first"])

    named = marks.select("node", "n", "first", _document_of_node(F.col("node"), F.col("doc_id")).alias("name"))
    return named.mapInArrow(lambda b: _by_slices(b, pick), "node long, n int, first array<long>")


def _repeat(marks: DataFrame) -> bool:
    """Whether rows share node and document, as far as the mask tells documents apart."""
    name = _document_of_node(F.col("node"), F.col("doc_id"))
    return not marks.groupBy("node", name.alias("name")).count().where(F.col("count") > 1).isEmpty()


def _compared(pairs: DataFrame, sets: DataFrame, least: float, folder: str) -> DataFrame:
    """``u, v, similarity`` of the distinct pairs that reach ``least``; works below ``folder``.

    ``sets`` has the sizes of the sets and, of their shingles, at least those that others hold.
    """
    pairs.select("u", "v").distinct().write.parquet(f"{folder}/pairs")
    pairs = pairs.sparkSession.read.schema("u long, v long").parquet(f"{folder}/pairs")
    mask = _mask(pairs.select("u").union(pairs.select("v")))

    def met(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(_may_be_in(mask, part["node"].to_numpy())))

    def compare(part: pa.RecordBatch) -> pa.RecordBatch:
        keep, values, sizes = [], [], part["size"].to_pylist()
        for i, (a, b) in enumerate(zip(part["a"], part["b"])):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            # In whole numbers up to rounding, as the bounds on sizes and positions.
            if shared >= least * (sizes[i] - shared) - 1e-9:
                keep.append(i)
                values.append(shared / (sizes[i] - shared) if sizes[i] else 1.0)
        at = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [part["u"].take(at), part["v"].take(at), pa.array(values, pa.float64())], ["u", "v", "similarity"]
        )

    sets = sets.mapInArrow(lambda b: _by_slices(b, met), "node long, n int, own binary")
    first = sets.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("own").alias("a"))
    second = sets.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("own").alias("b"))
    pairs.join(first, "u").join(second, "v").select("u", "v", "a", "b", (F.col("n_u") + F.col("n_v")).alias("size")).mapInArrow(
        lambda b: _by_slices(b, compare), "u long, v long, similarity double"
    ).write.parquet(f"{folder}/near")
    return pairs.sparkSession.read.schema("u long, v long, similarity double").parquet(f"{folder}/near")


def _may_reach(least: float) -> Column:
    """Whether the rows ``a`` and ``b`` of one shingle can belong to sets at ``least``.

    Shingles before the first common one are not shared, so at that one the bound holds.
    """
    a, b = F.col("a.n"), F.col("b.n")
    shared = F.least(a - F.col("a.pos"), b - F.col("b.pos"))
    return (shared >= least / (1 + least) * (a + b) - 1e-6) & (F.least(a, b) >= least * F.greatest(a, b) - 1e-6)


def _pairs(rows: DataFrame, least: float) -> DataFrame:
    """Pairs under one shingle; the smaller set, by size and then node, has a row that is ``early``."""
    a, b = rows.where("early").alias("a"), rows.alias("b")
    ordered = F.struct("a.n", "a.node") < F.struct("b.n", "b.node")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & ordered & _may_reach(least))
    return met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))


def _by_fingerprint(nodes: DataFrame, least: float, folder: str) -> DataFrame:
    """``u, v``: nodes of ``node, n, fp`` whose fingerprints are linked, and whose sizes allow ``least``.

    Nodes of one fingerprint meet its least node only; the shingles find what that leaves out.
    """
    heads = nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head"))
    alike = nodes.join(heads, "fp").select(F.struct("node", "n").alias("a"), F.col("head").alias("b"))
    found = simhash.links(heads.select("fp"), folder)
    first, second = (heads.select(F.col("fp").alias(fp), F.col("head").alias(name)) for fp, name in (("u", "a"), ("v", "b")))
    across = found.join(first, "u").join(second, "v").select("a", "b")
    near = F.least("a.n", "b.n") >= least * F.greatest("a.n", "b.n") - 1e-6
    met = alike.union(across).where((F.col("a.node") != F.col("b.node")) & near)
    return met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))


def _early(least: float) -> Column:
    """Whether the smaller set of a pair at ``least`` can have its first common shingle here."""
    return F.col("pos") < _needed(F.col("n"), 2 * least / (1 + least))


def _exploded(first: DataFrame, mask) -> DataFrame:
    """``key, node, n, pos`` of the shingles in ``mask`` of ``node, n, first``."""

    def spread(part: pa.RecordBatch) -> pa.RecordBatch:
        lists = part["first"]
        values, starts = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        rows = np.repeat(np.arange(part.num_rows), np.diff(starts))
        pos = np.arange(len(values)) - (starts[:-1] - starts[0])[rows]
        at = np.flatnonzero(_may_be_in(mask, values.astype(np.int64)))
        rows = pa.array(rows[at])
        columns = [pa.array(values[at]), part["node"].take(rows), part["n"].take(rows), pa.array(pos[at].astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "pos"])

    return first.select("node", "n", "first").mapInArrow(lambda b: _by_slices(b, spread), "key long, node long, n int, pos int")


def _by_hash(single: DataFrame, least: float, folder: str) -> DataFrame:
    """``key, node, n, pos, early, early_rows`` of the first shingles by hash that nodes share.

    A node that ``single`` has twice costs work and changes no pair.
    """
    spark = single.sparkSession
    keys = single.select("node", "n", F.posexplode("first").alias("pos", "key"))
    counted = keys.groupBy("key").agg(F.count("*").alias("rows"), F.count_if(_early(least)).alias("early_rows"))
    # Pairs grow with the early rows; a shingle without any joins nothing.
    counted.where("rows > 1 AND early_rows > 0").select("key", "early_rows").write.parquet(f"{folder}/counted")
    counted = spark.read.schema("key long, early_rows long").parquet(f"{folder}/counted")
    shared = _exploded(single, _mask(counted.select("key"))).join(counted, "key")
    shared.select("*", _early(least).alias("early")).write.parquet(f"{folder}/keys")
    return spark.read.parquet(f"{folder}/keys")


def _by_frequency(
    spark: SparkSession, sets: Callable[[Callable, str], DataFrame], least: float, folder: str
) -> tuple[DataFrame, DataFrame]:
    """``key, node, n, pos, early, early_rows`` in the order of all shingles of ``sets``, rare ones first,
    and the sets as ``node, n, own`` without shingles that no other holds.

    A shingle of one node joins nothing: it takes its place in the order and no row. Ties go by hash.
    """

    def spread(part: pa.RecordBatch) -> pa.RecordBatch:
        sizes = np.array([len(own.as_buffer()) // 8 for own in part["own"]], np.int64)
        values = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(own.as_buffer(), np.int64) for own in part["own"])])
        rows = pa.array(np.repeat(np.arange(part.num_rows), sizes))
        names = [name for name in ("node", "n") if name in part.schema.names]
        return pa.RecordBatch.from_arrays([pa.array(values), *(part[name].take(rows) for name in names)], ["key", *names])

    whole = sets(spread, "key long, node long")
    whole.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").write.parquet(f"{folder}/held")
    held = spark.read.schema("key long, held long").parquet(f"{folder}/held")
    mask = _mask(held.select("key"))

    def restrict(part: pa.RecordBatch) -> pa.RecordBatch:
        owns = [np.frombuffer(own.as_buffer(), np.int64) for own in part["own"]]
        kept = pa.array([own[_may_be_in(mask, own)].tobytes() for own in owns], pa.binary())
        return pa.RecordBatch.from_arrays([part["node"], pa.array([len(own) for own in owns], pa.int32()), kept], ["node", "n", "own"])

    sets(restrict, "node long, n int, own binary").write.parquet(f"{folder}/restricted")
    restricted = spark.read.schema("node long, n int, own binary").parquet(f"{folder}/restricted")
    shared = restricted.mapInArrow(lambda b: _by_slices(b, spread), "key long, node long, n int").join(held, "key")
    # One partition of the window holds the shingles of one text.
    own = Window.partitionBy("node")
    alone = F.col("n") - F.count("*").over(own)
    pos = (alone + F.row_number().over(own.orderBy("held", "key")) - 1).cast("int")
    first = shared.select("key", "node", "n", pos.alias("pos")).where(F.col("pos") < _needed(F.col("n"), least))
    first.select("*", _early(least).alias("early")).write.parquet(f"{folder}/first")
    first = spark.read.schema("key long, node long, n int, pos int, early boolean").parquet(f"{folder}/first")
    early = first.groupBy("key").agg(F.count_if("early").alias("early_rows")).where("early_rows > 0")
    return first.join(early, "key"), restricted


def _crowded(crowd: DataFrame, sets: DataFrame, least: float, folder: str, paired: int) -> list[DataFrame]:
    """Links ``u, v`` of the nodes of crowded shingles, from ``key, node, n, pos, early``."""
    spark = crowd.sparkSession
    far = max(0.0, 2 * least - 1)  # at most so dissimilar from the leader as two steps make
    left, closed, near, racing, out = crowd, None, None, None, []
    for number in range(LEADERS):
        sizes = left.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("leader")).where(F.col("c") > paired)
        if racing is not None:
            sizes = sizes.join(racing, "key", "left_semi")
        path = f"{folder}/leader-{number}"
        crowd.select("key", "node").join(sizes, "key").write.parquet(f"{path}/met")
        met = spark.read.parquet(f"{path}/met")
        if met.isEmpty():
            break
        apart = met.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v"))
        found = _compared(apart, sets, far, path)
        link = found.where(F.col("similarity") >= least - 1e-9)
        out.append(link.select("u", "v"))
        named = met.join(found.select(F.col("u").alias("leader"), F.col("v").alias("node"), "similarity"), ["leader", "node"])
        near = named if near is None else near.union(named)
        own = named.where(F.col("similarity") >= least - 1e-9).select("key", "node", "leader")
        own = own.union(met.where("node = leader").select("key", "node", "leader")).join(left.select("key", "node"), ["key", "node"])
        own.write.parquet(f"{path}/own")
        own = spark.read.schema("key long, node long, leader long").parquet(f"{path}/own")
        closed = own if closed is None else closed.union(own)
        gained = own.groupBy("key").agg(F.count("*").alias("gained")).join(met.groupBy("key").agg(F.min("c").alias("c")), "key")
        racing = gained.where(F.col("gained") >= F.col("c") * LINKED).select("key")
        left.join(own, ["key", "node"], "left_anti").write.parquet(f"{path}/left")
        left = spark.read.schema(crowd.schema).parquet(f"{path}/left")
    rest = _pairs(left, least)
    if closed is not None:
        homes = closed.select("key", F.col("node").alias("v"), "leader")
        outside = near.select("key", F.col("node").alias("u"), "leader").join(
            closed.select("key", F.col("node").alias("u"), "leader"), ["key", "u", "leader"], "left_anti"
        )
        crossing = outside.join(homes, ["key", "leader"]).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        rest = rest.union(crossing)
    return [*out, _compared(rest, sets, least, f"{folder}/rest").select("u", "v")]


def near_copies(
    docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY, paired: int = PAIRED
) -> DataFrame:
    """``doc_id, node, component_id`` of each row of ``doc_id, text``.

    Two texts are linked where the sets of their shingles have similarity ``least``; a text shorter
    than a shingle is one, and texts without words, null included, are equal. ``component_id`` is
    the smallest ``doc_id`` reachable over links; null ids are never the smallest, so it is null
    where no document of a component has an id. Repeated rows stay repeated.
    """
    spark: SparkSession = docs.sparkSession
    folder = fresh_folder(spark, "near")
    _marks(docs, size, least).write.parquet(f"{folder}/marks")
    marks = spark.read.parquet(f"{folder}/marks")
    # What all steps need; the first shingles, the bulk of the marks, go when they have met.
    marks.select("doc_id", "node").write.parquet(f"{folder}/ids")
    ids = spark.read.schema("doc_id long, node long").parquet(f"{folder}/ids")
    nodes = ids.groupBy("node").agg(F.min("doc_id").alias("least"))
    repeat = _repeat(ids)
    marks.groupBy("node").agg(F.min("n").alias("n"), F.min("fp").alias("fp")).write.parquet(f"{folder}/prints")
    prints = spark.read.schema("node long, n int, fp long").parquet(f"{folder}/prints")
    _by_fingerprint(prints, least, f"{folder}/simhash").distinct().write.parquet(f"{folder}/proposed")
    proposed = spark.read.schema("u long, v long").parquet(f"{folder}/proposed")
    # One row a node; sorting is left out where no row can repeat another.
    single = marks.dropDuplicates(["node"]).select("node", "n", "first") if repeat else _first_documents(marks, nodes)
    meeting = _by_hash(single, least, folder)
    meeting.where(F.col("early_rows") > paired).select("node").distinct().write.parquet(f"{folder}/crowd")
    crowd = spark.read.schema("node long").parquet(f"{folder}/crowd")
    # Leaders compare crowds; texts of one template, by chance alike in their bits, are not proposed again.
    both = proposed.join(crowd.withColumnRenamed("node", "u"), "u", "left_semi").join(crowd.withColumnRenamed("node", "v"), "v", "left_semi")
    proposed = proposed.join(both, ["u", "v"], "left_anti").select("u", "v")
    _pairs(meeting.where(F.col("early_rows") <= paired), least).union(proposed).distinct().write.parquet(f"{folder}/pairs")
    pairs = spark.read.schema("u long, v long").parquet(f"{folder}/pairs")
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).union(crowd).distinct()
    sets = _sets(docs, wanted.join(nodes, "node"), size)
    # Read by no later step, not even where an executor is lost; so below.
    for name in ("marks", "prints", "simhash", "proposed", "counted", "keys"):
        commits.remove(spark, f"{folder}/{name}")
    if repeat:
        sets(lambda part: part, "node long, own binary").dropDuplicates(["node"]).write.parquet(f"{folder}/sets")
        stored = spark.read.schema("node long, own binary").parquet(f"{folder}/sets")
        sets = lambda made, schema: stored.mapInArrow(lambda b: _by_slices(b, made), schema)
    # Sets of nodes that are in no crowd change counts a little, and no result.
    again, sets = _by_frequency(spark, sets, least, folder)
    for name in ("sets", "held"):
        commits.remove(spark, f"{folder}/{name}")
    few = _pairs(again.where(F.col("early_rows") <= paired), least)
    links = _compared(pairs.union(few), sets, least, f"{folder}/found").select("u", "v")
    for found in _crowded(again.where(F.col("early_rows") > paired).drop("early_rows"), sets, least, folder, paired):
        links = links.union(found.select("u", "v"))
    roots = components(links, f"{folder}/stars").withColumnRenamed("node", "member")
    rooted = nodes.join(roots, F.col("node") == F.col("member"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return ids.join(rooted.join(smallest, "root").select("node", "component_id"), "node").select(
        "doc_id", "node", "component_id"
    )


def without_near_copies(docs: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest ``doc_id``.

    All columns stay. Of rows that repeat a ``doc_id`` one stays. Rows without an id all stay.
    """
    found = near_copies(docs.select("doc_id", "text"), paired=paired)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))
