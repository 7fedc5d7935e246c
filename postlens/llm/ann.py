"""Approximate nearest neighbours by largest inner product: NN-descent and greedy graph search.

Equal vectors are one node. All nodes get one more component, so that they have one length; then
a large inner product with a query is a small angle. The neighbour graph starts from chunks of
vectors that are alike under random hyperplanes. Each round of NN-descent joins, for every node,
a sample of its neighbours and of the nodes it is a neighbour of, compares them with each other,
and keeps the best ``DEGREE`` of each; samples bound the work at nodes with very many links.
A query walks the graph from its start nodes: it expands its best nodes not yet expanded, scores
their neighbours on the original vectors, and keeps the best ``BEAM``, until all are expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import fresh_folder

NEAREST = 20
DEGREE = 32
ROUNDS = 5
SAMPLE = 20  # neighbours, and again nodes it is a neighbour of, that a node brings together
OFFERS = 12  # best comparisons a node gets from one meeting
CHUNK = 96  # vectors compared all with all at the start
ORDERS = 3  # times they are dealt into chunks
PLANES = 16
BEAM = 200
EXPAND = 40
ENTRIES = 16  # nodes at which every query looks, besides its own start

LINKS = "array<struct<v:long,s:float>>"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of rows that take part, one per id.

    Rows without id, and vectors that are null, empty, zero, or hold null or non-finite numbers
    take no part; nor do vectors of another length than most. Of rows with one id the smallest
    vector stays.
    """
    x = F.col("vector")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & sound & F.exists(x, lambda c: c != 0))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (size["n"] if size else 0))


def _twins(rows: DataFrame, keep: int) -> DataFrame:
    """``node, vector, twins``: the ``keep`` smallest ids of each distinct vector.

    Ids are thinned out per batch first, so that a very common vector sends few of them.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[tuple, list[int]] = {}
            for vec_id, vector in zip(batch["vec_id"].to_pylist(), batch["vector"].to_pylist()):
                own.setdefault(tuple(vector), []).append(vec_id)
            pairs = [(i, v) for v, ids in own.items() for i in sorted(ids)[:keep]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in pairs], pa.int64()), pa.array([v for _, v in pairs], pa.list_(pa.float64()))],
                ["vec_id", "vector"],
            )

    thinned = rows.mapInArrow(thin, "vec_id long, vector array<double>")
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep)
    return thinned.groupBy("vector").agg(ids.alias("twins")).select(F.get("twins", F.lit(0)).alias("node"), "vector", "twins")


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
    """Positions of each owner's ``keep`` best others, best first, each other once; by owner."""
    order = np.lexsort((-score, other, owner))
    first = np.ones(len(order), bool)
    first[1:] = (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1])
    order = order[first]
    order = order[np.lexsort((other[order], -score[order], owner[order]))]
    sorted_ = owner[order]
    starts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < keep]


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def _coded(nodes: DataFrame) -> DataFrame:
    """``node, code, orders``: the vector with equal length, in half precision, and its chunk orders."""
    longest = nodes.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, c: a + c * c))).first()[0] or 1.0

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch["vector"].to_pylist()) / np.sqrt(longest)
            x = np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))])
            planes = np.random.default_rng(11).standard_normal((x.shape[1], ORDERS, PLANES))
            bits = np.einsum("nd,dop->nop", x, planes)
            keys = ((bits > 0) << np.arange(PLANES - 1, -1, -1)).sum(2).astype(float)
            # Ties of the code are ordered along its first plane.
            keys += 1 / (1 + np.exp(-bits[:, :, 0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["node"],
                    pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary()),
                    pa.array(keys.tolist(), pa.list_(pa.float64())),
                ],
                ["node", "code", "orders"],
            )

    return nodes.select("node", "vector").mapInArrow(code, "node long, code binary, orders array<double>")


def _links_batch(owner, other, score, keep) -> pa.RecordBatch:
    at = _best(owner, other, score, keep)
    own = owner[at]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(at) else np.zeros(0, int)
    links = pa.ListArray.from_arrays(
        pa.array(np.r_[starts, len(at)], pa.int32()),
        pa.StructArray.from_arrays([pa.array(other[at]), pa.array(score[at].astype(np.float32))], ["v", "s"]),
    )
    return pa.RecordBatch.from_arrays([pa.array(own[starts]), links], ["u", "links"])


def _first_links(coded: DataFrame) -> DataFrame:
    """``u, links`` from comparing consecutive vectors of each order, in chunks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                # A short rest joins the chunk before it.
                if at and batch.num_rows - at < CHUNK // 2:
                    break
                size = CHUNK if batch.num_rows - at >= CHUNK + CHUNK // 2 else batch.num_rows - at
                part = batch.slice(at, size)
                ids, x = part["node"].to_numpy(), _codes(part["code"])
                u, v = (~np.eye(len(ids), dtype=bool)).nonzero()
                if len(u):
                    yield _links_batch(ids[u], ids[v], (x @ x.T)[u, v], DEGREE)

    found = None
    for order in range(ORDERS):
        key = F.get("orders", F.lit(order))
        dealt = coded.select("node", "code", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
        links = dealt.mapInArrow(compare, f"u long, links {LINKS}")
        found = links if found is None else found.union(links)
    return found.groupBy("u").agg(F.flatten(F.collect_list("links")).alias("links"))


def _merged(offered: DataFrame, coded: DataFrame) -> DataFrame:
    """``u, code, worst, links``: the best ``DEGREE`` of all offered links of each node."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.repeat(batch["u"].to_numpy(), batch["links"].value_lengths().fill_null(0).to_numpy())
            flat = batch["links"].flatten()
            kept = _links_batch(own, flat.field("v").to_numpy(), flat.field("s").to_numpy(), DEGREE)
            places = {u: i for i, u in enumerate(kept["u"].to_pylist())}
            at = pa.array([places.get(u) for u in batch["u"].to_pylist()], pa.int64())
            links = kept["links"].take(at)
            worst = [x[-1]["s"] if x and len(x) >= DEGREE else -np.inf for x in links.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["u"], batch["code"], pa.array(worst, pa.float32()), links], ["u", "code", "worst", "links"]
            )

    joined = coded.select(F.col("node").alias("u"), "code").join(offered, "u", "left")
    return joined.mapInArrow(merge, f"u long, code binary, worst float, links {LINKS}")


def _round(graph: DataFrame, number: int) -> DataFrame:
    """Links found by one round: ``u, links``, the old ones included."""
    edges = graph.select("u", F.explode("links.v").alias("v"))
    draw = F.pmod(F.xxhash64(F.lit(number), "u", "v"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    inward = edges.groupBy("v").count()
    out = edges.where(draw < SAMPLE / DEGREE).select(F.col("u").alias("center"), F.col("v").alias("member"))
    back = edges.join(inward, "v").where(draw < F.lit(float(SAMPLE)) / F.col("count"))
    met = out.union(back.select(F.col("v").alias("center"), F.col("u").alias("member"))).distinct()
    who = graph.select(F.col("u").alias("member"), "code", "worst")
    meetings = met.join(who, "member").groupBy("center").agg(F.collect_list(F.struct("member", "code", "worst")).alias("m"))

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["m"].value_lengths().to_numpy()
            flat = batch["m"].flatten()
            if not len(flat):
                continue
            ids, x, worst = flat.field("member").to_numpy(), _codes(flat.field("code")), flat.field("worst").to_numpy()
            us, vs, ss, at = [], [], [], 0
            for size in sizes.tolist():
                mine = slice(at, at + size)
                at += size
                s = x[mine] @ x[mine].T
                np.fill_diagonal(s, -np.inf)
                if size > OFFERS + 1:
                    best = np.argpartition(-s, OFFERS, axis=1)[:, :OFFERS]
                else:
                    best = np.tile(np.arange(size), (size, 1))
                score = np.take_along_axis(s, best, 1)
                i, j = (score > worst[mine][:, None]).nonzero()
                us.append(ids[mine][i])
                vs.append(ids[mine][best[i, j]])
                ss.append(score[i, j])
            u, v, s = map(np.concatenate, (us, vs, ss))
            if len(u):
                yield _links_batch(u, v, s, DEGREE)

    offers = meetings.mapInArrow(introduce, f"u long, links {LINKS}").union(graph.select("u", "links"))
    return offers.groupBy("u").agg(F.flatten(F.collect_list("links")).alias("links"))


def build(vectors: DataFrame, folder: str, rounds: int = ROUNDS, twins: int = NEAREST + 1) -> tuple[DataFrame, DataFrame]:
    """``(nodes, graph)`` of ``usable`` vectors, written below ``folder``.

    ``nodes``: ``node, vector, twins``; ``graph``: ``u, code, worst, links``.
    """
    spark = vectors.sparkSession
    _twins(vectors, twins).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    _coded(nodes).write.parquet(f"{folder}/codes")
    coded = spark.read.parquet(f"{folder}/codes")
    links = _first_links(coded)
    for number in range(rounds + 1):
        _merged(links, coded).write.parquet(f"{folder}/graph-{number}")
        graph = spark.read.parquet(f"{folder}/graph-{number}")
        links = _round(graph, number)
    return nodes, graph


BEAM_TYPE = "array<struct<v:long,s:double,done:boolean>>"


def _scored(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``query_id, v, s`` of ``query_id, vector, v``: exact inner products in double precision."""
    other = nodes.select(F.col("node").alias("v"), F.col("vector").alias("other"))
    product = F.aggregate(F.zip_with("vector", "other", lambda a, b: a * b), F.lit(0.0), lambda t, p: t + p)
    return pairs.join(other, "v").select("query_id", "v", product.alias("s"))


def search(
    queries: DataFrame, nodes: DataFrame, graph: DataFrame, folder: str, beam: int = BEAM, expand: int = EXPAND
) -> DataFrame:
    """``query_id, v, s`` of the ``beam`` best nodes found for ``query_id, vector, start``.

    ``start`` is a node to begin at, or null. Each round is written below ``folder``.
    """
    spark: SparkSession = queries.sparkSession
    asked = queries.select("query_id", "vector")
    # A constant number of entry nodes, the same for all queries.
    entries = [r.node for r in nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select("node").collect()]
    starts = queries.select("query_id", F.explode(F.array_compact(F.array("start", *map(F.lit, entries)))).alias("v")).distinct()
    near = graph.select("u", "links")
    found = starts
    beams = None
    number = 0
    while True:
        scored = _scored(found.join(asked, "query_id"), nodes).select(
            "query_id", F.struct("v", "s", F.lit(False).alias("done")).alias("b")
        )
        if beams is not None:
            scored = scored.union(beams.select("query_id", F.explode("beam").alias("b")))
        # An expanded node that is found again counts as expanded.
        once = scored.groupBy("query_id", "b.v").agg(F.max("b.s").alias("s"), F.max("b.done").alias("done"))
        best_first = F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("d"), "v", "done")))
        kept = F.transform(
            F.slice(best_first, 1, beam), lambda b: F.struct(b["v"].alias("v"), (-b["d"]).alias("s"), b["done"].alias("done"))
        )
        todo = F.slice(F.filter("beam", lambda b: ~b["done"])["v"], 1, expand)
        done = F.transform(
            "beam",
            lambda b: F.struct(
                b["v"].alias("v"), b["s"].alias("s"), (b["done"] | F.array_contains("todo", b["v"])).alias("done")
            ),
        )
        state = (
            once.groupBy("query_id").agg(kept.alias("beam")).withColumn("todo", todo).withColumn("beam", done)
        )
        state.write.parquet(f"{folder}/beam-{number}")
        beams = spark.read.schema(f"query_id long, beam {BEAM_TYPE}, todo array<long>").parquet(f"{folder}/beam-{number}")
        if beams.where(F.size("todo") > 0).isEmpty():
            return beams.select("query_id", F.explode("beam").alias("b")).select("query_id", "b.v", "b.s")
        seen = beams.select("query_id", F.explode("beam.v").alias("v"))
        found = (
            beams.select("query_id", F.explode("todo").alias("u"))
            .join(near, "u")
            .select("query_id", F.explode("links.v").alias("v"))
            .distinct()
            .join(seen, ["query_id", "v"], "left_anti")
        )
        number += 1


def nearest(vectors: DataFrame, modulus: int, count: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest rows found for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``modulus``; nearness is the inner
    product in double precision, ties go to the smaller id. See ``usable`` for rows that take no
    part; a table without others gives no row.
    """
    spark = vectors.sparkSession
    folder = fresh_folder(spark, "ann")
    usable(vectors).write.parquet(f"{folder}/vectors")
    rows = spark.read.parquet(f"{folder}/vectors")
    nodes, graph = build(rows, folder, twins=count + 1)
    own = nodes.select("vector", F.col("node").alias("start"))
    queries = (
        rows.where(F.pmod("vec_id", F.lit(modulus)) == 0).join(own, "vector").select(F.col("vec_id").alias("query_id"), "vector", "start")
    )
    queries.write.parquet(f"{folder}/queries")
    found = search(spark.read.parquet(f"{folder}/queries"), nodes, graph, f"{folder}/search")
    named = (
        found.join(nodes.select(F.col("node").alias("v"), "twins"), "v")
        .select("query_id", "s", F.explode("twins").alias("vec_id"))
        .where("vec_id <> query_id")
    )
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("d"), "vec_id"))), 1, count)
    return (
        named.groupBy("query_id")
        .agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("at", "b"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", (-F.col("b.d")).alias("score"))
    )
