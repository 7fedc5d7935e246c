"""Mixing sources to target weights by min-cost flow.

Documents of the same sources are one pattern: only the words of each pattern enter the flow. Its
capacity goes from a pattern to the sources it belongs to and on to their quotas. A pattern may be
taken several times; each further time costs more than the one before (a convex cost), so words are
repeated only where quotas ask for it, and where a document has several sources, the one that lacks
words gets it. Patterns and sources linked with each other make a network, and each network is solved
by successive shortest paths in a task of its own.

Of a pattern, documents are taken in a seeded random order until its flow is used up. Places in that
order are sums of sums over buckets of the order, so no task sees a whole pattern.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.components import components
from postlens.session import fresh_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 13
# Rows of a bucket of the seeded order, on average.
BUCKET = 4_096
# Source names as keys: a null is a source too, the last one.
KEY = "CASE WHEN source IS NULL THEN '~' ELSE concat('=', source) END"


def number_of_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, share: float, most: int) -> float:
    """What a weight of one gets, of ``size, weight``, so that ``least(most * size, level * weight)`` sums to
    ``share`` of all sizes. Each step caps the sources that are above and reshares the rest."""
    level, before = None, None
    while True:
        below = F.lit(True) if level is None else F.col("weight") * F.lit(level) <= F.col("size") * most
        row = sources.agg(
            F.sum("size").alias("total"),
            F.sum(F.when(~below, F.col("size") * most)).alias("capped"),
            F.sum(F.when(below, F.col("weight"))).alias("weight"),
            F.count_if(below).alias("n"),
        ).first()
        if not row["total"] or row["n"] == before or not row["weight"]:
            return level or 0.0
        level, before = (share * row["total"] - (row["capped"] or 0)) / row["weight"], row["n"]


def ranked(names: DataFrame, folder: str) -> DataFrame:
    """Add ``rank``, from 0, in the order of the column ``key``; sorted in parts, then counted."""
    spark = names.sparkSession
    schema = pa.schema([("key", pa.string()), ("part", pa.int64()), ("at", pa.int64())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = pa.array(range(seen, seen + batch.num_rows), pa.int64())
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array([part] * batch.num_rows, pa.int64()), at], schema=schema)

    ordered = names.select("key").repartitionByRange("key").sortWithinPartitions("key")
    ordered.mapInArrow(number, "key string, part long, at long").write.parquet(f"{folder}/ranked")
    placed = spark.read.schema("key string, part long, at long").parquet(f"{folder}/ranked")
    # One row a partition.
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    return names.join(placed.join(F.broadcast(starts), "part").select("key", (F.col("start") + F.col("at")).alias("rank")), "key")


def weighted_targets(sizes: DataFrame, folder: str, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``key, size, rank, target`` of each source of ``key, size``: ``weights`` go round by code point."""
    numbered = ranked(sizes, folder)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    numbered.withColumn("weight", weight).write.parquet(f"{folder}/sources")
    weighted = sizes.sparkSession.read.parquet(f"{folder}/sources")
    level = water_level(weighted, share, most)
    target = F.least((F.col("size") * most).cast("double"), F.col("weight") * F.lit(level))
    return weighted.select("key", "size", "rank", target.alias("target"))


# --- the flow ----------------------------------------------------------------------------------------


def least_cost_flow(words: list[int], members: list[list[int]], quotas: list[int], most: int = MOST) -> list[dict[int, int]]:
    """Words of each pattern for each of its sources: as many as quotas and ``most`` times the words allow,
    at the least cost. The k-th time of a word costs ``k - 1``, so the cost is convex.

    Successive shortest paths over reduced costs; patterns may take back what they gave.
    """
    p, s = len(words), len(quotas)
    start, end = p + s, p + s + 1
    graph: list[list[int]] = [[] for _ in range(p + s + 2)]
    to, room, cost = [], [], []

    def arc(u: int, v: int, capacity: int, price: int) -> int:
        for a, b, c, d in ((u, v, capacity, price), (v, u, 0, -price)):
            graph[a].append(len(to))
            to.append(b)
            room.append(c)
            cost.append(d)
        return len(to) - 2

    named = []
    for i in range(p):
        for time in range(most):
            arc(start, i, words[i], time)
        named.append([(j, arc(i, p + j, most * words[i], 0)) for j in members[i]])
    for j in range(s):
        arc(p + j, end, quotas[j], 0)
    potential = [0] * len(graph)
    while True:
        far: list[float] = [float("inf")] * len(graph)
        far[start], via, heap = 0, [-1] * len(graph), [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in graph[u]:
                if room[e]:
                    reached = d + cost[e] + potential[u] - potential[to[e]]
                    if reached < far[to[e]]:
                        far[to[e]], via[to[e]] = reached, e
                        heapq.heappush(heap, (reached, to[e]))
        if via[end] < 0:
            return [{j: room[e ^ 1] for j, e in own if room[e ^ 1]} for own in named]
        # Nodes that are farther than the end keep their order with its distance.
        potential = [a + min(b, far[end]) for a, b in zip(potential, far)]
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = to[via[v] ^ 1]
        moved = min(room[e] for e in path)
        for e in path:
            room[e] -= moved
            room[e ^ 1] += moved


def _networks(patterns: DataFrame, sources: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Patterns and sources with the number of their network: the least rank in it."""
    spark = patterns.sparkSession
    listed = patterns.select("members", F.explode("members").alias("key")).join(sources.select("key", "rank"), "key")
    listed.groupBy("members").agg(F.min("rank").alias("first"), F.sort_array(F.collect_list("rank")).alias("ranks")).write.parquet(f"{folder}/ranks")
    numbered = spark.read.parquet(f"{folder}/ranks")
    links = numbered.select(F.col("first").alias("u"), F.explode("ranks").alias("v")).where("u <> v").distinct()
    roots = components(links, f"{folder}/stars").select(F.col("node"), F.col("root").alias("linked"))
    homes = sources.select("key", "rank", "target").join(roots, F.col("rank") == F.col("node"), "left").select(
        "key", "rank", "target", F.coalesce("linked", "rank").alias("network")
    )
    own = numbered.join(homes.select(F.col("rank").alias("first"), "network"), "first").join(patterns, "members")
    return own, homes


def flows(patterns: DataFrame, sources: DataFrame, folder: str, most: int = MOST) -> DataFrame:
    """``members, cuts`` for the patterns ``members, words`` and the sources ``key, rank, target``.

    ``cuts`` lists by rank ``key, start, stop``: which of the pattern's words, repeats counted on, go to
    the source. A network is bounded by the number of different patterns in it, not by their documents.
    """
    own, homes = _networks(patterns, sources, folder)
    rows = own.select("network", "members", "ranks", "words").unionByName(
        homes.select("network", F.array("key").alias("members"), F.array("rank").alias("ranks"), F.round("target").cast("long").alias("quota")),
        allowMissingColumns=True,
    )

    def solve(table: pa.Table) -> pa.Table:
        given = sorted(table.to_pylist(), key=lambda r: r["ranks"])
        at = {r["ranks"][0]: (i, r) for i, r in enumerate(r for r in given if r["quota"] is not None)}
        own = [r for r in given if r["quota"] is None]
        quotas = [r["quota"] for _, r in at.values()]
        found = least_cost_flow([r["words"] for r in own], [[at[k][0] for k in r["ranks"]] for r in own], quotas, most)
        keys = [r["members"][0] for _, r in at.values()]
        cuts = []
        for flow in found:
            stop = 0
            cuts.append([])
            for j in sorted(flow):
                cuts[-1].append({"key": keys[j], "start": stop, "stop": stop + flow[j]})
                stop += flow[j]
        kind = pa.list_(pa.struct([("key", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"members": pa.array([r["members"] for r in own], pa.list_(pa.string())), "cuts": pa.array(cuts, kind)})

    return rows.groupBy("network").applyInArrow(solve, "members array<string>, cuts array<struct<key: string, start: long, stop: long>>")


# --- documents -----------------------------------------------------------------------------------------


def placed(rows: DataFrame, seed: int, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Rows of ``doc_id, members, size, copies`` with ``bucket`` and ``start`` in it, and the buckets' offsets."""
    bits = max(0, math.ceil(math.log2(max(1, rows.count()) / bucket)))
    own = rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size", "members"))
    own = own.withColumn("bucket", F.shiftrightunsigned("draw", 64 - bits) if bits else F.lit(0).cast("long"))
    words = F.col("size") * F.col("copies")
    sums = own.groupBy("members", "bucket").agg(F.sum(words).alias("words"))
    # A pattern has as many buckets at most as a pattern of all rows has.
    offsets = sums.select("members", "bucket", (F.sum("words").over(Window.partitionBy("members").orderBy("bucket")) - F.col("words")).alias("offset"))
    inside = Window.partitionBy("members", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return own.withColumn("start", F.sum(words).over(inside) - words), offsets


def select_documents(
    docs: DataFrame, targets: DataFrame, folder: str, most: int = MOST, seed: int = SEED, about: DataFrame | None = None
) -> DataFrame:
    """What the mix takes of each row of ``doc_id, members, size``.

    ``members`` lists the keys of a document's sources, sorted, at least one; ``targets`` has ``key, rank,
    target``. The result has ``doc_id, members, size, taken`` and ``taken_by``, the words for each source;
    the last document taken of a pattern may be taken in part. Equal rows are told apart by nothing:
    they stay as many rows and share what falls on them. Null ids are ids like others. Columns of
    ``about``, a row for each ``members``, come too.
    """
    spark = docs.sparkSession
    docs.groupBy("doc_id", "members", "size").agg(F.count("*").alias("copies")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    patterns = rows.groupBy("members").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    patterns.write.parquet(f"{folder}/patterns")
    patterns = spark.read.parquet(f"{folder}/patterns")
    flows(patterns, targets, folder, most).write.parquet(f"{folder}/flows")
    taken = spark.read.parquet(f"{folder}/flows").join(patterns, "members")
    own, offsets = placed(rows, seed)
    # Patterns meet their buckets, not their documents.
    more = [] if about is None else [name for name in about.columns if name != "members"]
    by_bucket = offsets.join(taken if about is None else taken.join(about, "members"), "members")
    at = own.join(by_bucket, ["members", "bucket"]).select(
        "doc_id", "members", "size", "words", "cuts", *more, (F.col("offset") + F.col("start")).alias("start"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    )
    at = at.withColumn("start", F.col("start") + F.col("size") * (F.col("copy") - 1))
    times = F.sequence(F.lit(0), F.lit(most - 1))

    def of(cut: Column) -> Column:
        """Words of the document between the ends of a cut, each time the pattern is gone through."""
        def once(done: Column, time: Column) -> Column:
            start = F.col("start") + F.col("words") * time
            shared = F.least(cut["stop"], start + F.col("size")) - F.greatest(cut["start"], start)
            return done + F.greatest(shared, F.lit(0).cast("long"))

        return F.aggregate(times, F.lit(0).cast("long"), once)

    by = F.filter(F.transform("cuts", lambda c: F.struct(c["key"].alias("key"), of(c).alias("words"))), lambda t: t["words"] > 0)
    return at.select("doc_id", "members", "size", *more, by.alias("taken_by")).withColumn(
        "taken", F.aggregate("taken_by", F.lit(0).cast("long"), lambda done, t: done + t["words"])
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of each row of ``doc_id, text, source``.

    A document's size is its number of words, 0 for a null text. The sources, by code point with null
    last, weigh ``weights`` in turn and share ``share`` of all words; a target stops at ``most`` times its
    source's words and the excess is reshared. Results depend on the rows and ``seed`` only. An empty
    table gives no row; other columns of any name are ignored.
    """
    folder = fresh_folder(docs.sparkSession, "mix")
    sized = docs.select("doc_id", "source", number_of_words(F.col("text")).alias("size"))
    sized.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(KEY).alias("key"), "size").write.parquet(f"{folder}/sized")
    sized = docs.sparkSession.read.schema("doc_id long, key string, size long").parquet(f"{folder}/sized")
    targets = weighted_targets(sized.groupBy("key").agg(F.sum("size").alias("size")), folder, weights, share, most)
    own = targets.select(F.array("key").alias("members"), F.col("size").alias("source_size"), "target")
    found = select_documents(sized.select("doc_id", F.array("key").alias("members"), "size"), targets, folder, most, seed, own)
    source = F.when(F.col("key") != "~", F.substring("key", 2, 1 << 30)).alias("source")
    return found.withColumn("key", F.col("members")[0]).select("doc_id", source, "size", "source_size", "target", "taken")
