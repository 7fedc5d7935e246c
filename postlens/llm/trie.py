"""Conversation prefix trie: which conversations share their first turns, and what sharing saves.

A node is a sequence of first turns. Its hash is a polynomial over two moduli of 61 bits, so the hash
of turns after others follows from both hashes: no task needs a whole conversation, and conversations
may start with turns of another. Node and conversation meet by hash; afterwards a node is named by its
smallest member and its depth.

Subtree totals are found by time-forward processing. Nodes are sorted by reverse level order inside
shards (bands of depth, blocks of smallest members); a task passes over a shard once and sends each
node's totals to its parent through a priority queue, which spills sorted runs. A parent's smallest
member and depth are never larger, so most parents are in the shard of their children. Totals that
leave a shard are summed by the node they go to. These nodes, each under the next such node above its
shard, make a smaller forest, which is processed in the same way in wider shards, until no totals
leave one; then each level adds what came from above.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.session import fresh_folder

MODULUS = (1 << 61) - 1
BASES = (0x12B9B0A1C3F5D7E5, 0x0F1E2D3C4B5A6977)
INVERSES = tuple(pow(base, -1, MODULUS) for base in BASES)
# A conversation takes at most so many turns from the start of another.
MOST_TAKEN = 5
# Shards of the first level: so many consecutive ids and depths; each level is ``WIDER`` in both.
BLOCK, BAND, WIDER = 1_000, 4_096, 64
# Messages that a queue holds in memory; more go to runs on disk.
IN_MEMORY = 100_000
# Consecutive ids whose list is made in one row, before lists are hashed one after the other.
LISTED = 4_096
ROWS = 4_096


class SpillingQueue:
    """A priority queue of ``(key, key, value, value)`` in whole numbers of 64 bits.

    Beyond ``IN_MEMORY`` messages the heap is written, sorted, to a temporary file of this task, which
    goes with the queue; such runs are read again bit by bit.
    """

    RECORD = struct.Struct("<qqqq")

    def __init__(self, limit: int = IN_MEMORY) -> None:
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, *message: int) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.limit:
            run = tempfile.TemporaryFile()
            for message in sorted(self.heap):
                run.write(self.RECORD.pack(*message))
            run.seek(0)
            self.heap = []
            heapq.heappush(self.runs, (*self._next(run), id(run), run))

    def _next(self, run) -> tuple[int, ...]:
        return self.RECORD.unpack(run.read(self.RECORD.size))

    def take(self, first: int, second: int) -> Iterator[tuple[int, int]]:
        """Remove the messages to a key; none to a smaller key may be left."""
        key = (first, second)
        while self.heap and self.heap[0][:2] == key:
            yield heapq.heappop(self.heap)[2:]
        while self.runs and self.runs[0][:2] == key:
            *message, number, run = self.runs[0]
            data = run.read(self.RECORD.size)
            if data:
                heapq.heapreplace(self.runs, (*self.RECORD.unpack(data), number, run))
            else:
                heapq.heappop(self.runs)
                run.close()
            yield tuple(message[2:])

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, ROWS).columns))


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches."""
    some = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*some), schema)]
        some.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        some.append(row)
        if len(some) == ROWS:
            yield batch()
    if some:
        yield batch()


def _longs(*names: str) -> pa.Schema:
    return pa.schema([(name, pa.int64()) for name in names])


def _ddl(schema: pa.Schema) -> str:
    types = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
    return ", ".join(f"{field.name} {types[field.type]}" for field in schema)


# --- turns to hashes of prefixes ---------------------------------------------------------------

# A turn: its place in its conversation, hashes of the turns up to it (a, b) and of itself (s, t).
_TURN = ("conv_id", "pos", "a", "b", "s", "t", "chars")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and prefix hashes inside this partition, which holds a stretch of all sorted turns."""
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        first = now = None
        for conv_id, digest, chars in _rows(batches):
            if now is None or conv_id != now:
                first = conv_id if now is None else first
                now, pos, a, b = conv_id, 0, 0, 0
            s = (int.from_bytes(digest[:8]) >> 3) % MODULUS
            t = (int.from_bytes(digest[8:16]) >> 3) % MODULUS
            pos, a, b = pos + 1, (a * BASES[0] + s) % MODULUS, (b * BASES[1] + t) % MODULUS
            yield conv_id, pos, a, b, s, t, chars, part, conv_id == first

    yield from _sent(rows(), CHAINED)


CHAINED = _longs(*_TURN, "part").append(pa.field("is_first", pa.bool_()))


def _placed(turns: DataFrame, folder: str) -> DataFrame:
    """``conv_id, pos, a, b, s, t, chars`` of each row of ``conv_id, turn, role, text``.

    A conversation may stand in several partitions. All but the first conversation of a partition
    start there, so at most one a partition needs the hash of what stands before.
    """
    spark = turns.sparkSession
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    ).write.parquet(f"{folder}/turns")
    given = spark.read.schema("conv_id long, turn long, digest binary, chars long").parquet(f"{folder}/turns")
    order = (F.col("conv_id"), F.asc_nulls_first("turn"), F.col("digest"))
    ordered = given.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "chars")
    ordered.mapInArrow(_chained, _ddl(CHAINED)).write.parquet(f"{folder}/chained")
    chained = spark.read.schema(_ddl(CHAINED)).parquet(f"{folder}/chained")

    # At most one conversation a partition, and two partitions a conversation more.
    cut = chained.where("is_first AND part > 0").select("conv_id").distinct()
    ends = (
        chained.join(F.broadcast(cut), "conv_id", "left_semi")
        .groupBy("conv_id", "part")
        .agg(F.max("pos").alias("n"), F.max_by(F.struct("a", "b"), "pos").alias("last"))
    )
    before: dict[tuple[int, int], tuple[int, int, int]] = {}
    now = None
    for row in sorted(ends.collect(), key=lambda r: (r["conv_id"], r["part"])):
        if row["conv_id"] != now:
            now, n, a, b = row["conv_id"], 0, 0, 0
        if n:
            before[now, row["part"]] = (n, a, b)
        a = (a * pow(BASES[0], row["n"], MODULUS) + row["last"]["a"]) % MODULUS
        b = (b * pow(BASES[1], row["n"], MODULUS) + row["last"]["b"]) % MODULUS
        n += row["n"]
    if not before:
        return chained.select(*_TURN)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, pos, a, b, s, t, chars, part in _rows(batches):
                if found := before.get((conv_id, part)):
                    n, c, d = found
                    a = (c * pow(BASES[0], pos, MODULUS) + a) % MODULUS
                    b = (d * pow(BASES[1], pos, MODULUS) + b) % MODULUS
                    pos += n
                yield conv_id, pos, a, b, s, t, chars

        return _sent(rows(), _longs(*_TURN))

    return chained.select(*_TURN, "part").mapInArrow(moved, _ddl(_longs(*_TURN)))


MEMBER = _longs("conv_id", "depth", "a", "b", "pa", "pb", "chars").append(pa.field("is_end", pa.bool_()))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node of each rebuilt turn and the node above: ``p`` stands for what the start changes."""

    def rows() -> Iterator[tuple]:
        for conv_id, depth, a, b, s, t, chars, after, p, q, is_end in _rows(batches):
            if p or q:
                a = (p * pow(BASES[0], after, MODULUS) + a) % MODULUS
                b = (q * pow(BASES[1], after, MODULUS) + b) % MODULUS
            yield conv_id, depth, a, b, (a - s) * INVERSES[0] % MODULUS, (b - t) * INVERSES[1] % MODULUS, chars, is_end

    return _sent(rows(), MEMBER)


def rebuilt_from_family(conv_id: Column) -> tuple[Column, Column]:
    """The conversation whose first turns replace the own ones, and how many."""
    return conv_id - conv_id % 100, (F.crc32(conv_id.cast("string").cast("binary")) % (MOST_TAKEN + 1)).cast("long")


def _membership(turns: DataFrame, rebuilt, folder: str) -> DataFrame:
    """One row per conversation and depth: ``conv_id, depth``, the node and the one above, ``chars``."""
    spark = turns.sparkSession
    _placed(turns, folder).write.parquet(f"{folder}/placed")
    placed = spark.read.schema(_ddl(_longs(*_TURN))).parquet(f"{folder}/placed")
    early = F.when(F.col("pos") <= MOST_TAKEN, F.struct("pos", "a", "b", "s", "t", "chars"))
    heads = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), F.array_sort(F.collect_list(early)).alias("head"))
    heads.write.parquet(f"{folder}/heads")
    heads = spark.read.parquet(f"{folder}/heads")
    taken_from, taken = rebuilt(F.col("conv_id"))
    given = heads.select(F.col("conv_id").alias("giver"), F.col("head").alias("given"))
    known = heads.select("*", taken_from.alias("giver"), taken.alias("skipped")).join(given, "giver", "left")
    known = known.withColumn("given", F.slice(F.coalesce("given", F.array().cast(given.schema["given"].dataType)), 1, F.col("skipped").cast("int")))

    def change(name: str) -> Column:
        """The hash of the turns taken less that of the own turns left out, as far as both go."""
        new, old = (F.coalesce(F.try_element_at(c, F.lit(-1))[name], F.lit(0)) for c in (F.col("given"), F.slice("head", 1, F.col("skipped").cast("int"))))
        return F.pmod(new - old, F.lit(MODULUS))

    starts = known.select(
        "conv_id",
        "given",
        "skipped",
        F.size("given").cast("long").alias("m"),
        (F.size("given") + F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("skipped"))).cast("long").alias("length"),
        change("a").alias("p"),
        change("b").alias("q"),
    )
    nothing = [F.lit(0).cast("long").alias(name) for name in ("after", "p", "q")]
    new = starts.select("conv_id", "length", F.explode("given").alias("g")).select(
        "conv_id", F.col("g.pos").alias("depth"), *(f"g.{n}" for n in ("a", "b", "s", "t", "chars")), *nothing, (F.col("g.pos") == F.col("length")).alias("is_end")
    )
    depth = F.col("pos") - F.col("skipped") + F.col("m")
    own = placed.join(starts, "conv_id").where("pos > skipped").select(
        "conv_id", depth.alias("depth"), "a", "b", "s", "t", "chars", (F.col("pos") - F.col("skipped")).alias("after"), "p", "q", (depth == F.col("length")).alias("is_end")
    )
    zero = F.lit(0).cast("long")
    top = starts.select("conv_id", *(zero.alias(n) for n in ("depth", "a", "b", "pa", "pb", "chars")), (F.col("length") == 0).alias("is_end"))
    new.union(own).mapInArrow(_members, _ddl(MEMBER)).union(top).write.parquet(f"{folder}/members")
    return spark.read.schema(_ddl(MEMBER)).parquet(f"{folder}/members")


# --- subtree totals ------------------------------------------------------------------------------

# A node by smallest member and depth, the node above it (null at the top), and what is summed.
FOREST = _longs("c", "d", "pc", "pd", "leaves", "saved")
TOTALS = _longs("c", "d", "leaves", "saved")


def _shards(forest: DataFrame, level: int, block: int, band: int) -> DataFrame:
    """Add the shard of each node and of its parent: a band of depths and a block of ids."""

    def place(value: str, width: int) -> Column:
        return F.expr(f"{value} div {width}L") if width < 1 << 62 else F.when(F.col(value).isNotNull(), F.lit(0).cast("long"))

    wider = WIDER**level
    return forest.select(
        place("d", band * wider).alias("x"),
        place("c", block * wider).alias("y"),
        place("pd", band * wider).alias("px"),
        place("pc", block * wider).alias("py"),
        *FOREST.names,
    )


def _upward(forest: DataFrame, every: bool) -> DataFrame:
    """Totals of every node inside its shard, or, by the node they go to, those that leave the shards."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            queue = SpillingQueue()
            for x, y, px, py, c, d, pc, pd, leaves, saved in _rows(batches):
                for more_leaves, more_saved in queue.take(-d, c):
                    leaves += more_leaves
                    saved += more_saved
                if pc is not None and (x, y) == (px, py):
                    queue.push(-pd, pc, leaves, saved)
                elif not every and pc is not None:
                    yield pc, pd, leaves, saved
                if every:
                    yield c, d, leaves, saved
            assert not queue

        return _sent(rows(), TOTALS)

    ordered = forest.repartition("x", "y").sortWithinPartitions("x", "y", F.desc("d"), "c")
    return ordered.mapInArrow(passed, _ddl(TOTALS))


def _downward(forest: DataFrame, ports: DataFrame) -> DataFrame:
    """``c, d, pc, pd`` of each node of ``ports``: the node to which the totals of its part of the shard go.

    Nodes are passed in level order. Each has two records, one where it stands and one where its
    parent does; there the parent's answer is sent on to it.
    """
    is_inner = (F.col("x") == F.col("px")) & (F.col("y") == F.col("py"))
    inner = F.coalesce(is_inner, F.lit(False))
    flagged = forest.join(ports.select("c", "d", F.lit(True).alias("is_port")), ["c", "d"], "left")
    nodes = flagged.select("x", "y", "d", "c", F.lit(0).alias("kind"), F.col("pd").alias("td"), F.col("pc").alias("tc"), inner.alias("inner"), F.coalesce("is_port", F.lit(False)).alias("is_port"))
    edges = forest.where(inner).select("x", "y", F.col("pd").alias("d"), F.col("pc").alias("c"), F.lit(1).alias("kind"), F.col("d").alias("td"), F.col("c").alias("tc"), F.lit(True), F.lit(False))
    schema = _longs("c", "d", "pc", "pd")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            queue, answer = SpillingQueue(), (0, -1)
            for _, _, d, c, kind, td, tc, inner, is_port in _rows(batches):
                if kind == 1:
                    queue.push(td, tc, *answer)
                    continue
                # A depth of -1 says that there is no node above.
                answer = next(queue.take(d, c)) if inner else (0, -1) if tc is None else (tc, td)
                if is_port:
                    yield (c, d, *((None, None) if answer[1] < 0 else answer))

        return _sent(rows(), schema)

    ordered = nodes.union(edges).repartition("x", "y").sortWithinPartitions("x", "y", "d", "c", "kind")
    return ordered.mapInArrow(passed, _ddl(schema))


def subtree_totals(forest: DataFrame, folder: str, block: int = BLOCK, band: int = BAND, level: int = 0) -> DataFrame:
    """``c, d, leaves, saved`` summed over the subtree of each node of ``c, d, pc, pd, leaves, saved``.

    A parent (``pc, pd``) has a smaller depth and no larger ``c``; the work is written below ``folder``.
    """
    spark = forest.sparkSession
    forest = _shards(forest, level, block, band)
    outside = forest.where("pc IS NOT NULL AND (x <> px OR y <> py)")
    if outside.isEmpty():
        return _upward(forest, every=True)
    path = f"{folder}/level-{level}"
    direct = _upward(forest, every=False).groupBy("c", "d").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    direct.write.parquet(f"{path}/direct")
    direct = spark.read.schema(_ddl(TOTALS)).parquet(f"{path}/direct")
    above = _downward(forest, direct).join(direct, ["c", "d"]).select(*FOREST.names)
    above.write.parquet(f"{path}/above")
    above = spark.read.schema(_ddl(FOREST)).parquet(f"{path}/above")
    subtree_totals(above, folder, block, band, level + 1).write.parquet(f"{path}/gained")
    gained = spark.read.schema(_ddl(TOTALS)).parquet(f"{path}/gained")
    more = gained.select("c", "d", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    names = ["x", "y", "px", "py", "c", "d", "pc", "pd"]
    added = [(F.col(n) + F.coalesce(m, F.lit(0))).alias(n) for n, m in (("leaves", "l"), ("saved", "s"))]
    return _upward(forest.join(more, ["c", "d"], "left").select(*names, *added), every=True)


# --- the trie --------------------------------------------------------------------------------------


def _ends(members: DataFrame, shared: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of nodes at which several conversations end.

    Ids are listed in the JVM in blocks of consecutive ids; the hash, which has to take the lists in
    order, passes over them as a stream.
    """
    schema = _longs("conv_id", "depth").append(pa.field("ends_sha256", pa.string()))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now = digest = None
            for conv_id, depth, ids in _rows(batches):
                if (conv_id, depth) != now:
                    if now is not None:
                        yield *now, digest.hexdigest()
                    now, digest = (conv_id, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            if now is not None:
                yield *now, digest.hexdigest()

        return _sent(rows(), schema)

    ends = members.where("is_end").select("depth", "a", "b", F.col("conv_id").alias("member"))
    met = ends.join(shared.select("depth", "a", "b", "conv_id"), ["depth", "a", "b"])
    listed = (
        met.groupBy("conv_id", "depth", F.expr(f"member div {LISTED}L").alias("block"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    )
    ordered = listed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "block").select("conv_id", "depth", "ids")
    return ordered.mapInArrow(hashed, _ddl(schema))


def prefix_trie(turns: DataFrame, rebuilt=rebuilt_from_family, block: int = BLOCK, band: int = BAND) -> DataFrame:
    """One row per node of the trie of rebuilt conversations of ``conv_id, turn, role, text``.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``; the pair of ``conv_id`` and ``depth`` is unique. ``rebuilt`` says from
    which conversation how many first turns (``MOST_TAKEN`` at most) replace the own ones.

    Turns go by ``turn``, nulls first, those of one turn by a SHA-256 of role and text; repeated rows
    are turns of their own. Null role or text is empty. Rows without ``conv_id`` belong to no
    conversation. A conversation left without turns ends at the root. An empty table has no root and
    gives no row. Other columns of any name are ignored.
    """
    spark = turns.sparkSession
    folder = fresh_folder(spark, "trie")
    members = _membership(turns.select("conv_id", "turn", "role", "text"), rebuilt, folder)
    members.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
        F.count_if("is_end").alias("n_ends"),
        F.max(F.when(F.col("is_end"), F.col("conv_id"))).alias("an_end"),
    ).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    above = (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")
    children = nodes.where("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        nodes.join(children, ["depth", "a", "b"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .join(parents, ["depth", "pa", "pb"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "chars", "n_ends", "an_end", "a", "b")
    )
    whole.write.parquet(f"{folder}/whole")
    whole = spark.read.parquet(f"{folder}/whole")
    forest = whole.select(
        F.col("conv_id").alias("c"),
        F.col("depth").alias("d"),
        F.col("parent_conv_id").alias("pc"),
        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("pd"),
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    totals = subtree_totals(forest, folder, block, band).select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")
    )
    several = _ends(members, whole.where("n_ends > 1"))
    # One end, or none: the hash of its id, or of nothing.
    alone = F.sha2(F.coalesce(F.col("an_end").cast("string"), F.lit("")), 256)
    return (
        whole.join(totals, ["conv_id", "depth"])
        .join(several, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", alone).alias("ends_sha256"),
        )
    )
