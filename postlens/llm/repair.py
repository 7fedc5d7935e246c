"""Conversation structure repair: the cheapest edits to turns that alternate, found by an auction.

After ``i`` rows of a conversation the roles written so far end in one of four ways: nothing yet, a
system turn, a user turn, an assistant turn. Rows and endings span a lattice; each edit is an arc with
a whole-number cost, and repairs are the paths from the first node to the end.

The auction keeps a price per node, never above an arc's cost plus the price at its head, and one
path. Where the last node's price is below the least such sum, the price rises to it and the path
gets shorter; else the path extends along an arc that attains it. When the path reaches the end,
prices along it are exact distances. Origins are taken block by block from the end of the
conversation, with the same prices: the exact ones behind a block are its ends, and it starts from
the least of them, so prices rise by the cost of a few rows only and the work grows with the length.

All cheapest paths consist of tight arcs, those whose cost is the fall of the price. The ones that
lead to the end are followed from the start, least initial first.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import BLANKS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Faults of a row, in the order in which they count.
SOUND, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
# The four endings, and the ending and role that a further user or assistant turn gives.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
# Rows of a block between two sets of origins.
BLOCK = 4
ROWS = 256

Edit = tuple[str, int, int, int]


def _kept(initial: str, ending: int) -> int | None:
    """The ending after a row that keeps its role, if it may."""
    if initial == "s":
        return SYSTEM if ending == START else None
    if initial == "u":
        return USER if ending != USER else None
    return ASSISTANT if initial == "a" and ending == USER else None


@cache
def _moves(initial: str | None, fault: int, ending: int) -> tuple[Edit, ...]:
    """``(initial of the edit, cost, rows taken, ending)`` by initial; no row is left where it is null."""
    moves = [("I", INSERT, 0, NEXT[ending])]
    if initial is not None:
        moves.insert(0, ("D", DELETE, 1, ending))
        if fault not in (IS_BLANK, IS_DUPLICATE):
            extra = TRUNCATED if fault == IS_TRUNCATED else 0
            kept = _kept(initial, ending)
            if kept is not None:
                moves.append(("K", KEEP + extra, 1, kept))
            moves.append(("R", REROLE + extra, 1, NEXT[ending]))
    return tuple(moves)


def _arcs(i: int, ending: int, initials: str, faults: bytes) -> tuple[Edit, ...]:
    if i == len(faults):
        return _moves(None, SOUND, ending)
    initial = initials[i]
    return _moves(initial if initial in "sua" else " ", faults[i], ending)


def _is_end(i: int, ending: int, n: int) -> bool:
    return i == n and ending in (START, ASSISTANT)


def prices(initials: str, faults: bytes) -> array:
    """A price per node ``4 * row + ending``; exact where a block starts and along the cheapest paths."""
    n = len(faults)
    price = array("q", bytes(32 * (n + 1)))
    for block in range(n - n % BLOCK, -1, -BLOCK):
        behind = block + BLOCK
        if behind <= n:
            least = min(price[4 * behind : 4 * behind + 4])
            for node in range(4 * block, 4 * behind):
                price[node] = least
        for ending in (START, SYSTEM, USER, ASSISTANT):
            _auction(block, ending, behind, initials, faults, price)
    return price


def _auction(row: int, ending: int, behind: int, initials: str, faults: bytes, price: array) -> None:
    """Extend and contract one path until it leads from the origin to the end, or to the next block,
    where all prices are exact."""
    n = len(faults)
    path = [(row, ending)]
    while True:
        i, s = path[-1]
        if i == behind or _is_end(i, s, n):
            return
        best, at, to = min([(cost + price[4 * (i + d) + t], i + d, t) for _, cost, d, t in _arcs(i, s, initials, faults)])
        if price[4 * i + s] < best:
            price[4 * i + s] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append((at, to))


def cheapest(initials: str, faults: bytes) -> tuple[int, str]:
    """The least cost and, of the edits at that cost, the initials that come first in ASCII order."""
    n = len(faults)
    price = prices(initials, faults)

    def tight(i: int, s: int) -> Iterator[Edit]:
        return (arc for arc in _arcs(i, s, initials, faults) if arc[1] + price[4 * (i + arc[2]) + arc[3]] == price[4 * i + s])

    # A bit per ending that leads to the end over tight arcs; inserted turns stay in the row.
    leads = bytearray(n + 1)
    for i in range(n, -1, -1):
        for _ in range(3):
            for s in (START, SYSTEM, USER, ASSISTANT):
                if _is_end(i, s, n) and price[4 * i + s] == 0 or any(leads[i + d] >> t & 1 for _, _, d, t in tight(i, s)):
                    leads[i] |= 1 << s
    i, s, audit = 0, START, []
    while not (_is_end(i, s, n) and price[4 * i + s] == 0):
        edit, _, taken, s = next(arc for arc in tight(i, s) if leads[i + arc[2]] >> arc[3] & 1)
        i += taken
        audit.append(edit)
    return price[START], "".join(audit)


class _Conversation:
    """One conversation on its way: first the codes of all its rows, then their texts."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.turns = [None, None, 0]  # least, largest, how many
        self.illegal = 0
        self.solved: tuple[int, str] | None = None
        self.at, self.ending = 0, START
        self.digest, self.written = hashlib.sha256(), False

    def code(self, turn: int | None, initial: str, faults: list[int]) -> None:
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        for fault in faults:
            if self.initials and self.initials[-1] + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.initials.append(initial)
            self.faults.append(fault)

    def _write(self, role: str, text: str) -> None:
        if self.written:
            self.digest.update(b"\n")
        self.written = True
        self.digest.update(f"{role}:".encode("utf-8", "replace"))
        self.digest.update(text.encode("utf-8", "replace"))

    def _inserts(self) -> None:
        while self.solved[1][self.at : self.at + 1] == "I":
            self._write(ROLE[self.ending], "")
            self.ending = NEXT[self.ending]
            self.at += 1

    def solve(self) -> None:
        if self.solved is None:
            self.initials = "".join(c or " " for c in self.initials)
            self.solved = cheapest(self.initials, self.faults)

    def text(self, role: str, text: str) -> None:
        self.solve()
        self._inserts()
        edit = self.solved[1][self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text)
            self.ending = _kept(role[:1], self.ending)
        elif edit == "R":
            self._write(ROLE[self.ending], text)
            self.ending = NEXT[self.ending]

    def result(self) -> tuple:
        self.solve()
        self._inserts()
        least, most, distinct = self.turns
        counts = [self.faults.count(fault) for fault in (IS_BLANK, IS_DUPLICATE, IS_TRUNCATED)]
        gaps = 0 if least is None else most - least + 1 - distinct
        return (self.conv_id, gaps, *counts, self.illegal, *self.solved, self.digest.hexdigest())


RESULT = pa.schema(
    [(name, pa.int64()) for name in "conv_id gaps blank duplicate truncated illegal cost".split()]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
RESULT_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows by conversation, kind and turn: ids, then codes, then texts."""
    now: _Conversation | None = None
    done: list[tuple] = []

    def sent() -> pa.RecordBatch:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*done), RESULT)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=RESULT)

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for row in zip(*(column.to_pylist() for column in part.columns)):
                conv_id, kind, turn, role, _, fault, copies, text = row
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv_id)
                if kind == 1:
                    # Copies of a row beside it repeat it, whatever it is, unless it is blank.
                    again = fault if fault == IS_BLANK else IS_DUPLICATE
                    now.code(turn, role[:1], [fault] + [again] * (copies - 1))
                elif kind == 2:
                    now.text(role, text)
            if len(done) >= ROWS:
                yield sent()
    if now is not None:
        done.append(now.result())
    if done:
        yield sent()


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id, turn, role, text``), and per id of ``ids``.

    ``gaps, blank, duplicate, truncated, illegal`` count faults, ``cost`` and ``audit`` are the
    cheapest edits, ``repaired_sha256`` hashes the repaired turns. Null roles and texts count as one
    space. Rows go by turn, nulls first, those of one turn by role and SHA-256 of the text. A null
    ``conv_id`` is a conversation of its own. A conversation without rows, as ``ids`` may name, has
    zeros, an empty audit and the hash of nothing; an empty table gives no row. Other columns of any
    name are ignored.

    Texts are shuffled once and pass as a stream; of a conversation only a few bytes a row stand in
    memory, as the audit holds a letter a row anyway. Rows that repeat are counted before the shuffle.
    """
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(end == "", IS_BLANK).when(end.isin(".", "!", "?"), SOUND).otherwise(IS_TRUNCATED)
    codes = (
        rows.select("conv_id", "turn", "role", "digest", fault.alias("fault"))
        .groupBy("conv_id", "turn", "role", "digest", "fault")
        .agg(F.count("*").alias("copies"))
    )
    # The first turn is null where one is.
    first = codes.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first")
    )
    named = [F.col(name).alias(f"_{name}") for name in ("conv_id", "role", "digest")]
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    seen = (F.col("fault") != IS_BLANK) & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    coded = codes.join(first.select(*named, "first"), same).withColumn("fault", F.when(seen, IS_DUPLICATE).otherwise(F.col("fault")))

    def record(frame: DataFrame, kind: int, *given: str) -> DataFrame:
        types = {"turn": "long", "role": "string", "digest": "binary", "fault": "int", "copies": "long", "text": "string"}
        columns = [(F.col(n) if n in given else F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        return frame.select("conv_id", F.lit(kind).alias("kind"), *columns)

    named_ids = (rows if ids is None else ids).select(F.col("conv_id").cast("long")).distinct()
    records = (
        record(named_ids, 0)
        .union(record(coded, 1, "turn", "role", "digest", "fault", "copies"))
        .union(record(rows, 2, "turn", "role", "digest", "text"))
    )
    ordered = records.repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.mapInArrow(_solved, RESULT_DDL)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` as a faulty export: by crc32 of ``conv_id:turn`` rows are dropped, emptied, stripped of
    their full stops, repeated, or given to the user. Nulls count as one space, in that key too."""
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    key = F.concat_ws(":", *(F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv_id", "turn")))
    kind: Column = F.crc32(key.cast("binary")) % 20
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )
