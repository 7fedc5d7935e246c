"""Packing of token pieces into sequences: first-fit decreasing inside randomised groups.

A document's ids are cut into full sequences and one rest. Pieces are dealt to groups at random,
by a hash, and each group is packed for itself: longest piece first, into the first sequence with
room, which a tournament tree over the free room finds in logarithmic time. The texts are read
once and only the pieces' sizes are shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlens.llm.common import free_memory, sole_holder
from postlens.llm.words import words
from postlens.session import fresh_folder

SEQUENCE = 2048
END_ID = 1
# Pieces in a group, on average; a group is packed by one task.
GROUP = 2048
# Words whose ids a Python worker remembers, and the longest such word in bytes: about 25 MB.
KNOWN_WORDS = 150_000
KNOWN_BYTES = 64
# Hashes of words by which a worker tells that it met a word before, until its memory is full.
MET = 1 << 22
# Bytes of texts whose words stand in memory at once; a word is encoded once for all of them.
TEXT_BYTES = 2 << 20

# Signs, without the apostrophe, which may begin a piece of its own with letters, and the signs of
# special tokens; letters of U+00C0 to U+017F and ASCII, without one that is two in lower case.
_SIGNS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")
# Bytes above 127 as the tokenizer writes them, where that is not the character of the same number.
_WRITTEN = {byte: 162 + byte for byte in range(128, 161)} | {173: 323}

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordTokens:
    """Ids of whole texts from a tokenizer in which no token spans white space.

    Each word is encoded by itself. Words that come again in later calls are remembered, up to
    ``KNOWN_WORDS``: most words come once and would take the room of others. The ids are those of
    ``encode(text)``, as unsigned 32-bit numbers, little-endian as on every platform Spark runs on.
    """

    def __init__(self, path: str):
        # A task has one core; the tokenizer's own threads would only take others' cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.met = bytearray(MET)

    def packed(self, texts: list[str | None]) -> Iterator[bytes]:
        """Packed ids of each text, with the end id."""
        known = self.known
        split = [list(words(text, lower=False)) for text in texts]
        new = set().union(*chain.from_iterable(split)).difference(known)
        self._learn(new)
        end = array("I", [END_ID]).tobytes()
        found = [b"".join(map(known.__getitem__, chain.from_iterable(parts))) + end for parts in split]
        # Before the first text is given out: callers need not ask for more than the texts they gave.
        room, kept = KNOWN_WORDS - (len(known) - len(new)), []
        if room > 0:
            marks = [hash(word) % MET for word in new]
            kept = [w for w, mark in zip(new, marks) if self.met[mark] and len(w) <= KNOWN_BYTES][:room]
            for mark in marks:
                self.met[mark] = 1
        for word in new.difference(kept):
            del known[word]
        yield from found

    def _learn(self, new: set[bytes]) -> None:
        """Encode words. Letters are one piece to the tokenizer, and so are ASCII signs.

        Its model alone, without normalising and cutting, gives their ids in half the time.
        """
        known, tokenize, coded, rest = self.known, self.tokenizer.model.tokenize, {}, []
        # Lists side by side: a tuple a word would keep the garbage collector busy.
        plain, own, signed, stems, signs = [], [], [], [], []
        for word in new:
            letters = word.rstrip(_SIGNS)
            if letters.isalpha():
                low = letters.lower()
            elif _LETTERS.fullmatch(letters):
                low = letters.decode().lower().encode()
            else:
                rest.append(word)
                continue
            # Words that differ in capitals or signs only share the ids of their letters.
            if (ids := coded.get(low)) is None:
                if (ids := known.get(low)) is None:
                    written = low.decode() if low.isascii() else low.decode("latin-1").translate(_WRITTEN)
                    ids = array("I", [t.id for t in tokenize(written)]).tobytes()
                coded[low] = ids
            if len(letters) == len(word):
                plain.append(word)
                own.append(ids)
            else:
                signed.append(word)
                stems.append(ids)
                signs.append(word[len(letters) :])
        distinct = [*set(signs)]
        done = [
            array("I", c.ids).tobytes()
            for c in self.tokenizer.encode_batch_fast([w.decode() for w in rest + distinct], add_special_tokens=False)
        ]
        ends = dict(zip(distinct, done[len(rest) :]))
        known.update(zip(plain, own))
        known.update(zip(signed, map(bytes.__add__, stems, map(ends.__getitem__, signs))))
        known.update(zip(rest, done))


@cache
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def cut(doc_id: int | None, packed: bytes, size: int) -> list[tuple]:
    """Full sequences and a rest, each with the crc32 of its ids."""
    total = len(packed) // 4
    return [
        (doc_id, at, min(size, total - at), zlib.crc32(packed[4 * at : 4 * (at + size)]), total)
        for at in range(0, total, size)
    ]


def by_bytes(batch: pa.RecordBatch, name: str, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in column ``name`` hold ``most`` bytes at most, or one row."""
    start = size = 0
    for at, n in enumerate(pc.binary_length(batch[name]).fill_null(0).to_pylist()):
        if size + n > most and at > start:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += n
    if batch.num_rows:
        yield batch.slice(start)


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """The pieces of each row of ``doc_id, text``; a null text holds the end id only."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_holder("packing", _tokens.cache_clear)
        tokens = _tokens(tokenizer)
        for batch in batches:
            free_memory()
            for part in by_bytes(batch, "text", TEXT_BYTES):
                ids = tokens.packed(part["text"].to_pylist())
                rows = [piece for doc_id, own in zip(part["doc_id"].to_pylist(), ids) for piece in cut(doc_id, own, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows)], schema=schema
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tokenize, PIECES)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size: the first with room. ``tree[1]`` is the winner, the most free room."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - leaves)
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins


def pack(parts: DataFrame, groups: int, size: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces; groups are packed apart and share no sequence."""

    def fill(table: pa.Table) -> pa.Table:
        order = sorted(
            table.to_pylist(),
            key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"]),
        )
        used: dict[int, int] = {}
        for row, place in zip(order, first_fit([r["length"] for r in order], size)):
            row["sequence_id"] = (row.pop("_group") << 32) + place
            row["offset"] = used.get(place, 0)
            used[place] = row["offset"] + row["length"]
        return pa.table({n: pa.array([r[n] for r in order], pa.int64()) for n in (*columns, "sequence_id", "offset")})

    columns = parts.columns
    dealt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(groups)).alias("_group")
    return (
        parts.select("*", dealt)
        .groupBy("_group")
        .applyInArrow(fill, f"{PIECES}, sequence_id long, offset long")
    )


def packed(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Pack all rows of ``doc_id, text`` into sequences of at most ``size`` ids.

    Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Null ids and
    repeated rows are packed like any other row; an empty table gives no piece.
    """
    path = f"{fresh_folder(docs.sparkSession, 'packing')}/pieces"
    pieces(docs, tokenizer, size).write.parquet(path)
    parts = docs.sparkSession.read.schema(PIECES).parquet(path)
    return pack(parts, max(1, round(parts.count() / group)), size)
