"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact similarity.

A window of as many shingles as an item slides over each document. Windows and items get a
fingerprint of their shingles; fingerprints within ``RADIUS`` bits agree in one of
``RADIUS + 1`` blocks at least, so tables by block value find them all. Each pair found is then
compared exactly: the sum of the smaller counts of their shingles over the sum of the larger ones.

A window at the threshold shares that part of its shingles with the item, so windows with fewer
shingles known from items of their length are passed over before they are fingerprinted; no pair
is lost by it.

A text of fewer shingles than an item is one window itself, if it can reach the threshold. Such a
text is compared with every item that holds enough of its shingles, without fingerprints.

Words are runs of letters and digits, in small letters, so punctuation and case hide no passage.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
SIMILARITY = 0.8
# Similarity 0.8 turns 9.6 of 64 bits on average, with a deviation of 2.9; 24 is five deviations off.
RADIUS = 24
# Items are compared in blocks of at most so many characters (or one item); each is sent to all tasks.
BLOCK_CHARS = 4_000_000
# Words whose hash a worker remembers.
KNOWN_WORDS = 100_000
# A document is read in stretches of about so many characters.
STRETCH = 1 << 20

_WORD = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"\s")
_FACTORS = np.array([xxhash.xxh64_intdigest(b"factor %d" % i) | 1 for i in range(SHINGLE)], np.uint64)
FOUND = "doc_id long, item_id long, similarity double, start long, n_words long"


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


_hash_of = _WordHash()


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One well-mixed number per run of ``size`` words."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out += hashes[i : i + n] * _FACTORS[i]
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(29)
    return out


def _print_of(ones: np.ndarray, total: int) -> np.ndarray:
    """Fingerprints from counts of set bits, one row of 64 per fingerprint."""
    return np.packbits(2 * ones > total, axis=-1, bitorder="little").view("<u8").ravel()


def _bits(shingles: np.ndarray) -> np.ndarray:
    return np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted and not empty."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class _Blocks:
    """Fingerprints by the value of each block; finds all within ``radius`` bits of another."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        edges = np.linspace(0, 64, min(radius + 1, 64) + 1).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        self.tables = []
        for shift, mask in self.blocks:
            table: dict[int, list[int]] = defaultdict(list)
            for i, value in enumerate(((prints >> shift) & mask).tolist()):
                table[value].append(i)
            self.tables.append({v: np.array(ids) for v, ids in table.items()})

    def near(self, fingerprint: np.uint64) -> np.ndarray:
        met = np.zeros(len(self.prints), bool)
        for (shift, mask), table in zip(self.blocks, self.tables):
            ids = table.get(int((fingerprint >> shift) & mask))
            if ids is not None:
                met[ids] = True
        ids = np.flatnonzero(met)
        return ids[np.bitwise_count(self.prints[ids] ^ fingerprint) <= self.radius]


class Items:
    """Index of one block of items, by the size of their shingles and the number of them."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity = similarity
        self.by_length: dict[tuple[int, int], tuple[list[int], list[Counter], _Blocks, np.ndarray]] = {}
        self.holders: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        groups = defaultdict(list)
        for item_id, text in items:
            hashes = _hashes(_words(text))
            if len(hashes):
                size = min(SHINGLE, len(hashes))
                groups[size, len(hashes) - size + 1].append((item_id, _shingles(hashes, size)))
        for key, members in groups.items():
            prints = np.concatenate([_print_of(_bits(s).sum(0, dtype=np.int64), len(s)) for _, s in members])
            self.by_length[key] = (
                [i for i, _ in members],
                [Counter(s.tolist()) for _, s in members],
                _Blocks(prints, radius),
                np.unique(np.concatenate([s for _, s in members])),
            )
            flat = np.concatenate([s for _, s in members])
            order = np.argsort(flat)
            self.holders[key] = flat[order], np.repeat(np.arange(len(members), dtype=np.int32), key[1])[order]
        self.longest = max((size + n - 1 for size, n in self.by_length), default=0)
        self.known = {
            size: np.unique(np.concatenate([s for (z, _), ms in groups.items() if z == size for _, s in ms]))
            for size in {size for size, _ in groups}
        }
        self.sieve = {}
        for size, known in self.known.items():
            self.sieve[size] = np.zeros(1 << 20, bool)
            self.sieve[size][known & np.uint64((1 << 20) - 1)] = True

    def _is_known(self, shingles: np.ndarray, size: int) -> np.ndarray:
        maybe = np.flatnonzero(self.sieve[size][shingles & np.uint64((1 << 20) - 1)])
        out = np.zeros(len(shingles), bool)
        out[maybe] = _is_in(shingles[maybe], self.known[size])
        return out

    def search(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Per item at the threshold: its best similarity, first such window and words of it."""
        best: dict[int, tuple[float, int, int]] = {}
        for start, words, whole in self._stretches(text):
            hashes = _hashes(words)
            for size in self.known:
                shingles = _shingles(hashes, size)
                known = self._is_known(shingles, size)
                if known.any():
                    self._search(shingles, known, size, start, best)
                    if whole:
                        self._compare_whole(shingles, known, size, best)
        return best

    def _stretches(self, text: str | None) -> Iterator[tuple[int, list[str], bool]]:
        """``(number of the first word, words, whether they are all of the text)``; a stretch overlaps the last by one window less a word."""
        text = text or ""
        at, first, tail = 0, 0, []
        while at < len(text) and self.longest:
            blank = _BLANK.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = blank.start() if blank else len(text)
            words = tail + _words(text[at:end])
            yield first, words, not first and end == len(text)
            tail = words[len(words) - min(len(words), self.longest - 1) :]
            first += len(words) - len(tail)
            at = end

    def _search(self, shingles: np.ndarray, known: np.ndarray, size: int, first: int, best: dict) -> None:
        places = np.flatnonzero(known)
        for (z, n), (ids, counts, blocks, own_known) in self.by_length.items():
            least = math.ceil(self.similarity * n - 1e-9)
            if z != size or len(shingles) < n or len(places) < least:
                continue
            mine = places[_is_in(shingles[places], own_known)]
            if len(mine) < least:
                continue
            sums = np.zeros(len(shingles) + 1, np.int64)
            sums[mine + 1] = 1
            sums = np.cumsum(sums)
            starts = np.flatnonzero(sums[n:] - sums[:-n] >= least)
            for start in starts.tolist():
                window = shingles[start : start + n]
                fingerprint = _print_of(_bits(window).sum(0, dtype=np.int64), n)[0]
                own = None
                for i in blocks.near(fingerprint).tolist():
                    own = own or Counter(window.tolist())
                    shared = sum((own & counts[i]).values())
                    similarity = shared / (2 * n - shared)
                    if similarity >= self.similarity and similarity > best.get(ids[i], (0.0, 0, 0))[0]:
                        best[ids[i]] = (similarity, first + start, n + size - 1)

    def _compare_whole(self, shingles: np.ndarray, known: np.ndarray, size: int, best: dict) -> None:
        """Compare a whole text with the items that have more shingles than it."""
        m, own = len(shingles), Counter(shingles.tolist())
        found, values = int(known.sum()), np.fromiter(own, np.uint64, len(own))
        for (z, n), (ids, counts, _, _) in self.by_length.items():
            least = math.ceil(self.similarity * n - 1e-9)
            if z != size or m >= n or found < least:
                continue
            held, holder = self.holders[z, n]
            from_, to = np.searchsorted(held, values, "left"), np.searchsorted(held, values, "right")
            met = np.concatenate([holder[a:b] for a, b in zip(from_, to)])
            for i in np.flatnonzero(np.bincount(met, minlength=len(ids)) >= least).tolist():
                shared = sum((own & counts[i]).values())
                similarity = shared / (m + n - shared)
                if similarity >= self.similarity and similarity > best.get(ids[i], (0.0, 0, 0))[0]:
                    best[ids[i]] = (similarity, 0, m + size - 1)


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items of ``item_id, text`` in blocks of about ``chars`` characters, one block at a time."""
    block, size = [], 0
    for row in benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").toLocalIterator():
        if block and size + len(row.text) > chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    if block:
        yield block


def _index(spark, block: list[tuple[int, str]], similarity: float, radius: int):
    """The block's index as a broadcast that each worker builds once from the items' texts."""
    sent = spark.sparkContext.broadcast(block)
    built: dict[str, Items] = {}

    def get() -> Items:
        if "items" not in built:
            built["items"] = Items(sent.value, similarity, radius)
        return built["items"]

    return get


def _searcher(index: Callable[[], Items]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, item, *hit)
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"])
                for item, hit in index().search(text.as_py()).items()
            ]
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            names = ["doc_id", "item_id", "similarity", "start", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return search


def _leaks(index: Callable[[], Items]):
    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(index().search(t)) for t in texts], dtype=bool)

    return leaks


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per row of ``doc_id, text`` and item that a window of it reaches ``similarity`` with.

    ``doc_id, item_id, similarity, start, n_words``: of the best window, the first of equals, with
    the number of its first word and its length in words. A text of fewer shingles than an item is
    the one window for it. Items of fewer than five words are one
    shingle of all their words. Null texts, items without words and rows without ``item_id`` match
    nothing; null and repeated ids of documents stay as they are.
    """
    found = docs.sparkSession.createDataFrame([], FOUND)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for block in item_blocks(benchmark, chars):
        index = _index(docs.sparkSession, block, similarity, radius)
        found = found.union(ids.mapInArrow(_searcher(index), FOUND))
    return found


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, chars: int = BLOCK_CHARS
) -> DataFrame:
    """``docs`` without the rows whose text reaches ``similarity`` with any item; all columns stay."""
    for block in item_blocks(benchmark, chars):
        index = _index(docs.sparkSession, block, similarity, radius)
        docs = docs.where(~_leaks(index)(F.col("text")))
    return docs
