"""Language identification by partial matching: frozen context trees score exact code lengths.

Per language, counts of bytes after contexts of up to ``ORDER`` bytes form a context tree over all
256 byte values. A byte costs ``-log2`` of its probability in the longest context seen in training;
where it was never seen there, the tree pays for an escape and asks the next shorter context
(method C: a context with d different bytes in n gives d / (n + d) to the escape). A context never
seen escapes for nothing; a byte never seen costs eight bits after the last escape. Statistics stay
frozen while texts are scored. The language with the shortest code wins.

Trees are sparse: sorted arrays of the grams seen, a gram being a context and its byte in base 256.
A text's grams are looked up once each, however often they occur in a slice of texts.

A-Z are taken as small letters, and the start of a text counts as ``ORDER`` zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import id_residue, sole_holder

ORDER = 4
# The bound of the training sample: documents a language, on average, chosen by a hash of the id.
SAMPLE = 1_000
# Grams of ``ORDER`` bytes of context that a language keeps, the most frequent ones; about 3 MB a language.
LARGEST = 100_000
UNDECIDED = "und"
# Texts are scored in groups of so many bytes; a longer text is cut, each part with its context.
SLICE = 1 << 19
ROWS = 256
# A stage keeps a text that costs at most so many bits a byte more than the training texts of its
# language, plus so many bits once, for short texts.
EXCESS, ALLOWED = 4.0, 60.0


@dataclass(frozen=True)
class Level:
    """Grams with a context of one length, their bits, and the escapes of the contexts; all sorted."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


@dataclass(frozen=True)
class Tree:
    """A language: levels from the longest context to none, and its bits a byte in training."""

    lang: str
    levels: tuple[Level, ...]
    rate: float


Model = tuple[Tree, ...]


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def _grams(data: np.ndarray) -> np.ndarray:
    """Each byte after the first ``ORDER`` with the ``ORDER`` before it, the oldest first."""
    n = len(data) - ORDER
    grams = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        grams <<= 8
        grams |= data[i : i + n]
    return grams


def _level(grams: np.ndarray, n: np.ndarray) -> Level:
    contexts, first, kinds = np.unique(grams >> 8, return_index=True, return_counts=True)
    total = np.add.reduceat(n, first) if len(n) else np.zeros(0, np.int64)
    bits = np.log2(np.repeat(total + kinds, kinds)) - np.log2(n)
    return Level(grams, bits.astype(np.float32), contexts, (np.log2(total + kinds) - np.log2(kinds)).astype(np.float32))


def tree(lang: str, grams: np.ndarray, n: np.ndarray, largest: int = LARGEST) -> Tree:
    """The tree of distinct ``grams`` with their counts."""
    order = np.argsort(grams)
    grams, n = grams[order], n[order]
    levels = []
    for length in range(ORDER, -1, -1):
        own, at = np.unique(grams & ((1 << 8 * (length + 1)) - 1), return_inverse=True)
        levels.append((own, np.bincount(at, n, len(own)).astype(np.int64)))
    if len(grams) > largest:
        # Ties by the gram, so that the model is the same each time.
        kept = np.sort(np.lexsort((grams, -n))[:largest])
        levels[0] = grams[kept], n[kept]
    built = tuple(_level(*level) for level in levels)
    rate = float((_bits_of(grams, built) * n).sum() / max(1, n.sum()))
    return Tree(lang, built, rate)


def _bits_of(grams: np.ndarray, levels: tuple[Level, ...]) -> np.ndarray:
    """The cost of each gram."""
    bits = np.zeros(len(grams))
    left = np.arange(len(grams))
    for length, level in zip(range(ORDER, -1, -1), levels):
        own = grams[left] & ((1 << 8 * (length + 1)) - 1)
        at = np.minimum(np.searchsorted(level.grams, own), max(0, len(level.grams) - 1))
        seen = level.grams[at] == own if len(level.grams) else np.zeros(len(own), bool)
        bits[left[seen]] += level.bits[at[seen]]
        left, own = left[~seen], own[~seen] >> 8
        at = np.minimum(np.searchsorted(level.contexts, own), max(0, len(level.contexts) - 1))
        known = level.contexts[at] == own if len(level.contexts) else np.zeros(len(own), bool)
        bits[left[known]] += level.escapes[at[known]]
    bits[left] += 8.0
    return bits


def train(docs: DataFrame, sample: int = SAMPLE, largest: int = LARGEST) -> Model:
    """Learn from ``doc_id, text, lang`` of documents with a text and a language.

    A sample of about ``sample`` documents a language bounds the cost. Spark sums the counts and
    builds one tree a language; only trees of at most ``largest`` grams a level come to the driver.
    """
    docs = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    totals = docs.groupBy("lang").count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", F.xxhash64("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row per language; texts stay in place.
    chosen = docs.join(F.broadcast(totals), "lang").where(draw < F.lit(float(sample)) / F.col("count")).select("lang", "text")

    def grams_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                seen: dict[str, list] = {}
                for lang, text in zip(part["lang"].to_pylist(), part["text"]):
                    data = np.frombuffer(bytes(ORDER) + _bytes_of(text.as_py()), np.uint8)
                    seen.setdefault(lang, []).append(_grams(data))
                for lang, grams in seen.items():
                    gram, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()), "gram": gram, "n": n})

    def build(table: pa.Table) -> pa.Table:
        lang = table["lang"][0].as_py()
        built = tree(lang, table["gram"].to_numpy(), table["n"].to_numpy(), largest)
        parts = [a.tobytes() for level in built.levels for a in (level.grams, level.bits, level.contexts, level.escapes)]
        return pa.table({"lang": [lang], "parts": pa.array([parts], pa.list_(pa.binary())), "rate": [built.rate]})

    counted = chosen.mapInArrow(grams_seen, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counted.groupBy("lang").applyInArrow(build, "lang string, parts array<binary>, rate double").collect()
    types = (np.int64, np.float32, np.int64, np.float32)

    def loaded(parts: list[bytes]) -> tuple[Level, ...]:
        arrays = [np.frombuffer(p, types[i % 4]) for i, p in enumerate(parts)]
        return tuple(Level(*arrays[i : i + 4]) for i in range(0, len(arrays), 4))

    return tuple(Tree(r["lang"], loaded(r["parts"]), r["rate"]) for r in sorted(rows, key=lambda r: r["lang"]))


def _segments(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of ``(row, bytes)``, each with ``ORDER`` bytes of context, of about ``SLICE`` bytes."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        data = bytes(ORDER) + _bytes_of(text)
        for at in range(0, len(data) - ORDER, SLICE):
            rows.append(row)
            parts.append(data[at : at + SLICE + ORDER])
            size += len(parts[-1])
            if size >= SLICE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def code_lengths(texts: list[str | None], model: Model) -> np.ndarray:
    """Bits of each whole text in each language's code."""
    total = np.zeros((len(texts), len(model)))
    for rows, parts in _segments(texts):
        grams = np.concatenate([_grams(np.frombuffer(part, np.uint8)) for part in parts])
        grams, at = np.unique(grams, return_inverse=True)
        starts = np.cumsum([0] + [len(part) - ORDER for part in parts[:-1]])
        for i, own in enumerate(model):
            np.add.at(total[:, i], rows, np.add.reduceat(_bits_of(grams, own.levels)[at], starts))
    return total


def decide(texts: list[str | None], model: Model) -> list[tuple[str, float, float]]:
    """Per text: the language, its share of 2 ** -bits among all languages, and the bits beyond what a
    text of this length costs in training; ``und``, 0 and 0 where there is no letter."""
    bits = code_lengths(texts, model)
    out = []
    for text, own in zip(texts, bits):
        if not len(own) or not any(map(str.isalpha, text or "")):
            out.append((UNDECIDED, 0.0, 0.0))
            continue
        best = int(own.argmin())
        share = float(1.0 / np.exp2(np.maximum(own[best] - own, -1000.0)).sum())
        out.append((model[best].lang, share, float(own[best]) - model[best].rate * len(_bytes_of(text))))
    return out


def _judged(docs: DataFrame, model: Model, schema: str, made) -> DataFrame:
    """``made(part, verdicts)`` of few rows at a time; ``docs`` has a column ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_holder("langid")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield made(part, decide(part["text"].to_pylist(), sent.value))

    return docs.mapInArrow(judge, schema)


def held_out(modulus: int = 4, residue: int = 2) -> Column:
    return id_residue("doc_id", modulus) == residue


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row; the statistics come from the others.

    Rows without text or language teach nothing; without any teacher, and for a text that is null
    or has no letter, the prediction is ``und`` with score 0. A null id counts as empty text.
    """

    def verdict(part: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        pred, score = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
        return pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pred, score], ["doc_id", "held_out", "lang_pred", "score"])

    model = train(docs.where(~held_out()), sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return _judged(rows, model, "doc_id long, held_out boolean, lang_pred string, score double", verdict)


def is_language(text: str | None, score: float, excess: float, least: float) -> bool:
    """Whether a verdict keeps a text: decided, and no dearer than text of its language can be."""
    return score >= max(least, 1e-9) and excess <= EXCESS * len(_bytes_of(text)) + ALLOWED


def with_language(docs: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without texts of undecided language, with a score under ``least``, or of a code so long
    (``EXCESS`` bits a byte above the language's own) that they are in no language learnt; all columns stay."""
    columns = docs.columns

    def kept(part: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        keep = [is_language(t, f[1], f[2], least) for t, f in zip(part["text"].to_pylist(), found)]
        return part.filter(pa.array(keep, pa.bool_()))

    model = train(docs.where(~held_out()), sample)
    return _judged(docs, model, docs.schema, kept).select(*columns)
