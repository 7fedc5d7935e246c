"""Rewriting of phrases by a dictionary table of any size: leftmost, longest match over segments.

A phrase is known by the hashes of its segments, 128 bits. A text is cut into segments, and wherever
a phrase may start, the windows of as many segments as phrases have are hashed where the text stands.
Windows leave it as five numbers and meet the phrases in one join. Frequent segments that start no
phrase, spaces above all, are known by their counts and start no window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import WORD
from postlens.operators.skew import HOT_SHARE
from postlens.session import fresh_folder

# Ways to cut a text; joined again, the segments are the text.
Segments = Callable[[Column], Column]


def by_spaces(text: Column) -> Column:
    """Tokens, and each space between them."""
    return F.regexp_extract_all(text, F.lit("[^ ]+| "), 0)


def by_words(text: Column) -> Column:
    """Words with their apostrophes, and what stands between words."""
    return F.regexp_extract_all(text, F.lit(rf"[{WORD}'’]+|[^{WORD}'’]+"), 0)


def by_symbols(text: Column) -> Column:
    """Every character that is no letter or blank by itself."""
    return F.regexp_extract_all(text, F.lit(r"(?s)[\p{L}\p{Z}\p{Cc}]+|."), 0)


def same(segment: Column) -> Column:
    return segment


# Frequent segments that are tested in the plan.
MAX_USELESS = 5_000


def _hashed(value: Column, *names: str) -> list[Column]:
    """128 bits of a value, as two columns."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def phrase_keys(table: DataFrame, segments: Segments = by_spaces, normal: Segments = same) -> DataFrame:
    """``h1, h2, length, first, replacement`` of the phrases in ``phrase, replacement``.

    Of equal phrases the one with the greatest replacement counts; null, which drops the phrase, only
    stands alone. Empty phrases are left out.
    """
    tokens = F.transform(segments(F.col("phrase")), normal)
    return (
        table.select(tokens.alias("tokens"), "replacement")
        .where(F.size("tokens") > 0)
        .select(*_hashed(F.col("tokens"), "h1", "h2"), F.size("tokens").alias("length"), F.col("tokens")[0].alias("first"), "replacement")
        .groupBy("h1", "h2", "length", "first")
        .agg(F.max("replacement").alias("replacement"))
    )


def rewrite_phrases(
    rows: DataFrame,
    text: str,
    table: DataFrame,
    segments: Segments = by_spaces,
    normal: Segments = same,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Rewrite the phrases of ``table`` (``phrase, replacement``) in the column ``text`` of ``rows``.

    Matches are taken from the left, the longest first, and do not overlap; a null replacement drops
    the phrase. ``normal`` is applied to segments where they are compared. All rows and columns stay,
    null texts too; equal texts, however many, are matched once. Rows are read once and stored.
    """
    if rows.isStreaming:
        raise ValueError("a dictionary table is joined per batch: see streaming.enrich.run_enrichment")
    spark, folder = rows.sparkSession, fresh_folder(rows.sparkSession, "phrases")
    phrase_keys(table, segments, normal).write.parquet(f"{folder}/phrases")
    known = spark.read.parquet(f"{folder}/phrases")
    # Settled once: what made the rows, an earlier dictionary maybe, would be done again at each reading.
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    lengths = sorted(row.length for row in known.select("length").distinct().collect())
    if not lengths:
        return rows

    texts = rows.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    found = _windows(texts, known, lengths, segments, normal, hot_share, folder).join(known.drop("first"), ["h1", "h2"])
    # At one place the longest comes first.
    match = F.struct("pos", (-F.col("length")).alias("order"), "length", "replacement")
    matches = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(match)).alias("matches"))
    start = F.struct(F.lit(0).alias("end"), F.slice("matches", 1, 0).alias("out"))

    def choose(chosen: Column, match: Column) -> Column:
        end = (match["pos"] + match["length"]).alias("end")
        taken = F.struct(end, F.concat(chosen["out"], F.array(match)).alias("out"))
        return F.when(match["pos"] >= chosen["end"], taken).otherwise(chosen)

    edits = matches.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.aggregate("matches", start, choose)["out"].alias("_edits"))
    k1, k2 = _hashed(F.col(text), "_k1", "_k2")
    keyed = rows.withColumns({"_k1": F.when(F.col(text).isNotNull(), k1), "_k2": k2})
    cut = keyed.join(edits, ["_k1", "_k2"], "left").withColumn("_cut", F.when(F.col("_edits").isNotNull(), segments(F.col(text))))
    rewritten = F.when(F.col("_edits").isNotNull(), _spliced(F.col("_cut"), F.col("_edits"))).otherwise(F.col(text))
    return cut.withColumn(text, rewritten).select(*rows.columns)


def _windows(texts, known, lengths, segments, normal, hot_share, folder) -> DataFrame:
    """``k1, k2, pos, h1, h2``: by text, the windows of the phrases' lengths where a phrase may start."""
    spark = texts.sparkSession
    cut = F.transform(segments(F.col("text")), normal)

    # Frequent segments, a number bounded by the share, are told from the others by their counts.
    tokens = texts.select(F.explode(cut).alias("token"))
    tokens.groupBy("token").agg(F.count("*").alias("n")).write.parquet(f"{folder}/tokens")
    seen = spark.read.parquet(f"{folder}/tokens")
    total = seen.agg(F.sum("n")).scalar()
    hot = seen.where(F.col("n") >= total * F.lit(hot_share)).orderBy(F.desc("n"), "token").limit(MAX_USELESS)
    firsts = known.select(F.col("first").alias("token")).distinct()
    useless = [row.token for row in hot.join(firsts, "token", "left_anti").collect()]

    # Copies of a text are matched once. Its segments stay where they are: only numbers leave the task.
    own = texts.distinct().select(*_hashed(F.col("text"), "k1", "k2"), cut.alias("cut"))
    starts = own.select("k1", "k2", "cut", F.posexplode("cut").alias("pos", "token")).where(~F.col("token").isin(useless))
    windows = starts.select("k1", "k2", "cut", "pos", F.explode(F.array(*map(F.lit, lengths))).alias("size"))
    window = F.slice("cut", F.col("pos") + 1, F.col("size"))
    return windows.where(F.col("pos") + F.col("size") <= F.size("cut")).select("k1", "k2", "pos", *_hashed(window, "h1", "h2"))


def _spliced(cut: Column, edits: Column) -> Column:
    """The segments with the chosen phrases replaced, as one text."""

    def end(i: Column) -> Column:
        before = F.get(edits, i - 1)
        return F.coalesce(before["pos"] + before["length"], F.lit(0))

    def piece(edit: Column, i: Column) -> Column:
        kept = F.slice(cut, end(i) + 1, edit["pos"] - end(i))
        return F.concat(F.array_join(kept, ""), F.coalesce(edit["replacement"], F.lit("")))

    n = F.size(edits)
    tail = F.slice(cut, end(n) + 1, F.greatest(F.size(cut) - end(n), F.lit(0)))
    return F.concat(F.array_join(F.transform(edits, piece), ""), F.array_join(tail, ""))
