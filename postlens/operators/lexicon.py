"""Token rewriting by a dictionary table of any size.

The Column forms in ``functions.text`` inline small dictionaries; this is the way for
dictionaries that are tables: lemmas, stop words, slang.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators.skew import salted_join


def rewrite_tokens(texts: DataFrame, key: str, text: str, table: DataFrame) -> DataFrame:
    """Rewrite every space-separated token of ``text`` that ``table`` lists.

    ``table`` has one row per ``token`` with its ``replacement``; a null replacement drops the
    token. ``key`` identifies a row of ``texts``. The result has ``key`` and ``text``.
    """
    listed = table.select("token", "replacement", F.lit(True).alias("listed"))
    tokens = texts.select(key, F.posexplode_outer(F.split(text, " ")).alias("pos", "token"))
    joined = salted_join(tokens, listed, "token", spread=key)
    rewritten = F.when(F.col("listed"), F.col("replacement")).otherwise(F.col("token"))
    # One group holds the tokens of one row only; they are gathered before the shuffle.
    ordered = F.array_sort(F.collect_list(F.struct("pos", rewritten.alias("token"))))
    return (
        joined.groupBy(key)
        .agg(F.max("pos").alias("last"), ordered.alias("parts"))
        .select(
            key,
            F.when(F.col("last").isNotNull(), F.array_join(F.col("parts.token"), " ")).alias(text),
        )
    )
