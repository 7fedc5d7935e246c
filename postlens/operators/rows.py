"""Row filters, samples and per-stage counters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import is_retweet


def drop_retweets(posts: DataFrame, text: str = "text") -> DataFrame:
    """A post without text is no retweet and stays."""
    return posts.where(~F.coalesce(is_retweet(F.col(text)), F.lit(False)))


def hash_sample(rows: DataFrame, key: str, fraction: float) -> DataFrame:
    """A fixed sample: the same keys in every run, and larger fractions contain smaller ones."""
    buckets = 1_000_000
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return rows.where(F.pmod(digest, F.lit(buckets)) < round(fraction * buckets))


def count_stages(rows: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """One pass over ``rows``: how many satisfy each named condition, one row per name."""
    if not stages:
        raise ValueError("no counter was named")
    counts = rows.agg(*[F.count_if(met).alias(name) for name, met in stages.items()])
    return counts.unpivot([], list(stages), "counter", "n")
