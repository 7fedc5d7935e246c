"""Equi-joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
# A key is hot when it holds at least this share of all rows, so at most 1 / share keys are hot.
HOT_SHARE = 1e-4


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    spread: str,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` to a smaller ``lookup`` on one key of any distribution.

    Rows of one key are spread over ``salts`` tasks by the hash of ``spread``; the lookup is
    repeated once per salt. No hint is given: Spark broadcasts the lookup when its size allows.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    repeated = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")


def weighted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    weight: str,
    value: str,
    spread: str,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add ``value`` to ``facts`` from a lookup about as large, which knows its rows per key.

    ``lookup[weight]`` is the number of ``facts`` rows of each key. The few keys with a share of
    at least ``hot_share`` are broadcast, a number bounded by ``1 / hot_share``; all others have
    no hot key and meet the lookup in a plain shuffle. Rows already served pass that shuffle
    under keys that match nothing, one for each value of ``spread``. ``facts`` appears once, so it
    is computed once.
    """
    total = lookup.select(F.sum(weight).alias("total")).scalar()
    is_hot = F.col(weight) >= total * F.lit(hot_share)
    hot = lookup.where(is_hot).select(on, F.col(value).alias("_hot"), F.lit(True).alias("_served"))
    # Always 0, but no literal: the optimizer would make a filter of it and join on the key alone.
    zero = F.pmod(F.col(weight).cast("long"), F.lit(1)).cast("long").alias("_salt")
    cold = lookup.where(~is_hot).select(on, zero, value)
    salt = F.when(F.col("_served"), F.xxhash64(spread)).otherwise(0)
    joined = (
        facts.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", salt.cast("long"))
        .join(cold, [on, "_salt"], "left")
    )
    return joined.withColumn(
        value, F.when(F.col("_served"), F.col("_hot")).otherwise(F.col(value))
    ).drop("_salt", "_hot", "_served")
