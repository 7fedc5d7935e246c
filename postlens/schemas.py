"""Declared schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_TAGS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

# The payload of one post as JSON text, as far as it is read.
POST = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("place", T.StructType([T.StructField("country_code", T.StringType())])),
        T.StructField("entities", T.StructType([T.StructField("hashtags", _TAGS)])),
        T.StructField(
            "coordinates",
            T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))]),
        ),
        T.StructField(
            "retweeted_status",
            T.StructType(
                [
                    T.StructField(
                        "extended_tweet",
                        T.StructType(
                            [
                                T.StructField(
                                    "entities", T.StructType([T.StructField("hashtags", _TAGS)])
                                ),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)

# Text that did not parse lands here when the schema names it.
CORRUPT = "_corrupt_record"
POST_OR_CORRUPT = T.StructType(POST.fields + [T.StructField(CORRUPT, T.StringType())])

# Lake of raw posts; the last three columns are partitions.
LAKE = T.StructType(
    [
        T.StructField(
            "tweetInfo",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("text", T.StringType()),
                    T.StructField("created_at", T.TimestampNTZType()),
                ]
            ),
        ),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("created_at", T.DateType()),
    ]
)
LAKE_PARTITIONS = ["category", "brand", "created_at"]

# Raw data set extracted from the lake.
RAW_DATASET = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("created_at", T.DateType()),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("blood_group", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)
PROFILE_PARTITIONS = ["sex", "blood_group", "created_at"]

# Brand catalog: one row per brand, in catalog order.
CATALOG = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("name", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField(
            "platforms",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("hashtags", T.ArrayType(T.StringType())),
                        T.StructField("handle", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Run ledger: one row per status change of a run.
LEDGER = T.StructType(
    [
        T.StructField("run_started_at", T.TimestampNTZType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_end_at", T.TimestampNTZType()),
        T.StructField("run_status", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("source_query_param", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("sink", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)
