"""Run parameters as JSON text: ``{start_dt, end_dt, brand, category}``; nulls are left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.dates import format_iso, parse_iso


def to_params(start: Column, end: Column, brand: Column, category: Column | None = None) -> Column:
    return F.to_json(
        F.struct(
            format_iso(start).alias("start_dt"),
            format_iso(end).alias("end_dt"),
            brand.alias("brand"),
            (F.lit(None).cast("string") if category is None else category).alias("category"),
        )
    )


def param(params: Column, name: str) -> Column:
    return F.get_json_object(params, f"$.{name}")


def start_of(params: Column) -> Column:
    return parse_iso(param(params, "start_dt"))


def end_of(params: Column) -> Column:
    return parse_iso(param(params, "end_dt"))
