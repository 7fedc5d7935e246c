"""Sinks reached through a connector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_external(rows: DataFrame, format: str, options: Mapping[str, str]) -> None:
    rows.write.format(format).options(**options).mode("append").save()


def append_jdbc(rows: DataFrame, options: Mapping[str, str], table: str) -> None:
    append_external(rows, "jdbc", {**options, "dbtable": table})
