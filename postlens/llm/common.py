"""Column helpers that several operators share."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, the only one that separates words or is stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` is faster and the same where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def id_residue(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


# Which operator keeps something in this Python worker, and how to drop it.
_HOLDER: list = ["", None]


def sole_holder(name: str, drop: Callable[[], None] | None = None) -> None:
    """Say that ``name`` runs in this Python worker; what another operator has kept in it goes.

    Workers serve one stage after the other, so that what each remembers would add up.
    """
    if _HOLDER[0] != name:
        if _HOLDER[1] is not None:
            _HOLDER[1]()
        _HOLDER[:] = name, drop
        free_memory()


def free_memory() -> None:
    """Give freed memory of this process back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library
