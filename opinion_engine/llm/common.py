"""What several operators share: learning splits and schemas."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % modulus


def is_held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept out of learning. A row without an id is: nothing is learned from it."""
    return F.coalesce(id_remainder(id_column, modulus) == remainder, F.lit(True))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def trim() -> None:
    """Give memory that a task has freed back to the system; the worker lives on and serves other stages."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if give_back is not None:
        give_back(0)
