"""Random-looking keys that depend on a row's id and a seed only.

``rand()`` follows the partition layout, so a lost executor or another number of
files gives other rows. These keys give the same rows on every layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS_PER_OCTAVE = 16
_PREFIX_DIGITS = 15  # 60 bits
# Number of values that ``size_bucket`` can take.
SIZE_BUCKETS = 60 * STEPS_PER_OCTAVE + 1


def order_key(row_id: Column, seed: int = 42) -> Column:
    """A hex text whose order shuffles the rows."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def leading_number(key: Column, digits: int) -> Column:
    """The number that the first hex digits of a key write."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def percent_bucket(key: Column) -> Column:
    """An even spread over 0..99."""
    return (leading_number(key, 8) % 100).cast("int")


def size_bucket(key: Column) -> Column:
    """A monotone function of the key with steps on a logarithmic scale.

    Of N rows, the bucket that holds the n-th smallest key holds about n/16 rows
    whatever N is. A count per bucket therefore tells which few rows can be among
    the n smallest, from one narrow aggregate.
    """
    octaves = F.log2(leading_number(key, _PREFIX_DIGITS).cast("double") + 1)
    return F.floor(octaves * STEPS_PER_OCTAVE).cast("int")
