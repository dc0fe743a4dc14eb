"""Random draws that depend only on a key, so every partitioning gives the same numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967297.0


def digest(seed: int, *parts: Column) -> Column:
    """md5, as hex digits, of the key seed:part:part..."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash32(digest_col: Column, at: int) -> Column:
    """32-bit integer from eight hex digits of a digest, starting at digit `at` (1-based)."""
    return F.conv(F.substring(digest_col, at, 8), 16, 10).cast("bigint")


def hash60(digest_col: Column, at: int) -> Column:
    """60-bit integer from fifteen hex digits of a digest: even when taken modulo large numbers."""
    return F.conv(F.substring(digest_col, at, 15), 16, 10).cast("bigint")


def uniform(digest_col: Column, at: int) -> Column:
    """Uniform draw in (0, 1)."""
    return (hash32(digest_col, at) + F.lit(1)) / F.lit(TWO_32)


def gauss(digest_col: Column) -> Column:
    """Standard normal draw by Box and Muller."""
    return F.sqrt(F.lit(-2.0) * F.log(uniform(digest_col, 1))) * F.cos(
        F.lit(2.0 * math.pi) * uniform(digest_col, 9)
    )
