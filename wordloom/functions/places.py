"""The place of a line in a corpus, (doc_id, line_no), as one number of the same order.

A minimum over a number keeps its state in a hash map; over a struct Spark would sort all words first. The word's
position in its line goes with the minimum (min_by), which a hash map holds as well.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 2**62


def place(doc_id: Column, line_no: Column) -> Column:
    """doc_id * 2^62 + line_no: 38 digits hold any doc_id with any number of lines that a file can have."""
    fits = (line_no >= 0) & (line_no < STEP)
    line = F.when(fits, line_no).otherwise(F.raise_error(F.lit("line number beyond 2^62")).cast("bigint"))
    step = F.lit(Decimal(STEP)).cast("decimal(19,0)")
    return (doc_id.cast("decimal(20,0)") * step + line.cast("decimal(19,0)")).cast("decimal(38,0)")


def parts(number: Column) -> tuple[Column, Column]:
    """doc_id and line_no of a place."""
    step = F.lit(Decimal(STEP)).cast("decimal(38,0)")
    line = F.pmod(number, step)
    return F.call_function("div", number - line, step), line.cast("bigint")
