"""Splitting rules for lines and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII white space class of the word pattern, and the line separator.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[ \t\n\x0B\f\r]+"
LINE_END = "\n"


def _split(text: Column, trailing: str, pattern: str) -> Column:
    # Trailing empty pieces are dropped, a leading one is kept, "" gives [""], all separators give [].
    trimmed = F.rtrim(text, F.lit(trailing))
    return F.when((trimmed == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, pattern)
    )


def split_words(text: Column) -> Column:
    """Words of a text: case-sensitive, cut at runs of white space."""
    return _split(text, BLANKS, BLANK_RUN)


def split_lines(text: Column) -> Column:
    """Lines of a text, cut at each line feed; a lone carriage return stays in its line."""
    return _split(text, LINE_END, LINE_END)


def collapse_blanks(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, BLANK_RUN, " ")
