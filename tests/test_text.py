import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions.text import collapse_blanks, split_lines, split_words

BLANK = re.compile(r"[ \t\n\x0b\f\r]+")


def words_by_rule(text):
    """The splitting rule stated once more, in Python."""
    if text == "":
        return [""]
    pieces = BLANK.split(text)
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


def lines_by_rule(text):
    if text == "":
        return [""]
    pieces = text.split("\n")
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


def apply(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expression(F.col("t")).alias("r"))
    return [r["r"] for r in sorted(rows.collect())]


CASES = [
    ("", [""]),
    ("   ", []),
    (" a b ", ["", "a", "b"]),
    ("a\tb\n", ["a", "b"]),
    ("a\u000bb", ["a", "b"]),
    ("a\u00a0b", ["a\u00a0b"]),
    ("a \u2028", ["a", "\u2028"]),
    ("a\u0085", ["a\u0085"]),
    ("a  b\r\n c", ["a", "b", "c"]),
    ("x", ["x"]),
]


def test_word_rules(spark):
    texts = [text for text, _ in CASES]
    assert apply(spark, texts, split_words) == [want for _, want in CASES]
    assert [words_by_rule(t) for t in texts] == [want for _, want in CASES]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\f\rab\u00a0\u2028\u0085", max_size=12), min_size=300, max_size=300))
def test_words_and_lines_of_any_text(spark, texts):
    assert apply(spark, texts, split_words) == [words_by_rule(t) for t in texts]
    assert apply(spark, texts, split_lines) == [lines_by_rule(t) for t in texts]


@pytest.mark.parametrize(
    "text, want", [("a\n\nb\rc\n\n\n", ["a", "", "b\rc"]), ("\n\n", []), ("", [""]), ("\na", ["", "a"])]
)
def test_line_rules(spark, text, want):
    assert apply(spark, [text], split_lines) == [want]


def test_collapse_blanks(spark):
    assert apply(spark, ["a  b\t\nc", "  a "], collapse_blanks) == ["a b c", " a "]
