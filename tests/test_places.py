import pytest
from pyspark.sql import functions as F

from wordloom.functions.places import parts, place

SCHEMA = "d bigint, l bigint"


def test_order_and_round_trip(spark):
    docs = [-(2**63), -(2**63) + 1, -5, -1, 0, 1, 7, 2**63 - 1]
    rows = sorted((d, l) for d in docs for l in (0, 1, 2**31, 2**62 - 1))
    table = spark.createDataFrame(rows, SCHEMA).withColumn("n", place(F.col("d"), F.col("l")))
    d, l = parts(F.col("n"))
    found = table.orderBy("n").select(d.alias("d"), l.alias("l"), "n").collect()
    assert [tuple(r)[:2] for r in found] == rows
    assert len({r["n"] for r in found}) == len(rows)


def test_lines_beyond_the_range_are_refused(spark):
    table = spark.createDataFrame([(0, 2**62)], SCHEMA)
    with pytest.raises(Exception, match="line number"):
        table.select(place(F.col("d"), F.col("l"))).collect()


def test_vocabulary_of_lines_past_two_to_the_31(spark):
    from wordloom.operators.corpus import distinct_words
    from wordloom.operators.vocab import fit_vocab

    lines = spark.createDataFrame(
        [(0, 2**31 + 5, "late b late"), (0, 2**31 + 4, "b early"), (1, 0, "later")], "doc_id bigint, line_no bigint, line string"
    )
    assert {r["word"]: r["id"] for r in fit_vocab(lines).collect()} == {"b": 0, "early": 1, "late": 2, "later": 3}
    found = {r["word"]: (r["doc_id"], r["line_no"], r["pos"], r["n"]) for r in distinct_words(lines).collect()}
    assert found["late"] == (0, 2**31 + 5, 0, 2) and found["b"] == (0, 2**31 + 4, 0, 2)


def test_first_places_need_no_sort(spark):
    """The minimum is taken in a hash map, before and after the exchange."""
    from wordloom.operators.corpus import distinct_words
    from wordloom.sources.text import lines_in_memory

    plan = distinct_words(lines_in_memory(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_words_of_a_line_cost_no_square(spark):
    """No lambda or sorted array stands in a filter of the plan, and a line of 20,000 words takes no second."""
    import time

    from wordloom.operators.corpus import distinct_words
    from wordloom.sources.text import lines_in_memory

    long = " ".join(f"w{i % 9000}" for i in range(20_000))
    lines = lines_in_memory(spark, [long, "w1 w2"])
    distinct_words(lines).count()
    started = time.monotonic()
    found = distinct_words(lines)
    assert found.count() == 9000
    assert time.monotonic() - started < 3  # the jobs alone take most of it here
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "lambda" not in plan


def test_first_words_equal_the_splitting_rule(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from wordloom.functions.text import BLANKS, split_words
    from wordloom.operators.arrow import first_words

    texts = ["", " ", "a", " a b a ", "b\t\na\x0b\x0c\rb", " a  ", None, "  \n", "a  a", "é é é", "\x1ca\x1c b"]
    word, line, pos, n = first_words(pa.array(texts, pa.string()), BLANKS)
    got = sorted(zip(line.tolist(), pos.tolist(), word.to_pylist(), n.tolist(), strict=True))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", split_words(F.col("t")).alias("w")).collect()
    want = [
        (r["i"], r["w"].index(w), w, r["w"].count(w)) for r in rows for w in dict.fromkeys(r["w"] or [])
    ]
    assert got == sorted(want)
