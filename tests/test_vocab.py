import pytest
from pyspark.sql import functions as F

from wordloom.config import Limits
from wordloom.operators import corpus, vocab
from wordloom.sources.text import lines_in_memory

# Nothing is broadcast whole; a key with a quarter of the rows is hot.
TIGHT = Limits(broadcast_rows=0, broadcast_bytes=0, hot_keys=4)


def ids_of(table):
    return {r["word"]: r["id"] for r in table.collect()}


def encode_texts(spark, table, texts, limits=None):
    rows = vocab.encode(lines_in_memory(spark, texts), table, limits).collect()
    return [r["ids"] for r in sorted(rows, key=lambda r: r["line_no"])]


def decode_ids(spark, table, ids, limits=None):
    rows = spark.createDataFrame(list(enumerate(ids)), "key bigint, ids array<bigint>")
    return [r["text"] for r in sorted(vocab.decode(rows, table, ["key"], limits).collect())]


@pytest.fixture(scope="module")
def fit(spark):
    return lambda *texts: vocab.fit_vocab(lines_in_memory(spark, list(texts)))


def test_round_trip(spark, fit):
    table = fit("rain falls", "falls rain", "on slate roofs")
    ids = encode_texts(spark, table, ["slate falls"])
    assert len(set(ids[0])) == 2
    assert decode_ids(spark, table, ids) == ["slate falls"]


def test_unknown_word_is_zero(spark, fit):
    table = fit("rain falls")
    assert encode_texts(spark, table, ["rain sleet", "sleet"]) == [[0, 0], [0]]
    row = vocab.encode(lines_in_memory(spark, ["rain sleet"]), table).first()
    assert row["oov_count"] == 1
    flags = [r["is_oov"] for r in vocab.encode_tokens(lines_in_memory(spark, ["rain sleet"]), table).orderBy("pos").collect()]
    assert flags == [False, True]


@pytest.mark.parametrize("limits", [None, TIGHT])
@pytest.mark.parametrize("second", ["c d", ""])
def test_lines_that_share_a_key_are_refused(spark, limits, second):
    lines = spark.createDataFrame([(1, 0, "a b"), (1, 0, second)], "doc_id bigint, line_no bigint, line string")
    table = vocab.fit_vocab(lines)
    with pytest.raises(Exception, match="share a key"):
        vocab.encode(lines, table, limits).collect()


def test_empty_corpus(spark, fit):
    table = fit()
    assert table.count() == 0
    assert encode_texts(spark, table, [""]) == [[0]]
    assert decode_ids(spark, table, [[0]]) == [""]


def test_single_word_and_empty_decode(spark, fit):
    assert encode_texts(spark, fit("slate"), ["slate"]) == [[0]]
    assert decode_ids(spark, fit("rain falls"), [[]]) == [""]


def test_case_is_kept(spark, fit):
    assert set(ids_of(fit("Rain rain"))) == {"Rain", "rain"}
    assert encode_texts(spark, fit("Rain Falls"), ["Rain Falls", "Rain Falls", "rain"]) == [[0, 1], [0, 1], [0]]


def test_first_seen_order(fit):
    assert ids_of(fit("oak elm", "elm oak ash", "fir ash oak")) == {"oak": 0, "elm": 1, "ash": 2, "fir": 3}


def test_blank_lines_and_blank_starts(spark, fit):
    table = fit(" a", "", "   ", "a b")
    assert ids_of(table) == {"": 0, "a": 1, "b": 2}
    assert encode_texts(spark, table, [" a", "", "   ", "a b"]) == [[0, 1], [0], [], [1, 2]]


def test_ids_over_many_partitions(spark):
    texts = [f"w{n} w{n + 1} common" for n in range(500)]
    lines = lines_in_memory(spark, texts).repartition(7)
    seen = list(dict.fromkeys(word for text in texts for word in text.split()))
    assert ids_of(vocab.fit_vocab(lines)) == {word: at for at, word in enumerate(seen)}


def test_extend_keeps_ids(spark, fit):
    table = fit("a b")
    more = vocab.extend_vocab(table, lines_in_memory(spark, ["c b d", "a e"]))
    assert ids_of(more) == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4}
    assert ids_of(vocab.extend_vocab(fit(), lines_in_memory(spark, ["x"]))) == {"x": 0}
    assert vocab.vocab_size(more) == 5


def test_unknown_ids_decode_to_empty_words(spark, fit):
    assert decode_ids(spark, fit("a b"), [[0, 9, 1, -1]]) == ["a  b "]


@pytest.mark.parametrize("long", [10, 1000])
def test_lookup_beyond_broadcast_equals_broadcast(spark, long):
    """A third of the words are one known word, a third one unknown word, some words are very long."""
    texts = ["the " * 10 + "zzz " * 10 + f"w{n} w{n % 3} " + "x" * long for n in range(60)] + ["", "  "]
    lines = lines_in_memory(spark, texts)
    table = vocab.fit_vocab(lines).where(F.col("word") != "zzz")
    small = sorted(vocab.encode(lines, table).collect())
    large = sorted(vocab.encode(lines, table, TIGHT).collect())
    assert small == large and len(small) == len(texts)
    encoded = vocab.encode(lines, table).select("line_no", "ids")
    assert sorted(vocab.decode(encoded, table, ["line_no"]).collect()) == sorted(
        vocab.decode(encoded, table, ["line_no"], TIGHT).collect()
    )


def test_no_exchange_after_lines_are_placed(spark):
    """With a broadcast vocabulary, encoding shuffles the raw lines and nothing else."""
    lines = lines_in_memory(spark, ["a b"])
    plan = vocab.encode(lines, vocab.fit_vocab(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_beyond_broadcast_only_cold_words_are_shuffled_again(spark):
    lines = lines_in_memory(spark, ["a b"])
    # Spark sees that these tables are small, and would broadcast them by itself.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = vocab.encode(lines, vocab.fit_vocab(lines), TIGHT)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The lines (for both parts), the cold words and their table, and the words found, by line.
    assert plan.count("Exchange hashpartitioning(doc_id") - plan.count("ReusedExchange") <= 3
    assert plan.count("Exchange hashpartitioning(word") == 2


def test_stats_and_distinct_words(spark):
    lines = lines_in_memory(spark, ["a b a", "", "  ", "b c"])
    assert corpus.corpus_stats(lines).first().asDict() == {"lines": 4, "words": 6}
    found = {r["word"]: (r["line_no"], r["pos"], r["n"]) for r in corpus.distinct_words(lines).collect()}
    assert found == {"a": (0, 0, 2), "b": (0, 1, 2), "": (1, 0, 1), "c": (3, 1, 1)}
    counted = corpus.partition_count(lines.repartition(3, "line_no")).first()
    assert counted["rows"] == 4 and 1 <= counted["partitions"] <= 3


def test_split_does_not_depend_on_partitions(spark):
    lines = lines_in_memory(spark, [str(n) for n in range(2000)])
    one = {r["line_no"] for r in corpus.split_train(lines.coalesce(1)).where("is_train").collect()}
    many = {r["line_no"] for r in corpus.split_train(lines.repartition(9)).where("is_train").collect()}
    assert one == many and 0.76 < len(one) / 2000 < 0.84


def test_weighted_split_keeps_documents_together(spark):
    from wordloom.operators.corpus import split_weighted

    lines = spark.range(3000).selectExpr("id div 3 as doc_id", "id % 3 as line_no", "'a' as line")
    found = split_weighted(lines, [5, 3, 0, 2]).groupBy("doc_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in found)
    shares = [sum(r["a"] == p for r in found) / len(found) for p in range(4)]
    assert shares[2] == 0 and all(abs(s - w) < 0.05 for s, w in zip(shares, [0.5, 0.3, 0, 0.2]))
    single = split_weighted(lines, [1, 1], by_document=False)
    assert single.groupBy("doc_id").agg(F.count_distinct("part").alias("n")).where("n > 1").count() > 500
    assert sorted(single.repartition(7).collect()) == sorted(single.collect())
    with pytest.raises(ValueError):
        split_weighted(lines, [1, -1])


@pytest.mark.parametrize("blocks", [2, 1 << 11])
def test_extension_beyond_broadcast(spark, blocks):
    """Words that a filter surely does not know skip the join; the result is the same."""
    known = vocab.fit_vocab(lines_in_memory(spark, [" ".join(f"k{i}" for i in range(500))]))
    more = lines_in_memory(spark, [" ".join(f"k{i} n{i} m{i}" for i in range(0, 900, 3)), "k1 é", ""])
    limits = Limits(broadcast_rows=2 * blocks, broadcast_bytes=0)
    want = sorted(map(tuple, vocab.extend_vocab(known, more).collect()))
    assert sorted(map(tuple, vocab.extend_vocab(known, more, limits).collect())) == want
    sure, rest = vocab.split_known(more.select(F.explode(F.split("line", " ")).alias("word")).distinct(), known, limits)
    new = {w for w, i in want if i >= 500}
    sure, rest = ({r["word"] for r in part.collect()} for part in (sure, rest))
    assert sure <= new and not sure & rest and {f"k{i}" for i in range(0, 500, 3)} <= rest
    # With few blocks the filter knows everything, with many it spares most new words the shuffle.
    assert len(sure) > 0.7 * len(new) if blocks > 2 else not sure
    again = vocab.known_words(known.where("id < 250"), blocks).union(vocab.known_words(known.where("id >= 250"), blocks))
    merged = again.groupBy("_block").agg(F.bit_or("_bits").alias("_bits"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, vocab.known_words(known, blocks).collect()))


def test_pieces_beyond_broadcast_send_each_word_once(spark, fit, monkeypatch):
    """A word that stands a thousand times is looked up once for each piece; null lines and ids are kept."""
    asked = []
    monkeypatch.setattr(vocab, "saved", lambda df: asked.append(df.cache()) or asked[-1])
    table = fit("the rain", "falls")
    lines = spark.createDataFrame(
        [(n, 0, "the " * 50 + "zzz falls") for n in range(20)] + [(20, 0, None), (21, 0, " the")], "doc_id bigint, line_no bigint, line string"
    )
    want = sorted(vocab.encode(lines, table).collect(), key=lambda r: r["doc_id"])
    assert not asked
    found = sorted(vocab.encode(lines.coalesce(1), table, TIGHT).collect(), key=lambda r: r["doc_id"])
    assert found == want and found[20]["ids"] == [] and found[0]["oov_count"] == 1
    assert asked[0].where("word = 'the'").count() <= 4  # a piece for each of four partitions
    monkeypatch.setattr(vocab, "PIECE_BYTES", 1)
    assert sorted(vocab.encode(lines, table, TIGHT).collect(), key=lambda r: r["doc_id"]) == want
    assert decode_ids(spark, table, [[0, None, 2], None, [], [7]], TIGHT) == ["the  falls", "", "", ""]
    assert decode_ids(spark, table, [[0, None, 2], None, [], [7]]) == ["the  falls", "", "", ""]


def test_pieces_span_arrow_batches(spark):
    """A piece is bounded by its bytes, not by the rows of an Arrow batch: fewer words are looked up twice."""
    lines = lines_in_memory(spark, ["a b c a"] * 50 + [""])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        one = vocab._pieces(lines, ["doc_id", "line_no"], "line", lambda x: vocab.cut_words(x, vocab.BLANKS), "word")
        parts = one.select("_piece").distinct().count()
        assert parts <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert one.where("word is not null").count() <= 4 * parts
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_first_places_are_those_of_the_splitting_rule():
    import pyarrow as pa

    from wordloom.operators.arrow import first_places

    texts = ["", " b a", None, "a  c b", "\t", "c d d "]
    word, line, pos = first_places(pa.array(texts, pa.string()), vocab.BLANKS)
    assert list(zip(word.to_pylist(), line.tolist(), pos.tolist())) == [("", 0, 0), ("b", 1, 1), ("a", 1, 2), ("c", 3, 1), ("d", 5, 1)]
    assert [len(x) for x in first_places(pa.array([], pa.string()), vocab.BLANKS)] == [0, 0, 0]


def test_first_places_do_not_depend_on_the_order_of_rows(spark):
    lines = lines_in_memory(spark, ["x y", "y z x", "w x", "z v"])
    want = sorted(vocab.fit_vocab(lines).collect())
    assert sorted(vocab.fit_vocab(lines.orderBy(F.desc("line_no")).coalesce(1)).collect()) == want
    plan = vocab._first_seen(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "SortAggregate" not in plan


def test_pieces_move_keys_and_not_lines(spark, fit, monkeypatch):
    """Beyond broadcast the raw lines are cut where they are read: what is written comes straight from them."""
    plans = []
    keep = vocab.saved
    monkeypatch.setattr(vocab, "saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    lines = lines_in_memory(spark, ["the rain", "falls the"])
    vocab.encode(lines, fit("the rain"), TIGHT)
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Sort" not in plans[0]
