"""Vocabulary: fit, extend, encode, decode."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from wordloom.config import Limits
from wordloom.functions.places import place
from wordloom.functions.text import BLANKS, split_words
from wordloom.operators.arrow import coded, cut_words, first_places, gathered, split_lists
from wordloom.sources.session import dense_ids, saved

# Bytes of text, or of ids, whose distinct values are looked up together.
PIECE_BYTES = 8 << 20
# Bytes of text of which a distinct word is one row before Spark counts.
FIRST_BYTES = 8 << 20
SHARED = "lines share a key"


def _first_seen(lines: DataFrame) -> DataFrame:
    # A slice of lines in corpus order sends each of its words once, with the place where it is seen first.
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "line", FIRST_BYTES):
            part = part.sort_by("first")
            word, line, pos = first_places(part.column("line"), BLANKS)
            columns = [word, part.column("first").take(pa.array(line)), pa.array(pos, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "first", "at"])

    placed = lines.select(place(F.col("doc_id"), F.col("line_no")).alias("first"), "line")
    words = placed.mapInArrow(work, "word string, first decimal(38,0), at int")
    return words.groupBy("word").agg(F.min("first").alias("first"), F.min_by("at", "first").alias("at"))


def fit_vocab(lines: DataFrame) -> DataFrame:
    """word, id: ids 0, 1, 2... in order of first occurrence."""
    return dense_ids(_first_seen(lines), ["first", "at"], "id").select("word", "id")


def _slots(word: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a word and its two bits in the block's 64."""
    h = F.xxhash64(word)
    bit = lambda at: F.shiftright(h, at).bitwiseAND(F.lit(63)).cast("int")
    mask = F.expr("1L")
    first, second = (F.call_function("shiftleft", mask, bit(at)) for at in (52, 58))
    return h.bitwiseAND(F.lit(blocks - 1)), first.bitwiseOR(second)


def known_words(vocab: DataFrame, blocks: int) -> DataFrame:
    """_block and _bits: a Bloom filter of the words, whose parts merge by `or`: a row for each of `blocks` at most."""
    block, mask = _slots(F.col("word"), blocks)
    return vocab.select(block.alias("_block"), mask.alias("_mask")).groupBy("_block").agg(F.bit_or("_mask").alias("_bits"))


def split_known(words: DataFrame, vocab: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """(words that are surely not in vocab, the others), told apart by a filter that is broadcast.

    The filter's size is half the broadcast limit of rows, whatever the vocabulary's. A vocabulary of some ten words for each
    block or more leaves it little to tell: then more words are among the others.
    """
    blocks = 1 << (max(limits.broadcast_rows // 2, 1).bit_length() - 1)
    block, mask = _slots(F.col("word"), blocks)
    marked = words.withColumn("_block", block).join(F.broadcast(known_words(vocab, blocks)), "_block", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    return marked.where(~maybe).select(*words.columns), marked.where(maybe).select(*words.columns)


def extend_vocab(vocab: DataFrame, lines: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Keeps all ids of vocab and appends the new words of lines, in order of first occurrence.

    A vocabulary beyond broadcast is compared by a shuffle join, to which only words go that a filter may know.
    """
    limits = limits or Limits()
    found = _first_seen(lines)
    if fits_broadcast(vocab, "word", limits):
        fresh = found.join(F.broadcast(vocab.select("word")), "word", "left_anti")
    else:
        fresh, rest = split_known(found, vocab, limits)
        fresh = fresh.unionByName(rest.join(vocab.select("word"), "word", "left_anti"))
    top = vocab.agg(F.max("id")).first()[0]
    added = dense_ids(fresh, ["first", "at"], "id", start=0 if top is None else top + 1)
    return vocab.select("word", "id").unionByName(added.select("word", "id"))


def vocab_size(vocab: DataFrame) -> int:
    return vocab.count()


def fits_broadcast(table: DataFrame, key: str, limits: Limits, value_bytes: int = 8) -> bool:
    """Whether a lookup table is within the broadcast limits, by counting it."""
    size = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 24 + value_bytes), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= limits.broadcast_rows and size["bytes"] <= limits.broadcast_bytes


def _probe(key: Column, limits: Limits) -> Column:
    # Join value of bounded length: long keys are replaced by a digest, told apart by the first letter.
    text = key.cast("string")
    return F.when(F.octet_length(text) <= limits.hot_key_bytes, F.concat(F.lit("="), text)).otherwise(
        F.concat(F.lit("#"), F.sha2(text, 256))
    )


def lookup_parts(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    limits: Limits | None = None,
    value_bytes: int = 8,
) -> list[DataFrame]:
    """rows left join table(key, value) in one or two parts, for a table of any size and frequent keys.

    A small table is broadcast after its size is counted: one part, still partitioned as rows.
    Otherwise the distinct keys of rows are counted (partial counts before the shuffle) and joined to
    the table, one row per key on both sides. The hot keys among them are few by construction and are
    broadcast: the first part, still partitioned as rows. The other keys, each with less than
    1/hot_keys of the rows, take a shuffle join: the second part.
    """
    limits = limits or Limits()
    table = table.select(key, value)
    value_limit = limits.hot_key_bytes
    if fits_broadcast(table, key, limits, value_bytes):
        return [rows.join(F.broadcast(table), key, "left")]

    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = saved(counted.join(table, key, "left"))
    total = known.agg(F.sum("_n")).first()[0] or 0
    # A hot key is broadcast with its value, so both are bounded in bytes.
    short = F.coalesce(F.octet_length(F.col(value).cast("string")), F.lit(0)) <= value_limit
    is_hot = (F.col("_n") * F.lit(limits.hot_keys) >= F.lit(total)) & short
    hot = known.where(is_hot).select(
        _probe(F.col(key), limits).alias("_probe"), F.col(value), F.lit(True).alias("_hot")
    )
    probed = rows.withColumn("_probe", _probe(F.col(key), limits)).join(F.broadcast(hot), "_probe", "left")
    done = probed.where(F.col("_hot") | F.col(key).isNull()).drop("_probe", "_hot")
    rest = probed.where(F.col("_hot").isNull() & F.col(key).isNotNull()).drop("_probe", "_hot", value)
    cold = known.where(~is_hot).select(key, value)
    return [done, rest.join(cold, key, "left")]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    limits: Limits | None = None,
    value_bytes: int = 8,
) -> DataFrame:
    """rows left join table(key, value): see lookup_parts."""
    first, *others = lookup_parts(rows, table, key, value, limits, value_bytes)
    for other in others:
        first = first.unionByName(other)
    return first


def _regroup(part: DataFrame, keys: list[str], entry: Column, missed: Column) -> DataFrame:
    """keys, entries in order, missed: the words of each line, brought together again where their line is.

    Every line has one first word, or one row without any; more of them tell that lines share a key, which fails.
    """
    begins = F.coalesce(F.col("pos"), F.lit(0)) == 0
    both = part.groupBy(*keys).agg(
        F.collect_list(entry).alias("_e"), F.count_if(missed).alias("_m"), F.count_if(begins).alias("_b")
    )
    shared = F.raise_error(F.lit(SHARED)).cast("bigint")
    return both.select(
        *keys, F.sort_array("_e").alias("entries"), F.when(F.col("_b") <= 1, F.col("_m")).otherwise(shared).alias("missed")
    )


def _pieces(rows: DataFrame, keys: list[str], column: str, lists: Callable[[pa.Array], pa.Array], key: str) -> DataFrame:
    """Rows cut into pieces of some PIECE_BYTES, each with a row for every distinct value, written once.

    _piece, keys, _codes: a row and the numbers of its values in its piece; _piece, _code, `key`: a number and its value.
    Narrow: rows stay where they are read. Their keys alone are shuffled, to find rows that share them, which fails.
    """
    kind = dict(rows.dtypes)[column]
    shown = StructType.fromDDL(f"_piece bigint, _codes array<int>, _code int, {key} {kind.removeprefix('array<').removesuffix('>')}")
    schema = StructType([StructField(name, rows.schema[name].dataType) for name in keys] + shown.fields)
    types = {f.name: to_arrow_type(f.dataType) for f in schema.fields}

    def batch_of(n: int, **columns: pa.Array) -> pa.RecordBatch:
        arrays = [columns[name].cast(kind) if name in columns else pa.nulls(n, kind) for name, kind in types.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(types))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, column, PIECE_BYTES):
            found, lengths = coded(lists(part.column(column)))
            piece, values = uuid.uuid4().int >> 65, found.dictionary
            mine, codes = pa.array(np.full(len(part), piece)), split_lists(found.indices, lengths)
            yield batch_of(len(part), _piece=mine, _codes=codes, **{name: part.column(name) for name in keys})
            numbers, mine = pa.array(np.arange(len(values))), pa.array(np.full(len(values), piece))
            yield batch_of(len(values), _piece=mine, _code=numbers, **{key: values})

    pieces = saved(rows.select(*keys, column).mapInArrow(work, schema))
    met = pieces.where(F.col("_code").isNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if not met.where("_n > 1").isEmpty():
        raise ValueError(SHARED)
    return pieces


def _by_pieces(
    rows: DataFrame, table: DataFrame, keys: list[str], column: str, lists, key: str, value: str, finish, schema: StructType
) -> DataFrame:
    """keys and what `finish` makes of (numbers of all values, how many each row has, values found by number).

    A value is looked up once for each piece: however frequent it is, a piece sends one row of it, so a large table is
    joined by a shuffle that is smaller than the rows and has no skew. Pieces are bounded, and so are the groups.
    """
    pieces = _pieces(rows, keys, column, lists, key)
    asked = pieces.where(F.col("_code").isNotNull()).select("_piece", "_code", key)
    found = asked.join(table.select(key, value), key, "left").select(F.col("_piece").alias("_of"), "_code", value)
    lines = pieces.where(F.col("_code").isNull()).select("_piece", *keys, "_codes")

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("_code")
        codes = left.column("_codes").combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(codes), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        made = finish(codes.flatten(), lengths, right.column(value).combine_chunks())
        return pa.Table.from_arrays([*[left.column(name) for name in keys], *made], names=schema.names)

    grouped = spread(lines, "_piece").groupBy("_piece").cogroup(spread(found, "_of").groupBy("_of"))
    return grouped.applyInArrow(put, schema)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df partitioned by keys into the session's number of shuffle partitions, however few its bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def encode(lines: DataFrame, vocab: DataFrame, limits: Limits | None = None) -> DataFrame:
    """doc_id, line_no, ids, oov_count: the words of each line as ids, unknown words as 0.

    Lines are partitioned by their key before they are cut into words: raw lines are the smallest
    form to shuffle, and with a broadcast vocabulary the regrouping then needs no further exchange.
    A group is the words of one line, so it never outgrows the row it came from. Beyond broadcast the distinct
    words of pieces of the corpus are looked up.
    """
    limits, keys = limits or Limits(), ["doc_id", "line_no"]
    if not fits_broadcast(vocab, "word", limits):
        schema = StructType([lines.schema[k] for k in keys] + StructType.fromDDL("ids array<bigint>, oov_count bigint").fields)
        return _by_pieces(lines, vocab, keys, "line", lambda x: cut_words(x, BLANKS), "word", "id", _ids, schema)
    tokens = spread(lines, *keys).select(*keys, F.posexplode_outer(split_words(F.col("line"))).alias("pos", "word"))
    found = tokens.join(F.broadcast(vocab.select("word", "id")), "word", "left")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(0)).alias("id")))
    unknown = F.col("pos").isNotNull() & F.col("id").isNull()
    return _regroup(found, keys, entry, unknown).select(
        *keys, F.col("entries.id").alias("ids"), F.col("missed").alias("oov_count")
    )


def _ids(flat: pa.Array, lengths: np.ndarray, found: pa.Array) -> list[pa.Array]:
    """The ids of each row, unknown words as 0, and the number of those."""
    ids = split_lists(pc.fill_null(found, 0).take(flat), lengths)
    unknown = np.concatenate([[0], np.cumsum(found.is_null().take(flat).to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = np.cumsum(lengths)
    return [ids, pa.array(unknown[ends] - unknown[ends - lengths])]


def encode_tokens(lines: DataFrame, vocab: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per word with its id; is_oov tells an unknown word from the word that has id 0."""
    tokens = lines.select(
        "doc_id", "line_no", F.posexplode(split_words(F.col("line"))).alias("pos", "word")
    )
    return lookup(tokens, vocab, "word", "id", limits).select(
        "doc_id",
        "line_no",
        "pos",
        "word",
        F.coalesce("id", F.lit(0)).alias("id"),
        F.col("id").isNull().alias("is_oov"),
    )


def decode(encoded: DataFrame, vocab: DataFrame, keys: list[str], limits: Limits | None = None) -> DataFrame:
    """keys, text: ids back to words, joined by one space; unknown ids become empty words.

    Beyond broadcast the distinct ids of pieces of the table are looked up.
    """
    limits = limits or Limits()
    if not fits_broadcast(vocab.select("id", "word"), "word", limits):
        schema = StructType([encoded.schema[k] for k in keys] + StructType.fromDDL("text string").fields)
        return _by_pieces(encoded, vocab, keys, "ids", lambda x: x, "id", "word", _texts, schema)
    entries = spread(encoded, *keys).select(*keys, F.posexplode_outer("ids").alias("pos", "id"))
    found = entries.join(F.broadcast(vocab.select("id", "word")), "id", "left")
    entry = F.when(
        F.col("pos").isNotNull(), F.struct("pos", F.coalesce("word", F.lit("")).alias("word"))
    )
    unknown = F.col("pos").isNotNull() & F.col("word").isNull()
    return _regroup(found, keys, entry, unknown).select(
        *keys, F.when(F.col("missed") >= 0, F.array_join(F.col("entries.word"), " ")).alias("text")
    )


def _texts(flat: pa.Array, lengths: np.ndarray, found: pa.Array) -> list[pa.Array]:
    """The words of each row, unknown ones empty, joined by one space."""
    return [pc.binary_join(split_lists(pc.fill_null(found, "").take(flat), lengths), " ")]


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab.select("word", "id").write.mode("overwrite").parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, id bigint").parquet(path)
