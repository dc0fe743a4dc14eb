"""Substring dedup: content-defined chunks deduplicated by digest, extended to spans of 50 words and more.

A gear hash rolls over the bytes of a text's words: h(i) is the sum of G[byte i - j] * 4^j over the last 16 bytes,
modulo 2^32. A text may be cut behind a word. It is cut where the hash is the least, or as small as the least, of some
`reach` neighbouring words, so a cut depends on the words around it alone, a chunk has at most `reach` words, and
insertions elsewhere move no cut. White space is not compared.

1. Chunks: a digest that two texts or two copies have makes its chunk a repeated one.
2. Seeds: a passage of 50 words holds chunks whose cuts its own words decide. It can stand elsewhere only if all of those
   are repeated, so only runs of repeated chunks, with what they can be extended by on both sides, are looked at further.
3. Extension: the windows of 50 words in those runs are compared by digests of 96 bits. What is found is what a
   comparison of all windows finds, word by word. Windows that overlap or touch are one span.

Equal texts are compared once, as the one with the least id; the others take over its spans. Chunks and texts that many rows
share are few by construction (they hold at least one in HOT_KEYS of all rows): what is known of them is broadcast, and their
rows are spread. Windows are summed before they are shuffled; their join is left to Spark, which splits large partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.textbytes import BASES, Texts, U, map_texts, mix, powers
from wordloom.sources.session import saved

REACH = 16
BITMAP_WORDS = 1 << 19
HOT_KEYS = 20_000
HOT_SPANS = 32  # a popular text with more spans is left to the shuffle


@dataclass(frozen=True)
class Chunking:
    """reach: words among which the least hash makes a cut, so the longest chunk; half of it is the usual one."""

    reach: int = 16
    seed: int = 11


@dataclass(frozen=True)
class Passages:
    """words: of the shortest passage that is found.

    2 * reach + REACH words at most decide on a cut on each side; 50 words hold a chunk for sure with a reach of 16.
    """

    words: int = 50
    chunking: Chunking = Chunking()

    def __post_init__(self):
        if self.words < 2 * self.chunking.reach + REACH:
            raise ValueError("passages this short need not hold a chunk of this reach")


def gear_hashes(data: np.ndarray, seed: int) -> np.ndarray:
    """The rolling hash at every byte, by doubling the reach four times."""
    gear = (mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 32)) >> np.uint64(32)).astype(np.uint32)
    h, reach = gear[data], 1
    while reach < REACH:
        h[reach:] += h[:-reach].copy() << np.uint32(2 * reach)
        reach *= 2
    return h


def running(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or the greatest of every width neighbours, by doubling the width."""
    done = 1
    while done < width and len(x):
        step = min(done, width - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


class Chunks:
    """The chunks of a slice of texts, as runs of words.

    cuts[w] tells that its text is cut behind word w; a text is also cut behind its last word.
    """

    def __init__(self, texts: Texts, chunking: Chunking):
        self.texts, self.reach = texts, chunking.reach
        starts, ends, self.text = texts.words()
        n = len(starts)
        # Bytes of words alone, as white space is not compared.
        self.at = np.concatenate([[0], np.cumsum(ends - starts)])
        rolled = gear_hashes(texts.data[~texts.blank], chunking.seed)
        place = np.arange(n)
        hashes = rolled[self.at[1:] - 1].astype(np.int64) if n else place
        # The first and the last place of the least hash of every window of `reach` words.
        first = running((hashes << 31) | place, chunking.reach, np.minimum)
        last = running((hashes << 31) | (n - place), chunking.reach, np.minimum)
        inside = self.text[: len(first)] == self.text[len(self.text) - len(first) :]
        mask = (1 << 31) - 1
        self.first, self.last = first & mask, n - (last & mask)
        least = np.where(inside, first >> 31, -1)
        # A place is cut if the least hash of some window around it is its own.
        padded = np.full(n + chunking.reach - 1, -1, np.int64)
        padded[chunking.reach - 1 : chunking.reach - 1 + len(least)] = least
        self.cuts = running(padded, chunking.reach, np.maximum)[:n] == hashes if len(least) else np.zeros(n, bool)
        self.ends = np.ones(n, bool)
        self.ends[:-1] = self.text[1:] != self.text[:-1]
        self.behind = np.flatnonzero(self.cuts | self.ends) + 1
        self.begin = np.concatenate([[0], self.behind[:-1]]).astype(np.int64)[: len(self.behind)]

    def digests(self, hashes: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the words of every chunk."""
        up, down = powers(BASES[0], len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, U)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        size = (self.behind - self.begin).astype(U)
        return mix((sums[self.behind] - sums[self.begin]) * down[self.begin] + size * U(BASES[1]))

    def decided(self, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) place of a cut that the words of each window, by their first, decide on for sure."""
        # The first word whose rolling hash covers no byte before the window.
        own = np.searchsorted(self.at, self.at[first] + REACH) - 1
        return self.first[own], self.last[first + width - self.reach]

    def possible(self, first: np.ndarray, width: int, known: np.ndarray) -> np.ndarray:
        """Which windows have only known ones among the chunks that they decide on."""
        low, high = self.decided(first, width)
        unknown = np.concatenate([[0], np.cumsum(~known)])
        return unknown[np.searchsorted(self.behind, high + 1) + 1] == unknown[np.searchsorted(self.behind, low + 1) + 1]


def cut(texts: Texts, chunking: Chunking) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word behind the last and text of every chunk; the chunks of a text cover its words."""
    chunks = Chunks(texts, chunking)
    return chunks.begin, chunks.behind, chunks.text[chunks.begin]


def chunk_rows(rows: DataFrame, passages: Passages) -> DataFrame:
    """mark, chunk (its digest), place and is_new of the chunks of a row; a text of fewer words than a passage has none.

    place holds the number of the chunk in its text, the fewest words of chunks that a window of the text decides on (6
    bits) and the chunk's own words (6 bits). is_new is 1 where the text has such a chunk for the first time, else 0.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(batch.column("text"))
        chunks = Chunks(texts, passages.chunking)
        owner = chunks.text[chunks.begin]
        long = np.bincount(chunks.text, minlength=texts.n) >= passages.words
        if not long.any():
            return None
        hashes = texts.word_hashes()
        first, _ = texts.windows(passages.words, hashes)
        low, high = chunks.decided(first, passages.words)
        span = np.full(texts.n, 63)
        np.minimum.at(span, chunks.text[first], high - low)
        number = np.arange(len(owner)) - np.searchsorted(owner, owner)
        place = (number << 12) + (span[owner] << 6) + (chunks.behind - chunks.begin)
        digests = chunks.digests(hashes)
        order = np.lexsort((digests, owner))
        new = np.ones(len(order), np.int64)
        new[order[1:]] = (owner[order[1:]] != owner[order[:-1]]) | (digests[order[1:]] != digests[order[:-1]])
        kept = long[owner]
        columns = [batch.column("mark").take(pa.array(owner[kept])), pa.array(digests[kept].view(np.int64))]
        columns += [pa.array(place[kept]), pa.array(new[kept])]
        return pa.RecordBatch.from_arrays(columns, ["mark", "chunk", "place", "is_new"])

    return map_texts(rows, "text", work, "mark bigint, chunk bigint, place bigint, is_new bigint")


def may_hold_passages(places: Column) -> Column:
    """Whether chunks, by their places in order, have a run of neighbours with as many words as a window decides on.

    Two chunks with one number are of unlike texts that share a mark: those are kept.
    """
    start = F.struct(F.lit(-2).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("run"), F.lit(False).alias("found"))

    def step(acc: Column, place: Column) -> Column:
        number, words = F.shiftright(place, 12), place.bitwiseAND(F.lit(63))
        run = F.when(number == acc["last"] + 1, acc["run"]).otherwise(F.lit(0)) + words
        enough = (run >= F.shiftright(place, 6).bitwiseAND(F.lit(63))) | (number == acc["last"])
        return F.struct(number.alias("last"), run.alias("run"), (acc["found"] | enough).alias("found"))

    return F.aggregate(places, start, step)["found"]


def placed_windows(rows: DataFrame, passages: Passages) -> DataFrame:
    """The windows of rows that can stand elsewhere, as all chunks that they decide on are among _chunks.

    Gives h1, h2, weight, at, length, mark and first_doc. weight counts rows: that of the text's copies, two at most, where the
    text has such a window for the first time, else 0. at is the place in words times 2^32 plus the start, and length is
    up to the end, in code points; two numbers shuffle leaner than three.
    """
    kind = rows.schema["first_doc"].dataType.simpleString()
    schema = f"h1 bigint, h2 int, weight bigint, at bigint, length bigint, mark bigint, first_doc {kind}"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(batch.column("text"))
        hashes = texts.word_hashes()
        first, h1 = texts.windows(passages.words, hashes)
        if not len(first):
            return None
        chunks = Chunks(texts, passages.chunking)
        # A chunk that one row has and that is repeated is in that row's own list, so one list does for all.
        listed = batch.column("_chunks").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        possible = chunks.possible(first, passages.words, np.isin(chunks.digests(hashes), listed))
        if not possible.any():
            return None
        first, h1 = first[possible], h1[possible]
        h2 = texts.windows(passages.words, texts.word_hashes(1))[1][possible]
        begins, ends, text = texts.words()
        owner, chars = text[first], texts.characters()
        start, end = chars[begins[first]], chars[ends[first + passages.words - 1]]
        place = first - np.searchsorted(text, owner)
        order = np.lexsort((h2, h1, owner))
        a, b, c = owner[order], h1[order], h2[order]
        new = np.ones(len(order), np.int64)
        new[order[1:]] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        copies = np.minimum(batch.column("copies").to_numpy(zero_copy_only=False), 2)
        rows_of = pa.array(owner)
        columns = {
            "h1": pa.array(h1.view(np.int64)),
            "h2": pa.array((h2 >> U(32)).astype(np.uint32).view(np.int32)),
            "weight": pa.array(new * copies[owner]),
            "at": pa.array((place << 32) + start - chars[texts.at[owner]]),
            "length": pa.array(end - start),
            "mark": batch.column("mark").take(rows_of),
            "first_doc": batch.column("first_doc").take(rows_of),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_texts(rows, "text", work, schema)


def likely(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """rows without most of those whose mark is not in marks, by a bitmap of 4 MB at most that is broadcast.

    It spares the shuffle of texts that have nothing repeated, up to some ten million marks; for tables larger than that
    Spark puts a filter of its own before the join.
    """
    word, bit = f"mark & {BITMAP_WORDS - 1}", f"cast(shiftright(mark, {BITMAP_WORDS.bit_length() - 1}) & 63 as int)"
    bitmap = marks.groupBy(F.expr(word).alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits"))
    joined = rows.withColumn("_word", F.expr(word)).join(F.broadcast(bitmap), "_word")
    return joined.where(f"shiftright(_bits, {bit}) & 1 = 1").drop("_word", "_bits")


def with_known(
    rows: DataFrame, known: DataFrame, keys: list[str], total: int, spread: Column, small: Column | None = None
) -> DataFrame:
    """rows inner join known on keys (bigint), where known has a row for each key and n, the rows that have it.

    total is no less than the sum of n. What is known of the keys with n of total / HOT_KEYS or more is broadcast: HOT_KEYS
    rows at most, for which `small` is true. Their rows are dealt by `spread` in the shuffle of the others.
    """
    hot = F.col("n") * HOT_KEYS >= total
    hot = hot if small is None else hot & small
    values = [c for c in known.columns if c not in (*keys, "n")]
    found = known.where(hot).select(*keys, *[F.col(c).alias(f"_h_{c}") for c in values], F.lit(True).alias("_hot"))
    cold = known.where(~hot).select(*[F.col(k).alias(f"_k_{k}") for k in keys], *values, F.lit(True).alias("_cold"))
    flagged = rows.join(F.broadcast(found), keys, "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    dealt = {f"_j_{k}": F.when(F.col("_hot"), spread if k == keys[0] else F.lit(0)).otherwise(F.col(k)).cast("bigint") for k in keys}
    flagged = flagged.withColumns(dealt)
    same = [F.col(f"_j_{k}") == F.col(f"_k_{k}") for k in keys]
    joined = flagged.join(cold, same, "left").where(F.col("_hot") | F.col("_cold"))
    picked = [F.when(F.col("_hot"), F.col(f"_h_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return joined.select(*rows.columns, *picked)


def repeated_spans(docs: DataFrame, passages: Passages | None = None, marks: bool = True) -> DataFrame:
    """doc_id, mark, start, end, n_words, n_windows, first_doc_id and is_first of every repeated span.

    A span is a run of whole words, each in a window that stands in two or more documents; its windows overlap or
    touch. first_doc_id is the least id of a document that has a window of it; is_first tells that the document
    itself is the first for all of them. start and end are code points; mark is a hash of the text, given
    with marks. A null or empty text has no spans, nor has one of fewer words than a passage. Rows that repeat a document are
    documents that repeat its windows; a null id counts as none for first_doc_id. A very long text is cut in a task by
    itself. Other columns are not read, whatever their names, and an empty table gives no rows.
    """
    passages = passages or Passages()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "text", F.xxhash64(text).alias("mark"), F.xxhash64(F.lit(1), text).alias("mark2"), F.xxhash64("doc_id").alias("_d")
    )
    ids = saved(rows.select("doc_id", "mark", "mark2", F.octet_length(text).alias("bytes")))
    size = ids.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("bytes") + 1).alias("bytes")).first()
    words = (size["bytes"] or 0) // 2  # no fewer than there are
    firsts = ids.groupBy("mark", "mark2").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"))
    each = chunk_rows(rows.select("text", "mark"), passages)
    counted = saved(each.groupBy("chunk").agg(F.sum("is_new").alias("n")).where("n > 1"))
    # Copies give the same rows; unlike texts that share a mark share a list: more windows are compared, no more.
    held = with_known(each.drop("is_new"), counted, ["chunk"], words, F.col("mark"))
    listed = held.groupBy("mark").agg(F.sort_array(F.collect_set(F.struct("place", "chunk"))).alias("_held"))
    listed = listed.where(may_hold_passages(F.col("_held.place"))).select("mark", F.array_distinct("_held.chunk").alias("_chunks"))
    wanted = saved(listed.join(firsts, "mark").withColumn("_d", F.xxhash64("first_doc")))
    near = likely(rows.drop("doc_id"), wanted.select("mark")).join(wanted, ["mark", "mark2", "_d"])
    found = placed_windows(near.dropDuplicates(["mark", "mark2", "_d"]).select("text", "mark", "first_doc", "copies", "_chunks"), passages)
    counts = found.groupBy("h1", "h2").agg(F.sum("weight").alias("n"), F.min("first_doc").alias("first_doc_id"))
    repeated = counts.where("n > 1")
    order = Window.partitionBy("mark", "first_doc").orderBy("at")
    place = F.shiftright("at", 32)
    begins = F.coalesce(F.lag(place).over(order) + passages.words < place, F.lit(True)).cast("int")
    start = F.col("at").bitwiseAND(F.lit((1 << 32) - 1))
    run = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = (
        found.drop("weight")
        .join(repeated, ["h1", "h2"])
        .withColumn("_begins", begins)
        .withColumn("_run", run)
        .groupBy("mark", "first_doc", "_run")
        .agg(
            F.min(start).alias("start"),
            F.max(start + F.col("length")).alias("end"),
            (F.max(place) - F.min(place) + passages.words).alias("n_words"),
            F.count(F.lit(1)).alias("n_windows"),
            F.min("first_doc_id").alias("first_doc_id"),
            F.coalesce(F.min(F.col("first_doc_id").eqNullSafe(F.col("first_doc"))), F.lit(False)).alias("_first"),
        )
    )
    # From the texts back to the rows that have them.
    names = ["start", "end", "n_words", "n_windows", "first_doc_id", "_first", "first_doc"]
    of_text = spans.groupBy("mark", F.xxhash64("first_doc").alias("_d")).agg(F.collect_list(F.struct(*names)).alias("_spans"))
    known = saved(of_text.join(wanted.select("mark", "mark2", "_d", F.col("copies").alias("n")), ["mark", "_d"]).drop("_d"))
    mine = with_known(ids, known, ["mark", "mark2"], size["rows"], F.xxhash64("doc_id"), F.size("_spans") <= HOT_SPANS)
    out = mine.select("doc_id", "mark", F.inline("_spans"))
    is_first = F.coalesce(F.col("_first") & (F.col("doc_id") == F.col("first_doc")), F.lit(False)).alias("is_first")
    return out.select("doc_id", *["mark"] * marks, *names[:5], is_first)


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with all their columns, their texts without the spans whose first document is another one."""
    gone = spans.where(~F.col("is_first")).groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_gone")
    )
    names = [f"_c{i}" for i in range(len(docs.columns))]
    doc, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    plain = docs.toDF(*names).withColumn("_mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = plain.join(gone, F.col(doc).eqNullSafe(F.col("doc_id")) & (F.col("_mark") == F.col("mark")), "left")
    # What stays lies between the end of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.col("_gone.end"))
    ends = F.concat(F.col("_gone.start"), F.array(F.length(text).cast("bigint")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    cleaned = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    return joined.withColumn(text, cleaned).select(*names).toDF(*docs.columns)
