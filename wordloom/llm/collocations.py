"""Phrase collocation mining: an FM-index for each shard of text, over word ids, enumerates its phrases.

A task cuts its texts into shards of bounded bytes. The words of a shard get numbers by language, 0 stands between its
pieces. The index holds the suffix order of the numbers and of their reverse, cut off at the longest phrase, with the
symbol before each suffix and the step from a suffix to the one before it. A phrase is a pair of intervals, one in each
order; all phrases of a length are extended by a word at once, to the right through the reverse order and to the left
through the other, with their counts. Counts of shards are summed.

A phrase with `least` occurrences has only parts with as many. So lengths are counted one after the other, and a shard of
the next pass breaks its pieces wherever the phrase of the last length is not among the frequent ones. What is
frequent is told to the tasks by a bitmap of a fixed size; a phrase that it lets through by chance is dropped by its sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.textbytes import Texts, U, mix, pieces, stretch_hashes
from wordloom.operators.vocab import lookup
from wordloom.sources.session import saved

SCHEMA = "lang string, phrase string, n bigint"
SALTS = 64


@dataclass(frozen=True)
class Mining:
    """least: occurrences of a phrase. words: of the longest. top: rows of each language.

    shard_bytes: text that one index covers; a longer text has its own. filter_bits: size of the bitmap, as a power of two.
    """

    least: int = 100
    words: int = 5
    top: int = 2000
    unknown: str = "und"
    shard_bytes: int = 3 << 20
    filter_bits: int = 27


def ordered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their keys, the keys in order), equal keys by place; keys are below bound."""
    n = len(keys)
    bits = max(n - 1, 1).bit_length()
    if bits + int(bound).bit_length() <= 63:
        packed = (keys.astype(np.int64) << bits) | np.arange(n)
        packed.sort()
        return packed & ((1 << bits) - 1), packed >> bits
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


def ranks(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(order, dense rank of each key, number of ranks)."""
    order, sorted_keys = ordered(keys, bound)
    new = np.zeros(len(keys), np.int64)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank, int(new.sum()) + 1


class Index:
    """FM-index of symbols 0..size-1, its suffixes ordered by their first `depth` symbols: right for patterns of so many."""

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        n, rank, kinds, done, one = len(symbols), symbols.astype(np.int64), size, 1, symbols.astype(np.int64)
        order, _ = ordered(rank, size)
        while done < depth:
            # Suffixes by twice as many symbols, or by one more; past the end stands what is less than all.
            step, other, more = (done, rank, kinds) if 2 * done <= depth else (done, one, size)
            after = np.zeros(n, np.int64)
            after[:-step] = other[step:] + 1 if step < n else 0
            order, rank, kinds = ranks(rank * (more + 1) + after, kinds * (more + 1))
            done = 2 * done if 2 * done <= depth else done + 1
        del rank, one
        self.suffixes = order.astype(np.int32)
        self.before = symbols[order - 1].astype(np.int32)
        del order
        self.counts = np.bincount(symbols, minlength=size)
        self.starts = np.cumsum(self.counts) - self.counts
        # The i-th c before the suffixes is the i-th suffix that starts with c.
        by_symbol, _ = ordered(self.before, size)
        self.step = np.empty(n, np.int32)
        self.step[by_symbol] = np.arange(n, dtype=np.int32)


@dataclass
class Phrases:
    """Intervals of phrases of one length, in the order of the text (forth) and of its reverse (back)."""

    length: int
    forth: np.ndarray
    back: np.ndarray
    count: np.ndarray


class Shard:
    """Both orders of a text of symbols that begins and ends with the separator 0."""

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        self.symbols, self.size = symbols, size
        self.forth = Index(symbols, size, depth)
        self.back = Index(symbols[::-1], size, depth)

    def words(self) -> Phrases:
        found = np.flatnonzero(self.forth.counts[1:]) + 1
        return Phrases(1, self.forth.starts[found], self.back.starts[found], self.forth.counts[found])

    def extended(self, phrases: Phrases, right: bool) -> Phrases:
        """Every phrase with one word more, that stands behind it (or before it) somewhere."""
        index, here, there = (self.back, phrases.back, phrases.forth) if right else (self.forth, phrases.forth, phrases.back)
        count = phrases.count
        owner = np.repeat(np.arange(len(count)), count)
        first = np.cumsum(count) - count
        row = here[owner] + np.arange(len(owner)) - first[owner]
        order, key = ordered(owner * self.size + index.before[row], len(count) * self.size)
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        many = np.diff(np.r_[heads, len(key)])
        from_phrase, symbol = key[heads] // self.size, key[heads] % self.size
        # In the other order, the phrases with a smaller word on this side come before; a separator is the smallest.
        there = there[from_phrase] + heads - first[from_phrase]
        here = index.step[row[order[heads]]].astype(np.int64)
        real = symbol > 0
        forth, back = (there, here) if right else (here, there)
        return Phrases(phrases.length + 1, forth[real], back[real], many[real])

    def spelled(self, phrases: Phrases) -> np.ndarray:
        """[phrases, length] symbols."""
        at = self.forth.suffixes[phrases.forth]
        return self.symbols[at[:, None] + np.arange(phrases.length)]

    def of_length(self, length: int) -> Phrases:
        """All phrases of so many words, by steps to the right and to the left in turn."""
        phrases = self.words()
        while phrases.length < length:
            phrases = self.extended(phrases, right=phrases.length % 2 == 1)
        return phrases


def phrase_hashes(hashes: np.ndarray, lengths: int) -> np.ndarray:
    """Hash of every run of so many word hashes."""
    n = max(len(hashes) - lengths + 1, 0)
    total = np.zeros(n, U)
    for k in range(lengths):
        total = mix(total * U(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return total


def language_hashes(langs: pa.Array) -> np.ndarray:
    names = [n.encode() for n in langs.to_pylist()]
    at = np.cumsum([0, *map(len, names)])
    return mix(stretch_hashes(np.frombuffer(b"".join(names), np.uint8), at[:-1], at[1:], 1))


class Words:
    """The words of a slice of texts, with the piece that each stands in and its language.

    Lower-cases A-Z; pieces end at . , ; : ! ? and line ends; words are runs of bytes other than space and tab.
    """

    def __init__(self, batch: pa.RecordBatch):
        texts = Texts(batch.column("text"))
        data = texts.data
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        stops = np.zeros(256, bool)
        stops[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
        ends_piece = stops[data]
        solid = ~(ends_piece | (data == 32) | (data == 9))
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        inner = texts.at[(texts.at > 0) & (texts.at < len(data))]
        before[inner], after[inner - 1] = False, False
        starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        text = np.searchsorted(texts.at, starts, side="right") - 1
        self.piece = (np.concatenate([[0], np.cumsum(ends_piece)])[starts] + text).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        flat = np.ascontiguousarray(data[solid])
        column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(flat))
        coded = pc.dictionary_encode(column)
        self.dictionary = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        langs = pc.dictionary_encode(batch.column("lang"))
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        where = np.cumsum(np.r_[0, pc.binary_length(self.dictionary).to_numpy(zero_copy_only=False)]).astype(np.int64)
        raw = np.frombuffer(self.dictionary.buffers()[2], np.uint8) if len(self.dictionary) else np.zeros(0, np.uint8)
        word_hash = stretch_hashes(raw[: where[-1]], where[:-1], where[1:])
        self.hashes = mix(word_hash[self.word] ^ language_hashes(self.langs)[self.lang]) if len(self.word) else np.zeros(0, U)

    def runs(self, length: int, known: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(word places, is_start): the words that stand in a run of `length` words both of whose phrases of one word
        less are known; is_start marks the first of each unbroken stretch of them. Where two runs touch, phrases across them
        are counted too; they have a part that is not frequent, so they are not either.
        """
        n = len(self.word)
        if known is None or not n:
            return np.arange(n), np.r_[True, self.piece[1:] != self.piece[:-1]] if n else np.zeros(0, bool)
        part = length - 1
        hashes = phrase_hashes(self.hashes, part)
        good = self.piece[: len(hashes)] == self.piece[part - 1 :]
        slot = hashes >> U(64 - bits)
        good &= (known[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8)) & 1 == 1
        # A phrase of `length` words begins where two parts in a row are known.
        whole = good[:-1] & good[1:] & (self.piece[: max(n - part, 0)] == self.piece[part:])
        begins = np.flatnonzero(whole)
        if not len(begins):
            return begins, np.zeros(0, bool)
        edge = np.zeros(n + 1, np.int64)
        edge[begins] += 1
        edge[begins + length] -= 1
        places = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        start = np.ones(len(places), bool)
        start[1:] = (np.diff(places) > 1) | (self.piece[places[1:]] != self.piece[places[:-1]])
        return places, start

    def counted(self, length: int, known: np.ndarray | None, bits: int) -> pa.RecordBatch | None:
        """lang, phrase and n of the phrases of so many words."""
        places, start = self.runs(length, known, bits)
        if not len(places):
            return None
        kinds = len(self.dictionary)
        _, local, size = ranks(self.lang[places] * kinds + self.word[places], len(self.langs) * kinds)
        first = np.empty(size, np.int64)
        first[local] = places
        # A separator before each stretch and at the end.
        symbols = np.zeros(len(places) + int(start.sum()) + 1, np.int64)
        symbols[np.arange(len(places)) + np.cumsum(start)] = local + 1
        shard = Shard(symbols, size + 1, length)
        phrases = shard.of_length(length)
        spelled = first[shard.spelled(phrases) - 1]
        words = [self.dictionary.take(pa.array(self.word[spelled[:, k]])) for k in range(length)]
        columns = [
            self.langs.take(pa.array(self.lang[spelled[:, 0]])),
            pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())).cast(pa.string()),
            pa.array(phrases.count),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])


def shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task, taken together or cut so that their texts have about limit bytes."""
    held, total = [], 0
    for batch in batches:
        for piece in pieces(batch, "text", limit):
            size = piece.column("text").nbytes
            if held and total + size > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
            held.append(piece)
            total += size
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def phrase_counts(docs: DataFrame, length: int, mining: Mining, known: np.ndarray | None = None) -> DataFrame:
    """lang, phrase and n, summed over the shards, of the phrases of `length` words whose parts the bitmap knows."""
    rows = docs.select(F.coalesce("lang", F.lit(mining.unknown)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, mining.shard_bytes):
            found = Words(shard).counted(length, shared.value, mining.filter_bits)
            if found is not None:
                # Small batches: the receiving side holds one at a time.
                for at in range(0, found.num_rows, 20_000):
                    yield found.slice(at, 20_000)

    each = rows.mapInArrow(work, SCHEMA)
    return each.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bitmap(frequent: DataFrame, length: int, bits: int) -> np.ndarray:
    """A bit for the leading bits of the hash of every phrase: 2^bits bits, whatever the number of phrases."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.dictionary_encode(batch.column("lang"))
            of_lang = language_hashes(langs.dictionary)[langs.indices.to_numpy(zero_copy_only=False)]
            words = Texts(batch.column("phrase")).word_hashes().reshape(-1, length)
            total = np.zeros(len(words), U)
            for k in range(length):
                total = mix(total * U(0x9E3779B97F4A7C15) + mix(words[:, k] ^ of_lang))
            yield pa.RecordBatch.from_arrays([pa.array(total.view(np.int64))], ["h"])

    frequent = frequent.select("lang", "phrase").mapInArrow(work, "h bigint")
    high = F.shiftrightunsigned("h", 64 - bits)
    word = F.shiftright(high, 6)
    rows = frequent.groupBy(word.alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))")).alias("b")
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    for batch in rows.toArrow().to_batches():
        out[batch.column("w").to_numpy()] = batch.column("b").to_numpy()
    return out.view(np.uint8)


def frequent_phrases(docs: DataFrame, mining: Mining) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f of all phrases of 1 to mining.words words with mining.least occurrences; lang, n of all words)."""
    counted = saved(phrase_counts(docs, 1, mining))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= mining.least).withColumn("words", F.lit(1))
    tables = [found]
    for length in range(2, mining.words + 1):
        known = bitmap(tables[-1], length - 1, mining.filter_bits)
        if not known.any():
            break
        counts = phrase_counts(docs, length, mining, known).where(F.col("n") >= mining.least)
        tables.append(saved(counts).withColumn("words", F.lit(length)))
    for table in tables[1:]:
        found = found.unionByName(table)
    return found.select("lang", "phrase", "words", F.col("n").alias("f")), totals


def _key(lang: Column, phrase: Column) -> Column:
    return F.concat_ws("\n", lang, phrase)


def collocations(docs: DataFrame, mining: Mining | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best mining.top phrases of each language.

    A phrase with as many occurrences as a longer one that holds it is left out; to find those, phrases of one word more
    are enough, as counts do not grow with a phrase. A null text is empty, a null language is `und`; a row that repeats
    another counts again; other columns are not read. Without documents there are no rows. A long text is one shard.
    """
    mining = mining or Mining()
    found, totals = frequent_phrases(docs, mining)
    many = found.where("words > 1").withColumn("_w", F.split("phrase", " "))
    part = lambda a, n: F.array_join(F.slice("_w", a, n), " ")
    size = F.col("words")
    # Of a phrase: both parts of every cut, to look up their counts.
    cuts = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    asked = many.select("lang", "phrase", "words", "f", "_w", cuts)
    asked = asked.select(
        "lang", "phrase", "words", "f", "k",
        F.explode(F.array(F.struct(F.lit(0).alias("side"), part(1, F.col("k")).alias("part")),
                          F.struct(F.lit(1).alias("side"), part(F.col("k") + 1, size).alias("part")))).alias("_p"),
    ).select("lang", "phrase", "f", "k", "_p.side", _key(F.col("lang"), F.col("_p.part")).alias("key"))
    table = found.select(_key(F.col("lang"), F.col("phrase")).alias("key"), F.col("f").alias("part_f"))
    seen = lookup(asked, table, "key", "part_f").select("lang", "phrase", "f", "k", "side", "part_f", F.lit(0).cast("bigint").alias("longer"))
    # Of a phrase of three words or more: itself, as the longer one of both phrases of one word less.
    shorter = many.where("words > 2").select(
        "lang", F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"), F.lit(None).cast("bigint").alias("f"),
        F.lit(None).cast("int").alias("k"), F.lit(None).cast("int").alias("side"), F.lit(None).cast("bigint").alias("part_f"),
        F.col("f").alias("longer"),
    )
    of = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("part_f")))
    places = range(1, mining.words)
    one = seen.unionByName(shorter).groupBy("lang", "phrase").agg(
        F.max("f").alias("a"), F.max("longer").alias("longer"),
        *[of(k, 0).alias(f"l{k}") for k in places], *[of(k, 1).alias(f"r{k}") for k in places],
    )
    kept = one.where("a > longer").join(totals, "lang")
    top = F.col("a").cast("decimal(18,0)") * F.lit(1000).cast("decimal(4,0)")
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    score = lambda k: F.call_function("div", (top * wide("n")).cast("decimal(38,0)"), (wide(f"l{k}") * wide(f"r{k}")).cast("decimal(38,0)"))
    options = F.array(*[
        F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in places
    ])
    best = F.array_min(F.array_compact(options))
    scored = kept.select("lang", "phrase", "a", "n", best.alias("_b")).select(
        "lang", "phrase", "a", F.col("_b.l").alias("l"), F.col("_b.r").alias("r"), "n", F.col("_b.score").alias("score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each share of a language, then the best of those: no task orders a whole language.
    salted = scored.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_r") <= mining.top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= mining.top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
