"""Quality rules whose cutoffs carry a guarantee on false rejections.

Every document gets a few scores, each bounded by 0 and 1, high for poor text. For a stratum (a language) and
a score, labelled good documents tell how many of them a cutoff would reject. A cutoff is safe if, were its
true false-rejection rate above alpha / scores, so few rejections among the holdout would have a chance of at
most delta / (strata * scores): an exact binomial test with Bonferroni's correction over strata and scores.
The cutoffs of a score are tested in a fixed order, from the loosest on, up to the first that is not safe, which
needs no further correction; the last safe one applies. With probability 1 - delta, every stratum loses at most
a share of alpha of its good documents. A stratum with too few labels gets no cutoff and loses nothing to the
method.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.textbytes import Texts, map_texts, mix, stretch_hashes
from wordloom.sources.session import saved

# Fixed by the query's contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SCORES = ("symbol_share", "repeat_share", "dup_line_share", "capital_share", "odd_length")


@dataclass(frozen=True)
class Risk:
    """alpha: largest share of good documents that a stratum may lose; delta: chance that this fails."""

    alpha: float = 0.01
    delta: float = 0.05
    grid: tuple[float, ...] = tuple(round(0.01 * k, 2) for k in range(1, 100))


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and capitals of each text."""
    data, at, n = texts.data, texts.at, texts.n
    starts, ends, owner = texts.words()
    solid = ~texts.blank
    out = {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": texts.per_text(solid & ((data & 0xC0) != 0x80)),
        "n_symbols": texts.per_text(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))),
        "n_capitals": texts.per_text((data >= 65) & (data <= 90)),
        "n_small": texts.per_text((data >= 97) & (data <= 122)),
    }

    # Lines: cut at line feeds and at the ends of texts.
    cuts = np.union1d(np.flatnonzero(data == 10), at[1:] - 1) if len(data) else np.zeros(0, np.int64)
    feeds = data[cuts] == 10 if len(cuts) else np.zeros(0, bool)
    line_ends = np.where(feeds, cuts, cuts + 1)
    line_starts = np.concatenate([[0], cuts[:-1] + 1]) if len(cuts) else cuts
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=worded[1:])
    full = worded[line_ends] > worded[line_starts]
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_text = np.searchsorted(at, line_starts, side="right") - 1
    key = line_text.astype(np.uint64), stretch_hashes(data, line_starts, line_ends)
    later = np.zeros(len(line_starts), bool)
    if len(line_starts):
        order = np.lexsort((key[1], key[0]))
        same = (key[0][order][1:] == key[0][order][:-1]) & (key[1][order][1:] == key[1][order][:-1])
        later[order[1:]] = same
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=n)

    first, window = texts.windows(WINDOW, texts.word_hashes())
    inside = mix(window + owner[first].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    cover = np.zeros(len(starts) + 1, np.int64)
    if len(first):
        order = np.argsort(inside, kind="stable")
        equal = inside[order][1:] == inside[order][:-1]
        twice = np.zeros(len(first), bool)
        twice[order[1:]] |= equal
        twice[order[:-1]] |= equal
        hit = first[twice]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)
    return out


def scores(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    words = np.maximum(counts["n_words"], 1)
    letters = np.maximum(counts["n_capitals"] + counts["n_small"], 1)
    mean = counts["word_chars"] / words
    return {
        "symbol_share": np.minimum(counts["n_symbols"] / words, 1.0),
        "repeat_share": counts["n_repeat_words"] / words,
        "dup_line_share": np.minimum(counts["n_dup_lines"] * 10 / words, 1.0),
        "capital_share": counts["n_capitals"] / letters,
        "odd_length": np.clip(np.abs(mean - 6.0) / 12.0, 0.0, 1.0),
    }


def measure(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, the base counts, base_failed and the scores of every document."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = f"{kinds}, {', '.join(f'{n} bigint' for n in names)}, base_failed boolean, " + ", ".join(
        f"{s} double" for s in SCORES
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = base_counts(Texts(batch.column(text)))
        failed = (counts["n_words"] < MIN_WORDS) | (
            100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
        )
        high = scores(counts)
        columns = [batch.column(k) for k in keys] + [pa.array(counts[n].astype(np.int64)) for n in names]
        columns += [pa.array(failed)] + [pa.array(high[s].astype(np.float64)) for s in SCORES]
        return pa.RecordBatch.from_arrays(columns, [*keys, *names, "base_failed", *SCORES])

    return map_texts(docs.select(*keys, text), text, work, schema)


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for a binomial X of n draws with chance p, exact up to rounding."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def most_rejected(n: int, p: float, level: float) -> int:
    """Largest k with P(X <= k) <= level; -1 if there is none. The chance grows with k, so it is searched by halves."""
    low, high = -1, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if tail(middle, n, p) <= level else (low, middle)
    return low


def rejected_by_cutoff(score: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """For each cutoff of the ascending grid, how many scores lie above it."""
    below = np.searchsorted(np.sort(score), grid, side="right")
    return len(score) - below


def choose_cutoffs(holdout: DataFrame, stratum: str, risk: Risk | None = None) -> DataFrame:
    """stratum, n_holdout and the cutoff of each score (null: none is safe), from measured good documents.

    holdout has one row per draw: a labelled good text, once. Tasks send sums per stratum, score and cutoff, so a large
    stratum is no large group; a stratum's sums are tested in one task.
    """
    risk = risk or Risk()
    grid = np.array(risk.grid)
    width = len(SCORES) * len(grid)
    kind = holdout.schema[stratum].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pc.dictionary_encode(batch.column(stratum), null_encoding="encode")
            strata, values = coded.indices.to_numpy(), [batch.column(s).to_numpy() for s in SCORES]
            for code, name in enumerate(coded.dictionary.to_pylist()):
                mine = strata == code
                sums = np.concatenate([rejected_by_cutoff(v[mine], grid) for v in values])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * width, batch.schema.field(stratum).type), pa.array(np.arange(width)),
                     pa.array(sums.astype(np.int64)), pa.array(np.full(width, mine.sum(), np.int64))],
                    ["_stratum", "cell", "rejected", "n"],
                )

    sums = (
        holdout.select(stratum, *SCORES)
        .mapInArrow(count, f"_stratum {kind}, cell bigint, rejected bigint, n bigint")
        .groupBy("_stratum", "cell")
        .agg(F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
        .groupBy("_stratum")
        .agg(F.max("n").alias("n_holdout"), F.sort_array(F.collect_list(F.struct("cell", "rejected"))).alias("cells"))
    )
    strata = holdout.select(stratum).distinct().count()
    level = risk.delta / max(1, strata * len(SCORES))
    share = risk.alpha / len(SCORES)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {s: [] for s in SCORES}
            for n, cells in zip(batch.column("n_holdout").to_pylist(), batch.column("rejected").to_pylist(), strict=True):
                limit = most_rejected(n, share, level)
                for i, s in enumerate(SCORES):
                    # Rejections only grow as the cutoff falls, so the last safe one in order is the lowest.
                    safe = [c for c, k in zip(risk.grid, cells[i * len(grid) : (i + 1) * len(grid)], strict=True) if k <= limit]
                    found[s].append(min(safe, default=None))
            columns = [batch.column("_stratum"), batch.column("n_holdout")]
            columns += [pa.array(found[s], pa.float64()) for s in SCORES]
            yield pa.RecordBatch.from_arrays(columns, ["_stratum", "n_holdout", *[f"max_{s}" for s in SCORES]])

    return sums.select("_stratum", "n_holdout", F.col("cells.rejected").alias("rejected")).mapInArrow(
        choose, f"_stratum {kind}, n_holdout bigint, " + ", ".join(f"max_{s} double" for s in SCORES)
    )


def apply_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk | None = None, broadcast_strata: int = 10_000
) -> DataFrame:
    """doc_id, base counts, base_failed, the scores, reasons and kept for every document.

    docs: doc_id, text and the stratum. labels: doc_id and quality, whose value 1 marks good documents; those that
    pass the base rules are the holdout, so the guarantee holds for what the method rejects.
    A null text is empty and fails the base; a null stratum is a stratum of its own; repeated rows are judged
    each by itself. The binomial bounds need independent draws, so a text counts once in the holdout of its stratum, however
    many documents have it and however often they are labelled. A long text is measured in a slice of its own; other
    columns are not read, and without documents there are no rows.
    Cutoffs are broadcast while there are at most broadcast_strata strata, and joined beyond that.
    """
    marked = docs.select("doc_id", stratum, "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"))
    measured = saved(measure(marked, keys=("doc_id", stratum, "_text")))
    good = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    holdout = measured.where(~F.col("base_failed")).join(good, "doc_id").dropDuplicates([stratum, "_text"])
    measured = measured.drop("_text")
    cutoffs = saved(choose_cutoffs(holdout, stratum, risk))
    if cutoffs.count() <= broadcast_strata:
        cutoffs = F.broadcast(cutoffs)
    joined = measured.join(cutoffs, F.col(stratum).eqNullSafe(F.col("_stratum")), "left").drop("_stratum")
    reasons = F.array_compact(
        F.array(*[F.when(F.col(s) > F.col(f"max_{s}"), F.lit(s)) for s in SCORES])
    )
    return joined.withColumn("reasons", reasons).withColumn(
        "kept", ~F.col("base_failed") & (F.size("reasons") == 0)
    )
