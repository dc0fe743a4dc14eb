"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is the number of ratings in its favour: rated of quality, rated not toxic; 0, 1 or 2. Its
terms (runs of letters and digits, runs of other marks, starts of words, and a few marks of style) are hashed to 64 bits. One
weight per hash is shared by all grades, and ordered thresholds t_0 < t_1 tell them apart:
P(grade <= k) = 1 / (1 + exp(score - t_k)). The model gives the expected grade and the chance of the top grade;
a document is kept if that chance reaches a cutoff.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.textbytes import Texts, U, map_texts, mix, stretch_hashes, window_hash

TOP = 2
STYLE = U(0xA5A5000000000000)
FILTER_BITS = 22
STEMS = (4, 5, 6)  # bytes at the start of a longer word that are terms too


@dataclass(frozen=True)
class Rating:
    """sample_rows: bound on the labelled rows that the model is fitted on, those whose ids hash lowest.

    min_documents: documents of the sample that a term must stand in to get a weight.
    """

    sample_rows: int = 12_000
    min_documents: int = 4
    rounds: int = 60
    penalty: float = 3e-4
    cutoff: float = 0.75


def grade(quality: Column, toxic: Column) -> Column:
    """2 - (poor) - (toxic); null if a rating is missing."""
    return (F.when(quality > 0, 1).when(quality.isNotNull(), 0) + F.when(toxic > 0, 0).when(toxic.isNotNull(), 1)).cast(
        "int"
    )


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct terms of every text, ordered by text."""
    data = texts.data
    small = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    letter = ((small >= 97) & (small <= 122)) | ((small >= 48) & (small <= 57)) | (small >= 128)
    kind = np.where(texts.blank, 0, np.where(letter, 1, 2)).astype(np.int8)
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[texts.at] = True
    cuts = np.flatnonzero(edge)
    starts, ends = (cuts[:-1], cuts[1:]) if len(data) else (cuts[:0], cuts[:0])
    solid = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    owner = np.searchsorted(texts.at, starts, side="right") - 1
    hashes = stretch_hashes(small, starts, ends)

    n = texts.n
    words, count = hashes, np.maximum(np.bincount(owner, minlength=n), 1)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1]) & (kind[starts[1:]] == 1)
    again = np.bincount(owner[same], minlength=n) / count
    marks = np.bincount(owner[kind[starts] == 2], minlength=n) / count
    capitals = texts.per_text((data >= 65) & (data <= 90)) / np.maximum(texts.per_text(letter), 1)
    twice = np.zeros(n)
    if len(words) >= 4:
        four = np.flatnonzero(owner[:-3] == owner[3:])
        key = mix(window_hash(words, 4)[four] + owner[four].astype(U) * U(0xD6E8FEB86659FD93))
        order = np.argsort(key, kind="stable")
        later = np.zeros(len(key), bool)
        later[order[1:]] = key[order][1:] == key[order][:-1]
        twice = np.bincount(owner[four[later]], minlength=n) / count
    length = np.log2(count)
    styles = [
        STYLE + U(1 << 32) * U(i) + np.minimum(np.floor(v * 10), 15).astype(U)
        for i, v in enumerate((again, marks, capitals * 2, twice, length / 10))
    ]
    stems = []
    for size in STEMS:
        long = (ends - starts > size) & (kind[starts] == 1)
        stems.append((owner[long], mix(stretch_hashes(small, starts[long], starts[long] + size) + U(size))))
    owner = np.concatenate([owner, *[s[0] for s in stems], *[np.arange(n)] * len(styles)])
    hashes = np.concatenate([hashes, *[s[1] for s in stems], *[mix(s) for s in styles]])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[first], hashes[first]


@dataclass
class Model:
    hashes: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self):
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U(64 - FILTER_BITS)).astype(np.int64)

    def scores(self, owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        known = np.flatnonzero(self.maybe[self._slot(hashes)]) if len(self.hashes) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes[known]), max(len(self.hashes) - 1, 0))
        hit = self.hashes[at] == hashes[known] if len(known) else np.zeros(0, bool)
        return np.bincount(owner[known[hit]], self.weights[at[hit]], minlength=n)

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for k = 0, 1, as columns."""
        return 1.0 / (1.0 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))


def _parts(n: int, size: int = 1 << 20) -> list[slice]:
    """Slices of n entries: what is made of one at a time stays small."""
    return [slice(at, at + size) for at in range(0, n, size)]


def fit_rows(grades: np.ndarray, owner: np.ndarray, hashes: np.ndarray, rating: Rating) -> Model:
    """The model of rows 0, 1, 2...: penalised likelihood by quasi-Newton steps on all rows at once, so it depends on no order."""
    ordered = np.sort(hashes)
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    found = ordered[heads[np.diff(np.r_[heads, len(ordered)]) >= rating.min_documents]]
    del ordered, heads
    rows_of, columns = [], []
    for part in _parts(len(hashes)):
        at = np.minimum(np.searchsorted(found, hashes[part]), max(len(found) - 1, 0))
        used = found[at] == hashes[part] if len(found) else np.zeros(len(at), bool)
        rows_of.append(owner[part][used].astype(np.int32))
        columns.append(at[used].astype(np.int32))
    del hashes
    owner = np.concatenate([*rows_of, np.zeros(0, np.int32)])
    column = np.concatenate([*columns, np.zeros(0, np.int32)])
    del rows_of, columns
    n, width = len(grades), len(found)
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=TOP + 1))[:TOP] / n, 1e-4, 1 - 1e-4)
    thresholds = np.log(shares / (1 - shares))
    thresholds[1] = max(thresholds[1], thresholds[0] + 0.1)
    # The second threshold is the first plus exp(gap): they stay ordered.
    start = np.concatenate([np.zeros(width), [thresholds[0], np.log(thresholds[1] - thresholds[0])]])
    rows = np.arange(n)

    def value(state: np.ndarray) -> tuple[float, np.ndarray]:
        weights, low, gap = state[:-2], state[-2], np.exp(np.clip(state[-1], -8, 4))
        score = np.zeros(n)
        for part in _parts(len(owner)):
            score += np.bincount(owner[part], weights[column[part]], minlength=n)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - np.array([low, low + gap]), -60, 60)))
        edges = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        chance = np.maximum(edges[rows, grades + 1] - edges[rows, grades], 1e-12)
        slope = edges * (1 - edges)
        by_score = (slope[rows, grades + 1] - slope[rows, grades]) / chance
        upper = np.where(grades < TOP, slope[rows, grades + 1] / chance, 0)
        lower = np.where(grades > 0, slope[rows, grades] / chance, 0)
        by_threshold = [-(upper[grades == k].sum() - lower[grades == k + 1].sum()) for k in range(TOP)]
        gradient = np.zeros(width)
        for part in _parts(len(owner)):
            gradient += np.bincount(column[part], by_score[owner[part]], minlength=width)
        gradient = gradient / n + rating.penalty * weights
        loss = -np.log(chance).sum() / n + rating.penalty / 2 * (weights @ weights)
        return loss, np.concatenate([gradient, [sum(by_threshold) / n, by_threshold[1] * gap / n]])

    state = minimum(value, start, rating.rounds)
    gap = np.exp(np.clip(state[-1], -8, 4))
    return Model(found, state[:-2], np.array([state[-2], state[-2] + gap]))


def minimum(value: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """A point near the minimum of a smooth function, by limited-memory quasi-Newton steps."""
    f, g = value(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q, factors = g.copy(), []
        for s, y, r in reversed(past):
            factors.append(r * (s @ q))
            q -= factors[-1] * y
        if past:
            s, y, r = past[-1]
            q *= 1 / (r * (y @ y))
        for (s, y, r), a in zip(past, reversed(factors), strict=True):
            q += s * (a - r * (y @ q))
        slope, size = -(g @ q), 1.0 if past else 1.0 / max(np.abs(g).sum(), 1e-12)
        for _ in range(20):
            to = x - size * q
            f_to, g_to = value(to)
            if f_to <= f + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = to - x, g_to - g
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y, 1 / (s @ y))]
        done = abs(f - f_to) < 1e-7 * max(1.0, abs(f))
        x, f, g = to, f_to, g_to
        if done:
            break
    return x


def fit(docs: DataFrame, labels: DataFrame, rating: Rating | None = None) -> Model | None:
    """The model of at most rating.sample_rows labelled documents, fitted in one task; None if none is labelled."""
    rating = rating or Rating()
    graded = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")).where(
        F.col("grade").isNotNull() & F.col("doc_id").isNotNull()
    )
    # One grade per document: of contradicting ones the lowest. The bound makes the broadcast safe.
    graded = graded.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rating.sample_rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column("text"))
        owner, hashes = terms(texts)
        at = np.searchsorted(owner, np.arange(texts.n + 1))
        found = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.binary())], ["doc_id", "grade", "terms"]
        )

    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_texts(sample, "text", work, f"doc_id {kind}, grade int, terms binary")
    # Of several texts with one id, always the same: that of the least digest.
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.sha2("terms", 256).alias("digest"), "grade", "terms")).alias("_m"))
    one = one.select("doc_id", "_m.grade", "_m.terms")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, counts, parts = [], [], []
        for b in batches:
            grades.append(b.column("grade").to_numpy(zero_copy_only=False))
            counts.append(pc.binary_length(b.column("terms")).to_numpy(zero_copy_only=False) // 8)
            parts += [np.frombuffer(x.as_buffer(), U).copy() for x in b.column("terms")]
        if grades:
            owner = np.repeat(np.arange(sum(map(len, counts)), dtype=np.int32), np.concatenate(counts))
            hashes = np.concatenate(parts)
            parts.clear()
            model = fit_rows(np.concatenate(grades), owner, hashes, rating)
            state = pickle.dumps((model.hashes, model.weights, model.thresholds))
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["state"])

    found = one.repartition(1).sortWithinPartitions("doc_id").mapInArrow(learn, "state binary").first()
    return None if found is None else Model(*pickle.loads(found["state"]))


def score(docs: DataFrame, model: Model | None, rating: Rating | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, expected_grade, p_top and kept for every document, each row by itself.

    A null text is empty. Without a model the grade and chance are null and every document is kept. Rows that repeat are
    scored each by itself, a long text in a slice of its own, and an empty table gives no rows.
    """
    rating = rating or Rating()
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{kinds}, expected_grade double, p_top double, kept boolean"
    shared = docs.sparkSession.sparkContext.broadcast(
        None if model is None else (model.hashes, model.weights, model.thresholds)
    )
    ready: list[Model] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(k) for k in keep]
        n = batch.num_rows
        if shared.value is None:
            columns += [pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array(np.ones(n, bool))]
        else:
            if not ready:
                ready.append(Model(*shared.value))
            below = ready[0].at_most(ready[0].scores(*terms(Texts(batch.column("text"))), n))
            top = 1 - below[:, -1]
            columns += [pa.array(TOP - below.sum(axis=1)), pa.array(top), pa.array(top >= rating.cutoff)]
        return pa.RecordBatch.from_arrays(columns, [*keep, "expected_grade", "p_top", "kept"])

    return map_texts(docs.select(*dict.fromkeys([*keep, "text"])), "text", work, schema)


def grade_documents(docs: DataFrame, labels: DataFrame, rating: Rating | None = None) -> DataFrame:
    """doc_id, expected_grade, p_top and kept of every document, by a model of the labelled ones."""
    return score(docs, fit(docs, labels, rating), rating)


def select_documents(docs: DataFrame, labels: DataFrame, rating: Rating | None = None) -> DataFrame:
    """The documents that the model keeps, with all their columns and in one pass over them."""
    model = fit(docs, labels, rating)
    names = [f"_c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    scored = score(docs.toDF(*names), model, rating, tuple(names))
    return scored.where("kept").select(*names).toDF(*docs.columns)
