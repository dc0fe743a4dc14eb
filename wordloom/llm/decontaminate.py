"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared in lower case with every run of white space as one space. Each benchmark item is cut into
overlapping patterns of at most `window` characters. If a stretch of a document is within k edits of a pattern of m
characters, they share at least m - q + 1 - k * q q-grams on diagonals (place in the document less place in the
pattern) that differ by k at most. So shared q-grams are counted in overlapping bands of diagonals, two k + 1 wide;
the bands that reach the bound are kept and verified by an alignment inside the band, the ends of the document free.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.textbytes import U, map_texts

BITS = 22
GAP = 64  # zeros between texts: more than any edit budget, so no stretch reaches over
WORD = re.compile(r"\S+")


@dataclass(frozen=True)
class Budget:
    """q: characters of a gram. window, stride: of patterns. share: edits for each character, 6 in 96 here.

    slice_chars: characters of benchmark text that are sent to the tasks at once; a larger benchmark takes more
    passes over the documents. Items of fewer than q characters are too short to be evidence and are left out.
    """

    q: int = 12
    window: int = 96
    stride: int = 48
    share: float = 1 / 16
    slice_chars: int = 4 << 20

    def edits(self, m: int) -> int:
        """The budget of a pattern of m characters: as many as leave the lemma a bound of one gram at least."""
        return min(int(m * self.share), (m - self.q) // self.q, GAP // 2 - 1)


def normal(text: str) -> str:
    return " ".join(text.lower().replace("\x00", " ").split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q code points from each place on, by doubling the width."""
    if len(points) < q:
        return np.zeros(0, U)
    width, done, have = 1, 0, points.astype(U) + U(1)
    total: np.ndarray | None = None
    base = 0x9E3779B97F4A7C15
    left = q
    while True:
        if left & 1:
            n = len(points) - (done + width) + 1
            part = have[done : done + n]
            total = part.copy() if total is None else total[:n] * U(pow(base, width, 1 << 64)) + part
            done += width
        left >>= 1
        if not left:
            return total * U(0xBF58476D1CE4E5B9)  # only the upper bits choose a slot
        n = len(have) - width
        have = have[:n] * U(pow(base, width, 1 << 64)) + have[width : width + n]
        width *= 2


class Patterns:
    """The grams of all patterns, sorted by hash, and the patterns themselves."""

    def __init__(self, items: list[tuple[object, str]], budget: Budget):
        self.budget, self.item, self.text = budget, [], []
        for key, text in items:
            points = code_points(normal(text or ""))
            if len(points) < budget.q:
                continue
            last = max(0, len(points) - budget.window)
            for at in sorted({*range(0, last, budget.stride), last}):
                self.item.append(key)
                self.text.append(points[at : at + budget.window])
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.edits = np.array([budget.edits(m) for m in self.size], np.int64)
        self.least = self.size - budget.q + 1 - self.edits * budget.q
        hashes = [gram_hashes(t, budget.q) for t in self.text]
        counts = [len(h) for h in hashes]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, U)
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owner, self.place = flat[order], owner[order], place[order]
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[(self.hashes >> U(64 - BITS)).astype(np.int64)] = True
        self.points = np.zeros((len(self.text), budget.window), np.uint32)
        for i, t in enumerate(self.text):
            self.points[i, : len(t)] = t

    def regions(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, start, end, exclusive) and edits of the stretches of points within budget of a pattern."""
        q, none = self.budget.q, np.zeros(0, np.int64)
        hashes = gram_hashes(points, q)
        if not len(hashes) or not len(self.hashes):
            return none, np.zeros((0, 2), np.int64), none
        known = self.maybe[(hashes >> U(64 - BITS)).astype(np.int64)]
        # A stretch within budget has at least the least bound of grams in so many places.
        reach = self.budget.window + int(self.edits.max())
        hit = np.flatnonzero(known)
        if not len(hit):
            return none, np.zeros((0, 2), np.int64), none
        # Of a run of least hits that lie within reach, all hits within reach of its first are looked at.
        least = int(self.least.min())
        begin = np.flatnonzero(hit[least - 1 :] - hit[: len(hit) - least + 1] < reach)
        marks = np.zeros(len(hit) + 1, np.int32)
        np.add.at(marks, begin, 1)
        np.add.at(marks, np.searchsorted(hit, hit[begin] + reach), -1)
        at = hit[np.cumsum(marks)[:-1] > 0]
        lo = np.searchsorted(self.hashes, hashes[at], side="left")
        n = np.searchsorted(self.hashes, hashes[at], side="right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        entry = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        pattern = self.owner[entry]
        diagonal = np.repeat(at, n) - self.place[entry]
        band = diagonal // (self.edits[pattern] + 1)
        low = int(band.min(initial=0)) - 1
        span = int(band.max(initial=0)) - low + 2
        key = np.concatenate([pattern * span + band - low, pattern * span + band - 1 - low])
        key, count = np.unique(key, return_counts=True)
        pattern, band = key // span, key % span + low
        kept = count >= self.least[pattern]
        return self.verify(points, pattern[kept], band[kept] * (self.edits[pattern[kept]] + 1))

    def verify(self, points: np.ndarray, pattern: np.ndarray, first: np.ndarray):
        """Aligns each pattern along the diagonals from first on; start and end of the best stretch in budget."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for begin in range(0, len(pattern), 4096):
            p, d = pattern[begin : begin + 4096], first[begin : begin + 4096]
            k = int(self.edits[p].max(initial=0))
            width = 2 * (k + 1) + 2 * k
            padded = np.concatenate([np.zeros(GAP, np.uint32), points, np.zeros(GAP + self.budget.window, np.uint32)])
            base = np.clip(d - k + GAP, 0, len(points) + GAP)
            x = np.arange(width)
            cost = np.broadcast_to(x, (len(p), width)).astype(np.int64)  # edits * 1024 + diagonal of the start
            ends = cost.copy()
            for j in range(int(self.size[p].max(initial=0))):
                doc = padded[np.minimum(base[:, None] + j + x, len(padded) - 1)]
                step = cost + 1024 * (doc != self.points[p, j][:, None])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1024)
                step = np.minimum.accumulate(step - 1024 * x, axis=1) + 1024 * x
                cost = step
                ending = self.size[p] == j + 1
                ends[ending] = cost[ending]
            best = ends.argmin(axis=1)
            value = ends[np.arange(len(p)), best]
            edits, start = value // 1024, base - GAP + value % 1024
            end = base - GAP + best + self.size[p]
            good = edits <= self.edits[p]
            found.append((p[good], np.stack([start, end], axis=1)[good], edits[good]))
        if not found:
            none = np.zeros(0, np.int64)
            return none, np.zeros((0, 2), np.int64), none
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_SPACES = np.array([chr(i).isspace() or i == 0 for i in range(0x3001)])


def raw_places(text: str) -> np.ndarray:
    """For each character of normal(text), its place in the text; one entry more, for the end."""
    if len(text.lower()) == len(text):
        points = code_points(text)
        solid = ~((points <= 0x3000) & _SPACES[np.minimum(points, 0x3000)])
        if not solid.any():
            return np.zeros(1, np.int64)
        # The first blank after a word stands for the space that follows it; there is none after the last word.
        stays = solid.copy()
        stays[1:] |= solid[:-1]
        end = int(np.flatnonzero(solid)[-1]) + 1
        return np.r_[np.flatnonzero(stays[:end]), end]
    out: list[int] = []
    end = 0
    for word in WORD.finditer(text.replace("\x00", " ")):
        if out:
            out.append(end)
        size, small = word.end() - word.start(), len(word[0].lower())
        out += [word.start() + min(i, size - 1) for i in range(small)]
        end = word.end()
    return np.array([*out, end], np.int64)


def search(patterns: Patterns, texts: list[str]) -> Iterator[tuple[int, object, int, int, int]]:
    """(text, item, start, end, edits): the stretches of every text that leak an item, overlapping ones as one."""
    points: list[np.ndarray] = []
    at, place = [], 0
    gap = np.zeros(GAP, np.uint32)
    for t in texts:
        at.append(place)
        points += [code_points(normal(t)), gap]
        place += len(points[-2]) + GAP
    if not points:
        return
    pattern, spans, edits = patterns.regions(np.concatenate(points))
    owner = np.searchsorted(at, spans[:, 0], side="right") - 1
    rows: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    numbers = {k: i for i, k in enumerate(dict.fromkeys(patterns.item))}
    names = list(numbers)
    for t, p, (a, b), e in zip(owner.tolist(), pattern.tolist(), spans.tolist(), edits.tolist(), strict=True):
        rows.setdefault((t, numbers[patterns.item[p]]), []).append((a - at[t], b - at[t], e))
    places: dict[int, np.ndarray] = {}
    for (t, item), found in sorted(rows.items()):
        if t not in places:
            places = {t: raw_places(texts[t])}
        where = places[t]
        merged: list[list[int]] = []
        for a, b, e in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1:] = [max(merged[-1][1], b), max(merged[-1][2], e)]
            else:
                merged.append([a, b, e])
        for a, b, e in merged:
            a, b = max(a, 0), min(b, len(where) - 1)
            if b > a:
                yield t, names[item], int(where[a]), int(where[b - 1]) + 1, e


def slices(benchmark: DataFrame, budget: Budget) -> Iterator[list[tuple[object, str]]]:
    """The items in parts of bounded size, each read by itself. One item is never cut."""
    size = F.length(F.coalesce("text", F.lit("")))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    parts = math.ceil(total / budget.slice_chars)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    for i in range(parts):
        yield [tuple(r) for r in benchmark.where(part == i).select("item_id", "text").dropDuplicates().collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, budget: Budget | None = None) -> DataFrame:
    """doc_id, item_id, start, end and edits of every stretch of a document that leaks an item.

    start and end are code points of the raw text, edits the most of any pattern in the stretch. Null texts are
    empty. Rows that repeat a document give its stretches again; items of equal text give each their own. A long text is
    searched in a slice of its own. Other columns are not read; without documents or items there are no rows.
    """
    budget = budget or Budget()
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start bigint, end bigint, edits bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in slices(benchmark, budget):
        out = out.unionByName(map_texts(docs.select("doc_id", "text"), "text", _finder(docs, items, budget, False), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, budget: Budget | None = None) -> DataFrame:
    """The documents without a leak, with all their columns."""
    budget = budget or Budget()
    names = [f"_c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    out = docs.toDF(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema)
    for items in slices(benchmark, budget):
        out = map_texts(out, "text", _finder(docs, items, budget, True), schema)
    return out.toDF(*docs.columns)


def _finder(docs: DataFrame, items: list, budget: Budget, drop: bool):
    shared = docs.sparkSession.sparkContext.broadcast(items)
    ready: list[Patterns] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not ready:
            ready.append(Patterns(shared.value, budget))
        found = list(search(ready[0], [t or "" for t in batch.column("text").to_pylist()]))
        if drop:
            clean = np.ones(batch.num_rows, bool)
            clean[[f[0] for f in found]] = False
            return batch.filter(pa.array(clean))
        if not found:
            return None
        text, item, start, end, edits = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(text)), pa.array(item), *[pa.array(x, pa.int64()) for x in (start, end, edits)]],
            ["doc_id", "item_id", "start", "end", "edits"],
        )

    return work
