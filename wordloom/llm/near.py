"""N-gram Jaccard join: MinHash bands, Bayesian pruning of candidates, exact verification.

Texts are sets of shingles of five words; two texts are linked if their Jaccard similarity is at least 0.8.

1. Equal texts become one node, so copies are never paired.
2. Texts that share a band of MinHash values are candidates. In a bucket they are compared value by value, some at a
   time: after m of n equal values, the posterior chance that the similarity reaches the threshold (uniform prior) is
   P(Binomial(n + 1, threshold) <= m); a pair is dropped as soon as it falls below the tolerance.
3. Survivors join their nodes into groups; inside a group similarities are computed exactly from the shingles.
   Links are counted, and classes are the components of the links.

Large buckets and groups are cut into blocks; a task holds two blocks. No pairs leave a task: it sends a tree of the
nodes that it found together, and a number of links for each node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.components import components
from wordloom.llm.quality_rules import tail
from wordloom.llm.textbytes import Texts, U, map_texts, mix
from wordloom.sources.session import saved


@dataclass(frozen=True)
class Nearness:
    """threshold: numerator and denominator. A true pair at the threshold shares no band with a chance of
    (1 - 0.8^rows)^bands, 3e-6 here; beyond it the chance falls fast. block, pruning_block: texts of one side of a task that verifies or prunes;
    signatures are small, so larger blocks send each text to fewer tasks."""

    words: int = 5
    threshold: tuple[int, int] = (4, 5)
    bands: int = 24
    rows: int = 4
    step: int = 16
    tolerance: float = 1e-6
    block: int = 128
    pruning_block: int = 512
    seed: int = 7

    @property
    def values(self) -> int:
        return self.bands * self.rows

    def least_equal(self) -> list[tuple[int, int]]:
        """(values compared, least number that must be equal) after each step."""
        share = self.threshold[0] / self.threshold[1]
        ends = [*range(self.step, self.values, self.step), self.values]
        return [(n, next(m for m in range(n + 1) if tail(m, n + 1, share) >= self.tolerance)) for n in ends]


def shingles(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the shingles of all texts; a text of fewer words, but one at least, is one shingle."""
    starts, _, owner = texts.words()
    hashes = texts.word_hashes()
    first, found = texts.windows(words, hashes)
    counts = np.bincount(owner, minlength=texts.n)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if not len(short):
        return owner[first], found
    begin = np.searchsorted(owner, short)
    extra = np.zeros(len(short), U)
    for k in range(words - 1):
        has = counts[short] > k
        extra[has] = mix(extra[has] * U(0x9E3779B97F4A7C15) + hashes[begin[has] + k] + U(k + 1))
    owners, all_hashes = np.concatenate([owner[first], short]), np.concatenate([found, extra])
    order = np.argsort(owners, kind="stable")
    return owners[order], all_hashes[order]


def signatures(owner: np.ndarray, hashes: np.ndarray, n: int, near: Nearness) -> np.ndarray:
    """[n, values] least values of linear functions of the shingles modulo 2^32; rows without shingles are zero."""
    out = np.zeros((n, near.values), np.uint32)
    if not len(owner):
        return out
    rng = np.random.default_rng(near.seed)
    factors = rng.integers(0, 1 << 31, near.values, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, near.values, dtype=np.uint32)
    low = (hashes >> U(32)).astype(np.uint32)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    rows = owner[starts]
    for k in range(near.values):
        out[rows, k] = np.minimum.reduceat(low * factors[k] + shifts[k], starts)
    return out


def _digest(column: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")), 256))


def sketch(docs: DataFrame, near: Nearness) -> DataFrame:
    """doc_id, digest, size (shingles, repeats counted) and sig of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column("text"))
        owner, hashes = shingles(texts, near.words)
        found = signatures(owner, hashes, texts.n, near)
        sig = pa.array([row.tobytes() for row in found], pa.binary())
        size = np.bincount(owner, minlength=texts.n).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(size), sig], ["doc_id", "digest", "size", "sig"]
        )

    return map_texts(
        docs.select("doc_id", "text", _digest().alias("digest")), "text", work,
        f"doc_id {kind}, digest binary, size bigint, sig binary",
    )


def in_blocks(rows: DataFrame, size: str, spread: str, block: int) -> DataFrame:
    """rows with _own, _i, _j: the rows of a group, dealt to pairs of its blocks; a small group is one block."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(spread, F.lit(1)), F.col("_blocks")).cast("int")
    return (
        rows.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_blocks", "_other")
    )


def by_group(
    rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """work(rows of whole groups, number of the group of each row), streamed; a group is the rows of equal keys."""
    placed = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finished(upto: int | None, table: pa.Table, number: np.ndarray):
            if upto is None or upto > 0:
                part = table.slice(0, upto)
                out = work(part, number[:upto])
                if out is not None and out.num_rows:
                    yield out

        def numbers(table: pa.Table) -> np.ndarray:
            changes = np.zeros(table.num_rows, bool)
            for k in keys:
                v = table.column(k).to_numpy()
                changes[1:] |= v[1:] != v[:-1]
            return np.cumsum(changes)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            number = numbers(table)
            last = int(np.searchsorted(number, number[-1]))
            yield from finished(last, table, number)
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from finished(None, table, numbers(table))

    return placed.mapInArrow(run, schema)


def pairs_of(number: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of the same group, some at a time: all pairs of a block, or those across two blocks."""
    ends = np.searchsorted(number, number, side="right")
    rows, d = np.arange(len(number)), 1
    same = i == j
    while len(rows):
        rows = rows[rows + d < ends[rows]]
        wanted = same[rows] | (own[rows] != own[rows + d])
        if wanted.any():
            yield rows[wanted], rows[wanted] + d
        d += 1


def trees(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that pairs (a, b) join it to."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label


def surviving(bucketed: DataFrame, near: Nearness) -> DataFrame:
    """a, b: trees over the nodes of a bucket whose pairs survive the pruning. bucketed: key, node, sig, _own, _i, _j."""
    limits = near.least_equal()

    def work(table: pa.Table, number: np.ndarray) -> pa.RecordBatch | None:
        node = table.column("node").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(node), near.values)
        left, right = [], []
        for a, b in pairs_of(number, *[table.column(c).to_numpy() for c in ("_own", "_i", "_j")]):
            equal, begin = np.zeros(len(a), np.int32), 0
            for end, least in limits:
                equal += (sig[a, begin:end] == sig[b, begin:end]).sum(axis=1)
                alive = equal >= least
                a, b, equal, begin = a[alive], b[alive], equal[alive], end
            left.append(a)
            right.append(b)
        if not left:
            return None
        label = trees(len(node), np.concatenate(left), np.concatenate(right))
        joined = np.flatnonzero(label != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[label[joined]]), pa.array(node[joined])], ["a", "b"])

    return by_group(bucketed, ["key", "_i", "_j"], work, "a bigint, b bigint")


def exact_links(sets: list[np.ndarray], near: Nearness) -> np.ndarray:
    """Boolean matrix of the sets (ascending, distinct) whose similarity reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    common = np.zeros((n, n))
    width = max(1, (4 << 20) // max(n, 1))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [begin, begin + width])
        block = np.zeros((n, width), np.float32)
        block[owner[lo:hi], column[lo:hi] - begin] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    up, down = near.threshold
    linked = (down * common >= up * union) & (sizes[:, None] > 0) & (sizes[None, :] > 0)
    np.fill_diagonal(linked, False)
    return linked


def verified(members: DataFrame, near: Nearness) -> DataFrame:
    """node, links, to: links of a node inside its pair of blocks, and the tree that they make."""

    def work(table: pa.Table, number: np.ndarray) -> pa.RecordBatch | None:
        node, own = table.column("node").to_numpy(), table.column("_own").to_numpy()
        one = table.column("_i").to_numpy() == table.column("_j").to_numpy()
        raw = table.column("shingles").to_pylist()
        starts = np.r_[np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(node)]
        nodes, links, to = [], [], []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if hi - lo < 2:
                continue
            linked = exact_links([np.frombuffer(r, U) for r in raw[lo:hi]], near)
            if not one[lo]:
                linked &= own[lo:hi, None] != own[None, lo:hi]
            label = trees(hi - lo, *np.nonzero(np.triu(linked)))
            nodes.append(node[lo:hi])
            links.append(linked.sum(axis=1))
            to.append(node[lo:hi][label])
        if not nodes:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (nodes, links, to)], ["node", "links", "to"]
        )

    return by_group(members, ["root", "_i", "_j"], work, "node bigint, links bigint, to bigint")


def join_near(docs: DataFrame, near: Nearness | None = None) -> DataFrame:
    """doc_id, class_id, n_links, n_copies and digest of every document.

    class_id is the least doc_id of the class, n_links the number of other texts with a similarity of 0.8 or more,
    n_copies the number of documents of the same text, itself included. Equal texts are in one class always, empty
    ones too; a null text is empty; an empty text has no links. A text of fewer than five words is one shingle.
    Repeated rows count as copies. A class of null ids alone has a null class_id. Other columns are ignored, and
    an empty table gives no rows. A long text is sketched in a slice of its own; when it is verified, its block holds all its shingles.
    """
    return classed(docs, near).select("doc_id", "class_id", "n_links", "n_copies", "digest")


def classed(docs: DataFrame, near: Nearness | None = None) -> DataFrame:
    """What join_near gives, and class: a number that tells classes apart even where ids are null or repeated."""
    near = near or Nearness()
    sketched = saved(sketch(docs.select("doc_id", "text"), near))
    nodes = saved(
        sketched.groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"),
            F.first("sig").alias("sig"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    width = 4 * near.rows
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", width * b + 1, width)) for b in range(near.bands)])
    banded = nodes.where("size > 0").select("node", F.explode(bands).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bucketed = banded.join(shared, "key").join(nodes.select("node", "sig"), "node")
    candidates = surviving(in_blocks(bucketed, "n", "node", near.pruning_block), near)
    groups = components(candidates)

    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = groups.join(sizes, "root").join(nodes.select("node", "doc", F.col("digest").alias("_digest")), "node")
    texts = docs.select("doc_id", "text", _digest().alias("digest"))
    found = texts.join(
        wanted, texts["doc_id"].eqNullSafe(wanted["doc"]) & (texts["digest"] == wanted["_digest"])
    ).select("node", "root", "n", "text")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = Texts(batch.column("text"))
        owner, hashes = shingles(made, near.words)
        at = np.searchsorted(owner, np.arange(made.n + 1))
        sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("node", "root", "n")], pa.array(sets, pa.binary())],
            ["node", "root", "n", "shingles"],
        )

    members = saved(map_texts(found, "text", cut, "node bigint, root bigint, n bigint, shingles binary"))
    # Rows that repeat an id with its text would come twice; the narrow count tells whether there are any.
    if members.groupBy("node").count().where("count > 1").limit(1).count():
        members = members.dropDuplicates(["node"])
    linked = saved(verified(in_blocks(members, "n", "node", near.block), near))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(linked.select(F.col("node").alias("a"), F.col("to").alias("b")))

    placed = nodes.select("node", "digest", "doc", "copies").join(classes, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("doc").alias("class_id"))
    known = placed.join(least, "root").join(links, "node", "left")
    return sketched.select("doc_id", "digest").join(
        known.select("digest", F.col("root").alias("class"), "class_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies")),
        "digest",
    ).select("doc_id", "class", "class_id", "n_links", "n_copies", "digest")


def one_of_each(docs: DataFrame, near: Nearness | None = None) -> DataFrame:
    """One document of each class, that of the least id, with all its columns.

    Null ids come last. Rows that repeat an id with its text count as one document, and one of them stays.
    """
    rows = classed(docs, near).groupBy("class", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "rows")).alias("first")
    chosen = saved(
        rows.groupBy("class").agg(first).select(
            F.col("first.doc_id").alias("_doc"), F.col("first.digest").alias("_digest"), F.col("first.rows").alias("_rows")
        )
    )
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    kept = plain.withColumn("_own", _digest(text)).join(
        chosen, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_digest"))
    )
    if chosen.where("_rows > 1").limit(1).count():
        kept = kept.where("_rows = 1").unionByName(kept.where("_rows > 1").dropDuplicates(["_doc", "_digest"]))
    return kept.select(*names).toDF(*docs.columns)
