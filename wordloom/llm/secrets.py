"""Secret scan with ownership frequency over the whole corpus, in DataFrame functions only.

Patterns give candidate spans. The value of each candidate is hashed, and the corpus tells in how many owners and
repositories that hash stands. One that many owners share, or a few in many repositories, is a copied example. One that an
owner has for itself, in however many repositories, is live unless it reads like a placeholder. Candidates of the base
kinds always stay; those of the kind `vendor`, whose patterns are wider, stay only if they are live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.sources.session import saved

# Fixed by the query's contract: kind, pattern, group of the value, its least length.
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Shorter runs fail anyway, and a run of 32 or more begins where the whole run does.
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
VENDOR = (
    "vendor",
    r"gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{24,}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+|-----BEGIN [A-Z ]*PRIVATE KEY-----",
    0,
    10,
)
KINDS = (*BASE_KINDS, VENDOR)
# What placeholders say, and how many different characters a value has that is none.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|change_?me|your_|redacted|xxxx"
LEAST_DISTINCT = 5
OWN = ("_row", "_repository", "_owner", "_matches", "spans")  # columns of the scan; those of docs are left out


def _found(text: Column, pattern: str, group: int) -> Column:
    """Array of (before, size, value) for each match, in order: characters since the last match, and its own."""
    rx = F.lit(pattern)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, rx, F.lit(group))
    before = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(before.alias("before"), F.transform(whole, F.length).alias("size"), value.alias("value"))
    # There is one piece more than matches.
    return F.when(text.rlike(pattern), F.slice(zipped, 1, F.size(whole)))


def scan(docs: DataFrame, repository: Column, owner: Column, text: str = "text") -> DataFrame:
    """_row, repository, owner, _matches and the other columns of docs but the text, written once."""
    whole = F.coalesce(F.col(text), F.lit(""))
    matches = F.array(
        *[
            F.coalesce(_found(whole, pattern, group), F.array().cast("array<struct<before:int,size:int,value:string>>"))
            for _, pattern, group, _ in KINDS
        ]
    )
    rest = [F.col(c) for c in docs.columns if c != text and c not in OWN]
    return saved(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), repository.alias("_repository"), owner.alias("_owner"),
            matches.alias("_matches"), *rest,
        )
    )


def reads_live(value: Column) -> Column:
    """Whether a value is none that people write in place of a secret."""
    return ~value.rlike(PLACEHOLDER) & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT)


def candidates(scanned: DataFrame) -> DataFrame:
    """_row, _repository, _owner, kind (its number), start, end, digest and reads_live of every match that is long enough."""
    by_kind = scanned.select("_row", "_repository", "_owner", F.posexplode("_matches").alias("kind", "_list"))
    each = by_kind.select("_row", "_repository", "_owner", "kind", F.posexplode("_list").alias("_i", "_m"))
    so_far = Window.partitionBy("_row", "kind").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_m.before").cast("bigint") + F.col("_m.size")).over(so_far)
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    return (
        each.select("*", end.alias("end"))
        .where(F.length("_m.value") >= least)
        .select(
            "_row", "_repository", "_owner", "kind", (F.col("end") - F.col("_m.size")).alias("start"), "end",
            F.sha2("_m.value", 256).alias("digest"), reads_live(F.col("_m.value")).alias("reads_live"),
        )
    )


def ownership(found: DataFrame, copied_owners: int = 3, copied_repositories: int = 6) -> DataFrame:
    """digest, n_owners, n_repositories and copied: whether copied_owners owners have the value, or two or more have it in
    copied_repositories repositories. What one owner has alone is never copied, in however many repositories it stands.

    A digest's rows first become one for each owner and repository, so a value that a third of all documents
    hold is no large group afterwards. A null owner counts as one owner.
    """
    owner = F.coalesce(F.col("_owner"), F.lit(""))
    places = found.groupBy("digest", owner.alias("_owner"), F.coalesce("_repository", F.lit("")).alias("_repository")).agg(
        F.count(F.lit(1)).alias("n")
    )
    owners = places.groupBy("digest", "_owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_owners"),
        F.sum("repositories").alias("n_repositories"),
        F.sum("n").alias("n_spans"),
    ).withColumn(
        "copied",
        (F.col("n_owners") >= copied_owners) | ((F.col("n_owners") >= 2) & (F.col("n_repositories") >= copied_repositories)),
    )


def find_secrets(
    docs: DataFrame, repository: Column, owner: Column, text: str = "text", copied_owners: int = 3, copied_repositories: int = 6
) -> DataFrame:
    """The columns of docs but the text, and spans: array of (start, kind, end, name, copied, live, n_owners) by start.

    Offsets are code points, the end exclusive. A null text is empty. A document without spans has an empty array.
    Repeated rows are scanned each by itself. A null owner or repository counts as one. Columns of docs that are
    named as the scan's own (OWN) are left out.
    """
    scanned = scan(docs, repository, owner, text)
    found = saved(candidates(scanned))
    judged = found.join(ownership(found, copied_owners, copied_repositories), "digest")
    judged = judged.withColumn("live", ~F.col("copied") & F.col("reads_live"))
    kept = judged.where((F.col("kind") < len(BASE_KINDS)) | F.col("live"))
    name = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", "end", name.alias("name"), "copied", "live", "n_owners")
    spans = kept.groupBy("_row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return (
        scanned.drop("_matches", "_repository", "_owner")
        .join(spans, "_row", "left")
        .withColumn("spans", F.coalesce("spans", empty))
        .drop("_row")
    )


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def is_base(span: Column) -> Column:
    return span["kind"] < len(BASE_KINDS)


def count_of(spans: Column, name: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["name"] == name)).cast("bigint")


def redact(
    docs: DataFrame, repository: Column, owner: Column, copied_owners: int = 3, copied_repositories: int = 6
) -> DataFrame:
    """docs with every live span replaced by its kind in brackets; copied examples and placeholders stay as they are.

    Spans that overlap are replaced as one, named by the first. n_chars, where docs has it, is that of the new text.
    Other columns and the number of rows stay. Spans come back to their text by its id and a hash of it.
    """
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    source = docs.select(
        "doc_id", "text", own.alias("_mark"), repository.alias("_place"), owner.alias("_holder")
    )
    found = find_secrets(source, F.col("_place"), F.col("_holder"), "text", copied_owners, copied_repositories)
    live = F.filter("spans", lambda s: s["live"])
    spans = (
        found.select(F.col("doc_id").alias("_doc"), "_mark", live.alias("_live"))
        .where(F.size("_live") > 0)
        .groupBy("_doc", "_mark")
        .agg(F.first("_live").alias("_live"))
    )
    names = [f"_c{i}" for i in range(len(docs.columns))]
    doc, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    plain = docs.toDF(*names).withColumn("_own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = plain.join(spans, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_mark")), "left")

    def step(done: Column, span: Column) -> Column:
        between = F.substring(F.col(text), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        named = F.concat(F.lit("["), span["name"], F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(span["start"] >= done["at"], F.concat(done["parts"], F.array(between, named)))
            .otherwise(done["parts"])
            .alias("parts"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate("_live", start, step)
    rest = F.substring(F.col(text), (cut["at"] + 1).cast("int"), F.length(text))
    out = joined.withColumn(
        text, F.when(F.col("_live").isNull(), F.col(text)).otherwise(F.concat(F.array_join(cut["parts"], ""), rest))
    )
    if "n_chars" in docs.columns:
        size = names[docs.columns.index("n_chars")]
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(size, F.when(F.col("_live").isNull(), F.col(size)).otherwise(F.length(text)).cast(kind))
    return out.select(*names).toDF(*docs.columns)
