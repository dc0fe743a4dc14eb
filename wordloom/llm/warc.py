"""Resolution of not-modified revisits in web archives, in DataFrame functions.

A revisit says that a server answered "not modified". It is joined as of its date to the latest earlier full
response of the same canonical URL. The validators it carries must agree with that response; then the response's
headers are updated by those that such an answer may change.

Records are dealt by ranges of (URL, date), so the captures of one URL, however many, go to many tasks. Inside a range
a window looks back; what a range needs from earlier ones is one response, found among one row for each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.sources.session import saved

# Fixed by the HTTP caching rules: what a not-modified answer does not change, and fields of one connection.
KEPT_FROM_RESPONSE = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
HEADERS = "array<struct<name:string,value:string>>"


def canonical(url: Column) -> Column:
    """Scheme and `www.` dropped, host in lower case without its default port, no fragment, no utm_ parameters,
    no slash at the end."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"(?i)^https?://(www\.)?", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r":(80|443)$", ""))
    path = F.regexp_replace(bare, r"^[^/?]*", "")
    path = F.regexp_replace(path, r"([?&])utm_[^&]*(?=&|$)", "$1")
    path = F.regexp_replace(F.regexp_replace(path, r"&+(?=&|$)", ""), r"\?&", "?")
    return F.concat(host, F.regexp_replace(F.regexp_replace(path, r"\?$", ""), r"/+(?=\?|$)", ""))


def header(headers: Column, name: str) -> Column:
    """The first value of that name, whatever its case."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def validated(revisit: Column, response: Column) -> Column:
    """Whether the revisit's validator agrees: its entity tag, compared weakly, or else its date of change."""
    tag, old_tag = (F.regexp_replace(header(h, "etag"), r"^W/", "") for h in (revisit, response))
    date, old_date = header(revisit, "last-modified"), header(response, "last-modified")
    return F.when(tag.isNotNull(), F.coalesce(tag == old_tag, F.lit(False))).otherwise(
        F.coalesce(date == old_date, F.lit(False))
    )


def merged(revisit: Column, response: Column) -> Column:
    """The response's headers, those that the revisit brings and may change replaced; by name, in lower case."""
    may = F.filter(revisit, lambda h: ~F.lower(h["name"]).isin(*KEPT_FROM_RESPONSE))
    names = F.transform(may, lambda h: F.lower(h["name"]))
    rest = F.filter(response, lambda h: ~F.array_contains(names, F.lower(h["name"])))
    lowered = F.transform(
        F.concat(rest, may), lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value"))
    )
    return F.array_sort(lowered)


def resolve(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """record_id, url (canonical), date, response_id, state and headers of every revisit.

    records: record_id, url, date, kind (`response` for full ones, `revisit`; others are passed over), headers (array
    of name and value). Earlier is by date alone; of responses of one date the greatest record_id is the latest.
    state: `resolved`; `changed` if the validators disagree; `unvalidated` if the revisit has none; `missing` if there
    is no earlier response, or the revisit has no URL or date. response_id and headers are null unless resolved.
    A null header list is empty, an entry without a name is passed over; repeated records are resolved each by itself.
    Of a name that a response repeats all entries stay, and the first is its validator; other columns are not read, and an
    empty table gives no rows.
    """
    spark = records.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    known = F.coalesce("headers", F.array().cast(HEADERS))
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical(F.col("url")).alias("url"),
        "date",
        # A revisit comes before the responses of its date, which are not earlier.
        (F.col("kind") == "response").alias("full"),
        F.filter(known, lambda h: h["name"].isNotNull()).cast(HEADERS).alias("headers"),
    )
    whole = rows.where("url is not null and date is not null")
    order = ["url", "date", "full", "record_id"]
    placed = saved(
        whole.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    )
    response = F.struct(F.col("record_id").alias("id"), "headers")
    before = Window.partitionBy("_part", "url").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    looked = placed.withColumn("_near", F.last(F.when(F.col("full"), response), ignorenulls=True).over(before))

    # One row for each range and URL that begins a range: what the range leaves behind for that URL.
    begins = placed.groupBy("_part").agg(F.min_by("url", "_at").alias("url"))
    starts = begins.select("url").distinct()
    tails = (
        placed.where("full").join(starts, "url", "left_semi").groupBy("_part", "url")
        .agg(F.max_by(response, "_at").alias("_tail"))
    )
    earlier = Window.partitionBy("url").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = begins.join(tails, ["_part", "url"], "full_outer")
    carried = spans.select("_part", "url", F.last("_tail", ignorenulls=True).over(earlier).alias("_far"))
    found = (
        looked.where(~F.col("full"))
        .join(carried.where("_far is not null"), ["_part", "url"], "left")
        .withColumn("_response", F.coalesce("_near", "_far"))
    )
    lost = rows.where("not full and (url is null or date is null)").withColumn(
        "_response", F.lit(None).cast(found.schema["_response"].dataType)
    )
    columns = ["record_id", "url", "date", "headers", "_response"]
    revisits = found.select(*columns).unionByName(lost.select(*columns))
    has = header(F.col("headers"), "etag").isNotNull() | header(F.col("headers"), "last-modified").isNotNull()
    state = (
        F.when(F.col("_response").isNull(), "missing")
        .when(~has, "unvalidated")
        .when(validated(F.col("headers"), F.col("_response.headers")), "resolved")
        .otherwise("changed")
    )
    good = F.col("state") == "resolved"
    return revisits.withColumn("state", state).select(
        "record_id", "url", "date", F.when(good, F.col("_response.id")).alias("response_id"), "state",
        F.when(good, merged(F.col("headers"), F.col("_response.headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Archive records drawn from pages: of each a full response, a later revisit and one just before the response.

    page_id stands for the time. The first revisit carries an entity tag, a stale one for every fifth page; the other
    one the date of change of the page of the same URL before it, as far as that is known: of its own page.
    """

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    size = F.length(F.coalesce("html", F.lit("")))
    full = F.array(
        entry("ETag", tag), entry("Last-Modified", page), entry("Content-Type", F.lit("text/html")),
        entry("Content-Length", size), entry("Cache-Control", F.lit("max-age=60")),
    )
    stale = F.when(page % 5 == 0, F.lit('W/"stale"')).otherwise(F.concat(F.lit("W/"), tag))
    later = F.array(
        entry("etag", stale), entry("cache-control", F.concat(F.lit("max-age="), page % 100)),
        entry("content-length", F.lit(0)), entry("x-cache", F.lit("hit")),
    )
    sooner = F.array(entry("Last-Modified", page), entry("Content-Length", F.lit(0)))
    record = [
        F.struct((page * 3).alias("record_id"), F.col("url").alias("url"), (page * 1000).alias("date"),
                 F.lit("response").alias("kind"), full.alias("headers")),
        F.struct((page * 3 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"),
                 (page * 1000 + 500 + page % 7 * 100_000).alias("date"), F.lit("revisit").alias("kind"), later.alias("headers")),
        F.struct((page * 3 + 2).alias("record_id"), F.col("url").alias("url"), (page * 1000 - 500).alias("date"),
                 F.lit("revisit").alias("kind"), sooner.alias("headers")),
    ]
    return pages.select(F.explode(F.array(*record)).alias("r")).select("r.*")
