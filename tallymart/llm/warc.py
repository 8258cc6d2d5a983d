"""Not-modified revisit records of web archives, resolved to the response they stand for.

A revisit takes the latest earlier full response (status 200) of the same canonical URL, by (date, record
id). Validators must agree: ETags without regard to weakness if both have one, else Last-Modified if both
have one; a revisit that differs, or has nothing to compare, is not resolved. A resolved record has the
response's payload and its headers, updated with the revisit's, except those that describe a message
rather than the resource.

The as-of join runs on narrow rows, payloads are joined after it by record id. It goes by blocks of time:
inside a block by a window, and over the last response of each block, so that a URL with a large share of
the captures is spread over as many tasks as it has blocks.

Null URLs, dates or record ids: the row takes no part as a response; as a revisit it has no earlier one.
Rows with one record id that is not unique are resolved each; the largest payload of the response's id is
taken. Header names are compared in lower case; of repeated names the last one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import stored

BLOCK_SECONDS = 86_400

# Query parameters that name a visit, not a page.
VISIT = r"^(utm_[a-z]+|ref|sessionid|jsessionid|phpsessid|sid)="

# Headers a not-modified answer does not update (RFC 9111, 3.2).
KEPT_HEADERS = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authentication-info proxy-authorization te trailer transfer-encoding upgrade"
).split()

RESOLVED, NONE, DIFFERS, UNVERIFIED = "resolved", "no_earlier_response", "validator_differs", "no_validator"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www, user and default port; path without trailing slashes; parameters
    sorted, without those that name a visit; no scheme and no fragment."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    for part in ("^.*@", ":(80|443)$", r"^www[0-9]*\."):
        host = F.regexp_replace(host, part, "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    params = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    params = F.array_join(F.sort_array(F.filter(params, lambda p: (p != "") & ~p.rlike(VISIT))), "&")
    return F.concat(host, path, F.when(params != "", F.concat(F.lit("?"), params)).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """The headers with names in lower case; the last of a repeated name stays."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(named, lambda e: e["key"])
    last = F.filter(named, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), e["key"]))
    return F.map_from_entries(last)


def merged_headers(old: Column, new: Column) -> Column:
    permitted = F.map_filter(new, lambda k, v: ~k.isin(KEPT_HEADERS))
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(permitted), k)), permitted)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Of (record_id, url, date, kind, status, headers, payload): one row per row of kind ``revisit``:
    record_id, canonical_url, date, outcome, source_id, headers, payload. Without a source the headers are
    the revisit's own and there is no payload."""
    rows = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("page"),
        "date",
        (F.col("kind") == "revisit").alias("revisit"),
        ((F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull()).alias("full"),
        lower_names(F.col("headers")).alias("headers"),
    ).filter("revisit OR full")
    # Rows without a URL or date cannot match; each would else be a group of its own kind.
    usable = rows.filter("page IS NOT NULL AND date IS NOT NULL")
    usable = usable.withColumn("block", F.floor(F.unix_seconds("date") / BLOCK_SECONDS))
    usable = stored(usable, "captures")
    source = F.when(F.col("full"), F.struct("record_id", "headers"))
    order = [F.col("date"), F.col("record_id").asc_nulls_first()]
    before = Window.partitionBy("page", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = usable.withColumn("near", F.last(source, ignorenulls=True).over(before)).filter("revisit")
    # The last response of each block, for the revisits of later blocks.
    lasts = usable.groupBy("page", "block").agg(F.max_by(F.when(F.col("full"), F.struct("record_id", "headers")), F.when(F.col("full"), F.struct("date", "record_id"))).alias("last"))
    earlier = Window.partitionBy("page").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.withColumn("far", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    found = inside.join(lasts, ["page", "block"]).withColumn("source", F.coalesce("near", "far"))
    lost = rows.filter("revisit AND (page IS NULL OR date IS NULL)")
    lost = lost.withColumn("source", F.lit(None).cast(found.schema["source"].dataType))
    columns = ["record_id", "page", "date", "headers", "source"]
    found = found.select(*columns).union(lost.select(*columns))

    def tag(headers: Column, name: str) -> Column:
        return F.regexp_replace(F.trim(headers[name]), "^W/", "")

    mine, theirs = F.col("headers"), F.col("source.headers")
    by_tag = tag(mine, "etag") == tag(theirs, "etag")
    by_date = F.trim(mine["last-modified"]) == F.trim(theirs["last-modified"])
    same = F.coalesce(by_tag, by_date)
    outcome = F.when(F.col("source").isNull(), NONE).when(same, RESOLVED).when(~same, DIFFERS).otherwise(UNVERIFIED)
    found = found.withColumn("outcome", outcome)
    good = F.col("outcome") == RESOLVED
    found = found.select(
        "record_id",
        F.col("page").alias("canonical_url"),
        "date",
        "outcome",
        F.when(good, F.col("source.record_id")).alias("source_id"),
        F.when(good, merged_headers(theirs, mine)).otherwise(mine).alias("headers"),
    )
    payloads = records.filter((F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull())
    payloads = payloads.groupBy(F.col("record_id").alias("source_id")).agg(F.max("payload").alias("payload"))
    # Revisits without a source would all meet in one task of the join; the second key spreads them.
    spread = F.when(F.col("source_id").isNotNull(), F.xxhash64("source_id")).otherwise(F.xxhash64("record_id", "canonical_url", "date"))
    found = found.withColumn("spread", spread)
    payloads = payloads.withColumn("spread", F.xxhash64("source_id"))
    return found.join(payloads, ["source_id", "spread"], "left").select(
        "record_id", "canonical_url", "date", "outcome", "source_id", "headers", "payload"
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Captures of web pages, as an archive of them would hold: each page's response and a revisit half an
    hour later under another spelling of its URL; of every fifth page one whose validator differs, of
    every seventh one from before the response."""
    digest = F.md5(F.coalesce("html", F.lit("")))
    first = F.lit(1_700_000_000) + F.col("page_id") * 60
    host_on = F.regexp_replace("url", "^https?://(www[.])?", "")

    def record(number: int, url: Column, seconds: Column, kind: str, status: int, headers: dict[str, Column], payload: Column):
        made = F.create_map(*[x for k, v in headers.items() for x in (F.lit(k), v)])
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"),
            url.alias("url"),
            F.timestamp_seconds(seconds).alias("date"),
            F.lit(kind).alias("kind"),
            F.lit(status).alias("status"),
            made.alias("headers"),
            payload.alias("payload"),
        )

    tag = F.concat(F.lit('"'), digest, F.lit('"'))
    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    none = F.lit(None).cast("string")
    response = {"ETag": tag, "Content-Type": F.lit("text/html"), "Content-Length": size, "Cache-Control": F.lit("max-age=60")}
    again = {"etag": F.concat(F.lit("W/"), tag), "content-length": F.lit("0"), "cache-control": F.lit("max-age=600")}
    other = {"ETag": F.lit('"other"')}
    all_ = F.array_compact(
        F.array(
            record(0, F.col("url"), first, "response", 200, response, F.col("html")),
            record(1, F.concat(F.lit("HTTPS://www."), host_on, F.lit("#top")), first + 1800, "revisit", 304, again, none),
            F.when(F.col("page_id") % 5 == 0, record(2, F.col("url"), first + 3600, "revisit", 304, other, none)),
            F.when(F.col("page_id") % 7 == 0, record(3, F.col("url"), first - 31_536_000, "revisit", 304, again, none)),
        )
    )
    return pages.select(F.inline(all_))
