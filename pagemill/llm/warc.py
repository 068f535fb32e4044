"""Web archive records: not-modified revisits resolved to full responses.

A revisit belongs to the latest earlier full response of its canonical URL, if its
validators agree with that response. The two are then one response: the stored body
and headers, updated by those headers a not-modified answer may change.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that do not tell pages apart.
TRACKING = r"^(utm_[^=]*|ref|sid)(=|$)"
FULL, NOT_MODIFIED = 200, 304
# Spans that the time between the first and the last record is cut into.
SPANS = 1024


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without closing slashes,
    and the sorted parameters but for tracking ones; scheme and fragment are dropped."""
    rest = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    parts = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    query = F.array_join(F.array_sort(F.filter(parts, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _same_etag(a: Column, b: Column) -> Column:
    """Equal entity tags, weak or strong."""
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def latest_full(records: DataFrame, spans: int = SPANS) -> DataFrame:
    """(record_id, key, full) of the not-modified records: ``full`` is the struct (at,
    record_id, etag, last_modified) of the latest earlier full response of their key.

    Time is cut into spans. A window looks back within a key's span, and what earlier
    spans of the key end with is carried over, so that a key with very many records is
    spread over its spans. Only the first and the last time pass the driver.
    """
    low, high = records.agg(F.min("at"), F.max("at")).first()
    width = max(1, ((high or 0) - (low or 0)) // spans + 1)
    full = F.when(F.col("status") == FULL, F.struct("at", "record_id", "etag", "last_modified"))
    narrow = records.select("record_id", "key", "at", "status", full.alias("own")).withColumn(
        "span", F.floor((F.col("at") - F.lit(low or 0)) / width)
    )
    ends = narrow.groupBy("key", "span").agg(F.max("own").alias("last"))
    before = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.max("last").over(before)).drop("last")
    earlier = Window.partitionBy("key", "span").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    seen = narrow.withColumn("inner", F.max("own").over(earlier)).where(F.col("status") == NOT_MODIFIED)
    return seen.join(carried, ["key", "span"]).select(
        "record_id", "key", F.coalesce("inner", "carried").alias("full")
    )


def resolve_revisits(records: DataFrame, spans: int = SPANS) -> DataFrame:
    """(record_id, key, full_id, outcome, headers, body) of every not-modified row of
    (record_id, url, at bigint, status, etag, last_modified, headers map, body).

    ``outcome`` is etag or modified by the validator that agreed, mismatch if the one
    that counts did not (an entity tag goes before a date), unchecked if the record has
    none, missing without an earlier full response. Only the first two have headers and
    body. Of full responses of one time the largest id counts. Rows without id, URL or
    time are missing with a null key or id; an empty body is a body; header names compare
    in lower case and null headers are none. Record ids are unique: equal rows of a full
    response count as one, equal revisits are resolved alike. Empty tables give no rows.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("key"), "at", "status", "etag", "last_modified", "headers", "body"
    )
    whole = F.col("record_id").isNotNull() & F.col("key").isNotNull() & F.col("at").isNotNull()
    found = latest_full(rows.where(whole), spans).dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("_id"), "full"
    )
    revisits = rows.where(F.col("status") == NOT_MODIFIED).drop("body", "status", "at")
    met = revisits.join(found, F.col("record_id") == F.col("_id"), "left")
    outcome = (
        F.when(F.col("full").isNull(), "missing")
        .when(F.col("etag").isNotNull(), F.when(_same_etag(F.col("etag"), F.col("full.etag")), "etag"))
        .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == F.col("full.last_modified"), "modified"))
        .otherwise("unchecked")
    )
    met = met.withColumn("outcome", F.coalesce(outcome, F.lit("mismatch")))
    agreed = F.col("outcome").isin("etag", "modified")
    met = met.withColumn("full_id", F.when(agreed, F.col("full.record_id")))
    stored = rows.where(whole & (F.col("status") == FULL)).dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("_full"), F.col("headers").alias("_headers"), "body"
    )
    both = met.join(stored, F.col("full_id") == F.col("_full"), "left")
    return both.select("record_id", "key", "full_id", "outcome", F.when(agreed, merged("_headers", "headers")).alias("headers"), "body")


def merged(stored: str, update: str) -> Column:
    """The stored headers, with the permitted ones of the update in their place."""
    none = F.create_map().cast("map<string,string>")

    def lower(name: str) -> Column:
        entries = F.map_entries(F.coalesce(F.col(name), none))
        return F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))

    new = F.filter(lower(update), lambda e: e["key"].isin(*PERMITTED))
    names = F.transform(new, lambda e: e["key"])
    kept = F.filter(lower(stored), lambda e: ~F.array_contains(names, e["key"]))
    return F.array_distinct(F.array_sort(F.concat(kept, new)))


def page_records(pages: DataFrame) -> DataFrame:
    """Records as a crawler would keep of (page_id, url, html): a full response of each
    page, a not-modified answer after it, whose validators are the page's, a date only or
    those of another version, and one before it, which only an older page can serve."""
    at, etag = F.col("page_id") * 1000, F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    kind = F.length("html") % 3
    changed = F.when(kind == 0, F.concat(F.lit("W/"), etag)).when(kind == 2, '"changed"')

    def headers(date: Column, age: str, content: str) -> Column:
        pairs = {"Content-Type": F.lit(content), "Cache-Control": F.lit(age), "Date": date.cast("string")}
        return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v)))

    def record(number: int, status: int, moved: int, tag: Column, age: str, content: str, body: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"), "url", (at + moved).alias("at"), F.lit(status).alias("status"),
            tag.alias("etag"), (at - 50).alias("last_modified"), headers(at + moved, age, content).alias("headers"), body.alias("body"),
        )

    none = F.lit(None).cast("string")
    return pages.select(F.inline(F.array(
        record(0, FULL, 0, etag, "max-age=60", "text/html", F.col("html")),
        record(1, NOT_MODIFIED, 400, changed, "max-age=90", "text/plain", none),
        record(2, NOT_MODIFIED, -400, none, "no-cache", "text/plain", none),
    )))
