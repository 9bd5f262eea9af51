"""Not-modified revisits of web captures, resolved by an as-of join.

A revisit record says that a page had not changed; its content is that of the latest earlier full response of the same
canonical URL. That response is looked up as of the revisit's time, its validators are checked (the entity tag by weak
comparison where the revisit names one, else the time of last modification), and the headers a not-modified answer may
bring up to date replace the stored ones.

The as-of join is a running "last response seen" over URL and time. Time is cut in spans, so a URL that holds a third
of all records is spread over as many tasks as it has spans: inside a span the window runs over its records, and what
the spans before hand on is computed over one row per URL and span. Only keys and validators take part; headers and
bodies of the responses found are joined by record id at the end. All of it is built-in expressions.

Cases: a null or empty URL matches nothing; a null time is earlier than all others and has no earlier response;
responses at the very time of the revisit are not earlier; of several at the latest time the largest record id counts;
a response without status 200 is not a full response; null headers have no fields; without any validator in the
revisit the response is taken and marked unchecked; repeated record ids give a row each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that a not-modified answer may bring up to date.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")
#: Parameters that name a visit, not a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)="
SPAN_SECONDS = 86_400
RESOLVED, UNCHECKED, MISMATCH, MISSING = "resolved", "resolved_unchecked", "validator_mismatch", "no_response"


def canonical_url(url: Column) -> Column:
    """Host and path with sorted parameters: no scheme, ``www.``, default port, fragment or tracking parameters."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1)
    fields = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(fields), "&")
    whole = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host != "", whole)


def header_lines(headers: Column) -> Column:
    return F.filter(F.split(F.coalesce(headers, F.lit("")), "\r?\n"), lambda x: F.contains(x, F.lit(":")))


def header_name(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def header(headers: Column, name: str) -> Column:
    """The value of the first field of a name, or null."""
    found = F.filter(header_lines(headers), lambda x: header_name(x) == name)
    return F.trim(F.regexp_replace(F.get(found, F.lit(0)), "^[^:]*:", ""))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored fields, those that the update may and does name replaced by its own."""
    new = F.filter(header_lines(update), lambda x: header_name(x).isin(*PERMITTED))
    names = F.transform(new, header_name)
    old = F.filter(header_lines(stored), lambda x: ~F.array_contains(names, header_name(x)))
    return F.array_join(F.concat(old, new), "\r\n")


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def latest_earlier(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Every revisit's record_id, and resolved_id, etag, last_modified of the latest earlier full response (or nulls)."""
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    seen = F.struct(
        F.col("record_id").alias("resolved_id"),
        header(F.col("headers"), "etag").alias("etag"),
        header(F.col("headers"), "last-modified").alias("last_modified"),
    )
    at = F.coalesce(F.col("at"), F.lit(-(1 << 62)))
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical_url(F.col("uri")).alias("url"),
        at.alias("at"),
        F.floor(at / span_seconds).cast("bigint").alias("span"),
        F.when(full, seen).alias("seen"),
        (F.col("kind") == "revisit").alias("asks"),
    )
    rows = rows.where(F.col("url").isNotNull() & (F.col("asks") | F.col("seen").isNotNull()))
    # at the same time, revisits come before responses
    inside = Window.partitionBy("url", "span").orderBy("at", F.desc("asks"), "record_id")
    local = F.last("seen", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = rows.groupBy("url", "span").agg(F.max_by("seen", F.when(F.col("seen").isNotNull(), F.struct("at", "record_id"))).alias("newest"))
    before = Window.partitionBy("url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    handed = spans.select("url", "span", F.last("newest", ignorenulls=True).over(before).alias("handed"))
    asked = rows.withColumn("local", local).where("asks").drop("seen")
    return asked.join(handed, ["url", "span"], "left").select("record_id", F.coalesce("local", "handed").alias("seen")).select("record_id", "seen.*")


def resolve_revisits(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """One row per revisit: record_id, uri, at, resolved_id, outcome, status, headers, body.

    ``records``: record_id, kind (``response``, ``revisit``, others are left alone), uri, at (seconds), status, headers
    (fields on lines), body. Revisits that are not resolved have null status, headers and body.
    """
    found = latest_earlier(records, span_seconds)
    asks = records.where("kind = 'revisit'").select("record_id", "uri", "at", F.col("headers").alias("update"))
    # repeated record ids ask the same question: one answer serves them all
    found = found.groupBy("record_id").agg(F.max(F.struct("resolved_id", "etag", "last_modified")).alias("seen")).select("record_id", "seen.*")
    asked = asks.join(found, "record_id", "left")
    tag, modified = header(F.col("update"), "etag"), header(F.col("update"), "last-modified")
    same = F.when(tag.isNotNull(), F.coalesce(weak(tag) == weak(F.col("etag")), F.lit(False))).when(
        modified.isNotNull(), F.coalesce(modified == F.col("last_modified"), F.lit(False))
    )
    outcome = F.when(F.col("resolved_id").isNull(), MISSING).when(same.isNull(), UNCHECKED).when(same, RESOLVED).otherwise(MISMATCH)
    judged = asked.withColumn("outcome", outcome)
    use = F.when(F.col("outcome").isin(RESOLVED, UNCHECKED), F.col("resolved_id"))
    judged = judged.withColumn("use", use)
    stored = records.where("kind = 'response' AND status = 200").select(
        F.col("record_id").alias("use"), "status", F.col("headers").alias("stored"), "body"
    )
    joined = judged.join(stored, "use", "left")
    headers = F.when(F.col("use").isNotNull(), merged_headers(F.col("stored"), F.col("update")))
    return joined.select(
        "record_id", "uri", "at", F.col("use").alias("resolved_id"), "outcome", "status", headers.alias("headers"), "body"
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Capture records made from web pages: each page a response, most with a revisit, host fronts visited often.

    Page p is captured at 7919 p modulo 10,000,019 seconds. Pages with p mod 3 = 2 have a revisit of their own URL in
    another spelling (a quarter of a day before or after it), those with p mod 3 = 1 one of their host's front page,
    which pages with p mod 50 = 0 capture too. Entity tags are digests of the page; some revisits name a stale tag, some
    only a time, some nothing.
    """
    p = F.col("page_id")
    at = (p * 7919) % 10_000_019
    front = F.concat(F.lit("http://"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.lit("/"))
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(at / 86_400).cast("string"))
    full = F.concat(F.lit("Content-Type: text/html\r\nETag: "), tag, F.lit("\r\nLast-Modified: "), day, F.lit("\r\nServer: s\r\nCache-Control: no-store"))
    response = pages.select(
        (p * 4).alias("record_id"), F.lit("response").alias("kind"), F.col("url").alias("uri"), at.alias("at"),
        F.when(p % 40 == 7, 404).otherwise(200).alias("status"), full.alias("headers"), F.col("html").alias("body"),
    )
    fronts = pages.where(p % 50 == 0).select(
        (p * 4 + 1).alias("record_id"), F.lit("response").alias("kind"), front.alias("uri"), at.alias("at"),
        F.lit(200).alias("status"), full.alias("headers"), F.col("html").alias("body"),
    )
    update = F.concat(
        F.lit("Date: now\r\nCache-Control: max-age=60\r\nContent-Type: text/plain"),
        F.when(p % 3 == 1, "").when(p % 7 == 0, '\r\nETag: "stale"').when(p % 7 == 1, "")
        .when(p % 7 == 2, F.concat(F.lit("\r\nlast-modified: "), day)).otherwise(F.concat(F.lit("\r\netag: W/"), tag)),
    )
    spelled = F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("utm_source=again#x"))
    revisits = pages.where(p % 3 != 0).select(
        (p * 4 + 2).alias("record_id"), F.lit("revisit").alias("kind"), F.when(p % 3 == 1, front).otherwise(spelled).alias("uri"),
        (at + F.when(p % 5 == 0, -21_600).otherwise(21_600)).alias("at"), F.lit(304).alias("status"),
        update.alias("headers"), F.lit(None).cast("string").alias("body"),
    )
    return response.unionByName(fronts).unionByName(revisits)
