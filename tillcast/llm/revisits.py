"""Resolution of not-modified revisit records (operator 2).

A revisit answered "not modified" carries no payload: it refers to the latest earlier full
response for the same canonical URL.  Records are ranked by (URL, time) over range partitions,
so one URL with a third of all captures is spread over many tasks; each partition carries its
last response forward, and the partitions' last responses (one row per partition and URL) are
carried across partitions.  Payloads stay out of all this: they are read a second time and moved
once, to their record_id.  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import durable

#: Fields that a not-modified answer may update in the stored response (RFC 9110
#: 15.4.5, RFC 9111 3.2); lengths and codings of the payload stay those of the full response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not select a resource.
TRACKING = "utm_[a-z]+|gclid|fbclid|ref"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, http as https, no "www.", default port, fragment, tracking
    parameters or trailing slash; the other parameters keep their order.  Null stays null."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(path, r"/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    query = F.regexp_replace(query, rf"(^|&)({TRACKING})=[^&]*", "")
    query = F.regexp_replace(query, r"^&", "")
    return (F.when(host == "", u)
            .otherwise(F.concat(F.lit("https://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records(record_id long, kind, url, captured, headers
    map<string,string>, payload)``: record_id, canonical_url, status, response_id, captured,
    response_captured, headers, payload.

    ``kind`` is ``response`` (full) or ``revisit``; other kinds are ignored.  Header names are
    compared in lower case.  The response is the latest one of the same canonical URL with an
    earlier time; of several at that time the largest record_id.  ``status``:

    * ``resolved``: the revisit's ETag equals the response's (weak comparison), or, if either has
      none, its Last-Modified does.  Headers are the response's, updated by the permitted fields
      of the revisit; the payload is the response's.
    * ``changed``: the validators contradict each other; ``unchecked``: there is none that both
      carry.  Headers are the revisit's own; no payload.
    * ``missing``: no earlier response.

    Null URL or time: ``missing`` for a revisit, no use as a response.  Null headers or payload
    are empty.  Repeated revisit rows are returned each.  No rows: no rows.  Other columns are
    ignored."""
    lower = F.transform_keys(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k))
    # of names that differ in case only, the one that sorts last counts
    lower = F.map_from_entries(F.map_entries(lower))
    r = records.where("kind in ('response', 'revisit')").select(
        F.col("record_id").cast("long").alias("record_id"), F.col("kind"),
        canonical_url(F.col("url")).alias("canonical_url"), F.col("captured"), lower.alias("headers"))
    # same-time revisits come before responses: a response must be strictly earlier
    late = F.when(F.col("kind") == "response", 1).otherwise(0)
    tagged = durable(r.withColumn("_late", late)
                     .repartitionByRange("canonical_url", "captured", "_late", "record_id")
                     .withColumn("_part", F.spark_partition_id()))
    usable = (F.col("kind") == "response") & F.col("captured").isNotNull() & F.col("canonical_url").isNotNull()
    # only keys, validators and headers are ranked and kept; the payload is fetched at the end by record_id
    light = tagged.withColumn("_resp", F.when(usable, F.struct(
        "captured", F.coalesce("record_id", F.lit(-1)).alias("record_id"), F.map_entries("headers").alias("h"))))
    own = Window.partitionBy("_part", "canonical_url").orderBy("captured", "_late", "record_id")
    seen = light.withColumn("_here", F.last("_resp", ignorenulls=True).over(own))
    ends = light.groupBy("canonical_url", "_part").agg(F.max("_resp").alias("_end"))
    before = Window.partitionBy("canonical_url").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = durable(ends.select(F.col("canonical_url").alias("_url"), F.col("_part").alias("_p"),
                                F.last("_end", ignorenulls=True).over(before).alias("_carry")))
    asked = (seen.where("kind = 'revisit'")
             .join(carry, F.col("canonical_url").eqNullSafe(F.col("_url")) & (F.col("_part") == F.col("_p")), "left")
             .withColumn("_r", F.when(F.col("captured").isNotNull() & F.col("canonical_url").isNotNull(),
                                      F.coalesce("_here", "_carry"))))
    theirs = F.map_from_entries("_r.h")
    etag, their_etag = _weak(F.col("headers")["etag"]), _weak(theirs["etag"])
    date, their_date = F.col("headers")["last-modified"], theirs["last-modified"]
    status = (F.when(F.col("_r").isNull(), "missing")
              .when(etag.isNotNull() & their_etag.isNotNull(), F.when(etag == their_etag, "resolved").otherwise("changed"))
              .when(date.isNotNull() & their_date.isNotNull(), F.when(date == their_date, "resolved").otherwise("changed"))
              .otherwise("unchecked"))
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(updates, k))
    checked = asked.withColumn("status", status).select(
        "record_id", "canonical_url", "status", "captured",
        F.when(F.col("status") != "missing", F.col("_r.record_id")).alias("response_id"),
        F.col("_r.captured").alias("response_captured"),
        F.when(F.col("status") == "resolved", F.map_concat(kept, updates)).otherwise(F.col("headers")).alias("headers"))
    # where an unresolved revisit looks for a payload, its key is null: it meets none
    bodies = (records.where("kind = 'response'")
              .select(F.col("record_id").cast("long").alias("_id"), F.coalesce("payload", F.lit("")).alias("payload"))
              .groupBy("_id").agg(F.min("payload").alias("payload")))
    return (checked.withColumn("_id", F.when(F.col("status") == "resolved", F.col("response_id")))
            .join(bodies, "_id", "left").drop("_id"))


def captures(pages: DataFrame) -> DataFrame:
    """WARC-like records of ``pages(page_id, url, html)``: per page one full response and two
    later revisits, whose validators agree, contradict or are absent by rules on page_id.
    Every eleventh page has only revisits."""
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    day = F.concat(F.lit("day-"), (F.col("page_id") % 97).cast("string"))

    def record(kind, offset, etag, date, extra):
        headers = [F.lit(x) if isinstance(x, str) else x for x in
                   ("ETag", etag, "Last-Modified", date, "Cache-Control", extra, "Content-Length",
                    F.octet_length("html").cast("string") if kind == "response" else F.lit("0"))]
        return F.struct((F.col("page_id") * 3 + offset).alias("record_id"), F.lit(kind).alias("kind"),
                        (F.col("page_id") * 10 + offset * 7).alias("captured"),
                        F.map_filter(F.create_map(*headers), lambda k, v: v.isNotNull()).alias("headers"),
                        (F.col("html") if kind == "response" else F.lit(None).cast("string")).alias("payload"))

    p = F.col("page_id")
    first = record("response", 0, F.when(p % 5 != 3, tag), day, F.lit("max-age=60"))
    second = record("revisit", 1, F.when(p % 4 != 1, F.concat(F.lit("W/"), tag)), F.when(p % 7 != 2, day),
                    F.concat(F.lit("max-age="), (p % 600).cast("string")))
    third = record("revisit", 2, F.when(p % 6 == 0, F.lit('"other"')).when(p % 6 < 4, tag), F.when(p % 3 != 0, F.lit("day-x")),
                   F.lit("no-cache"))
    return (pages.select("url", F.explode(F.array(first, second, third)).alias("x"), "page_id")
            .where((F.col("page_id") % 11 != 5) | (F.col("x.kind") == "revisit")).select("url", "x.*"))
