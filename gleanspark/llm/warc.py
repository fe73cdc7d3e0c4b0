"""WARC: resolving not-modified revisits by an as-of join.

A record has record_id, type (`response` or `revisit`), url, ts (any long that orders time), status and headers (a map with
lower-case names). A revisit of status 304 is resolved to the latest full response (type response,
status 200) of its canonical URL with a strictly earlier ts; of several at that ts, the one with the largest id. It is accepted if the validators agree: ETags, compared weakly, where
both have one, else Last-Modified. The merged headers are the response's, with those that a 304 may update taken from it.

The as-of join cuts time into ranges: within a (URL, range) by a window, across ranges by carrying one row per (URL, range). So a
URL that holds most records is many tasks. Headers of a response that many revisits share are broadcast to them (at most 1 / HOT_SHARE such responses); revisits
without a response meet no join. Null url: never matches. Null ts: no earlier response, and serves none. Repeated records resolve alike; of responses that share
an id, the one whose headers sort first serves. An empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import UPPER, join_groups, scratch

#: Ranges that the time span is cut into.
RANGES = 256
#: Header fields that a 304 response may update (RFC 9110, 15.4.5), and Last-Modified.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, leading www., default port, trailing slashes and utm_ parameters; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.translate(F.regexp_extract(bare, r"^([^/?]*)", 1), UPPER, UPPER.lower())
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), r"(^|&)utm_[^&]*", ""), r"^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _validates(revisit: Column, response: Column) -> Column:
    tag = lambda h: F.regexp_replace(h["etag"], r"^W/", "")
    by_tag = tag(revisit) == tag(response)
    return F.coalesce(by_tag, revisit["last-modified"] == response["last-modified"], F.lit(False))


def merged_headers(revisit: Column, response: Column) -> Column:
    """The response's headers, updated with the revisit's permitted ones."""
    kept = F.map_filter(revisit, lambda k, _: k.isin(*PERMITTED))
    base = F.map_filter(response, lambda k, _: ~F.map_contains_key(kept, k))
    return F.map_concat(base, kept)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each 304 revisit with canonical_url, resolved_id, outcome (resolved, mismatch or none) and merged headers (a revisit's own if unresolved)."""
    base = records.select("record_id", "type", "ts", "status", "headers", canonical_url(F.col("url")).alias("canonical_url"))
    span = base.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, width = span["lo"] or 0, max(1, -(-((span["hi"] or 0) - (span["lo"] or 0) + 1) // RANGES))
    full = (F.col("type") == "response") & (F.col("status") == 200)
    turned = (F.col("type") == "revisit") & (F.col("status") == 304)
    slim = base.select("record_id", "ts", "canonical_url", F.coalesce(full, F.lit(False)).alias("full"), F.floor((F.col("ts") - lo) / width).alias("range")).where(full | turned)
    timed = slim.where("ts is not null and canonical_url is not null")
    capture = F.when(F.col("full"), F.struct("ts", "record_id"))
    last = timed.groupBy("canonical_url", "range").agg(F.max(capture).alias("last"))
    carried = F.max("last").over(Window.partitionBy("canonical_url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    carry = last.select("canonical_url", "range", carried.alias("carried"))
    earlier = F.max(capture).over(Window.partitionBy("canonical_url", "range").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1))
    asof = timed.withColumn("within", earlier).where("not full").join(carry, ["canonical_url", "range"], "left")
    asof = asof.select(F.col("record_id").alias("__id"), F.col("ts").alias("__ts"), "canonical_url", F.coalesce("within", "carried")["record_id"].alias("resolved_id")).distinct()
    revisits = base.where(turned).select("record_id", "ts", "canonical_url", "headers")
    same = (F.col("record_id") == F.col("__id")) & (F.col("ts") == F.col("__ts")) & (revisits["canonical_url"] == asof["canonical_url"])
    matched = revisits.join(asof, same, "left").select("record_id", revisits["canonical_url"], "ts", "headers", "resolved_id")
    matched = scratch(matched)
    sorted_headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])), "; ")
    responses = base.where(full).groupBy(F.col("record_id").alias("resolved_id")).agg(F.min_by("headers", sorted_headers).alias("stored"))
    served = matched.where("resolved_id is not null")
    used = served.groupBy("resolved_id").agg(F.count("*").alias("__n"))
    joined = join_groups(served, responses.join(used, "resolved_id"), "resolved_id", "__n", served.count())
    outcome = F.when(_validates(F.col("headers"), F.col("stored")), "resolved").otherwise("mismatch")
    headers = F.when(outcome == "resolved", merged_headers(F.col("headers"), F.col("stored"))).otherwise(F.col("headers"))
    columns = ["record_id", "canonical_url", "ts"]
    found = joined.select(*columns, F.when(outcome == "resolved", F.col("resolved_id")).alias("resolved_id"), outcome.alias("outcome"), headers.alias("headers"))
    return found.unionByName(matched.where("resolved_id is null").select(*columns, "resolved_id", F.lit("none").alias("outcome"), "headers"))
