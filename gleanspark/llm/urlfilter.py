"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is a host and the beginning of a path: it fits the host, its subdomains, and
paths that start with it. An entry's key is host and path joined. Of a URL the keys to look up are its host's
suffixes, up to the most labels listed, joined with its path's prefixes of the listed lengths. Rules come first: the longest
that fits decides (of equally long ones that with the longer host; keys that occur twice: block wins). Else a URL is blocked if a
listed entry without rule fits, and allowed otherwise.

The filter has a fixed bound (16 MB of words); tasks test the hashes of their rows' keys against it where the rows are. Rows without a possible hit pass
straight through. Of the others, the distinct keys that passed meet the list by an exact hash join, which removes false positives; what is left are list
entries, which the rows then meet by key. Equal rows collapse before they are shuffled, so a URL or key that most rows share fills no task.

Null URLs and URLs without `://` have empty host and path and fit nothing. Very long URLs go through whole. Rows that repeat id and URL are judged once and come
back as often. An empty table or list gives an empty or all-allowing result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import bloom
from gleanspark.llm.common import UPPER, scratch

#: Found entries of up to so many rows (some 100 bytes each) are broadcast, after counting; more are shuffled.
BROADCAST_ROWS = 500_000
SCHEMA = "host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The parts after the first `://`: host, A-Z lower-cased, and path."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.call_function("substring", url, at + 3)), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str | None]]) -> DataFrame:
    """Entries (host, path, verdict): allow or block for a rule, null for a plain listed URL."""
    return spark.createDataFrame(rules, SCHEMA)


def _keys(lengths: list[int], most: int) -> Column:
    """The keys to look up for columns host and path."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    prefixes = F.transform(F.filter(F.array([F.lit(x) for x in lengths]), lambda k: k <= F.length("path")), lambda k: F.call_function("substring", F.col("path"), F.lit(1), k))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _passing(listed: DataFrame, n: int):
    """A function of hashes (array<long>) to the positions of those that the filter of the list's keys may hold."""
    blocks = bloom.n_blocks(n)
    words = np.zeros(blocks, dtype=np.int64)
    for r in bloom.build(listed.select(F.xxhash64("key").alias("h")), "h", blocks).toLocalIterator():
        words[r["__block"]] = r["__word"]
    shared = listed.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("array<int>")
    def passing(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        filter_ = shared.value
        for hashes in batches:
            h, ends = hashes.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.append(0, hashes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            mask = bloom.masks(h)
            at = np.nonzero((filter_[bloom.blocks_of(h, len(filter_))] & mask) == mask)[0]
            row = np.searchsorted(ends, at, side="right") - 1
            counts = np.bincount(row, minlength=len(hashes))
            yield pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array((at - ends[row]).astype(np.int32)))

    return passing.asNondeterministic()  # so that no plan computes it twice


def judge(pages: DataFrame, entries: DataFrame, *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    listed = entries.where("host is not null").select(F.concat("host", F.coalesce("path", F.lit(""))).alias("key"), F.length("host").alias("host_length"), "verdict", F.length(F.coalesce("path", F.lit(""))).alias("path_length"), F.size(F.split("host", r"\.")).alias("labels"))
    shape = listed.agg(F.sort_array(F.collect_set("path_length")).alias("lengths"), F.max("labels").alias("labels"), F.count("*").alias("n")).first()
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    keyed = rows.withColumn("keys", _keys(shape["lengths"] or [0], shape["labels"] or 1))
    passing = _passing(listed, shape["n"])
    probed = keyed.withColumn("at", passing(F.transform("keys", lambda k: F.xxhash64(k))))
    probed = probed.select("page_id", "host", "path", F.transform("at", lambda i: F.get("keys", i)).alias("keys"))
    columns = [F.col("page_id").alias(page_id), "host", "path"]
    missed = probed.where("size(keys) = 0").select(*columns, F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    # The exact join: distinct possible keys against the list. At most the list's own keys are left.
    possible = probed.select(F.explode("keys").alias("key")).distinct()
    found = scratch(listed.join(possible, "key", "left_semi").groupBy("key").agg(F.max("host_length").alias("host_length"), F.max("verdict").alias("verdict"), F.max(F.col("verdict").isNull()).alias("plain")))  # "block" sorts after "allow"
    found_or_broadcast = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    # A row's first key stands for the row itself, so counting it tells how often equal rows occur.
    hits = probed.where("size(keys) > 0").select("page_id", "host", "path", F.posexplode("keys").alias("nth", "key")).join(found_or_broadcast, "key", "left")
    rank = F.struct(F.length("key").alias("length"), "host_length", "verdict", "key")
    judged = hits.groupBy("page_id", "host", "path").agg(F.max(F.when(F.col("verdict").isNotNull(), rank)).alias("best"), F.max("plain").alias("listed"), F.sum(F.when(F.col("nth") == 0, 1).otherwise(0)).alias("copies"))
    verdict = F.coalesce("best.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    again = judged.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return missed.unionByName(again.select(*columns, F.col("best.key").alias("rule"), verdict.alias("verdict")))
