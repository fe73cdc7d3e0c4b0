"""The queries of this subpackage: each applies its operator to its whole table. SQL for DuckDB is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import exact_dedup, langid, licenses, media, mixing, packing, simhash, toxicity, urlfilter, warc
from gleanspark.llm.common import table


def default_tokenizer() -> tuple[str, str, str]:
    """The public byte-level BPE files, where they are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = langid.fold(F.col("doc_id"), 4) == 2
    scored = toxicity.score(docs, toxicity.train(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "votes")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, folder = media.store(table(spark, sf_dir, "documents"))
    out = media.features(media.metadata(rows, folder), folder)
    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    return out.select(*columns, "digest", "width", "height", "bits")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer=default_tokenizer(), capacity=1024, end_id=2, **packing.VECTOR)


def _captures(pages: DataFrame) -> DataFrame:
    """WARC records of a page: up to three full responses, one of them later than the revisit, a revisit with validators of every kind, and one before any response.

    By page_id: every third page changes between two responses; every fifth first response has no validators; a revisit has the latest ETag, weak,
    the first response's ETag, only Last-Modified, or nothing.
    """
    p, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    tag = lambda salt: F.concat(F.lit('"'), F.substring(F.md5(F.concat(html, F.lit(salt))), 1, 16), F.lit('"'))
    day, bare = F.concat(F.lit("d"), (p % 7).cast("string")), p % 5 == 4
    first, second, kind = tag(""), tag("2"), p % 4

    def record(n: int, type_: str, ts, headers: dict):
        entries = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in headers.items()]
        named = F.map_from_entries(F.array_compact(F.array(*entries)))
        return F.struct((p * 8 + n).alias("record_id"), F.lit(type_).alias("type"), "url", ts.alias("ts"), F.lit(200 if type_ == "response" else 304).alias("status"), named.alias("headers"))

    full = {"content-type": F.lit("text/html"), "content-length": F.octet_length(html).cast("string"), "cache-control": F.lit("max-age=3600")}
    turned = {"content-length": F.lit("0"), "cache-control": F.lit("max-age=60"), "set-cookie": F.lit("a=b")}
    latest = F.concat(F.lit("W/"), F.when(p % 3 == 0, second).otherwise(first))
    records = [
        record(0, "response", p * 20, full | {"etag": F.when(~bare, first), "last-modified": F.when(~bare, day)}),
        F.when(p % 3 == 0, record(1, "response", p * 20 + 4, full | {"etag": second})),
        F.when(p % 2 == 0, record(2, "response", p * 20 + 9, full | {"etag": tag("3")})),
        record(3, "revisit", p * 20 + 6, turned | {"etag": F.when(kind == 0, latest).when(kind == 1, first), "last-modified": F.when(kind == 2, day)}),
        F.when(p % 7 == 0, record(4, "revisit", p * 20 - 1, turned | {"etag": first})),
    ]
    return pages.select(F.explode(F.array_compact(F.array(*records))).alias("r")).select("r.*")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(_captures(table(spark, sf_dir, "pages")))
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(pairs, "; "))


#: Host, path, verdict; plain entries without verdict are the filter's own list: canonical URLs of known spam sites.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
SPAM = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED = [(f"{name}.example.{top}", "/", None) for name in SPAM for top in ("com", "net", "org")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, RULES + LISTED))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.fold(F.col("doc_id"), 5) == 0
    found = langid.predict(docs, langid.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_simhash, op3_exact_dedup, op4_toxicity, op5_media, op6_licenses, op7_packing, op8_warc_revisits, op9_url_filter, op10_language_id)
}
