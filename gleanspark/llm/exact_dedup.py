"""Exact dedup by two passes over a Bloom filter; built-in expressions only.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Pass one
counts how often each bit of a bounded filter is set and keeps the bits set twice; pass two
tests each row's hash. Rows that miss are unique and pass straight through; only possible
repeats are shuffled, by SHA-256. Of equal texts the row with the largest doc_id stays; of
rows that repeat text and doc_id alike, one stays; a null doc_id stays only in a group without
any other. An empty table gives an empty result. Input columns named like an output column
are replaced by it; all others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm import bloom
from gleanspark.llm.common import ascii_lower, join_groups, scratch, without


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _hashes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row a document: __id, text_sha256 and __h, a 64-bit hash for the filter. The only pass over texts."""
    sha = F.sha2(normalised(F.col(text)), 256).alias("text_sha256")
    slim = docs.select(F.col(doc_id).alias("__id"), sha)
    return scratch(slim.withColumn("__h", F.xxhash64("text_sha256")))


def _groups(suspects: DataFrame) -> DataFrame:
    return suspects.groupBy("text_sha256").agg(F.max("__id").alias("keep_id"), F.count("*").alias("group_size"))


def annotate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    hashes = _hashes(docs, doc_id, text)
    n = hashes.count()
    blocks = bloom.n_blocks(n)
    probed = bloom.probe(hashes, "__h", scratch(bloom.build_repeated(hashes, "__h", blocks)), blocks, "__maybe")
    columns = [F.col("__id").alias(doc_id), "keep_id", "group_size", "kept", "text_sha256"]
    unique = probed.where("not __maybe").select(
        F.col("__id").alias(doc_id), F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    suspects = probed.where("__maybe").select("__id", "text_sha256")
    joined = join_groups(suspects, _groups(suspects), "text_sha256", "group_size", n)
    # Only rows that carry the id to be kept can stay; they are one a group unless rows repeat.
    stays = F.col("__id").eqNullSafe(F.col("keep_id"))
    nth = F.row_number().over(Window.partitionBy("text_sha256", "__id").orderBy("__id"))
    keepers = joined.where(stays).withColumn("kept", nth == 1)
    dropped = joined.where(~stays).withColumn("kept", F.lit(False))
    return unique.unionByName(keepers.select(columns)).unionByName(dropped.select(columns))


def drop_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Texts of unique rows are never shuffled; a possible repeat meets its group's decision by
    (text_sha256, doc_id), which spreads even a group that holds most rows.
    """
    hashes = _hashes(docs, doc_id, text)
    blocks = bloom.n_blocks(hashes.count())
    repeated = scratch(bloom.build_repeated(hashes, "__h", blocks))
    slim = bloom.probe(hashes, "__h", repeated, blocks, "__maybe").where("__maybe")
    decided = _groups(slim).select(F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep"))
    own = ["__sha", "__h", "__maybe", "__keep", "__nth"]
    keyed = without(docs, *own).withColumn("__sha", F.sha2(normalised(F.col(text)), 256)).withColumn("__h", F.xxhash64("__sha"))
    probed = bloom.probe(keyed, "__h", repeated, blocks, "__maybe")
    unique = probed.where("not __maybe").drop(*own)
    suspects = probed.where("__maybe").withColumnRenamed("__sha", "__own")
    same = (F.col("__own") == F.col("__sha")) & F.col(doc_id).eqNullSafe(F.col("__keep"))
    nth = F.row_number().over(Window.partitionBy("__own", doc_id).orderBy(doc_id))
    kept = suspects.join(decided, same).withColumn("__nth", nth).where("__nth = 1").drop(*own, "__own")
    return unique.unionByName(kept)
