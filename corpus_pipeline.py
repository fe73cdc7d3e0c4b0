"""A corpus pipeline of five stages over ``documents``: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage gets the rows its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``; a document that the mix takes several times is that many rows.

Other columns of the input are left out, whatever their names. A null text has no language and goes in the first stage, as do empty texts and
those without a letter; so the stages after it handle them only if they are called on their own, as each operator's docstring says. Null lang or source: the
document isn't learnt from; null is a source of its own. Rows that repeat an id and a text are one row after exact dedup; rows that share only an
id stay apart until near-dedup drops an id, which drops all of its rows. Very long texts go through whole. An empty table gives an empty result of
the same columns at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import exact_dedup, langid, mixing, packing, simhash
from gleanspark.llm.common import scratch, table
from gleanspark.llm.queries import default_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject."""
    model = langid.train(docs.where(langid.fold(F.col("doc_id"), 5) != 0))
    return langid.predict(docs, model, keep=[*COLUMNS]).where("not rejected").select(COLUMNS)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs.select(COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs.select(COLUMNS), width=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mix(docs.select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer=default_tokenizer(), capacity=1024, end_id=2, **packing.VECTOR)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't express the trained language classifier; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch(docs)
    return docs
