"""Best-fit packing of tokenised documents into fixed-length sequences, with vector capacities.

Each document's token ids plus an end id form one piece, or, if longer than a sequence, pieces of full
length of which the first may be shorter. Sequences have three capacities: tokens,
documents and attention cost (tiles of scores that attention within pieces touches). Pieces go from the longest to the shortest, each into the sequence
that leaves the least weighted residual norm (``score="norm"``) or has the greatest weighted dot product of demand and
residual (``score="dot"``) under every constraint. Pieces of one length are alike, so the plan
works on counts by length and on runs of like sequences: its size depends on the sequence length
only. Executors then number the pieces of each length and look up their places.

Null text counts as empty (one piece: the end id). Rows that repeat a doc_id are packed like any other;
so are null ids. An empty table gives an empty result.

The ids are those of the byte-level BPE vocabulary of the ``tokenizers`` file. Texts of Latin letters go through
the equal rank file, which is several times as fast; any other text goes through the ``tokenizers`` library itself.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.common import scratch, worker_cache

#: Pieces of one length that are numbered in one task.
RANGE_ROWS = 2000
#: For sequences of 1024 tokens: at most 64 documents; in tiles of 64 x 64 scores, what one piece of full length touches (256) and one tile; both count a fifth of
#: what free tokens do.
VECTOR = {"max_docs": 64, "max_cost": 257, "tile": 64, "weights": (1.0, 0.2, 0.2)}
#: Only for texts within these code points are both tokenizers' character classes surely alike.
OTHER = re.compile("[^\t-\r\x20-\x7e\xa0-ɏ‐-…]")


#: Longer runs of white space exceed the stack of the fast library's regex.
SPACES = re.compile(r"\s{5000}")


def byte_bpe(json_path: str, ranks_path: str | None, pattern: str | None) -> Callable[[str], np.ndarray]:
    """text -> ids (uint32), by the ``tokenizers`` file; texts in Latin script by the rank file of the same vocabulary, if given.

    The fast library gives up on very long runs; such texts go through the ``tokenizers`` file too.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    slow.encode_special_tokens = True
    whole = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    if not ranks_path:
        return whole
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not OTHER.search(text) and not SPACES.search(text):
            try:
                return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
            except ValueError:
                pass
        return whole(text)

    return encode


def encoder(*paths: str | None) -> Callable[[str], np.ndarray]:
    """One encoder a worker process, for all its tasks."""
    cache = worker_cache()
    if ("byte_bpe", *paths) not in cache:
        cache["byte_bpe", *paths] = byte_bpe(*paths)
    return cache["byte_bpe", *paths]


def pieces(docs: DataFrame, *, tokenizer: tuple, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    id_field = T.StructField(doc_id, docs.schema[doc_id].dataType)
    fields = [id_field, *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())))]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        for batch in batches:
            source, rows, arrays = [], [], []
            for k, value in enumerate(batch.column(1)):
                ids = np.append(encode(value.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    source.append(k)
                    rows.append((piece, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())))
                    if with_ids:
                        arrays.append(ids[lo:hi].astype(np.int64))
            columns = np.array(rows, dtype=np.int64).reshape(-1, 4)
            out = [batch.column(0).take(pa.array(source, pa.int64())), pa.array(columns[:, 0].astype(np.int32)), *(pa.array(columns[:, c]) for c in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array(arrays, pa.list_(pa.int64()))] if with_ids else [])], names=[f.name for f in fields])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, T.StructType(fields))


def attention_cost(length: int, tile: int) -> int:
    """Tiles of ``tile`` x ``tile`` scores that a piece's attention touches: however short, a piece takes whole tiles."""
    return (-(-length // tile)) ** 2


class Runs:
    """Runs of like sequences: residual capacities, number and first sequence id of each."""

    def __init__(self, capacity: np.ndarray, weights: np.ndarray, score: str) -> None:
        self.capacity, self.weights, self.score = capacity, weights, score
        self.residual = np.zeros((0, 3), dtype=np.int64)
        self.count, self.first = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def best(self, demand: np.ndarray) -> int | None:
        fits = np.nonzero((self.residual >= demand).all(axis=1))[0]
        if not len(fits):
            return None
        share = self.residual[fits] / self.capacity
        if self.score == "dot":
            return int(fits[np.argmax((self.weights * share * (demand / self.capacity)).sum(axis=1))])
        return int(fits[np.argmin((self.weights * (share - demand / self.capacity) ** 2).sum(axis=1))])

    def add(self, residual: np.ndarray, count: int, first: int) -> None:
        if count and residual[0] > 0 and residual[1] > 0:
            self.residual = np.vstack([self.residual, residual])
            self.count, self.first = np.append(self.count, count), np.append(self.first, first)

    def take(self, k: int) -> tuple[np.ndarray, int, int]:
        out = self.residual[k], int(self.count[k]), int(self.first[k])
        self.residual, self.count, self.first = np.delete(self.residual, k, axis=0), np.delete(self.count, k), np.delete(self.first, k)
        return out


def plan(counts: dict[int, int], *, capacity: int, max_docs: int, max_cost: int, tile: int = 1, weights: tuple = (1.0, 0.0, 0.0), score: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Places as (length, first rank, number, first sequence id, offset): piece rank r + i goes to sequence s + i."""
    limits = np.array([capacity, max_docs, max_cost], dtype=np.int64)
    runs, places, sequences = Runs(limits, np.array(weights), score), [], 0
    for length in sorted(counts, reverse=True):
        rank, left, demand = 0, counts[length], np.array([length, 1, attention_cost(length, tile)], dtype=np.int64)
        while left:
            k = runs.best(demand)
            if k is None:
                each = int((limits // demand).min())
                if not each:
                    raise ValueError(f"a piece of {length} tokens exceeds a sequence's capacities")
                residual, number, first = limits, left // each or 1, sequences
                sequences += number
            else:
                residual, number, first = runs.take(k)
                each = int((residual // demand).min())
            # a sequence takes as many as it can before the next does: full ones, then one with the rest
            full, used = min(number, left // each), int(capacity - residual[0])
            for place in range(each if full else 0):
                places.append((length, rank, full, first, used + place * length))
                rank += full
            left -= full * each
            runs.add(residual - each * demand, full, first)
            rest = left if full < number and left < each else 0
            for place in range(rest):
                places.append((length, rank, 1, first + full, used + place * length))
                rank += 1
            left -= rest
            if rest:
                runs.add(residual - rest * demand, 1, first + full)
            runs.add(residual, number - full - bool(rest), first + full + bool(rest))
    return places


def pack(docs: DataFrame, *, tokenizer: tuple, capacity: int = 1024, max_docs: int | None = None, max_cost: int | None = None, tile: int = 1, weights: tuple = (1.0, 0.0, 0.0), score: str = "norm", end_id: int = 2, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset. By default the document and cost capacities are those that a full sequence can't exceed, and
    choose nothing; :data:`VECTOR` are capacities and weights for sequences of 1024 tokens."""
    spark = docs.sparkSession
    cut = scratch(pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id, doc_id=doc_id, text=text, with_ids=with_ids))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = plan(counts, capacity=capacity, max_docs=max_docs or capacity, max_cost=max_cost or capacity * capacity, tile=tile, weights=weights, score=score)
    table = spark.createDataFrame(places, "length long, rank long, number long, first long, at long")
    # Number the pieces of each length: ranges by hash, then within a range, so that a common length is many tasks.
    ranges = max(1, sum(counts.values()) // RANGE_ROWS)
    ranged = cut.withColumn("__range", F.pmod(F.xxhash64(doc_id, "piece"), F.lit(ranges)))
    sizes = ranged.groupBy("length", "__range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__range")) - F.col("n")
    offsets = sizes.select("length", "__range", before.alias("__before"))
    nth = F.row_number().over(Window.partitionBy("length", "__range").orderBy(doc_id, "piece"))
    ranked = ranged.withColumn("__nth", nth).join(offsets, ["length", "__range"]).withColumn("__rank", F.col("__before") + F.col("__nth") - 1)
    # The places' number is bounded by the sequence length alone.
    inside = (F.col("__rank") >= F.col("rank")) & (F.col("__rank") < F.col("rank") + F.col("number"))
    placed = ranked.join(F.broadcast(table.withColumnRenamed("length", "__length")), (F.col("length") == F.col("__length")) & inside)
    sequence = F.col("first") + F.col("__rank") - F.col("rank")
    out = [doc_id, "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), F.col("at").alias("offset")]
    return placed.select(*out, *(["ids"] if with_ids else []))
