"""Language ID: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

Subwords are byte 3-grams and 4-grams of the text with ASCII non-letters as spaces and A-Z
lower-cased. A text's vector is the mean of its subwords' embeddings. Probabilities are
calibrated by a temperature fitted on a fifth of the sample that training leaves out. The score is the best class's probability times the share of the
text's subwords that training has seen, so that it falls for what is in no learnt language, whichever class it resembles. A text is rejected
if it is null or has no letter, or if its score is below a bound under which at most
``REJECT_SHARE`` of that fifth lies. A fifth of under ``REJECT_PIECES`` pieces says little of its lowest scores, so then
the bound is ``REJECT_CHANCE`` times the score of a blind guess at most.

Training reads at most ``max_docs`` labelled documents, those with the smallest seeded hash; rows that repeat a doc_id
count once, with the least text. It uses each whole text and two windows of it. Prediction reads every whole text. As the mean and the softmax's
input are linear, executors add up one row of class scores a subword. Null text or no letter: `und`, score 0.
Ties between classes go to the label that sorts first; repeated rows get equal results. An empty table gives an empty result. Without any labelled row all texts
are `und`. Input columns named like an output are replaced by it; the text crosses to Python once, whether it is carried or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_BUCKETS, DIM, EPOCHS, RATE = 16, 16, 4, 2.0
MAX_DOCS = 2000
WINDOWS = (40, 200)
REJECT_SHARE, REJECT_CHANCE = 0.0005, 1.2
REJECT_PIECES = 400
#: Positions handled at once by an executor: bounds its memory however long a text is.
BLOCK = 1 << 18

_letters = np.full(256, 32, dtype=np.uint8)
_letters[97:123] = np.arange(97, 123)
_letters[65:91] = np.arange(97, 123)
_letters[128:] = np.arange(128, 256)
LETTERS = _letters


def subwords(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 3-grams and then 4-grams of the bytes: (start positions, buckets)."""
    c = LETTERS[raw].astype(np.uint32)
    for n in (3, 4):
        if len(c) < n:
            continue
        m = len(c) - n + 1
        ok = c[1 : 1 + m] != 32
        h = c[:m] * np.uint32(0x9E3779B1) + np.uint32(n)
        for k in range(1, n):
            h = (h ^ c[k : k + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        if n == 4:
            ok &= c[2 : 2 + m] != 32
        at = np.nonzero(ok)[0]
        yield at, (h[at] >> np.uint32(32 - LOG_BUCKETS)).astype(np.int64)


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # class scores of each bucket, and whether training has seen it
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = (total[:, : len(self.labels)] / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def scores(self, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best class, score) of texts with these sums of the table's rows and numbers of subwords."""
        p = self.probabilities(total, n)
        return p.argmax(axis=1), p.max(axis=1) * total[:, -1] / np.maximum(n, 1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole text and windows of each document as (label, h, ids, counts)."""
    for batch in batches:
        out: list[tuple] = []
        for text, label, h in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            rng = np.random.default_rng(abs(h))
            cuts = [raw] + [raw[s : s + w] for w in WINDOWS if len(raw) > w for s in [int(rng.integers(len(raw) - w))]]
            for piece in cuts:
                found = [b for _, b in subwords(piece)]
                ids, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, int), np.zeros(0, int))
                if len(ids):
                    out.append((label, h, ids.astype(np.int32), counts.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int32())), pa.array([x[3] for x in out], pa.list_(pa.int32()))],
            names=["label", "h", "ids", "counts"],
        )


def train(labelled: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "lang", max_docs: int = MAX_DOCS, seed: int = 5) -> Model:
    """A model of the rows with a label. At most ``max_docs`` documents' subword counts reach the driver."""
    keyed = labelled.where(F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), F.xxhash64(F.lit(seed), doc_id).alias("h"))
    last = keyed.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    if last is None:
        return Model([], np.zeros((1, 1)), np.zeros(0), 1.0, 1.0)
    one = keyed.where(F.col("h") <= last).groupBy("h").agg(F.min(F.struct("text", "label")).alias("d")).select("d.text", "d.label", "h")
    sample = one.mapInArrow(_features, "label string, h long, ids array<int>, counts array<int>").toArrow()
    (ids, at), (counts, _) = _flat(sample.column(2)), _flat(sample.column(3))
    names = zip(*(sample.column(i).to_pylist() for i in (1, 0)), strict=True)
    data = sorted(((h, name, ids[a:b], counts[a:b]) for (h, name), a, b in zip(names, at[:-1].tolist(), at[1:].tolist(), strict=True)), key=lambda x: (x[0], len(x[2])))
    labels = sorted({x[1] for x in data})
    no = {name: k for k, name in enumerate(labels)}
    fit, held = [x for x in data if x[0] % 5], [x for x in data if not x[0] % 5]
    rng = np.random.default_rng(seed)
    emb = (rng.random((1 << LOG_BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    out, bias = (rng.random((DIM, len(labels)), dtype=np.float32) - 0.5) / 4, np.zeros(len(labels), dtype=np.float32)
    steps, step = max(1, EPOCHS * len(fit)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(fit)):
            _, name, ids, counts = fit[k]
            rate, step = np.float32(RATE * (1 - step / steps)), step + 1
            share = (counts / counts.sum()).astype(np.float32)
            x = share @ emb[ids]
            z = x @ out + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[no[name]] -= 1
            back = out @ g
            out -= rate * np.outer(x, g)
            bias -= rate * np.float32(0.1) * g
            emb[ids] -= rate * np.outer(share, back)
    seen = np.zeros((1 << LOG_BUCKETS, 1), dtype=np.float32)
    for _, _, ids, _ in fit:
        seen[ids] = 1
    model = Model(labels, np.hstack([emb @ out, seen]).astype(np.float32), bias, 1.0, 0.0)
    return _calibrated(model, held or fit, no)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of lists, as arrays: Python's own integers would take ten times the driver's memory."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy(), at


def _calibrated(model: Model, held: list, no: dict[str, int]) -> Model:
    total = np.array([counts @ model.table[ids] for _, _, ids, counts in held], dtype=np.float64).reshape(len(held), len(no) + 1)
    n, y = np.array([x[3].sum() for x in held]), np.array([no[x[1]] for x in held])
    best = (np.inf, 1.0)
    for model.temperature in np.geomspace(0.05, 20, 60):
        p = model.probabilities(total, n)[np.arange(len(held)), y]
        best = min(best, (-np.log(np.maximum(p, 1e-12)).mean(), float(model.temperature)))
    model.temperature = best[1]
    bound = np.quantile(model.scores(total, n)[1], REJECT_SHARE)
    model.reject_below = float(bound if len(held) >= REJECT_PIECES else min(REJECT_CHANCE / len(no), bound))
    return model


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls empty, without copying."""
    column = column.fill_null("") if column.null_count else column
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=wide)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), at


def sums(model: Model, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the table's rows and number of subwords of the texts between the offsets, in blocks that may cut long texts."""
    total, n = np.zeros((len(at) - 1, len(model.labels) + 1)), np.zeros(len(at) - 1, dtype=np.int64)
    for lo in range(int(at[0]), int(at[-1]), BLOCK):
        hi = min(lo + BLOCK, int(at[-1]))
        for k, (pos, bucket) in enumerate(subwords(raw[lo : min(hi + 3, int(at[-1]))])):
            doc = np.searchsorted(at, pos + lo, side="right") - 1
            ok = (pos + lo < hi) & (pos + lo + 3 + k <= at[doc + 1])
            doc, bucket = doc[ok], bucket[ok]
            if len(doc):
                first = np.concatenate([[0], np.nonzero(doc[1:] != doc[:-1])[0] + 1])
                total[doc[first]] += np.add.reduceat(model.table[bucket], first, axis=0)
                n[doc[first]] += np.diff(np.append(first, len(doc)))
    return total, n


def predict(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each document with lang_pred, score and rejected; ``keep``: input columns to carry (default: the id)."""
    keep = keep or [doc_id]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    # the text comes first and only once; where it is carried, its column goes back as it came
    sent = [text, *(c for c in keep if c != text)]
    back = [sent.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        names = np.array([*m.labels, "und"], dtype=object)
        for batch in batches:
            raw, at = text_bytes(batch.column(0))
            letter = batch.column(batch.num_columns - 1).fill_null(False).to_numpy(zero_copy_only=False)
            if m.labels:
                top, score = m.scores(*sums(m, raw, at))
            else:
                top, score, letter = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=bool)
            score = np.where(letter, score, 0.0)
            pred = names[np.where(letter, top, len(m.labels))]
            new = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(~letter | (score < m.reject_below))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in back), *new], names=[*keep, "lang_pred", "score", "rejected"])
        pa.default_memory_pool().release_unused()

    carried = docs.select([F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*carried.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    has_letter = F.col(f"`{text}`").rlike(r"\p{L}")
    return docs.select(*[F.col(f"`{c}`") for c in sent], has_letter.alias("__letter")).mapInArrow(run, schema)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts
