"""Media columns: content-addressed payloads in tar shards.

A text's UTF-8 bytes, filled up with zeros to a positive multiple of 64, are stored as the pixels of an 8-bit grey PNG 64 wide.
Each task appends its distinct payloads, named by their SHA-256, to its own tar shards in the
shared folder, and rows carry digest, shard, offset and length. Equal payloads have equal digests and bytes; a
task stores each once, so copies within a task share a place. Texts and payloads are never shuffled; rows of places are dealt to reading tasks
by slices of the shards. Metadata columns come from range reads of the
first 33 bytes alone; payloads are read only for features.

Null text counts as empty: 64 zeros. Repeated rows and ids share places. An empty table gives an empty
result and no shard. Shards go when the application ends unless ``folder`` is given. A lost task writes new shards; its rows
name only the shards of the attempt that succeeded.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.common import _path, scratch, shared_dir

WIDTH, HEADER = 64, 33
SHARD_BYTES = 256 << 20
#: Digests whose place, or features, a task remembers.
REMEMBERED = 100_000
#: Stored bytes that a reading task gets, and those of the slices that it gets them in: many a task, so that tasks come out alike.
TASK_BYTES, SLICE_BYTES = 32 << 20, 2 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(padded payload, bytes without padding)."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH), len(raw)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)  # each line starts with filter 0
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """(width, height, bits a sample) from the first 33 bytes; raises ValueError if they aren't a PNG's."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", head[16:25])


def from_png(media: bytes) -> bytes:
    width, height, _ = png_header(media[:HEADER])
    at, body = HEADER, b""
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        if kind == b"IDAT":
            body += media[at + 8 : at + 8 + n]
        at += n + 12
    lines = np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("only unfiltered lines are written here")
    return lines[:, 1:].tobytes()


def mean_hash(payload: bytes) -> str:
    """16 hex digits: which of 8 x 8 areas of the image are brighter than its mean."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    edges = np.arange(9) * len(rows) // 8
    bands = np.array([rows[min(a, len(rows) - 1) : max(b, min(a, len(rows) - 1) + 1)].mean(axis=0) for a, b in zip(edges[:-1], edges[1:], strict=True)])
    areas = bands.reshape(8, 8, 8).mean(axis=2)
    return np.packbits((areas > areas.mean()).ravel()).tobytes().hex()


class _Shard:
    """A tar file being written."""

    def __init__(self, folder: str) -> None:
        files, path = pafs.FileSystem.from_uri(folder)
        self.name = f"shard-{uuid.uuid4().hex}.tar"
        self.file, self.at = files.open_output_stream(f"{path}/{self.name}"), 0

    def add(self, name: str, body: bytes) -> int:
        """The body's offset."""
        info = tarfile.TarInfo(name)
        info.size = len(body)
        head = info.tobuf(format=tarfile.USTAR_FORMAT)
        self.file.write(head + body + bytes(-len(body) % 512))
        offset = self.at + len(head)
        self.at = offset + len(body) + -len(body) % 512
        return offset

    def close(self) -> None:
        self.file.write(bytes(1024))
        self.file.close()


def store(docs: DataFrame, *, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """(rows of doc_id, n_bytes, digest, shard, offset, length; the shards' folder)."""
    spark = docs.sparkSession
    own = folder or f"{shared_dir(spark)}/media-{uuid.uuid4().hex}"
    files, path = _path(spark, own)
    files.mkdirs(path)
    if not folder:
        files.deleteOnExit(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, places = None, {}
        for batch in batches:
            rows = []
            for value in batch.column(1):
                payload, n = payload_of(value.as_py())
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in places:
                    if shard and shard.at > SHARD_BYTES:
                        shard.close()
                        shard = None
                    shard = shard or _Shard(own)
                    media = to_png(payload)
                    if len(places) >= REMEMBERED:
                        places.clear()
                    places[digest] = (shard.name, shard.add(f"{digest}.png", media), len(media))
                rows.append((n, digest, *places[digest]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)
        if shard:
            shard.close()

    names = [doc_id, "n_bytes", "digest", "shard", "offset", "length"]
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
    return _by_slices(scratch(docs.select(doc_id, text).mapInArrow(run, schema))), own


def _by_slices(rows: DataFrame) -> DataFrame:
    """``rows`` in tasks by stored bytes, not by rows: each reads slices of shards, in order of offset."""
    ends = rows.groupBy("shard").agg(F.max(F.col("offset") + F.col("length")).alias("end"))
    stored = ends.agg(F.sum("end")).first()[0] or 0
    return rows.repartition(stored // TASK_BYTES + 1, "shard", F.floor(F.col("offset") / SLICE_BYTES)).sortWithinPartitions("shard", "offset")


def _read(rows: DataFrame, folder: str, columns: list[tuple[str, T.DataType, pa.DataType]], describe, whole: bool) -> DataFrame:
    """``rows`` with columns that ``describe`` makes of the header, or of the whole stored bytes."""
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, t, _ in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        name, file, known = None, None, {}
        for batch in batches:
            got = []
            for shard, offset, length in zip(*(batch.column(batch.schema.names.index(n)).to_pylist() for n in ("shard", "offset", "length")), strict=True):
                if (shard, offset) not in known:
                    if shard != name:
                        name, file = shard, files.open_input_file(f"{root}/{shard}")
                    file.seek(offset)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[shard, offset] = describe(file.read(length if whole else min(length, HEADER)))
                got.append(known[shard, offset])
            new = list(zip(*got, strict=True)) if got else [()] * len(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, k) for v, (_, _, k) in zip(new, columns, strict=True))], names=schema.names)

    return rows.mapInArrow(run, schema)


def metadata(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` of :func:`store` with width, height and bits, by range reads of headers only."""
    return _read(rows, folder, [(n, T.LongType(), pa.int64()) for n in ("width", "height", "bits")], png_header, whole=False)


def _features(media: bytes) -> tuple:
    payload = from_png(media)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), mean_hash(payload)


def features(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and feature, from the bytes read back."""
    long, string = (T.LongType(), pa.int64()), (T.StringType(), pa.string())
    columns = [("payload_bytes", *long), ("payload_sha256", *string), ("tail_crc32", *long), ("media_bytes", *long), ("media_sha256", *string), ("feature", *string)]
    return _read(rows, folder, columns, _features, whole=True)
