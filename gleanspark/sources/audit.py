"""Reading audit logs: an index of JSON lines per date, and one JSON file per request.

Spark's file sources skip names that start with an underscore, so the index has a data source of its own. Index lines,
detail files and checks go through one pass without a shuffle.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleanspark.functions import records

INDEX = "_request_index.jsonl"
SAMPLE_SCHEMA = (
    "sample_id string, date string, tenant_hash string, user_hash string, session_hash string, event_time_ms long, line_no long, model string, client_type string, user_text string, response_text string, "
    "message_count int, messages_chars int, has_tools boolean, tool_names array<string>, prompt_tokens long, completion_tokens long, finish_reason string, redaction_hits int, has_user_text boolean, "
    "tool_trace string, history_unsafe boolean, tool_unsafe boolean, messages_json string, spoken_json string, tools_json string, response_json string, canonical string"
)


def date_range(start: str, end: str) -> list[str]:
    """All dates from start to end, both in strict YYYY-MM-DD form and included."""
    first, last = valid_date(start), valid_date(end)
    if first > last:
        raise ValueError("start is after end")
    return [(first + timedelta(days=k)).isoformat() for k in range((last - first).days + 1)]


def valid_date(text: str) -> date:
    value = date.fromisoformat(text)
    if value.isoformat() != text:
        raise ValueError(f"not a YYYY-MM-DD date: {text}")
    return value


def _files(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("/") else (fs.LocalFileSystem(), root)


class _Date(InputPartition):
    def __init__(self, day: str) -> None:
        self.day = day


class _IndexReader(DataSourceReader):
    def __init__(self, root: str, days: list[str]) -> None:
        self.root, self.days = root, days

    def partitions(self) -> list[InputPartition]:
        return [_Date(d) for d in self.days]

    def read(self, partition: _Date) -> Iterator[tuple]:
        files, root = _files(self.root)
        with files.open_input_stream(f"{root}/{partition.day}/{INDEX}") as f:
            rest, line = b"", 0
            while block := f.read(1 << 20):
                *lines, rest = (rest + block).split(b"\n")
                for text in lines:
                    line += 1
                    if text.strip():
                        yield partition.day, line, text.decode("utf-8", "replace")
            if rest.strip():
                yield partition.day, line + 1, rest.decode("utf-8", "replace")


class AuditIndex(DataSource):
    """``spark.read.format("audit_index").option("dates", "2026-01-01,2026-01-02").load(root)``: date, line_no, text."""

    @classmethod
    def name(cls) -> str:
        return "audit_index"

    def schema(self) -> str:
        return "date string, line_no long, text string"

    def reader(self, schema) -> DataSourceReader:
        return _IndexReader(self.options["path"], self.options["dates"].split(","))


def read_index(spark: SparkSession, root: str, dates: list[str]) -> DataFrame:
    spark.dataSource.register(AuditIndex)
    return spark.read.format("audit_index").option("dates", ",".join(dates)).load(root)


def index_entry(text: str) -> tuple[dict | None, str | None]:
    """(entry, error) of an index line."""
    try:
        entry = records.parse(text)
    except ValueError:
        return None, "bad_index_json"
    good = isinstance(entry, dict) and all(isinstance(entry.get(k), str) and entry[k] for k in ("request_id", "file_path"))
    return (entry, None) if good else (None, "bad_index_record")


def safe_path(relative: str) -> bool:
    """Whether a path stays below its root: relative, and no way up."""
    return not relative.startswith(("/", "\\")) and ":" not in relative.split("/")[0] and ".." not in relative.replace("\\", "/").split("/") and posixpath.normpath(relative) != "."


def load_detail(files, root: str, relative: str):
    """(raw record, error) of a detail file; symbolic links may not lead out of the root."""
    import os

    from pyarrow import fs

    if not safe_path(relative):
        return None, "unsafe_detail_path"
    path = f"{root}/{relative}"
    if isinstance(files, fs.LocalFileSystem) and not os.path.realpath(path).startswith(os.path.realpath(root) + os.sep):
        return None, "unsafe_detail_path"
    if files.get_file_info(path).type != fs.FileType.File:
        return None, "missing_detail_file"
    with files.open_input_file(path) as f:
        try:
            return records.parse(f.read().decode("utf-8")), None
        except ValueError:
            return None, "bad_detail_json"


def hash_id(value) -> str:
    import hashlib

    return "" if value is None or value == "" else hashlib.sha256(str(value).encode()).hexdigest()[:16]


def canonicalise(raw: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Samples, or reasons, of records that are already in a table: date, line_no, request_id, file_path, raw (JSON text). Columns ``without`` are left out."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([f for f in StructType.fromDDL(f"{SAMPLE_SCHEMA}, reason string") if f.name not in without])
    whole = "canonical" not in without
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                row: dict = {"reason": None}
                try:
                    value = records.parse(r["raw"] or "")
                    row |= records.canonical(r["date"], r["line_no"], {"request_id": r["request_id"], "file_path": r["file_path"]}, value, hash_id, whole)
                except records.Rejected as e:
                    row["reason"] = str(e)
                except ValueError:
                    row["reason"] = "bad_detail_json"
                rows.append({"date": r["date"], "line_no": r["line_no"]} | row)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return raw.select("date", "line_no", "request_id", "file_path", "raw").mapInArrow(run, schema)


def read_samples(spark: SparkSession, root: str, dates: list[str], limit: int | None = None) -> DataFrame:
    """A row per index line: ``reason`` (null if accepted) and the sample's columns.

    ``limit`` stops before the line of the (limit + 1)-th well-formed index entry of a date.
    """
    index = read_index(spark, root, dates)
    if limit is not None:
        from pyspark.sql import Window

        formed = F.pandas_udf(lambda s: s.map(lambda x: index_entry(x)[1] is None), "boolean")
        nth = F.row_number().over(Window.partitionBy("date").orderBy("line_no"))
        end = index.where(formed("text")).withColumn("n", nth).where(F.col("n") == limit + 1).select("date", F.col("line_no").alias("end"))
        index = index.join(F.broadcast(end), "date", "left").where("end is null or line_no < end").drop("end")

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType.fromDDL(f"{SAMPLE_SCHEMA}, reason string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        for batch in batches:
            rows = []
            for day, line, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                entry, reason = index_entry(text)
                row: dict = {}
                if not reason:
                    raw, reason = load_detail(files, base, entry["file_path"])
                if not reason:
                    try:
                        row = records.canonical(day, line, entry, raw, hash_id)
                    except records.Rejected as e:
                        reason = str(e)
                rows.append({"date": day, "line_no": line, "reason": reason} | row)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    spread = index.repartition(max(2, spark.sparkContext.defaultParallelism), "date", "line_no")  # one date is one partition of the source: deal its files out
    return spread.mapInArrow(run, schema)
