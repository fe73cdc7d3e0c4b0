"""Synthetic samples: parsing and checking what a generator returns, ids, and resumable appends."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.functions.records import is_call, is_tool, parse
from gleanspark.operators.scoring import ROUTES, stable_json

#: Keys that mark logged data; a batch that has one anywhere is refused.
AUDIT_KEYS = {"request_id", "file_path", "tenant_id", "user_id", "api_key_id", "client_ip", "session_id", "request_body", "response_body", "tenant_hash", "user_hash", "session_hash"}
SCHEMA = "sample_id string, task_type string, json string, problem string"
FENCE = re.compile(r"^\s*```(?:json)?\s*\n?(.*?)\n?\s*```\s*$", re.S)


def strip_fence(text: str) -> str:
    m = FENCE.match(text)
    return m[1] if m else text.strip()


def audit_key(value) -> bool:
    if isinstance(value, dict):
        return any(k in AUDIT_KEYS or audit_key(v) for k, v in value.items())
    return isinstance(value, list) and any(map(audit_key, value))


def _filled(value) -> bool:
    return isinstance(value, str) and value.strip() != ""


def _messages(value) -> list | None:
    good = isinstance(value, list) and value and all(isinstance(m, dict) and m.get("role") in ("system", "user", "assistant") and _filled(m.get("content")) for m in value)
    return [{"role": m["role"], "content": m["content"]} for m in value] if good and any(m["role"] == "user" for m in value) else None


def normalise(sample) -> dict | None:
    """The sample in the shape of its task type, or None."""
    if not isinstance(sample, dict) or not _filled(sample.get("topic")):
        return None
    kind, base = sample.get("task_type"), {"task_type": sample.get("task_type"), "topic": sample["topic"]}
    if kind == "router":
        return base | {"input": sample["input"], "label": sample["label"]} if _filled(sample.get("input")) and sample.get("label") in ROUTES else None
    messages = _messages(sample.get("messages"))
    if not messages:
        return None
    if kind == "sft":
        return base | {"messages": messages, "response": sample["response"]} if _filled(sample.get("response")) else None
    reply, tools = sample.get("response_message"), sample.get("tools")
    if kind != "tool_use_sft" or not isinstance(reply, dict) or not isinstance(tools, list) or not tools or not all(map(is_tool, tools)):
        return None
    calls = reply.get("tool_calls")
    good = isinstance(calls, list) and calls and all(map(is_call, calls))
    return base | {"messages": messages, "tools": tools, "response_message": reply} if good else None


def sample_id(sample: dict) -> str:
    """Depends on the content, not on where it came from."""
    own = {k: v for k, v in sample.items() if k not in ("source", "sample_id")}
    return "synthetic-" + hashlib.sha256(stable_json(own).encode()).hexdigest()[:24]


def parse_batch(answer: str, source: dict) -> list[dict]:
    """The valid samples of an answer: an array, or an object with ``samples``. ValueError if it has none or an audit-like key."""
    value = parse(strip_fence(answer))
    listed = value.get("samples") if isinstance(value, dict) else value
    if not isinstance(listed, list):
        raise ValueError("no samples")
    if audit_key(value):
        raise ValueError("audit-like key")
    good = [n | {"source": source, "sample_id": sample_id(n)} for n in map(normalise, listed) if n]
    if not good:
        raise ValueError("no valid sample")
    return good


def parse_answers(answers: DataFrame, **source: str) -> DataFrame:
    """(batch_index, answer) rows to samples: sample_id, task_type, json; a refused batch is a row with its problem. ``source`` is told of every sample."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for batch, answer in zip(frame["batch_index"], frame["answer"], strict=True):
                try:
                    rows += [(s["sample_id"], s["task_type"], stable_json(s), None) for s in parse_batch(answer or "", {"type": "synthetic", "batch_index": int(batch)} | source)]
                except ValueError as e:
                    rows.append((None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["sample_id", "task_type", "json", "problem"], dtype=object)

    return answers.select("batch_index", "answer").mapInPandas(run, SCHEMA)


def unseen(new: DataFrame, old: DataFrame, key: str = "sample_id") -> DataFrame:
    """The rows whose key ``old`` lacks."""
    return new.join(old.select(key), key, "left_anti")


def synthesize(
    spark: SparkSession, generate: Callable[[int], str], folder: str, target: int, per_round: int = 8, retries: int = 3, most_rounds: int = 1000, progress: Callable[[dict], None] | None = None, **source: str
) -> int:
    """Asks ``generate(batch_index)`` in rounds on the executors and appends new samples to ``folder`` until it has ``target``.

    Resumes from what the folder holds; ends as well after ``most_rounds``, or after a round without a new sample. ``progress`` is told the state before the first
    round and after each one.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = []
            for batch in frame["id"]:
                for left in reversed(range(max(1, retries))):
                    try:
                        answers.append((batch, generate(int(batch))))
                        break
                    except Exception:
                        if not left:
                            raise
            yield pd.DataFrame(answers, columns=["batch_index", "answer"])

    have = lambda: spark.read.schema("sample_id string, task_type string, json string, round int").parquet(folder) if _exists(spark, folder) else None
    old = have()
    count = old.count() if old is not None else 0
    first = (old.agg(F.max("round")).first()[0] if count else -1) + 1 if old is not None else 0
    tell = lambda n: progress({"completed": count, "target_count": target, "next_batch_index": n * per_round}) if progress else None
    tell(first)
    for n in range(first, first + most_rounds):
        if count >= target:
            break
        answers = spark.range(n * per_round, (n + 1) * per_round, numPartitions=per_round).mapInPandas(ask, "batch_index long, answer string")
        new = parse_answers(answers, **source).where("problem is null").drop("problem").dropDuplicates(["sample_id"])
        if old is not None:
            new = unseen(new, old)
        new.withColumn("round", F.lit(n)).write.mode("append").parquet(folder)
        old = have()
        count, before = old.count(), count
        tell(n + 1)
        if count == before:
            break
    return count


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
