"""Samples: one request and its reply a row, slim: what classification, scoring and selection need.

Columns: sample_id, date, tenant_hash, user_hash, session_hash, event_time_ms, line_no, model, client_type, user_text,
response_text, message_count, messages_chars, has_tools, tool_names, prompt_tokens, completion_tokens, finish_reason,
redaction_hits, has_user_text, tool_trace (null if good), history_unsafe (a message fails the leak scan), tool_unsafe (so does a
part of the tool trace).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.functions import text as t

DATE = "2026-01-01"


def from_conversations(conversations: DataFrame, date: str = DATE) -> DataFrame:
    """Each assistant turn with the turns before it. History is summed up by windows, never copied into rows."""
    clean = t.redact(conversations, "text", out="content", stats="stats").withColumn("hits", F.coalesce(t.redaction_hits(F.col("stats")), F.lit(0)))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    user = F.when(F.col("role") == "user", F.col("content"))
    chars = F.length("role") + F.length("content") + 23
    turns = clean.select(
        "conv_id", "turn", "role", "content",
        F.last(user, ignorenulls=True).over(before).alias("last_user"),
        F.count("*").over(before).alias("message_count"),
        (F.sum(chars).over(before) + F.count("*").over(before) + 1).alias("messages_chars"),
        F.sum(F.size(F.split("content", r"\s+"))).over(before).alias("prompt_tokens"),
        F.max(F.when(t.strip(user) != "", 1).otherwise(0)).over(before).alias("any_user"),
        F.max(F.when((t.strip(F.col("content")) != "") & t.leakage(t.strip(F.col("content"))).isNotNull(), 1).otherwise(0)).over(before).alias("unsafe"),
        (F.coalesce(F.sum("hits").over(before), F.lit(0)) + F.col("hits")).alias("redaction_hits"),
    )
    answers = turns.where((F.col("role") == "assistant") & (F.col("message_count") > 0))
    conv = F.col("conv_id")
    return answers.select(
        F.sha2(F.concat_ws(":", conv, "turn"), 256).alias("sample_id"),
        F.lit(date).alias("date"),
        F.lit("").alias("tenant_hash"),
        t.hash_identifier(F.floor(conv / 10)).alias("user_hash"),
        t.hash_identifier(conv).alias("session_hash"),
        (conv * 3_600_000 + F.col("turn") * 60_000).alias("event_time_ms"),
        (conv * 1000 + F.col("turn")).alias("line_no"),
        F.get(F.array(*[F.lit(m) for m in ("gpt-4o", "qwen-max", "glm-4", "deepseek-chat", "mistral")]), (conv % 5).cast("int")).alias("model"),
        F.lit("api").alias("client_type"),
        t.strip(F.coalesce("last_user", F.lit(""))).alias("user_text"),
        t.strip(F.col("content")).alias("response_text"),
        "message_count",
        "messages_chars",
        F.lit(False).alias("has_tools"),
        F.array().cast("array<string>").alias("tool_names"),
        F.coalesce("prompt_tokens", F.lit(0)).alias("prompt_tokens"),
        F.size(F.split("content", r"\s+")).alias("completion_tokens"),
        F.lit("stop").alias("finish_reason"),
        "redaction_hits",
        (F.col("any_user") == 1).alias("has_user_text"),
        F.lit(None).cast("string").alias("tool_trace"),
        (F.col("unsafe") == 1).alias("history_unsafe"),
        F.lit(False).alias("tool_unsafe"),
    )


def histories(conversations: DataFrame) -> DataFrame:
    """sample_id and its non-empty messages (role, content): for exports only, as every sample repeats its conversation so far."""
    clean = t.redact(conversations, "text", out="content", stats="stats").withColumn("content", t.strip(F.col("content")))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = clean.select("conv_id", "turn", "role", F.collect_list(F.when(F.col("content") != "", F.struct("role", "content"))).over(before).alias("messages"))
    return turns.where("role = 'assistant'").select(F.sha2(F.concat_ws(":", "conv_id", "turn"), 256).alias("sample_id"), "messages")
