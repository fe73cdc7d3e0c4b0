"""Route and intent by rules, the deterministic score, and what a sample may be used for: projections only."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gleanspark.functions import text as t

# ---- Fixed values: labels and key words, in order of precedence.

ROUTES = ("general_chat", "code_generation", "tool_agent", "long_context", "reasoning", "domain_qa", "unsafe_or_invalid", "unknown")
ROUTE_WORDS = (
    ("code_generation", ("python", "代码", "函数", "bug", "sql", "shell", "脚本")),
    ("reasoning", ("推理", "证明", "分析", "为什么", "步骤")),
    ("domain_qa", ("账单", "订单", "用户资料", "营业", "发票")),
)
INTENT_WORDS = (
    ("debug_code", ("bug", "报错", "traceback", "修复", "debug")),
    ("write_code", ("python", "代码", "函数", "sql", "shell", "脚本")),
    ("summarize_or_transform", ("总结", "改写", "翻译", "提取")),
    ("analyze_reason", ("推理", "证明", "分析", "为什么", "步骤")),
    ("domain_lookup", ("账单", "订单", "用户资料", "营业", "发票")),
)
INTENTS = ("greeting_or_probe", "answer_question", "write_code", "debug_code", "analyze_reason", "use_tool", "summarize_or_transform", "domain_lookup", "unknown")
LONG_TOKENS, LONG_CHARS = 64_000, 120_000


@dataclass(frozen=True)
class Config:
    """Defaults of selection: fixed values."""

    selected_min_score: float = 0.6
    router_min_score: float = 0.5
    sft_min_score: float = 0.6
    tool_use_min_score: float = 0.6
    multi_turn_min_score: float = 0.6
    max_sft_per_user: int = 1000
    max_router_per_user: int = 2000
    max_tool_use_per_user: int = 1000
    max_per_task: int = 200
    max_high_value_per_task: int = 50
    max_chars: int = 1200
    episode_gap_minutes: int = 30
    k_threshold: int = 5
    dedupe: bool = True
    near_duplicates: bool = True
    noise_filter: bool = True
    simhash_hamming: int = 4
    jaccard: float = 0.88
    min_chars: int = 16
    min_tokens: int = 4
    max_representatives: int = 128
    control_repeats: int = 2
    task_burst: int = 8
    burst_minutes: float = 20
    max_seen_hashes: int = 1_000_000
    hmac_key: str = ""


def _has_any(low: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def route_label() -> Column:
    low = F.lower("user_text")
    out = F.when(F.col("has_tools"), "tool_agent").when((F.coalesce("prompt_tokens", F.lit(0)) >= LONG_TOKENS) | (F.col("messages_chars") >= LONG_CHARS), "long_context")
    for label, words in ROUTE_WORDS:
        out = out.when(_has_any(low, words), label)
    return out.otherwise("general_chat")


def intent_label() -> Column:
    low, norm = F.lower("user_text"), F.col("normalized")
    out = F.when(norm.isin(*t.GREETINGS) | (F.length(norm) <= 2), "greeting_or_probe").when(F.col("has_tools"), "use_tool")
    for label, words in INTENT_WORDS:
        out = out.when(_has_any(low, words), label)
    return out.when(F.col("user_text") != "", "answer_question").otherwise("unknown")


def stable_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def content_hash(value: object) -> str:
    return hashlib.sha256(stable_json(value).encode()).hexdigest()


@F.pandas_udf(StringType())
def task_fingerprint(route: pd.Series, intent: pd.Series, user: pd.Series, tools: pd.Series) -> pd.Series:
    """24 hex digits of the hash over the JSON of route, intent, normalised text and sorted tool names."""
    return pd.Series([content_hash({"route": r, "intent": i, "user": u, "tools": sorted(n)})[:24] for r, i, u, n in zip(route, intent, user, tools, strict=True)], dtype=object)


def classify(samples: DataFrame) -> DataFrame:
    """Adds normalized, route_label and intent_label."""
    return samples.withColumn("normalized", t.normalize(F.col("user_text"))).withColumns({"route_label": route_label(), "intent_label": intent_label()})


def _labels(*pairs: tuple[Column, str]) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(x)) for c, x in pairs]))))


def score(classified: DataFrame) -> DataFrame:
    """Adds deterministic_score, value_labels, risk_labels, reject_reasons and score_bucket."""
    route, intent, norm = F.col("route_label"), F.col("intent_label"), F.col("normalized")
    code = (route == "code_generation") | intent.isin("write_code", "debug_code")
    tool = (route == "tool_agent") | (intent == "use_tool")
    reason = (route == "reasoning") | (intent == "analyze_reason")
    domain = (route == "domain_qa") | (intent == "domain_lookup")
    formed = F.length("response_text") >= 8
    add = lambda c, x: F.when(c, x).otherwise(0.0)
    base = F.lit(0.5) + add(code, 0.25) + add(tool, 0.25) + add(reason, 0.2) + add(domain, 0.15) + add(formed, 0.1)  # in this order: it is a sum of doubles
    empty = F.col("user_text") == ""
    greeting = ~empty & (norm.isin(*t.GREETINGS) | ((F.length(norm) <= 2) & (route == "general_chat")))
    short = ~empty & ~greeting & (F.length(norm) < 4) & (route == "general_chat")
    cut = F.coalesce(F.col("finish_reason") == "length", F.lit(False))
    redacted = F.col("redaction_hits") > 0
    capped = F.when(empty, 0.0).when(greeting, F.least(base, F.lit(0.2))).when(short, F.least(base, F.lit(0.3))).otherwise(base)
    capped = F.when(cut, F.least(capped, F.lit(0.4))).otherwise(capped)
    capped = F.when(redacted, F.least(capped, F.lit(0.45))).otherwise(capped)
    rejects = F.array_compact(F.array(F.when(empty, F.lit("empty_user_text")), F.when(greeting, F.lit("greeting_or_probe")), F.when(short, F.lit("too_short_low_information")), F.when(cut, F.lit("length_finish")), F.when(redacted, F.lit("redaction_risk"))))
    out = classified.withColumns(
        {
            "deterministic_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), capped)),
            "value_labels": _labels((code, "code_task"), (tool, "tool_task"), (reason, "reasoning_task"), (domain, "domain_task"), (formed, "well_formed_response")),
            "risk_labels": _labels((empty | greeting | short, "low_information"), (cut, "length_finish"), (redacted, "redaction_risk")),
            "reject_reasons": rejects,
        }
    )
    return out.withColumns({"final_score": F.col("deterministic_score"), "score_bucket": t.score_bucket(F.col("deterministic_score"))})


def annotate(samples: DataFrame, config: Config = Config()) -> DataFrame:
    """Classified and scored samples with task_fingerprint, task_bucket and use_for.

    A sample with tools but a bad tool trace is rejected for every use.
    """
    out = score(classify(samples))
    out = out.withColumn("task_fingerprint", task_fingerprint("route_label", "intent_label", "normalized", "tool_names"))
    bucket = F.concat_ws(":", "route_label", "intent_label")
    if config.hmac_key:
        bucket = F.concat_ws(":", bucket, t.hmac_digest(config.hmac_key, 12)(F.concat_ws(":", "date", "task_fingerprint")))
    return use_for(out.withColumn("task_bucket", bucket), config)


def exportable_sft() -> Column:
    return (F.col("response_text") != "") & F.col("has_user_text") & ~F.col("has_tools") & F.coalesce(F.col("finish_reason") != "length", F.lit(True))


def use_for(scored: DataFrame, config: Config = Config()) -> DataFrame:
    """(Re)computes use_for from rejects and scores; a bad tool trace found on the way becomes a reject."""
    final, least = F.col("final_score"), config.selected_min_score
    open_ = (F.size("reject_reasons") == 0) & (F.col("deterministic_score") >= least) & (final >= least)
    bad = open_ & F.col("has_tools") & (final >= config.tool_use_min_score) & F.col("tool_trace").isNotNull()
    tool = F.col("has_tools") & (final >= config.tool_use_min_score) & F.col("tool_trace").isNull()
    kinds = F.array_compact(F.array(F.when(final >= config.router_min_score, F.lit("router_classification")), F.when((final >= config.sft_min_score) & exportable_sft(), F.lit("sft")), F.when(tool, F.lit("tool_use_sft"))))
    none = F.array().cast("array<string>")
    mark = F.array(F.lit("invalid_selected_tool_trace"))
    return scored.withColumns(
        {
            "use_for": F.when(open_ & ~bad, kinds).otherwise(none),
            "risk_labels": F.when(bad, F.array_union("risk_labels", mark)).otherwise(F.col("risk_labels")),
            "reject_reasons": F.when(bad, F.array_union("reject_reasons", mark)).otherwise(F.col("reject_reasons")),
        }
    )


def final_route(label: Column, confidence: Column) -> tuple[Column, Column]:
    """(label, confidence word): a valid model label wins, as high from 0.75 on and else as low; without one the rules' label is medium."""
    valid = F.coalesce(label.isin(*ROUTES) & confidence.between(0.0, 1.0) & ~F.isnan(confidence), F.lit(False))
    return F.when(valid, label).otherwise(F.col("route_label")), F.when(valid & (confidence >= 0.75), "high").when(valid, "low").otherwise("medium")
