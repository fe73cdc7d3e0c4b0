"""Training shapes: projections of samples to one JSON text a row, keys sorted."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import text as t
from gleanspark.operators.labels import router_features
from gleanspark.operators.scoring import exportable_sft, final_route

# ---- Fixed values: versions of the records' shapes, and why a sample is queued for a label.
CANONICAL, QUALITY, EPISODE, SELECTED = "audit_canonical.v2", "audit_quality.v1", "audit_episode.v1", "selected_training.v1"
REPORT, LABEL_QUEUE = "selection_report.v1", "label_queue.v2"
LOW_CONFIDENCE = "low_confidence_route"


def _model_label(samples: DataFrame) -> tuple[Column, Column]:
    """(label, confidence) that a model gave, null where none was asked."""
    if "model_label" in samples.columns:
        return F.col("model_label"), F.col("model_confidence")
    return F.lit(None).cast("string"), F.lit(None).cast("double")


def _json(**parts: Column) -> Column:
    """A JSON object of JSON texts, keys sorted."""
    inner = [F.concat(F.lit(f'"{k}":'), F.coalesce(parts[k], F.lit("null"))) for k in sorted(parts)]
    return F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))


def _text(c: Column) -> Column:
    """A JSON string."""
    return F.regexp_replace(F.regexp_replace(F.to_json(F.array(c)), r"^\[", ""), r"\]$", "")


def _bare(c: Column) -> Column:
    return c.cast("string")


def _list(c: str) -> Column:
    return F.to_json(F.col(c))


def base_metadata() -> Column:
    return _json(
        source_date=_text(F.col("date")), route_label=_text(F.col("route_label")), intent_label=_text(F.col("intent_label")), score_bucket=_text(F.col("score_bucket")),
        value_labels=_list("value_labels"), risk_labels=_list("risk_labels"), model_bucket=_text(t.model_bucket(F.col("model"))),
    )


def _messages() -> Column:
    """The history with the reply, JSON."""
    reply = _json(role=F.lit('"assistant"'), content=_text(F.col("response_text")))
    return F.concat(F.regexp_replace("spoken_json", r"\]$", ""), F.lit(","), reply, F.lit("]"))


def sft(samples: DataFrame) -> DataFrame:
    record = _json(sample_id=_text(F.col("sample_id")), instruction=F.lit('""'), input=_text(F.col("user_text")), output=_text(F.col("response_text")), messages=_messages(), metadata=_json(source_date=_text(F.col("date")), model=_text(F.col("model"))))
    return samples.where(exportable_sft()).select("sample_id", record.alias("json"))


def tool_use(samples: DataFrame) -> DataFrame:
    record = _json(sample_id=_text(F.col("sample_id")), messages=F.col("messages_json"), tools=F.col("tools_json"), response_message=F.col("response_json"), metadata=_json(source_date=_text(F.col("date")), finish_reason=_text(F.col("finish_reason")), model=_text(F.col("model"))))
    return samples.where(F.col("has_tools") & F.coalesce(F.col("finish_reason") != "length", F.lit(True))).select("sample_id", record.alias("json"))


def router(samples: DataFrame, label: Column | None = None, confidence: Column | None = None) -> DataFrame:
    label = F.lit(None).cast("string") if label is None else label
    confidence = F.lit(None).cast("double") if confidence is None else confidence
    final, word = final_route(label, confidence)
    features = _json(message_count=_bare(F.col("message_count")), has_tools=_bare(F.col("has_tools")), prompt_tokens=_bare(F.col("prompt_tokens")), client_type=_text(F.coalesce("client_type", F.lit(""))))
    model_label = F.when(word != "medium", F.to_json(F.struct(confidence.alias("confidence"), label.alias("label"))))
    labels = _json(weak_model_label=_text(F.col("model")), rule_label=_text(F.col("route_label")), model_label=model_label, final_label=_text(final), confidence=_text(word))
    return samples.select("sample_id", _json(sample_id=_text(F.col("sample_id")), input=_text(F.col("user_text")), features=features, labels=labels).alias("json"))


def label_queue(samples: DataFrame, label: Column, confidence: Column) -> DataFrame:
    """Why, features and present labels of samples whose route is of low confidence."""
    _, word = final_route(label, confidence)
    found = _json(route_label=_text(F.col("route_label")), intent_label=_text(F.col("intent_label")), confidence=_text(word))
    record = _json(schema_version=_text(F.lit(LABEL_QUEUE)), reason=_text(F.lit(LOW_CONFIDENCE)), features=F.to_json(router_features()), labels=found)
    return samples.where(word == "low").select("sample_id", record.alias("json"))


def selected_sft(selected: DataFrame) -> DataFrame:
    record = _json(schema_version=_text(F.lit(SELECTED)), instruction=F.lit('""'), input=_text(F.col("user_text")), output=_text(F.col("response_text")), messages=_messages(), metadata=base_metadata())
    return selected.where(F.array_contains("selected", "sft")).select("sample_id", record.alias("json"))


def selected_router(selected: DataFrame) -> DataFrame:
    """The final label is the model's, where it gave a valid one, else the rules'."""
    final, _ = final_route(*_model_label(selected))
    labels = _json(final_label=_text(final), rule_label=_text(F.col("route_label")))
    record = _json(schema_version=_text(F.lit(SELECTED)), input=_text(F.col("user_text")), features=F.to_json(router_features()), labels=labels, metadata=base_metadata())
    return selected.where(F.array_contains("selected", "router_classification")).select("sample_id", record.alias("json"))


def selected_tool_use(selected: DataFrame) -> DataFrame:
    record = _json(schema_version=_text(F.lit(SELECTED)), messages=F.col("messages_json"), tools=F.col("tools_json"), response_message=F.col("response_json"), metadata=base_metadata())
    return selected.where(F.array_contains("selected", "tool_use_sft")).select("sample_id", record.alias("json"))


def multi_turn(built: DataFrame, key: str | None = None) -> DataFrame:
    """Episodes with a public id, which nobody can link to the internal one without ``key`` (none: a new one, kept nowhere)."""
    meta = _json(source_date=_text(F.col("date")), turn_count=_bare(F.col("turn_count")), route_label=_text(F.col("route_label")), intent_label=_text(F.col("intent_label")), score_bucket=_text(F.col("score_bucket")))
    digest = t.hmac_digest(key or uuid.uuid4().hex, 16)(F.col("episode_id"))
    public = F.concat(F.lit("ep"), F.substring(digest, 1, 8), F.lit("x"), F.substring(digest, 9, 8))
    record = _json(schema_version=_text(F.lit(SELECTED)), episode_export_id=_text(public), messages=F.to_json("messages"), metadata=meta)
    return built.select("episode_id", record.alias("json"))


def quality(samples: DataFrame) -> DataFrame:
    """Diagnostics without any text."""
    route, intent = _text(F.col("route_label")), _text(F.col("intent_label"))
    task = _json(route_label=route, intent_label=intent, task_bucket=_text(F.col("task_bucket")))
    dedupe = _json(bucket=_text(F.col("dedupe_bucket")), matched_reasons=_list("matched_reasons"), suppressed_use_for=_list("suppressed_use_for"))
    model_score = _bare(F.col("model_score")) if "model_score" in samples.columns else F.lit("null")
    own = _json(
        deterministic_quality_score=_bare(F.col("deterministic_score")), model_quality_score=model_score, final_quality_score=_bare(F.col("final_score")), score_bucket=_text(F.col("score_bucket")),
        value_labels=_list("value_labels"), risk_labels=_list("risk_labels"), reject_reasons=_list("reject_reasons"), use_for=_list("use_for"), dedupe=dedupe,
    )
    features = _json(route_label=route, intent_label=intent, has_tools=_bare(F.col("has_tools")), model_bucket=_text(t.model_bucket(F.col("model"))))
    record = _json(schema_version=_text(F.lit(QUALITY)), sample_id=_text(F.col("sample_id")), source_date=_text(F.col("date")), task=task, quality=own, features=features, reject_reasons=_list("reject_reasons"))
    return samples.select("sample_id", record.alias("json"))


def episode_records(built: DataFrame) -> DataFrame:
    """Episodes as diagnostics: turns by id, time and labels, no text."""
    turn = lambda x, i: F.struct(x["sample_id"].alias("sample_id"), i.alias("turn_index"), x["event_time_ms"].alias("event_time_ms"), x["route_label"].alias("route_label"), x["intent_label"].alias("intent_label"), x["score_bucket"].alias("score_bucket"))
    record = F.struct(
        F.lit(EPISODE).alias("schema_version"), F.col("episode_id").alias("episode_id_internal"), F.col("date").alias("source_date"), "turn_count", "route_label", "intent_label", "score_bucket",
        "missing_session_fallback", "index_order_only", F.col("eligible").alias("eligible_for_selected_multi_turn"), F.transform("turns", turn).alias("turns"),
    )
    return built.select("episode_id", F.to_json(record).alias("json"))


def rejects(read: DataFrame) -> DataFrame:
    """Published rejects carry version, date and reason only."""
    return read.where("reason is not null").select(_json(schema_version=_text(F.lit(REPORT)), date=_text(F.col("date")), reason=_text(F.col("reason"))).alias("json"))
