"""Optional labels by a model: settings, payloads of features, strict parsing of answers, and what they may change.

The client is a function from a payload (JSON text) to an answer (text); none is called unless it is given. Equal payloads are asked once: the answers are
written to the shared folder before anything reads them, so outputs of one plan cannot contradict each other, and a lost executor asks again only for what it held.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import records
from gleanspark.functions import text as t
from gleanspark.operators.scoring import INTENTS, ROUTES, Config, use_for
from gleanspark.sources.tables import stored

# ---- Fixed values: names of tasks, labels that an answer may carry, the form of answers, and the score below which one ranks a sample down.
ROUTE_TASK, QUALITY_TASK = "classify_route", "score_quality"
VALUE_LABELS = ("code_task", "tool_task", "reasoning_task", "domain_task", "multi_turn_task", "well_formed_response")
RISK_LABELS = (
    "redaction_risk", "low_information", "invalid_selected_tool_trace", "length_finish", "duplicate", "quota_exceeded",
    "leakage_scan_failed", "near_duplicate", "debug_noise", "debug_burst", "dedupe_state_saturated",
)
ROUTE_FORM = {"label": "string", "confidence": "number", "reason": "string"}
QUALITY_FORM = {"quality_score": "number", "value_labels": "array[string]", "risk_labels": "array[string]", "reason": "string"}
SYSTEM = "Return only JSON for audit label classification."
DOWNRANK = 0.6
MAX_TIMEOUT, MAX_CACHE = 120, 1_000_000

ROUTE_SCHEMA = "model_label string, model_confidence double, label_error string"
QUALITY_SCHEMA = "model_score double, model_values array<string>, model_risks array<string>, label_error string"


# ---------------------------------------------------------------- settings


def clamped(value, default: int, least: int, most: int) -> int:
    try:
        n = int(value)
    except (TypeError, ValueError):
        n = default
    return min(most, max(least, n))


def is_on(value: str | None, default: bool = True) -> bool:
    """A switch of the environment: unset or empty is the default; 0, false, no and off are off."""
    return default if value is None or value == "" else value.strip().lower() not in ("0", "false", "no", "off")


def load_config(env: dict[str, str] | None = None) -> dict:
    """The labeler's settings from the environment; it is enabled if address, key and model are all there."""
    env = os.environ if env is None else env
    url, key, model = env.get("AUDIT_LABEL_BASE_URL", "").rstrip("/"), env.get("AUDIT_LABEL_API_KEY", ""), env.get("AUDIT_LABEL_MODEL", "")
    entries = clamped(env.get("AUDIT_LABEL_CACHE_MAX_ENTRIES", "10000"), 10_000, 0, MAX_CACHE)
    return {
        "enabled": bool(url and key and model), "base_url": url, "api_key": key, "model": model, "timeout": clamped(env.get("AUDIT_LABEL_TIMEOUT", "30"), 30, 1, MAX_TIMEOUT),
        "cache_enabled": is_on(env.get("AUDIT_LABEL_CACHE")) and entries > 0, "cache_max_entries": entries,
    }


# ---------------------------------------------------------------- payloads


def _array(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)])


def _form(form: dict[str, str]) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in form.items()])


def router_features() -> Column:
    return F.struct(
        "message_count", "has_tools", t.token_bucket(F.col("prompt_tokens")).alias("prompt_tokens_bucket"), t.token_bucket(F.col("completion_tokens")).alias("completion_tokens_bucket"),
        t.client_bucket(F.col("client_type")).alias("client_type_bucket"), "route_label", "intent_label", t.model_bucket(F.col("model")).alias("model_bucket"),
    )


def route_payload(snippets: bool = False) -> Column:
    """The question for a route, as JSON text; null if a snippet is asked for and fails the leak scan."""
    text = F.col("user_text")
    sample = F.struct(router_features().alias("features"), *([text.alias("snippet")] if snippets else []))
    payload = F.to_json(F.struct(F.lit(ROUTE_TASK).alias("task"), _array(ROUTES).alias("labels"), sample.alias("sample"), _form(ROUTE_FORM).alias("response_format")))
    return F.when(t.leakage(text).isNull(), payload) if snippets else payload


def quality_payload(snippets: bool = False) -> Column:
    """The question for a quality score, as JSON text; null if a snippet fails the leak scan."""
    features = F.struct(
        "route_label", "intent_label", "has_tools", "message_count", t.token_bucket(F.col("prompt_tokens")).alias("prompt_tokens_bucket"), t.token_bucket(F.col("completion_tokens")).alias("completion_tokens_bucket"),
        F.when(F.col("redaction_hits") > 0, "has_redactions").otherwise("none").alias("redaction_density_bucket"), t.model_bucket(F.col("model")).alias("model_bucket"),
    )
    texts = [F.col("user_text").alias("user_snippet"), F.col("response_text").alias("assistant_snippet")] if snippets else []
    sample = F.struct(features.alias("features"), *texts)
    allowed = [_array(INTENTS).alias("allowed_intent_labels"), _array(VALUE_LABELS).alias("allowed_value_labels"), _array(RISK_LABELS).alias("allowed_risk_labels")]
    payload = F.to_json(F.struct(F.lit(QUALITY_TASK).alias("task"), *allowed, sample.alias("sample"), _form(QUALITY_FORM).alias("response_format")))
    safe = t.leakage(F.col("user_text")).isNull() & t.leakage(F.col("response_text")).isNull()
    return F.when(safe, payload) if snippets else payload


# ---------------------------------------------------------------- answers


def _unit(value) -> float | None:
    good = isinstance(value, int | float) and not isinstance(value, bool) and math.isfinite(value) and 0 <= value <= 1
    return float(value) if good else None


def _object(answer: str | None) -> dict | None:
    """The JSON object of an answer whose reason, if any, is a string."""
    try:
        value = records.parse(answer or "")
    except ValueError:
        return None
    return value if isinstance(value, dict) and isinstance(value.get("reason", ""), str) else None


def parse_route(answer: str | None) -> tuple[str | None, float | None]:
    """(label, confidence) of an answer, or nothing if it is not strictly of that form."""
    value = _object(answer)
    if value is None or value.get("label") not in ROUTES or _unit(value.get("confidence")) is None:
        return None, None
    return value["label"], _unit(value["confidence"])


def parse_quality(answer: str | None) -> tuple[float | None, list[str], list[str]]:
    """(score, value labels, risk labels) of an answer. Unknown labels are left out; labels that are no list void the answer."""
    value = _object(answer)
    score = _unit(value.get("quality_score")) if value is not None else None
    listed = [value.get(k, []) for k in ("value_labels", "risk_labels")] if score is not None else []
    if score is None or not all(isinstance(x, list) for x in listed):
        return None, [], []
    values, risks = ({x for x in found if isinstance(x, str)} & set(allowed) for found, allowed in zip(listed, (VALUE_LABELS, RISK_LABELS), strict=True))
    return score, sorted(values), sorted(risks)


def ask(samples: DataFrame, client: Callable[[str], str], parse: Callable, schema: str) -> tuple[DataFrame, DataFrame]:
    """(samples joined to the parsed answers by ``payload``, the stored answers with ``asked``: how many samples they serve).

    A failing call gives an empty answer and ``label_error``. Rows with a null payload are not asked about.
    """
    names = [f.split()[0] for f in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for payload, n in zip(frame["payload"], frame["asked"], strict=True):
                error = None
                try:
                    answer = client(payload)
                except Exception as e:  # the label is optional: the sample goes on without it
                    answer, error = None, f"labeler_request_failed:{type(e).__name__}"
                found = parse(answer)
                if error is None and found[0] is None:
                    error = "labeler_invalid_response"
                rows.append((payload, n, *found, error))
            yield pd.DataFrame(rows, columns=["payload", "asked", *names])

    distinct = samples.where("payload is not null").groupBy("payload").agg(F.count("*").alias("asked"))
    answers = stored(distinct.mapInPandas(run, f"payload string, asked long, {schema}"))
    return samples.join(answers.drop("asked"), "payload", "left"), answers


def answer_stats(answers: DataFrame, task: str) -> DataFrame:
    """(section, key, n): calls made, samples served from an earlier answer, and errors."""
    one = answers.select(
        F.explode(
            F.array(
                F.struct(F.lit("requests").alias("section"), F.lit(task).alias("key"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit("cache_hits").alias("section"), F.lit(task).alias("key"), (F.col("asked") - 1).alias("n")),
                F.struct(F.lit("errors").alias("section"), F.concat(F.lit(f"{task}:"), "label_error").alias("key"), F.col("label_error").isNotNull().cast("long").alias("n")),
            )
        ).alias("e")
    ).select("e.*")
    return one.where("n > 0").groupBy("section", "key").agg(F.sum("n").alias("n"))


def label_routes(samples: DataFrame, client: Callable[[str], str], snippets: bool = False) -> DataFrame:
    """Adds model_label and model_confidence."""
    return route_answers(samples, client, snippets)[0]


def route_answers(samples: DataFrame, client: Callable[[str], str], snippets: bool = False) -> tuple[DataFrame, DataFrame]:
    """(samples with model_label and model_confidence, the label's statistics)."""
    asked, answers = ask(samples.withColumn("payload", route_payload(snippets)), client, parse_route, ROUTE_SCHEMA)
    return asked.drop("payload", "label_error"), answer_stats(answers, ROUTE_TASK)


def skip_reason(config: Config) -> Column:
    """Why a sample is not worth a question about its quality, or null."""
    return (
        F.when(F.size("reject_reasons") > 0, "deterministic_reject")
        .when(F.coalesce(F.col("deterministic_score"), F.lit(0.0)) < config.selected_min_score, "below_selected_min_score")
        .when(F.size("use_for") == 0, "no_selected_use")
    )


def label_quality(samples: DataFrame, client: Callable[[str], str], config: Config = Config(), snippets: bool = False) -> DataFrame:
    """Lets a model's score lower a sample, never raise it: risks reject, a low score ranks down. Samples that :func:`skip_reason` names are not asked about."""
    return quality_answers(samples, client, config, snippets)[0]


def quality_answers(samples: DataFrame, client: Callable[[str], str], config: Config = Config(), snippets: bool = False) -> tuple[DataFrame, DataFrame]:
    """(:func:`label_quality`'s samples, the label's statistics, skips among them)."""
    skip = skip_reason(config)
    asked, answers = ask(samples.withColumn("payload", F.when(skip.isNull(), quality_payload(snippets))), client, parse_quality, QUALITY_SCHEMA)
    lower = F.coalesce(F.col("model_score") < F.col("deterministic_score"), F.lit(False))
    risky = F.coalesce(F.size("model_risks") > 0, F.lit(False)) & F.col("model_score").isNotNull()
    down = lower & (F.col("model_score") < DOWNRANK)
    none = F.expr("cast(array() as array<string>)")
    reasons = F.concat(F.when(risky, F.array(F.lit("model_risk"))).otherwise(none), F.when(down, F.array(F.lit("model_downranked"))).otherwise(none))
    out = asked.withColumns(
        {
            "final_score": F.when(lower, F.col("model_score")).otherwise(F.col("final_score")),
            "value_labels": F.array_sort(F.array_union("value_labels", F.coalesce("model_values", none))),
            "risk_labels": F.array_sort(F.array_union("risk_labels", F.coalesce("model_risks", none))),
            "reject_reasons": F.array_union("reject_reasons", reasons),
        }
    )
    skipped = samples.select(skip.alias("why")).where("why is not null").groupBy(F.lit("skips").alias("section"), F.concat(F.lit(f"{QUALITY_TASK}:"), "why").alias("key")).agg(F.count("*").alias("n"))
    stats = answer_stats(answers, QUALITY_TASK).unionByName(skipped)
    return use_for(out, config).drop("payload", "model_values", "model_risks", "label_error"), stats


def http_client(url: str, key: str, model: str, timeout: float = 30) -> Callable[[str], str]:
    """A chat-completions client. Used only if a caller passes it."""

    def call(payload: str) -> str:
        import urllib.request

        body = json.dumps({"model": model, "temperature": 0, "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": payload}]}).encode()
        request = urllib.request.Request(f"{url.rstrip('/')}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return json.load(response)["choices"][0]["message"]["content"]

    return call


def client_of(config: dict) -> Callable[[str], str] | None:
    """The client that settings describe, or None if they don't enable it."""
    return http_client(config["base_url"], config["api_key"], config["model"], config["timeout"]) if config["enabled"] else None
