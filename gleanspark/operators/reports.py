"""Counts over samples: one pass, an exploded row per count, then small counts folded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.selection import DEDUPE_REASONS


def _counted(samples: DataFrame, sections: dict[str, str]) -> DataFrame:
    """(section, key, n): sections map names to SQL expressions of string arrays."""
    entries = F.flatten(F.array(*[_entries(section, e) for section, e in sections.items()]))
    return samples.select(F.explode(entries).alias("e")).groupBy("e.section", "e.key").agg(F.count("*").alias("n"))


def _entries(section: str, expression: str):
    return F.transform(F.expr(expression), lambda k: F.struct(F.lit(section).alias("section"), k.alias("key")))


SECTIONS = {
    "route_counts": "array(route_label)",
    "intent_counts": "array(intent_label)",
    "score_counts": "array(score_bucket)",
    "route_intent_score_counts": "array(concat_ws('|', route_label, intent_label, score_bucket))",
    "reject_reasons": "reject_reasons",
    "risk_labels": "risk_labels",
    "dedupe": f"concat(filter(reject_reasons, r -> r in {DEDUPE_REASONS!r}), if(array_contains(risk_labels, 'dedupe_state_saturated'), array('state_saturated'), cast(array() as array<string>)))",
}


def quality_stats(samples: DataFrame, k: int = 5) -> DataFrame:
    """(section, key, n) with counts below ``k`` folded within their section."""
    counts = _counted(samples, SECTIONS)
    shown = F.when(F.col("n") >= k, F.col("key")).otherwise("suppressed_small_count")
    return counts.groupBy("section", shown.alias("key")).agg(F.sum("n").alias("n"))


def user_task_stats(samples: DataFrame, k: int = 5) -> DataFrame:
    """Counts of route, intent and score together, small ones folded."""
    return quality_stats(samples, k).where("section = 'route_intent_score_counts'").select("key", "n")


def stats(samples: DataFrame) -> DataFrame:
    """(section, key, n) of accepted samples: models, finish reasons, task types, redaction hits. Nothing is suppressed."""
    kinds = "if(has_tools, array('router', 'tool_use_sft'), if(coalesce(finish_reason, '') <> 'length', array('router', 'sft'), array('router')))"
    sections = {"total": "array('accepted')", "models": "array(coalesce(model, 'unknown'))", "finish_reasons": "array(coalesce(finish_reason, 'unknown'))", "task_types": kinds}
    return _counted(samples, sections)


def dedupe_rejected(samples: DataFrame) -> DataFrame:
    """How many samples a dedupe reason rejects."""
    return samples.agg(F.count_if(F.arrays_overlap("reject_reasons", F.array(*[F.lit(r) for r in DEDUPE_REASONS]))).alias("rejected"), F.count("*").alias("total"))
