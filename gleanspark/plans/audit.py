"""The daily plan: audit logs to training sets.

    python -m gleanspark.plans.audit --input-root logs --output-root out --date 2026-01-01
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, fields, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.operators import exports, labels, reports, scoring, selection
from gleanspark.operators.scoring import Config
from gleanspark.sources import audit, sinks
from gleanspark.sources.tables import stored


# ---- Fixed values: where each output goes, the plan's version, and who may see what.
PATHS = {
    "canonical": "canonical/{}.jsonl", "sft": "sft/{}.jsonl", "tool_use_sft": "tool_use_sft/{}.jsonl", "router": "router_classification/{}.jsonl", "label_queue": "label_queue/{}.jsonl",
    "rejects": "reports/{}.rejects.jsonl", "quality": "quality/{}.jsonl", "episodes": "episodes/{}.jsonl", "selected_sft": "selected/sft/{}.jsonl", "selected_tool_use_sft": "selected/tool_use_sft/{}.jsonl",
    "selected_router": "selected/router_classification/{}.jsonl", "selected_multi_turn_sft": "selected/multi_turn_sft/{}.jsonl", "stats": "reports/{}.stats.json", "manifest": "manifests/{}.manifest.json",
    "quality_stats": "reports/{}.quality_stats.json", "user_task_stats": "reports/{}.user_task_stats.json", "selection_manifest": "reports/{}.selection_manifest.json",
}
BASE = ("canonical", "sft", "tool_use_sft", "router", "label_queue", "rejects", "stats", "manifest")
DIAGNOSTICS, EPISODES = ("canonical", "quality", "episodes"), ("episodes", "selected_multi_turn_sft")
VERSION = "2026.07.19"
SENSITIVITY = {"canonical": "restricted_diagnostic", "quality": "restricted_diagnostic", "episodes": "restricted_diagnostic", "selected": "training_facing_privacy_strict", "reports": "operational_k_suppressed"}
NOTE = "Aggregated by non-linkable route/intent/score buckets; no user/session hashes emitted."
REPORTS = ("stats", "quality_stats", "user_task_stats", "manifest", "selection_manifest")


@dataclass(frozen=True)
class Outputs:
    """Which outputs a run has."""

    disable_selection: bool = False
    disable_episodes: bool = False
    disable_diagnostics: bool = False
    compat_output_set: bool = False

    def names(self) -> list[str]:
        if self.compat_output_set or self.disable_selection:
            return list(BASE)
        left_out = (DIAGNOSTICS if self.disable_diagnostics else ()) + (EPISODES if self.disable_episodes else ())
        return [n for n in PATHS if n not in left_out]


def plan(
    read: DataFrame, config: Config = Config(), *, outputs: Outputs = Outputs(), route_client: Callable | None = None, quality_client: Callable | None = None, snippets: bool = False, label_stats: list | None = None
) -> dict[str, DataFrame]:
    """Tables of a table of read samples, by output name. What several outputs read (answers of models, samples after selection) is stored on the way.

    ``label_stats`` takes the statistics of the labels that were asked for.
    """
    accepted = read.where("reason is null").drop("reason")
    scored, stats = scoring.annotate(accepted, config), label_stats if label_stats is not None else []
    label, confidence = F.lit(None).cast("string"), F.lit(None).cast("double")
    if route_client:
        scored, found = labels.route_answers(scored, route_client, snippets)
        label, confidence = F.col("model_label"), F.col("model_confidence")
        stats.append(found)
    if quality_client:
        scored, found = labels.quality_answers(scored, quality_client, config, snippets)
        stats.append(found)
    out = {
        "canonical": accepted.select(F.col("canonical").alias("json")),
        "sft": exports.sft(scored),
        "tool_use_sft": exports.tool_use(scored),
        "router": exports.router(scored, label, confidence),
        "label_queue": exports.label_queue(scored, label, confidence),
        "rejects": exports.rejects(read),
        "stats": reports.stats(scored),
    }
    names = outputs.names()
    if "selected_sft" in names:
        marked = stored(selection.mark_dedupe(scored, config))
        done = stored(selection.apply_decisions(marked, selection.select(marked, config), config))
        built = selection.episodes(done, config)
        out |= {
            "selected_sft": exports.selected_sft(done),
            "selected_router": exports.selected_router(done),
            "selected_tool_use_sft": exports.selected_tool_use(done),
            "selected_multi_turn_sft": exports.multi_turn(selection.multi_turn(built)),
            "quality": exports.quality(done),
            "episodes": exports.episode_records(built),
            "quality_stats": reports.quality_stats(done, config.k_threshold),
            "user_task_stats": reports.user_task_stats(done, config.k_threshold),
            "done": done,
        }
    return {n: rows for n, rows in out.items() if n in names or n == "done"}


def _nested(rows: DataFrame) -> dict:
    """(section, key, n) rows as {section: {key: n}}: a row a label, so few."""
    out: dict = {}
    for r in rows.collect():
        (out.setdefault(r["section"], {}) if "section" in rows.columns else out)[r["key"]] = r["n"]
    return out


def _json(value: dict) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2)


def stats_report(rows: DataFrame, read: DataFrame, counts: dict) -> dict:
    found = _nested(rows)
    hits = F.explode(F.from_json(F.get_json_object("canonical", "$.quality.redaction_stats"), "map<string,long>"))
    hits = read.where("reason is null").select(hits).groupBy("key").agg(F.sum("value").alias("n"))
    rejected = {k: n for k, n in counts.items() if k is not None}
    sections = {k: found.get(k, {}) for k in ("models", "finish_reasons", "task_types")}
    return sections | {"accepted": counts.get(None, 0), "rejected": sum(rejected.values()), "reject_reasons": rejected, "redaction_hits": _nested(hits)}


def quality_report(rows: DataFrame, total: int, k: int) -> dict:
    found = _nested(rows)
    return {s: found.get(s, {}) for s in reports.SECTIONS} | {"schema_version": exports.REPORT, "total": total, "k_threshold": k}


def task_report(rows: DataFrame, k: int) -> dict:
    return {"schema_version": exports.REPORT, "bucket_counts": _nested(rows), "k_threshold": k, "note": NOTE}


def selection_manifest(day: str, run_id: str, config: Config, outputs: Outputs, done: DataFrame, started: str, finished: str, labelers: dict) -> dict:
    """What a run had on, and how many samples it chose."""
    kinds = {r["kind"]: r["count"] for r in done.select(F.explode("selected").alias("kind")).groupBy("kind").count().collect()}
    dropped = reports.dedupe_rejected(done).first()
    paths = [PATHS[n].format(day) for n in outputs.names()]
    return {
        "schema_version": exports.REPORT, "date": day, "pipeline_version": VERSION, "run_id": run_id, "started_at": started, "finished_at": finished, "sensitivity": SENSITIVITY,
        "schema_versions": {"canonical": exports.CANONICAL, "quality": exports.QUALITY, "episodes": exports.EPISODE, "selected": exports.SELECTED, "reports": exports.REPORT, "label_queue": exports.LABEL_QUEUE},
        "output_matrix": {"enabled_outputs": sorted({p.rsplit("/", 1)[0] for p in paths}), "relative_paths": paths} | asdict(outputs),
        "selection": {"selected_counts": {k: kinds.get(k, 0) for k in selection.KINDS}, "candidate_count": dropped["total"], "dedupe_enabled": config.dedupe, "dedupe_rejected": dropped["rejected"], "dedupe_config": asdict(replace(config, hmac_key=""))},
        "labelers": labelers, "k_threshold": config.k_threshold,
    }


def _now() -> str:
    return datetime.now(timezone.utc).replace(microsecond=0).isoformat().replace("+00:00", "Z")


def process_date(
    spark: SparkSession, input_root: str, output_root: str, day: str, config: Config = Config(), *, outputs: Outputs = Outputs(), limit: int | None = None, single_file: bool = False, dry_run: bool = False,
    progress: Callable[[dict], None] | None = None, **kwargs,
) -> dict:
    """Reads a date, writes every output to staging, publishes all at once, and returns the manifest. ``progress`` is told the counts once all files are read.

    Outputs are folders of part files, or single files if asked for, which one task has to write.
    """
    store, run_id, started = sinks.Store(spark, output_root), uuid.uuid4().hex, _now()
    sinks.acquire_lock(store, day, run_id)
    try:
        read = stored(audit.read_samples(spark, input_root, [day], limit))  # each file is read once and used by every output
        counts = {r["reason"]: r["count"] for r in read.groupBy("reason").count().collect()}
        rejected = {k: n for k, n in counts.items() if k is not None}
        manifest = {"date": day, "run_id": run_id, "accepted": counts.get(None, 0), "rejected": rejected, "outputs": sorted(outputs.names())}
        if progress:
            files = sum(n for k, n in counts.items() if k not in ("bad_index_json", "bad_index_record"))
            progress({"event": "audit_pipeline_progress", "date": day, "index_records": sum(counts.values()), "files_attempted": files, "accepted": manifest["accepted"], "rejected": sum(rejected.values()), "reject_reasons": rejected})
        if dry_run:
            return manifest
        stats: list[DataFrame] = []
        tables, staged = plan(read, config, outputs=outputs, label_stats=stats, **kwargs), {}
        done = tables.pop("done", None)
        for name in outputs.names():
            target = PATHS[name].format(day)
            staged[target] = source = f".tmp/{day}.{run_id}/{target}"
            if name not in REPORTS:
                sinks.stage(store, source, tables[name], single_file)
            elif name == "stats":
                store.write(source, _json(stats_report(tables[name], read, counts)))
            elif name == "quality_stats":
                store.write(source, _json(quality_report(tables[name], manifest["accepted"], config.k_threshold)))
            elif name == "user_task_stats":
                store.write(source, _json(task_report(tables[name], config.k_threshold)))
            elif name == "manifest":
                store.write(source, _json(manifest))
            else:
                found: dict = {}
                for rows in stats:
                    for section, part in _nested(rows).items():
                        found.setdefault(section, {}).update(part)
                snippets = bool(kwargs.get("snippets"))
                labelers = {"route_enabled": bool(kwargs.get("route_client")), "quality_enabled": bool(kwargs.get("quality_client")), "snippets_enabled": snippets, "feature_only_default": not snippets, "stats": found}
                store.write(source, _json(selection_manifest(day, run_id, config, outputs, done, started, _now(), labelers)))
        sinks.publish(store, staged, run_id)
        return manifest
    finally:
        store.delete(f".tmp/{day}.{run_id}")
        sinks.release_lock(store, day, run_id)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser()
    p.add_argument("--input-root", required=True)
    p.add_argument("--output-root", default="audit_training")
    p.add_argument("--date")
    p.add_argument("--yesterday", action="store_true")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--limit", type=int)
    p.add_argument("--dry-run", action="store_true")
    for f in fields(Outputs):
        p.add_argument("--" + f.name.replace("_", "-"), action="store_true")
    for name in ("route-labeler", "quality-labeler", "label-snippets"):
        p.add_argument(f"--enable-{name}", action="store_true")
    p.add_argument("--progress-every", type=int, default=0, help="above 0: tell the counts of a date once its files are read")
    p.add_argument("--single-file", action="store_true", help="one file per output, written by one task, instead of a folder of part files")
    for f in fields(Config):
        p.add_argument("--" + f.name.replace("_", "-"), type=(lambda s: s.lower() in ("1", "true", "yes")) if isinstance(f.default, bool) else type(f.default), default=f.default)
    args = p.parse_args(argv)
    chosen = [bool(args.date), args.yesterday, bool(args.start_date or args.end_date)]
    if sum(chosen) != 1 or bool(args.start_date) != bool(args.end_date):
        p.error("choose one of --date, --yesterday, or --start-date with --end-date")
    if args.limit is not None and args.limit < 0:
        p.error("--limit must not be negative")
    return args


def resolve_dates(args: argparse.Namespace) -> list[str]:
    if args.date:
        return [audit.valid_date(args.date).isoformat()]
    if args.yesterday:
        return [(date.today() - timedelta(days=1)).isoformat()]
    return audit.date_range(args.start_date, args.end_date)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    config = replace(Config(), **{f.name: getattr(args, f.name) for f in fields(Config)})
    outputs = Outputs(**{f.name: getattr(args, f.name) for f in fields(Outputs)})
    client = labels.client_of(labels.load_config())
    clients = {"route_client": client if args.enable_route_labeler else None, "quality_client": client if args.enable_quality_labeler else None, "snippets": args.enable_label_snippets}
    tell = (lambda event: print(json.dumps(event, ensure_ascii=False, sort_keys=True), file=sys.stderr, flush=True)) if args.progress_every > 0 else None
    spark = SparkSession.builder.getOrCreate()
    for day in resolve_dates(args):
        print(json.dumps(process_date(spark, args.input_root, args.output_root, day, config, outputs=outputs, limit=args.limit, single_file=args.single_file, dry_run=args.dry_run, progress=tell, **clients)), flush=True)


if __name__ == "__main__":
    main()
