"""Synthetic training samples from a chat model.

    python -m gleanspark.plans.synthesis --target-count 20 --batch-size 5

Settings come from the environment, over which a ``.env`` file goes. Samples are appended to ``<output root>/samples`` (Parquet), the state after each
round is in ``state.json``, and all samples are written as lines to ``samples.jsonl`` at the end. The same command resumes.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession

from gleanspark.operators import synthetic
from gleanspark.operators.scoring import ROUTES
from gleanspark.sources import sinks

# ---- Fixed values: settings' names and defaults, and the request's parameters.
KEY, URL, MODEL, TIMEOUT, RETRIES = "DEEPSEEK_API_KEY", "DEEPSEEK_BASE_URL", "DEEPSEEK_MODEL", "DEEPSEEK_TIMEOUT", "DEEPSEEK_MAX_RETRIES"
DEFAULTS = {URL: "https://api.deepseek.com", MODEL: "deepseek-v4-flash", TIMEOUT: "30", RETRIES: "10"}
OUTPUT_ROOT, TARGET, BATCH = "audit_training/synthetic_samples", 20, 5
REQUEST = {"temperature": 0.4, "max_tokens": 5000, "response_format": {"type": "json_object"}, "thinking": {"type": "disabled"}}

SYSTEM = "You write synthetic training data. Answer with one compact JSON value and nothing else."
SHAPES = {
    "router": {"task_type": "router", "topic": "routing", "input": "帮我写一个二分查找", "label": "code_generation"},
    "sft": {"task_type": "sft", "topic": "geography", "messages": [{"role": "user", "content": "长江流经哪些省份？"}], "response": "青海、西藏、四川、云南、重庆、湖北、湖南、江西、安徽、江苏和上海。"},
    "tool_use_sft": {
        "task_type": "tool_use_sft", "topic": "travel", "messages": [{"role": "user", "content": "查一下明天去上海的火车"}], "tools": [{"type": "function", "function": {"name": "find_trains"}}],
        "response_message": {"role": "assistant", "content": None, "tool_calls": [{"id": "call_1", "type": "function", "function": {"name": "find_trains", "arguments": '{"to": "上海", "day": "明天"}'}}]},
    },
}


def prompt(batch_index: int, batch_size: int) -> str:
    """What a model is asked for: so many invented Chinese samples as one JSON object, nothing personal, of the three shapes."""
    return "\n".join(
        [
            f"Write {batch_size} invented Chinese samples as json: one object whose key samples holds an array. No markdown, no comments.",
            "Invent everything: no real person, account, address, number, key, identifier, path or log may occur.",
            "task_type is one of " + ", ".join(sorted(SHAPES)) + "; every sample has a topic. A router sample has an input and a label out of " + ", ".join(sorted(ROUTES)) + ".",
            "An sft sample has messages and a response. A tool_use_sft sample has messages, tools, and a response_message with at least one valid tool call.",
            "The shapes: " + json.dumps({"samples": list(SHAPES.values())}, ensure_ascii=False, sort_keys=True),
            f"This is batch {batch_index}; differ from other batches.",
        ]
    )


def request_body(model: str, batch_index: int, batch_size: int) -> dict:
    return {"model": model, "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": prompt(batch_index, batch_size)}]} | REQUEST


def read_env(path: str) -> dict[str, str]:
    """NAME=value lines of a file, ``export`` before them and quotes around values allowed; no file: nothing."""
    out: dict[str, str] = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines() if Path(path).exists() else []:
        name, found, value = line.strip().removeprefix("export ").partition("=")
        name, value = name.strip(), value.strip()
        if found and name and not name.startswith("#"):
            quoted = len(value) > 1 and value[0] in "'\"" and value[-1] == value[0]
            out[name] = value[1:-1] if quoted else value
    return out


def positive(text: str) -> int:
    if (n := int(text)) <= 0:
        raise ValueError(text)
    return n


def settings(env_file: str, environ: dict[str, str] | None = None) -> dict:
    """Address, key, model and limits; SystemExit if there is no key or a limit is no positive number."""
    env = DEFAULTS | dict(os.environ if environ is None else environ) | read_env(env_file)
    if not env.get(KEY):
        raise SystemExit(f"{KEY} is missing; set it or put it into {env_file}")
    try:
        return {"api_key": env[KEY], "base_url": env[URL].rstrip("/"), "model": env[MODEL], "timeout": positive(env[TIMEOUT]), "retries": positive(env[RETRIES])}
    except ValueError as e:
        raise SystemExit(f"{TIMEOUT} and {RETRIES} must be positive integers: {e}") from None


def http_generator(config: dict, batch_size: int) -> Callable[[int], str]:
    """Asks the model for a batch; an answer without text is an error, so that it is asked again."""

    def generate(batch_index: int) -> str:
        import urllib.request

        body = json.dumps(request_body(config["model"], batch_index, batch_size), ensure_ascii=False).encode()
        request = urllib.request.Request(f"{config['base_url']}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {config['api_key']}"})
        with urllib.request.urlopen(request, timeout=config["timeout"]) as response:
            text = json.load(response)["choices"][0]["message"]["content"]
        if not text or not text.strip():
            raise ValueError("an answer without text")
        return text

    return generate


def run(spark: SparkSession, generate: Callable[[int], str], root: str, target: int, retries: int, model: str, per_round: int = 8) -> dict:
    """Appends until there are ``target`` samples, or no new ones come; returns what main prints."""
    now = lambda: datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None).isoformat() + "Z"
    store, states = sinks.Store(spark, root), []

    def keep(state: dict) -> None:
        states.append(state)
        store.write("state.json", json.dumps(state | {"updated_at": now()}, sort_keys=True, indent=2) + "\n")

    completed = synthetic.synthesize(spark, generate, f"{root}/samples", target, per_round, retries, progress=keep, generator_model=model, created_at=now())
    if store.exists("samples"):
        spark.read.parquet(f"{root}/samples").select("json").write.mode("overwrite").text(f"{root}/samples.jsonl")
    return {"completed": completed, "target_count": target, "written": completed - states[0]["completed"], "output_file": f"{root}/samples.jsonl", "state_file": f"{root}/state.json"}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Synthetic training samples from a chat model.")
    p.add_argument("--env-file", default=".env")
    p.add_argument("--output-root", default=OUTPUT_ROOT)
    p.add_argument("--target-count", type=positive, default=TARGET)
    p.add_argument("--batch-size", type=positive, default=BATCH)
    args = p.parse_args(argv)
    config = settings(args.env_file)
    spark = SparkSession.builder.getOrCreate()
    try:
        told = run(spark, http_generator(config, args.batch_size), args.output_root, args.target_count, config["retries"], config["model"])
    except KeyboardInterrupt:
        print("Interrupted; the same command resumes.", file=sys.stderr)
        return 130
    print(json.dumps(told, ensure_ascii=False, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
