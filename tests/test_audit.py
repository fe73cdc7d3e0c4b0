"""The daily plan over logs written here, and the parts it is made of."""

import copy
import json
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import records
from gleanspark.functions import text as t
from gleanspark.operators import scoring, selection
from gleanspark.plans import audit as plans
from gleanspark.sources import audit, sinks

DAY = "2026-03-04"


def raw(user="Write a python function that sorts numbers", reply="def f(xs): return sorted(xs)", n=0, **more):
    return {
        "timestamp_ms": 1_772_600_000_000 + n * 60_000,
        "user_id": "u1",
        "tenant_id": "t1",
        "session_id": "s1",
        "request_id": f"r{n}",
        "model": "gpt-4o",
        "client_type": "api",
        "status": "success",
        "request_body": {"messages": [{"role": "user", "content": user}], "temperature": 0.5},
        "response_body": {"choices": [{"message": {"role": "assistant", "content": reply}, "finish_reason": "stop"}], "usage": {"prompt_tokens": 10, "completion_tokens": 5.0}},
    } | more


def write_logs(root: Path, rows, extra_lines=()):
    day = root / DAY
    day.mkdir(parents=True)
    lines = []
    for k, row in enumerate(rows):
        (day / f"{k}.json").write_text(row if isinstance(row, str) else json.dumps(row, ensure_ascii=False))
        lines.append(json.dumps({"request_id": f"r{k}", "file_path": f"{DAY}/{k}.json"}))
    (day / "_request_index.jsonl").write_text("\n".join([*lines, *extra_lines]) + "\n")


def samples_of(spark, root, rows, **kwargs):
    write_logs(root, rows)
    return audit.read_samples(spark, str(root), [DAY], **kwargs)


def test_index_errors_and_blank_lines(spark, tmp_path):
    write_logs(tmp_path, [raw()], ["", "{bad", '{"request_id": NaN, "file_path": "x"}', "[1]", '{"request_id": "", "file_path": "x"}', '{"request_id": "a", "file_path": "../x"}', f'{{"request_id": "a", "file_path": "{DAY}/none.json"}}'])
    got = {r["line_no"]: r["reason"] for r in audit.read_samples(spark, str(tmp_path), [DAY]).collect()}
    assert got == {1: None, 3: "bad_index_json", 4: "bad_index_json", 5: "bad_index_record", 6: "bad_index_record", 7: "unsafe_detail_path", 8: "missing_detail_file"}


def changed(path, value):
    out = copy.deepcopy(raw())
    at = out
    for key in path[:-1]:
        at = at[key]
    at[path[-1]] = value
    return out


CHOICE = ("response_body", "choices", 0, "message")
REJECTS = [
    (changed(("status",), "error"), "status_not_success"),
    (changed(("request_body",), [1]), "missing_messages"),
    (changed(("request_body", "messages"), []), "missing_messages"),
    (changed(("request_body", "messages", 0, "content"), None), "invalid_messages"),
    (changed(("request_body", "messages", 0, "content"), [{"text": 1}]), "invalid_messages"),
    (changed(("request_body", "tools"), [{"type": "function", "function": {"name": ""}}]), "invalid_tools"),
    (changed(("response_body", "choices"), []), "missing_choices"),
    (changed(CHOICE, "x"), "invalid_response_message"),
    (changed((*CHOICE, "tool_calls"), [{"id": "1"}]), "invalid_response_message"),
    (changed(("response_body", "usage"), {"prompt_tokens": True}), "invalid_usage"),
    (changed(("response_body", "usage"), {"prompt_tokens": 1.5}), "invalid_usage"),
    (changed(("response_body", "usage"), {"prompt_tokens": 10**30}), "invalid_usage"),
    (changed((*CHOICE, "content"), "  "), "empty_assistant_response"),
    (changed(("request_body", "messages", 0, "content"), "x" * 200_001), "prompt_too_long"),
    (changed((*CHOICE, "content"), "x" * 100_001), "response_too_long"),
    ("[1, 2]", "bad_detail_json"),
    ('{"status": NaN}', "bad_detail_json"),
    ('{"status": 1e9999}', "bad_detail_json"),
    (changed(("response_body", "usage"), {}), None),
    (changed(("request_body", "messages", 0, "content"), ["a", {"type": "text", "text": "b"}]), None),
]


def test_reject_reasons(spark, tmp_path):
    got = samples_of(spark, tmp_path, [r for r, _ in REJECTS]).orderBy("line_no").collect()
    assert [r["reason"] for r in got] == [reason for _, reason in REJECTS]


def test_limit_counts_well_formed_entries(spark, tmp_path):
    write_logs(tmp_path, [raw(n=k) for k in range(5)])
    got = audit.read_samples(spark, str(tmp_path), [DAY], limit=2)
    assert sorted(r["line_no"] for r in got.collect()) == [1, 2]
    assert audit.read_samples(spark, str(tmp_path), [DAY], limit=0).count() == 0


PII = "mail a@b.com or c@d.org, a@b.com; phone 13812345678; key sk-abcdefghijklmnop1234; card 6222 0212 3456 7890; at 10.1.2.3"


def test_redaction_is_the_same_in_both_forms(spark):
    texts = [PII, "", None, "中文13812345678中文", "11010119900101123X", "id 第42行 1.2.3.4.5", "bearer sk-ABCDEFGHIJKLMNOP"]
    rows = t.redact(spark.createDataFrame([(x,) for x in texts], "text string"), "text").collect()
    for r in rows:
        hits: dict = {}
        assert r["redacted"] == records.redact_text(r["text"] or "", hits)
        assert r["redaction_stats"] == hits
    assert rows[0]["redacted"].startswith("mail <EMAIL_1> or <EMAIL_2>, <EMAIL_1>; phone <PHONE_1>;")


def test_keys_that_become_alike_stay_apart():
    assert records.redact_tree({"a@b.com": 1, "c@d.com": 2}, {}) == {"<EMAIL_1>": 1, "<EMAIL_1>__2": 2}


def test_leak_scan_is_the_same_in_both_forms(spark):
    texts = ["fine", "", "  ", "x" * 1201, "see https://x.y", "/etc/passwd", "a/b", "A" * 40, "```", "<X_1>", "{};={};={};=", "<b>", "550e8400-e29b-41d4-a716-446655440000", "中文/英文"]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").withColumn("r", t.leakage(F.col("x"))).collect()
    assert {r["x"]: r["r"] for r in rows} == {x: records.leak(x) for x in texts}


def test_normalisation(spark):
    cases = {"Continue continue, CONTINUE!": "continue", "see https://x.y/z now": "see <url> now", "Line 42 of 3.5": "line <num> of <num>", "open /tmp/a.txt": "open <path>", None: "", "ok ok go go": "ok go go", "第42行": "第42行"}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").withColumn("n", t.normalize_for_dedupe(F.col("x"))).collect()
    assert {r["x"]: r["n"] for r in rows} == cases


PLAIN_SEGMENT = r"(?:[A-Za-z0-9_.-]+|<[A-Za-z_]+_\d+>)"
PLAIN_PATH = re.compile(r"(?:(?:^|\s)(?:/|\.\.?/|~[/\\]|[A-Za-z]:[\\/])\S+|(?:^|\s)" + PLAIN_SEGMENT + r"(?:[/\\]" + PLAIN_SEGMENT + r")*[/\\][A-Za-z0-9_.-]*\.[A-Za-z0-9_.-]+)")


def test_paths_as_a_plain_pattern_finds_them(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["a", "b.c", ".", "/", "\\", "<x_1>", "<", "-", " ", "c:", "~", "é", "\n"]) for _ in range(rng.randrange(1, 16))) for _ in range(4000)]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", F.regexp_replace("x", t.PATH, "#").alias("y")).collect()
    assert [r["y"] for r in rows] == [PLAIN_PATH.sub("#", r["x"]) for r in rows]


@pytest.mark.parametrize("unit", ["a/", "/", " ", "\n", "a b ", "MIT License ", "1 ", "<x_1>/"])
def test_very_long_texts(spark, unit):
    text = "x " + unit * (5_000_000 // len(unit)) + " y"
    row = spark.createDataFrame([(text,)], "x string").select(F.length(t.normalize_for_dedupe(F.col("x"))).alias("n"), F.length(t.strip(F.col("x"))).alias("s"), t.leakage(F.col("x")).alias("l"), F.size(t.dedupe_tokens(t.normalize(F.col("x")))).alias("k")).first()
    assert 0 < row["n"] <= 1200 and row["s"] == len(text.strip()) and row["l"] == "too_long" and row["k"] > 0


def test_time(spark):
    cases = {"2026-01-02T03:04:05Z": 1767323045000, "2026-01-02 03:04:05.12": 1767323045120, "2026-01-02T03:04:05+08:00": 1767294245000, "2026-13-02T03:04:05Z": None, "x": None}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").withColumn("n", t.timestamp_ms(F.col("x"))).collect()
    assert {r["x"]: r["n"] for r in rows} == cases
    assert {k: records.time_ms({"timestamp": k}) for k in cases} == cases


def call(id_="c1", name="f", arguments="{}"):
    return {"id": id_, "type": "function", "function": {"name": name, "arguments": arguments}}


TOOLS = [{"type": "function", "function": {"name": "f"}}]
ASK, ANSWER = {"role": "assistant", "content": "", "tool_calls": [call()]}, {"role": "tool", "content": "1", "tool_call_id": "c1"}


@pytest.mark.parametrize(
    "messages, tools, calls, want",
    [
        ([ASK, ANSWER], TOOLS, [call("c2")], None),
        ([ASK], TOOLS, [call("c2")], "missing_tool_result"),
        ([ANSWER, ASK], TOOLS, [call("c2")], "unmatched_tool_result"),
        ([ASK, ANSWER], TOOLS, [call("c1")], "duplicate_tool_call_id"),
        ([], TOOLS, [call(name="g")], "unknown_tool_name"),
        ([], [], [call(name="g")], None),
        ([], TOOLS, [call(arguments="[1]")], "invalid_tool_arguments"),
        ([], TOOLS, [call(arguments="")], None),
        ([], TOOLS, [], "missing_tool_calls"),
        ([ASK, {"role": "user", "content": "x"}], TOOLS, [call("c2")], "missing_tool_result"),
    ],
)
def test_tool_traces(messages, tools, calls, want):
    assert records.tool_trace(messages, tools, {"tool_calls": calls}) == want


def selected(spark, root, rows, config=scoring.Config()):
    read = samples_of(spark, root, rows)
    marked = selection.mark_dedupe(scoring.annotate(read.where("reason is null").drop("reason"), config), config)
    return selection.apply_decisions(marked, selection.select(marked, config), config).orderBy("line_no").collect()


def test_duplicates(spark, tmp_path):
    rows = [raw(n=0), raw(n=1), raw(n=2, reply="sorted(xs) does it, simply"), raw(n=3, user="Write a python function that sorts 42 numbers"), raw(n=4, user="Write a python function that sorts 43 numbers")]
    got = selected(spark, tmp_path, rows)
    assert got[0]["selected"] == ["router_classification", "sft"]
    assert got[1]["reject_reasons"] == ["duplicate_content"] and not got[1]["use_for"]
    assert got[2]["selected"] == ["sft"] and "duplicate" in got[2]["risk_labels"]
    assert "normalized_duplicate_content" in got[4]["reject_reasons"] or "near_duplicate_content" in got[4]["reject_reasons"]


def test_low_information_and_pii_are_not_selected(spark, tmp_path):
    got = selected(spark, tmp_path, [raw(user="你好"), raw(user="debug this: mail me at a@b.com", n=1), raw(user="open /etc/passwd with python", n=2)])
    assert got[0]["reject_reasons"] == ["greeting_or_probe"]
    assert "redaction_risk" in got[1]["reject_reasons"]
    assert got[2]["reject_reasons"] == ["leakage_scan_failed"] and not got[2]["selected"]


def test_repeated_control_words(spark, tmp_path):
    got = selected(spark, tmp_path, [raw(user="continue", reply=f"here is part {k} of it", n=k) for k in range(3)])
    assert ["debug_noise_repeat" in r["reject_reasons"] for r in got] == [False, False, True]


def test_burst(spark, tmp_path):
    config = scoring.Config(task_burst=2)
    rows = [raw(reply=f"answer number {k}", n=n) for k, n in enumerate((0, 10, 15, 100))]
    got = selected(spark, tmp_path, rows, config)
    assert ["debug_burst" in r["reject_reasons"] for r in got] == [False, False, True, False]


def test_fold_and_windows_agree_and_quota_binds(spark, tmp_path):
    rows = [raw(user=f"Explain python topic {chr(97 + k % 7)} in depth please", reply=f"This is reply {k % 3} in words", n=k) for k in range(40)]
    read = samples_of(spark, tmp_path, rows).where("reason is null").drop("reason")
    config = scoring.Config(near_duplicates=False, noise_filter=False)
    cands = selection.candidates(selection.mark_dedupe(scoring.annotate(read, config), config)).cache()
    key = ["kind", "sample_id", "line_no", "decision"]
    fold, windows = (f(cands, config).select(key) for f in (selection.decide_by_fold, selection.decide_by_windows))
    assert fold.exceptAll(windows).count() == windows.exceptAll(fold).count() == 0
    tight = scoring.Config(near_duplicates=False, noise_filter=False, max_sft_per_user=2)
    assert not selection.quota_free(cands, tight)
    got = {r["decision"]: r["count"] for r in selection.decide_by_fold(cands, tight).where("kind = 'sft'").groupBy("decision").count().collect()}
    assert got["selected"] == 2 and got["quota_exceeded"] > 0


def test_episodes(spark, tmp_path):
    rows = [raw(user=f"Please explain the sql join number {'abcdef'[k]}", reply=f"It joins rows, case {k}", n=n) for k, n in enumerate((0, 5, 35, 90))]
    rows.append(raw(n=6, session_id=None) | {"request_id": "x"})
    config = scoring.Config(near_duplicates=False)
    read = samples_of(spark, tmp_path, rows).where("reason is null").drop("reason")
    marked = selection.mark_dedupe(scoring.annotate(read, config), config)
    built = selection.episodes(marked, config)
    assert sorted(r["turn_count"] for r in built.collect()) == [1, 1, 3]  # 30 minutes apart still joins
    turns = selection.multi_turn(built).collect()
    assert [len(r["messages"]) for r in turns] == [6]


def test_process_date_publishes_all_or_nothing(spark, tmp_path):
    write_logs(tmp_path / "in", [raw(), changed(("status",), "error"), raw(n=2, user="你好")])
    out = tmp_path / "out"
    manifest = plans.process_date(spark, str(tmp_path / "in"), f"file://{out}", DAY, single_file=True)
    assert manifest["accepted"] == 2 and manifest["rejected"] == {"status_not_success": 1}
    line = json.loads((out / f"selected/sft/{DAY}.jsonl").read_text())
    assert line["output"] == "def f(xs): return sorted(xs)" and "sample_id" not in line
    assert records.unsafe(line) is None
    assert json.loads((out / f"reports/{DAY}.rejects.jsonl").read_text()) == {"date": DAY, "reason": "status_not_success", "schema_version": "selection_report.v1"}
    told = json.loads((out / f"reports/{DAY}.selection_manifest.json").read_text())
    assert told["selection"]["selected_counts"] == {"router_classification": 1, "sft": 1, "tool_use_sft": 0} and told["selection"]["candidate_count"] == 2
    assert told["output_matrix"]["disable_episodes"] is False and told["labelers"]["feature_only_default"] is True
    stats = json.loads((out / f"reports/{DAY}.stats.json").read_text())
    assert (stats["accepted"], stats["rejected"], stats["reject_reasons"], stats["models"]) == (2, 1, {"status_not_success": 1}, {"gpt-4o": 2})
    assert json.loads((out / f"reports/{DAY}.quality_stats.json").read_text())["total"] == 2
    assert len((out / f"canonical/{DAY}.jsonl").read_text().splitlines()) == 2
    assert not list((out / ".locks").glob("*.lock")) and not list((out / ".tmp").glob("*"))
    events: list = []
    small = plans.Outputs(disable_episodes=True, disable_diagnostics=True)
    again = plans.process_date(spark, str(tmp_path / "in"), f"file://{out}", DAY, outputs=small, progress=events.append)
    assert again["accepted"] == 2 and (out / f"sft/{DAY}.jsonl").is_dir() and "episodes" not in again["outputs"]
    assert [e["rejected"] for e in events] == [1]


def test_outputs_by_switch():
    every = plans.Outputs().names()
    assert set(every) - set(plans.Outputs(disable_episodes=True).names()) == {"episodes", "selected_multi_turn_sft"}
    assert set(every) - set(plans.Outputs(disable_diagnostics=True).names()) == {"canonical", "quality", "episodes"}
    assert plans.Outputs(compat_output_set=True).names() == plans.Outputs(disable_selection=True).names() == list(plans.BASE)


def test_model_labels_reach_exports(spark, tmp_path):
    rows = [raw(), raw(n=1, user="Explain the sql join to me in words")]
    read = samples_of(spark, tmp_path, rows)
    stats: list = []
    out = plans.plan(read, route_client=lambda p: '{"label": "reasoning", "confidence": 0.5}', label_stats=stats)
    chosen = [json.loads(r["json"]) for r in out["selected_router"].collect()]
    assert len(chosen) == 2 and all(r["labels"] == {"final_label": "reasoning", "rule_label": "code_generation"} for r in chosen)
    queue = [json.loads(r["json"]) for r in out["label_queue"].collect()]
    assert len(queue) == 2 and set(queue[0]) == {"schema_version", "reason", "features", "labels"} and queue[0]["reason"] == "low_confidence_route"
    assert queue[0]["labels"]["confidence"] == "low" and queue[0]["features"]["prompt_tokens_bucket"] == "lt_512"
    (turns,) = [json.loads(r["json"]) for r in out["selected_multi_turn_sft"].collect()]
    assert re.fullmatch("ep[0-9a-f]{8}x[0-9a-f]{8}", turns["episode_export_id"]) and turns["metadata"]["turn_count"] == 2
    assert stats and records.unsafe(turns) is None


def test_publish_rolls_back(spark, tmp_path):
    store = sinks.Store(spark, f"file://{tmp_path}")
    store.write("a", "old")
    store.write("s/a", "new")
    store.write("s/b", "new")

    def failing(source, target):
        if target == "b":
            raise OSError("no")
        store.move(source, target)

    with pytest.raises(OSError):
        sinks.publish(store, {"a": "s/a", "b": "s/b"}, "run", move=failing)
    assert store.read("a") == "old" and not store.exists("b")


def test_lock(spark, tmp_path):
    store = sinks.Store(spark, f"file://{tmp_path}")
    sinks.acquire_lock(store, DAY, "one")
    with pytest.raises(RuntimeError):
        sinks.acquire_lock(store, DAY, "two")
    sinks.release_lock(store, DAY, "two")
    assert store.exists(f".locks/{DAY}.lock")
    sinks.release_lock(store, DAY, "one")
    sinks.acquire_lock(store, DAY, "two")
    store.write(f".locks/{DAY}.lock", json.dumps({"run_id": "old", "host": "elsewhere", "pid": 1, "at": 0}))
    sinks.acquire_lock(store, DAY, "three")


def test_dates():
    assert audit.date_range("2026-02-27", "2026-03-01") == ["2026-02-27", "2026-02-28", "2026-03-01"]
    for bad in ("2026-2-1", "2026-02-30", "x"):
        with pytest.raises(ValueError):
            audit.valid_date(bad)
    with pytest.raises(SystemExit):
        plans.parse_args(["--input-root", "x"])


def test_redaction_looks_for_what_a_kind_needs():
    for kind in records.NEEDS:
        assert kind in {name for _, name, _ in records.REDACTIONS}
    for text, kind in (("a@b.co", "email"), ("１３８００１３８０００" + "1", None), ("13800138000", "phone"), ("11010519900307123X", "cn_id"), ("6222 0212-3456 7890", "bank_card"), ("1.2.3.4", "ip"), ("١.٢.٣.٤", "ip")):
        hits: dict[str, int] = {}
        records.redact_text(f"say {text} now", hits)
        assert (kind in hits) if kind else not hits, text
