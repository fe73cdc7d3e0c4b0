"""Optional labels and synthetic samples, with stand-ins for the model."""

import json

import pytest

from gleanspark.functions import records
from gleanspark.operators import labels, samples, scoring, synthetic

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    return scoring.annotate(samples.from_conversations(spark.read.parquet(f"{SF}/conversations.parquet"))).cache()


@pytest.mark.parametrize(
    "answer, want",
    [
        ('{"label": "reasoning", "confidence": 0.8}', ("reasoning", 0.8)),
        ('{"label": "made_up", "confidence": 0.8}', (None, None)),
        ('{"label": "reasoning", "confidence": true}', (None, None)),
        ('{"label": "reasoning", "confidence": NaN}', (None, None)),
        ('{"label": "reasoning", "confidence": 1.1}', (None, None)),
        ("not json", (None, None)),
        (None, (None, None)),
    ],
)
def test_route_answers(answer, want):
    assert labels.parse_route(answer) == want


NONE = (None, [], [])


@pytest.mark.parametrize(
    "answer, want",
    [
        ('{"quality_score": 0.5, "risk_labels": ["duplicate", "x", 3], "value_labels": ["code_task"]}', (0.5, ["code_task"], ["duplicate"])),
        ('{"quality_score": 1}', (1.0, [], [])),
        ('{"quality_score": "1"}', NONE),
        ('{"quality_score": true}', NONE),
        ('{"quality_score": 1.01}', NONE),
        ('{"quality_score": 0.5, "value_labels": 3}', NONE),
        ('{"quality_score": 0.5, "risk_labels": null}', NONE),
        ('{"quality_score": 0.5, "reason": 1}', NONE),
        ('{"score": 0.5}', NONE),
        ("[]", NONE),
        (None, NONE),
    ],
)
def test_quality_answers(answer, want):
    assert labels.parse_quality(answer) == want


def test_a_reason_must_be_text():
    assert labels.parse_route('{"label": "reasoning", "confidence": 0.8, "reason": 1}') == (None, None)


def test_settings():
    env = {"AUDIT_LABEL_BASE_URL": "http://x/", "AUDIT_LABEL_API_KEY": "k", "AUDIT_LABEL_MODEL": "m"}
    found = labels.load_config(env)
    assert found == {"enabled": True, "base_url": "http://x", "api_key": "k", "model": "m", "timeout": 30, "cache_enabled": True, "cache_max_entries": 10_000}
    assert labels.client_of(found) and labels.client_of(labels.load_config({})) is None
    odd = labels.load_config(env | {"AUDIT_LABEL_TIMEOUT": "999", "AUDIT_LABEL_CACHE": "off", "AUDIT_LABEL_CACHE_MAX_ENTRIES": "x"})
    assert (odd["timeout"], odd["cache_enabled"], odd["cache_max_entries"]) == (120, False, 10_000)
    assert labels.load_config(env | {"AUDIT_LABEL_TIMEOUT": "0"})["timeout"] == 1


def test_a_model_can_only_lower(scored):
    high = labels.label_quality(scored, lambda _: '{"quality_score": 1.0}')
    assert high.where("final_score <> deterministic_score").count() == 0
    asked = scored.where("size(reject_reasons) = 0 and deterministic_score >= 0.6 and size(use_for) > 0").count()
    low = labels.label_quality(scored, lambda _: '{"quality_score": 0.1}').where("array_contains(reject_reasons, 'model_downranked')")
    assert low.where("size(use_for) = 0 and final_score = 0.1").count() == low.count() == asked > 0


def test_samples_not_worth_a_question(scored):
    from pyspark.sql import functions as F

    bad = scored.limit(3).withColumn("reject_reasons", F.array(F.lit("length_finish")))
    poor = scored.limit(2).withColumn("deterministic_score", F.lit(0.5))
    unused = scored.where("size(reject_reasons) = 0").limit(1).withColumn("use_for", F.array().cast("array<string>"))
    rows, stats = labels.quality_answers(bad.unionByName(poor).unionByName(unused), lambda _: 1 / 0)
    assert {(r["section"], r["key"]): r["n"] for r in stats.collect()} == {("skips", "score_quality:deterministic_reject"): 3, ("skips", "score_quality:below_selected_min_score"): 2, ("skips", "score_quality:no_selected_use"): 1}
    assert rows.count() == 6 and rows.where("array_contains(reject_reasons, 'model_downranked')").count() == 0


def test_failing_client_changes_nothing(scored):
    def broken(_):
        raise OSError

    got, stats = labels.route_answers(scored, broken)
    assert got.where("model_label is not null").count() == 0 and got.count() == scored.count()
    assert {r["key"] for r in stats.where("section = 'errors'").collect()} == {"classify_route:labeler_request_failed:OSError"}


def test_equal_payloads_are_asked_once(spark, scored, tmp_path):
    """However many outputs read the answers."""
    folder = str(tmp_path)

    def client(payload):
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return '{"label": "reasoning", "confidence": 0.9}'

    got = labels.label_routes(scored, client)
    assert got.count() == got.where("model_label = 'reasoning'").count() == scored.count()
    assert len(list(tmp_path.iterdir())) == scored.select(labels.route_payload().alias("p")).distinct().count()


def test_payloads(scored):
    plain = [json.loads(r["p"]) for r in scored.select(labels.route_payload().alias("p")).collect()]
    assert all(set(p) == {"task", "labels", "sample", "response_format"} and set(p["sample"]) == {"features"} for p in plain)
    assert plain[0]["task"] == "classify_route" and plain[0]["labels"] == sorted(scoring.ROUTES) and plain[0]["response_format"] == labels.ROUTE_FORM
    quality = json.loads(scored.select(labels.quality_payload().alias("p")).first()["p"])
    assert quality["task"] == "score_quality" and quality["allowed_risk_labels"] == sorted(labels.RISK_LABELS) and quality["sample"]["features"]["redaction_density_bucket"] in ("none", "has_redactions")
    told = scored.select("user_text", "response_text", labels.quality_payload(True).alias("p"), labels.route_payload(True).alias("r")).collect()
    for r in told:
        safe = [records.leak(r[c]) is None for c in ("user_text", "response_text")]
        assert (r["p"] is not None) == all(safe) and (r["r"] is not None) == safe[0]
        if r["p"]:
            assert json.loads(r["p"])["sample"]["assistant_snippet"] == r["response_text"]


ROUTER = {"task_type": "router", "topic": "t", "input": "x", "label": "reasoning"}
SFT = {"task_type": "sft", "topic": "t", "messages": [{"role": "user", "content": "q"}], "response": "a"}
TOOL = {"type": "function", "function": {"name": "f"}}
USE = {"task_type": "tool_use_sft", "topic": "t", "messages": SFT["messages"], "tools": [TOOL], "response_message": {"tool_calls": [{"id": "1", "type": "function", "function": {"name": "f", "arguments": "{}"}}]}}


def test_batches():
    good = synthetic.parse_batch("```json\n" + json.dumps({"samples": [ROUTER, SFT, USE, {"task_type": "sft"}]}) + "\n```", {"batch_index": 1})
    assert [s["task_type"] for s in good] == ["router", "sft", "tool_use_sft"]
    assert good[0]["sample_id"] == synthetic.sample_id(ROUTER | {"source": {"other": 1}})
    for bad in ("[]", "{}", "x", json.dumps([ROUTER | {"extra": {"request_id": 1}}]), json.dumps([ROUTER, {"request_body": {}}]), json.dumps([ROUTER | {"x": [{"response_body": 1}]}]), json.dumps([{"task_type": "router"}])):
        with pytest.raises(ValueError):
            synthetic.parse_batch(bad, {})


def test_synthesis_resumes_and_ends(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    make = lambda k: json.dumps([ROUTER | {"input": f"question {k % 12}"}])
    assert synthetic.synthesize(spark, make, folder, 5, per_round=4) == 8
    assert synthetic.synthesize(spark, make, folder, 10, per_round=4) == 12
    assert synthetic.synthesize(spark, make, folder, 100, per_round=4) == 12  # only repeats are left
    assert spark.read.parquet(folder).select("sample_id").distinct().count() == 12
