"""Queries over inputs made from the tables so that every outcome of an operator occurs; the SQL states the outcomes.

A row takes the case that its id names; the expected results are written down beside the inputs, not computed by the code they check.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import records
from gleanspark.functions import text as t
from gleanspark.operators import exports, labels, reports, samples, scoring, selection, synthetic
from gleanspark.operators.scoring import Config, content_hash
from gleanspark.plans.catalog import SAMPLES, STATS, _read, _simhashes, query
from gleanspark.sources import audit

LONG = "@long@"


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def expected(cases, k: int, by: str = "doc_id") -> str:
    """SQL for what the case of a row has at position ``k``."""
    return f"[{', '.join(_literal(c[k]) for c in cases)}][{by} % {len(cases)} + 1]"


def given(cases, k: int = 0, by: str = "doc_id") -> Column:
    """What the case of a row has at position ``k``."""
    return F.get(F.array(*[F.lit(c[k]).cast("string") for c in cases]), (F.col(by) % len(cases)).cast("int"))


def _docs(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id")


# ---------------------------------------------------------------- checks of logged records


def _call(id_="c1", name="f", arguments="{}", **more) -> dict:
    return {"id": id_, "type": "function", "function": {"name": name, "arguments": arguments}} | more


def _record(messages=None, reply=None, usage=None, **body) -> str:
    messages = [{"role": "user", "content": "hello there"}] if messages is None else messages
    reply = {"role": "assistant", "content": "fine"} if reply is None else reply
    answer = {"choices": [{"message": reply, "finish_reason": "stop"}], "usage": {} if usage is None else usage}
    return json.dumps({"status": "success", "request_id": "r", "request_body": {"messages": messages} | body, "response_body": answer})


def _tool(**function) -> dict:
    return {"type": "function", "function": {"name": "f"} | function}


def _user(content) -> list[dict]:
    return [{"role": "user", "content": content}]


def _say(**more) -> dict:
    return {"role": "assistant", "content": "fine"} | more


BAD_REPLY, BAD_TOOLS, BAD_MESSAGES, BAD_USAGE = "invalid_response_message", "invalid_tools", "invalid_messages", "invalid_usage"
#: A logged record and the first reason against it.
RECORDS = [
    (_record(), None), ("{", "bad_detail_json"), ("[1]", "bad_detail_json"), ('{"status": NaN}', "bad_detail_json"), ('{"status": 1e999}', "bad_detail_json"),
    ('{"status": "error"}', "status_not_success"), ('{"status": "success"}', "missing_messages"), (_record([]), "missing_messages"),
    (_record(_user(3)), BAD_MESSAGES), (_record([{"content": "x"}]), BAD_MESSAGES), (_record(["x"]), BAD_MESSAGES), (_record(_user([{"text": 3}])), BAD_MESSAGES),
    (_record(_user(["a", {"type": "image"}, {"text": "b"}])), None),
    (_record(tools={}), BAD_TOOLS), (_record(tools=[{"type": "function"}]), BAD_TOOLS), (_record(tools=[_tool(name="")]), BAD_TOOLS), (_record(tools=[_tool(description=None)]), BAD_TOOLS),
    (_record(tools=[_tool(parameters=None)]), BAD_TOOLS), (_record(tools=[_tool(parameters={"type": "object"}, description="d")]), None),
    ('{"status": "success", "request_body": {"messages": [{"role": "user", "content": "x"}]}, "response_body": {"choices": []}}', "missing_choices"),
    (_record(reply={"role": "assistant", "content": None}), BAD_REPLY), (_record(reply={"role": "assistant", "content": 4}), BAD_REPLY),
    (_record(reply=_say(tool_calls=[_call("")])), BAD_REPLY), (_record(reply=_say(tool_calls=[_call(type="other")])), BAD_REPLY), (_record(reply=_say(tool_calls=[_call(arguments={})])), BAD_REPLY),
    (_record(reply={"role": "assistant", "content": None, "tool_calls": [_call()]}), None),
    (_record(usage={"prompt_tokens": -1}), BAD_USAGE), (_record(usage={"total_tokens": 1.5}), BAD_USAGE), (_record(usage={"prompt_tokens": True}), BAD_USAGE), (_record(usage={"prompt_tokens": 1_000_000_001}), BAD_USAGE),
    (_record(usage={"prompt_tokens": 7.0, "other": "x"}), None), (_record(reply=_say(content=" \n ")), "empty_assistant_response"),
    (_record(_user(LONG)), "prompt_too_long"), (_record(reply=_say(content=LONG)), "response_too_long"),
]


def _logs(spark, sf_dir, cases) -> DataFrame:
    """Each document as the logged record of its case; a mark in it stands for a very long text."""
    raw = given(cases)
    raw = F.when(raw.contains(LONG), F.replace(raw, F.lit(LONG), F.repeat(F.lit("x"), 200_001))).otherwise(raw)
    return audit.canonicalise(_docs(spark, sf_dir).select(F.lit("2026-01-01").alias("date"), F.col("doc_id").alias("line_no"), F.lit("r").alias("request_id"), F.lit("a/b.json").alias("file_path"), raw.alias("raw")))


@query(f"SELECT doc_id AS line_no, {expected(RECORDS, 1)} AS reason FROM documents")
def val_reasons(spark, sf_dir):
    return _logs(spark, sf_dir, RECORDS).select("line_no", "reason")


def _asked(*calls) -> dict:
    return {"role": "assistant", "content": "", "tool_calls": list(calls)}


def _told(id_="c1") -> dict:
    return {"role": "tool", "content": "ok", "tool_call_id": id_}


TOOLS, ANSWERED = [_tool()], {"role": "assistant", "content": None, "tool_calls": [_call("c9")]}
#: A record with tools, what is wrong with its trace, and its route.
TRACES = [
    (_record(reply=ANSWERED, tools=TOOLS), None, "tool_agent"), (_record(reply=ANSWERED), None, "tool_agent"), (_record(tools=TOOLS), "missing_tool_calls", "tool_agent"), (_record(), None, "general_chat"),
    (_record(reply=_say(tool_calls=[_call(name="g")]), tools=TOOLS), "unknown_tool_name", "tool_agent"), (_record(reply=_say(tool_calls=[_call(arguments="[1]")]), tools=TOOLS), "invalid_tool_arguments", "tool_agent"),
    (_record(reply=_say(tool_calls=[_call(arguments="{")])), "invalid_tool_arguments", "tool_agent"), (_record(reply=_say(tool_calls=[_call(arguments="")])), None, "tool_agent"),
    (_record([*_user("x"), _asked(_call("c1")), _told(), *_user("y")], ANSWERED), None, "tool_agent"), (_record([*_user("x"), _asked(_call("c1")), *_user("y")], ANSWERED), "missing_tool_result", "tool_agent"),
    (_record([*_user("x"), _asked(_call("c1"))], ANSWERED), "missing_tool_result", "tool_agent"), (_record([*_user("x"), _told("c7")], ANSWERED), "unmatched_tool_result", "tool_agent"),
    (_record([*_user("x"), _asked(_call("c9")), _told("c9")], ANSWERED), "duplicate_tool_call_id", "tool_agent"), (_record([*_user("x"), _asked(_call("c1"), _call("c1")), _told()], ANSWERED), "duplicate_tool_call_id", "tool_agent"),
    (_record([*_user("x"), _asked({"id": "c1"}), _told()], ANSWERED), "invalid_tool_call", "tool_agent"),
]


@query(f"SELECT doc_id AS line_no, {expected(TRACES, 1)} AS tool_trace, {expected(TRACES, 2)} AS route_label FROM documents")
def val_traces(spark, sf_dir):
    return scoring.classify(_logs(spark, sf_dir, TRACES)).select("line_no", "tool_trace", "route_label")


#: A record, its last user text, its reply's text, its tools' names.
TEXTS = [
    (_record(_user("  hi there \n")), "hi there", "fine", ""), (_record(_user(["a ", "", " b"])), "a\nb", "fine", ""),
    (_record(_user([{"type": "text", "text": "a"}, {"type": "image", "text": "no"}, {"text": " b "}])), "a\nb", "fine", ""), (_record([*_user("first"), _say(), *_user("")]), "", "fine", ""),
    (_record([{"role": "system", "content": "s"}]), "", "fine", ""), (_record(reply=_say(content=[{"type": "text", "text": "x"}, {"text": "y"}]), tools=[_tool(name="b"), _tool(name="a")]), "hello there", "x\ny", "a,b"),
    (_record(reply=_say(tool_calls=[_call(name="z"), _call("c2", name="b")]), tools=[_tool(name="b")]), "hello there", "fine", "b,z"),
]


@query(f"SELECT doc_id AS line_no, {expected(TEXTS, 1)} AS user_text, {expected(TEXTS, 2)} AS response_text, {expected(TEXTS, 3)} AS tool_names FROM documents")
def fn_texts(spark, sf_dir):
    return _logs(spark, sf_dir, TEXTS).select("line_no", "user_text", "response_text", F.array_join("tool_names", ",").alias("tool_names"))


#: A record, its messages once redacted, and how many distinct matches that took.
TREES = [
    (_record(_user("to a@x.org, b@x.org, a@x.org")), '[{"content":"to <EMAIL_1>, <EMAIL_2>, <EMAIL_1>","role":"user"}]', "2"), (_record(_user("call 13812345678")), '[{"content":"call <PHONE_1>","role":"user"}]', "1"),
    (_record([{"role": "user", "content": "x", "c@x.org": "10.0.0.1", "d@x.org": [1, None, "10.0.0.2"]}]), '[{"<EMAIL_1>":"<IP_1>","<EMAIL_1>__2":[1,null,"<IP_1>"],"content":"x","role":"user"}]', "4"),
    (_record(), '[{"content":"hello there","role":"user"}]', "0"),
]


@query(f"SELECT doc_id AS line_no, {expected(TREES, 1)} AS messages, {expected(TREES, 2)}::INT AS hits FROM documents")
def red_trees(spark, sf_dir):
    return _logs(spark, sf_dir, TREES).select("line_no", F.col("messages_json").alias("messages"), F.col("redaction_hits").alias("hits"))


#: A JSON value and the first thing that forbids its export.
VALUES = [
    ('{"a": "fine words", "b": [1, "more", null, ""]}', None), ('{"a": {"request_id": 1}}', "forbidden key request_id"), ('[{"Content_HASH_x": 1}]', "forbidden key Content_HASH_x"), ('{"sampleId": ""}', "forbidden key sampleId"),
    ('["mail a@x.org"]', "email"), ('{"a": ["see https://x.org"]}', "url"), ('"   "', "empty"), ("17", None), ('{"b": "x", "taskFingerprint": 2}', "forbidden key taskFingerprint"),
]


@query(f"SELECT doc_id, {expected(VALUES, 1)} AS problem FROM documents")
def val_exports(spark, sf_dir):
    def run(frames):
        for frame in frames:
            yield frame.assign(problem=[records.unsafe(records.parse(v)) for v in frame["value"]]).drop(columns="value")

    return _docs(spark, sf_dir).select("doc_id", given(VALUES).alias("value")).mapInPandas(run, "doc_id long, problem string")


#: An index line and what is wrong with it; a path of a detail file and whether it may be read.
LINES = [
    ('{"request_id": "r", "file_path": "a/b.json"}', None, "a/b.json", "true"), ("{", "bad_index_json", "/etc/x", "false"), ('{"request_id": "r"}', "bad_index_record", "a/../../x", "false"), ("[]", "bad_index_record", "..", "false"),
    ('{"request_id": "", "file_path": "x"}', "bad_index_record", "a\\..\\x", "false"), ('{"request_id": "r", "file_path": 3}', "bad_index_record", "a/..b/c", "true"), ('{"request_id": "r", "file_path": "x", "n": NaN}', "bad_index_json", "./a", "true"),
]


@query(f"SELECT doc_id, {expected(LINES, 1)} AS problem, {expected(LINES, 3)}::BOOLEAN AS safe FROM documents")
def src_guards(spark, sf_dir):
    def run(frames):
        for f in frames:
            yield f[["doc_id"]].assign(problem=[audit.index_entry(x)[1] for x in f["line"]], safe=[audit.safe_path(x) for x in f["path"]])

    return _docs(spark, sf_dir).select("doc_id", given(LINES).alias("line"), given(LINES, 2).alias("path")).mapInPandas(run, "doc_id long, problem string, safe boolean")


# ---------------------------------------------------------------- text functions

#: A text, the same redacted, its distinct matches by kind, and the result of the leak scan.
PERSONAL = [
    ("mail a@x.org, A@x.org and a@x.org", "mail <EMAIL_1>, <EMAIL_2> and <EMAIL_1>", "email=2", "email"), ("key sk-abcdefghij0123456789 end", "key <SECRET_1> end", "secret=1", "secret"), ("tel 13812345678 or +8613912345678", "tel <PHONE_1> or <PHONE_2>", "phone=2", "phone"),
    ("id 11010519491231002X ok", "id <CN_ID_1> ok", "cn_id=1", "cn_id"), ("card 6222 0000 1111 2222 ok", "card <BANK_CARD_1> ok", "bank_card=1", "bank_card"), ("host 10.1.2.3 and 10.1.2.3", "host <IP_1> and <IP_1>", "ip=1", "ip"), ("plain words", "plain words", "", None),
    ("both a@x.org at 10.0.0.9", "both <EMAIL_1> at <IP_1>", "email=1,ip=1", "email"), ("see http://x.org/a", "see http://x.org/a", "", "url"), ("u 123e4567-e89b-12d3-a456-42661417400a u", "u 123e4567-e89b-12d3-a456-42661417400a u", "", "uuid"), ("open /var/log/x now", "open /var/log/x now", "", "file_path"),
    ("lit " + "aB" * 20, "lit " + "aB" * 20, "", "long_literal"), ("Error: it broke", "Error: it broke", "", "code_block"), ("was <EMAIL_1> here", "was <EMAIL_1> here", "", "redaction_placeholder"), ("{};" * 4, "{};" * 4, "", "code_heavy"), ("<b>", "<b>", "", "placeholder_only"), (" \n", " \n", "", "empty"),
    ("ab " * 401, "ab " * 401, "", "too_long"),
]


@query(f"SELECT doc_id, {expected(PERSONAL, 1)} AS redacted, {expected(PERSONAL, 2)} AS hits FROM documents")
def red_kinds(spark, sf_dir):
    rows = t.redact(_docs(spark, sf_dir).withColumn("text", given(PERSONAL)), "text")
    return rows.select("doc_id", "redacted", F.array_join(F.transform(F.map_entries("redaction_stats"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("hits"))


@query(f"SELECT doc_id, {expected(PERSONAL, 3)} AS reason FROM documents")
def leak_kinds(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.leakage(given(PERSONAL)).alias("reason"))


#: A text and what it is for dedupe.
MARKS = [
    ("See  HTTPS://x.org/a?b=1 NOW", "see <url> now"), ("open /var/log/x.txt please", "open <path> please"), ("edit src/a/b.py", "edit <path>"), ("has <EMAIL_1> in it", "has <redacted> in it"), ("pay 12 or 3.5 by a1", "pay <num> or <num> by a1"),
    ("Well, (yes)! 'no'", "well yes no"), ("ok ok ok go", "ok go"), ("go go", "go go"), ("继续 继续 好的。", "继续 好的"), ("", ""), (None, ""), ("x " * 700, ("x " * 600).strip() + " "),
]


@query(f"SELECT doc_id, {expected(MARKS, 1)} AS normalized FROM documents")
def fn_norm_marks(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.normalize_for_dedupe(given(MARKS)).alias("normalized"))


#: A time and its milliseconds.
TIMES = [
    ("2026-01-02T03:04:05Z", "1767323045000"), ("2026-01-02 03:04:05", "1767323045000"), ("2026-01-02T03:04:05.6", "1767323045600"), ("2026-01-02T03:04:05.678901+08:00", "1767294245678"), ("2026-01-02T03:04:05-0130", "1767328445000"),
    ("1969-12-31T23:59:59Z", "-1000"), ("2026-02-30T00:00:00Z", None), ("2026-01-02", None), ("soon", None), (None, None),
]


@query(f"SELECT doc_id, {expected(TIMES, 1)}::BIGINT AS ms FROM documents")
def fn_time_forms(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.timestamp_ms(given(TIMES)).cast("long").alias("ms"))


#: A model, its bucket, a client and its bucket.
NAMES = [
    ("GPT-4o", "openai", "web", "web"), ("x-openai-y", "openai", "CLI", "cli"), ("Qwen-max", "qwen", "sdk", "sdk"), ("glm-4", "glm", "api", "api"), ("deepseek-gpt", "deepseek", "opencode", "opencode"), ("mistral", "other", "webs", "other"), ("", "unknown", "", "unknown"), (None, "unknown", None, "unknown"),
]


@query(f"SELECT doc_id, {expected(NAMES, 1)} AS model, {expected(NAMES, 3)} AS client FROM documents")
def fn_name_buckets(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.model_bucket(given(NAMES)).alias("model"), t.client_bucket(given(NAMES, 2)).alias("client"))


BITS = " + ".join(f"CASE WHEN 2 * sum((v >> {b}) & 1) >= count(*) THEN {1 << b}::HUGEINT ELSE 0 END" for b in range(64))


@query(f"""WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(trim(lower(text)), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) AS s FROM documents),
  m AS (SELECT doc_id, s, replace(s, ' ', '') AS c FROM n),
  l AS (SELECT doc_id, unnest(list_concat(CASE WHEN s = '' THEN [] ELSE string_split(s, ' ') END, list_transform(range(1, greatest(length(c) - 1, 1)), lambda i: substr(c, i, 3)))) AS token FROM m),
  h AS (SELECT doc_id, ('0x' || substr(sha256(token), 1, 16))::UBIGINT AS v FROM l),
  f AS (SELECT doc_id, ({BITS})::UBIGINT AS bits FROM h GROUP BY doc_id)
  SELECT n.doc_id, lpad(lower(printf('%x', coalesce(bits, 0::UBIGINT))), 16, '0') AS simhash FROM n LEFT JOIN f USING (doc_id)""")
def fn_simhash_words(spark, sf_dir):
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.lower("text")), "[^a-z ]+", " "), " +", " "))
    return _simhashes(_read(spark, sf_dir, "documents").select("doc_id", plain.alias("n")))


@query("""SELECT doc_id, sha256('{"a":' || coalesce(to_json(source), 'null') || ',"n":[' || doc_id || ',true]}') AS hash FROM documents""")
def fn_hashes(spark, sf_dir):
    def run(frames):
        for f in frames:
            yield f[["doc_id"]].assign(hash=[content_hash({"n": [int(i), True], "a": s}) for i, s in zip(f["doc_id"], f["source"], strict=True)])

    return _read(spark, sf_dir, "documents").select("doc_id", "source").mapInPandas(run, "doc_id long, hash string")


@query("SELECT strftime(d, '%Y-%m-%d') AS date FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS d FROM events)")
def src_dates(spark, sf_dir):
    first, last = _read(spark, sf_dir, "events").agg(F.date_format(F.min("ts"), "yyyy-MM-dd"), F.date_format(F.max("ts"), "yyyy-MM-dd")).first()
    return spark.createDataFrame([(d,) for d in audit.date_range(first, last)], "date string")


# ---------------------------------------------------------------- classification and scores of varied requests

#: What users ask, by conversation.
ASKED = [
    ("请写一个 python 函数",), ("这个 bug 怎么修复",), ("帮我总结 这段话",), ("为什么 天是蓝的",), ("我的 订单 在哪",), ("hi",), ("你好",), ("abc",), ("x",), ("Debug  THIS thing",), ("翻译 一下",), ("an ordinary question, please",), ("",),
]
VARIED = SAMPLES.replace("FROM conversations", "FROM varied")
VARIED = f"varied AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN {expected(ASKED, 0, 'conv_id')} ELSE text END AS text FROM conversations), {VARIED}"


def _varied(spark, sf_dir) -> DataFrame:
    told = _read(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("role") == "user", given(ASKED, 0, "conv_id")).otherwise(F.col("text")))
    return scoring.annotate(samples.from_conversations(told))


@query(f"WITH {VARIED} SELECT sample_id, route_label, intent_label FROM labelled")
def cls_varied(spark, sf_dir):
    return _varied(spark, sf_dir).select("sample_id", "route_label", "intent_label")


@query(f"WITH {VARIED} SELECT sample_id, deterministic_score, score_bucket, array_to_string(reject_reasons, ',') AS reject_reasons FROM labelled")
def scr_varied(spark, sf_dir):
    return _varied(spark, sf_dir).select("sample_id", "deterministic_score", "score_bucket", F.array_join("reject_reasons", ",").alias("reject_reasons"))


@query(f"WITH {VARIED}, {STATS} SELECT section, CASE WHEN n >= 5 THEN key ELSE 'suppressed_small_count' END AS key, sum(n)::BIGINT AS n FROM counts GROUP BY 1, 2")
def agg_quality_varied(spark, sf_dir):
    return reports.quality_stats(_varied(spark, sf_dir))


#: Finish reason, redactions: the score's caps (reasons in order).
CAPS = [("stop", "0", "0.85", ""), ("length", "0", "0.4", "length_finish"), ("stop", "2", "0.45", "redaction_risk"), ("length", "1", "0.4", "length_finish,redaction_risk")]


@query(f"SELECT doc_id, {expected(CAPS, 2)}::DOUBLE AS deterministic_score, {expected(CAPS, 3)} AS reject_reasons FROM documents")
def scr_caps(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(
        "doc_id", F.lit("write a python sort").alias("user_text"), F.lit("def sort").alias("response_text"), F.lit(False).alias("has_tools"), F.lit(9).alias("prompt_tokens"), F.lit(99).alias("messages_chars"),
        given(CAPS).alias("finish_reason"), given(CAPS, 1).cast("int").alias("redaction_hits"),
    )
    return scoring.score(scoring.classify(rows)).select("doc_id", "deterministic_score", F.array_join("reject_reasons", ",").alias("reject_reasons"))


# ---------------------------------------------------------------- ordered operators

#: What users of three sessions say, by event.
SAID = [("ok",), ("OK!",), ("write it",), ("继续",), ("7",), ("that",)]
MS = "(epoch_us(ts) // 1000)"


def _sample(events: DataFrame, text: Column, reply: Column, session: Column, task: Column, score: Column, uses: Column | None = None) -> DataFrame:
    """Events as annotated samples."""
    none = F.array().cast("array<string>")
    return events.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("sample_id"), F.date_format("ts", "yyyy-MM-dd").alias("date"), session.alias("session_key"), session.alias("user_hash"), session.alias("session_hash"), F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"),
        F.col("event_id").alias("line_no"), F.lit("general_chat").alias("route_label"), F.lit("answer_question").alias("intent_label"), score.alias("final_score"), F.lit("medium").alias("score_bucket"), task.alias("task_fingerprint"),
        text.alias("user_text"), reply.alias("response_text"), t.normalize(text).alias("normalized"), t.normalize_for_dedupe(text).alias("dedupe_text"), none.alias("tool_names"), F.lit(False).alias("history_unsafe"), F.lit(False).alias("tool_unsafe"),
        (uses if uses is not None else none).alias("use_for"), none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("value_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"),
    )


def _crowd() -> Column:
    return F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string"))


@query(f"""WITH e AS (SELECT event_id, ts::DATE AS day, user_id % 3 AS s, {MS} AS ms, event_type, ['ok', 'ok', 'write it', '继续', '<num>', 'that'][event_id % 6 + 1] AS said FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY day, s, said ORDER BY ms, event_id) AS nth, lag(ms, 8) OVER (PARTITION BY day, s, event_type ORDER BY ms, event_id) AS since FROM e)
  SELECT event_id, said <> 'write it' AND nth > 2 AS repeated, coalesce(since >= ms - 7200000, false) AS burst FROM n""")
def win_noise(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    marked = selection.mark_noise(_sample(e, given(SAID, 0, "event_id"), F.lit("r"), _crowd(), F.col("event_type"), F.lit(0.6)), Config(burst_minutes=120))
    return marked.select(F.col("line_no").alias("event_id"), F.array_contains("reject_reasons", "debug_noise_repeat").alias("repeated"), F.array_contains("reject_reasons", "debug_burst").alias("burst"))


#: Requests that repeat, some only but for punctuation, some with an address in the reply.
RANKED = f"""e AS (SELECT event_id, ts::DATE AS day, {MS} AS ms, (event_id % 4) * 0.1::DOUBLE + 0.6 AS score, 'ask about ' || event_type || CASE WHEN event_id % 3 = 0 THEN '!' ELSE '' END AS said, event_type AS same, event_id % 5 = 0 AS leaky FROM events),
  k AS (SELECT *, 'router_classification' AS kind, said AS exact, same AS normal, false AS unsafe FROM e
    UNION ALL SELECT *, 'sft', said || leaky, same || leaky, leaky FROM e),
  r AS (SELECT *, row_number() OVER (PARTITION BY day, kind, normal ORDER BY score DESC, ms, event_id) AS nth FROM k),
  f AS (SELECT day, kind, normal, arg_min(exact, nth) AS exact, min(nth) AS nth FROM r WHERE NOT unsafe GROUP BY ALL),
  d AS (SELECT r.*, CASE WHEN f.nth < r.nth THEN CASE WHEN f.exact = r.exact THEN 'duplicate_content' ELSE 'normalized_duplicate_content' END WHEN unsafe THEN 'leakage_scan_failed' ELSE 'selected' END AS decision
    FROM r LEFT JOIN f ON f.day = r.day AND f.kind = r.kind AND f.normal = r.normal)"""


def _ranked(spark, sf_dir) -> DataFrame:
    said = F.concat(F.lit("ask about "), "event_type", F.when(F.col("event_id") % 3 == 0, "!").otherwise(""))
    reply = F.when(F.col("event_id") % 5 == 0, "mail a@x.org").otherwise("all good")
    score = (F.col("event_id") % 4).cast("double") * 0.1 + 0.6
    uses = F.array(F.lit("router_classification"), F.lit("sft"))
    return _sample(_read(spark, sf_dir, "events"), said, reply, F.concat(F.lit("u"), F.col("user_id").cast("string")), F.concat(F.lit("t"), F.col("event_id").cast("string")), score, uses)


@query(f"WITH {RANKED} SELECT event_id, kind, decision FROM d")
def win_two_pass(spark, sf_dir):
    return selection.select(_ranked(spark, sf_dir)).select(F.col("line_no").alias("event_id"), "kind", "decision")


@query(f"WITH {RANKED} SELECT event_id, kind, decision FROM d")
def win_fold(spark, sf_dir):
    """The same by the fold that quotas need."""
    return selection.decide_by_fold(selection.candidates(_ranked(spark, sf_dir))).select(F.col("line_no").alias("event_id"), "kind", "decision")


@query(f"""WITH {RANKED}, p AS (SELECT event_id, list(kind ORDER BY kind) FILTER (decision = 'selected') AS chosen, list(DISTINCT decision ORDER BY decision) AS all_, list(kind ORDER BY kind) FILTER (decision IN ('selected', 'quota_exceeded')) AS left_ FROM d GROUP BY event_id)
  SELECT event_id, coalesce(array_to_string(chosen, ','), '') AS selected, coalesce(array_to_string(left_, ','), '') AS use_for,
    array_to_string(list_concat(CASE WHEN len(list_filter(all_, lambda x: x LIKE '%duplicate_content')) > 0 THEN ['duplicate'] ELSE [] END, CASE WHEN list_contains(all_, 'leakage_scan_failed') THEN ['leakage_scan_failed'] ELSE [] END), ',') AS risk_labels,
    array_to_string(list_concat(CASE WHEN left_ IS NULL THEN list_filter(all_, lambda x: x LIKE '%duplicate_content') ELSE [] END, CASE WHEN list_contains(all_, 'leakage_scan_failed') THEN ['leakage_scan_failed'] ELSE [] END).list_sort(), ',') AS reject_reasons
  FROM p""")
def win_marks(spark, sf_dir):
    marked = _ranked(spark, sf_dir)
    done = selection.apply_decisions(marked, selection.select(marked))
    joined = lambda c: F.array_join(F.array_sort(c), ",").alias(c)
    return done.select(F.col("line_no").alias("event_id"), joined("selected"), joined("use_for"), joined("risk_labels"), joined("reject_reasons"))


@query(f"""SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY ts::DATE, user_id % 3 ORDER BY event_id % 4 DESC, {MS}, event_id) <= 3 THEN 'selected' ELSE 'quota_exceeded' END AS decision FROM events""")
def win_quota(spark, sf_dir):
    said = F.concat(F.lit("ask "), F.regexp_replace(F.translate(F.col("event_id").cast("string"), "0123456789", "abcdefghij"), "$", " please"))
    score, task = (F.col("event_id") % 4).cast("double") * 0.1 + 0.6, F.concat(F.lit("t"), F.col("event_id").cast("string"))
    rows = _sample(_read(spark, sf_dir, "events"), said, F.lit("fine"), _crowd(), task, score, F.array(F.lit("router_classification")))
    return selection.select(rows, Config(max_router_per_user=3)).select(F.col("line_no").alias("event_id"), "decision")


@query(f"""WITH g AS (SELECT *, {MS} AS ms, ts::DATE AS day, {MS} - lag({MS}) OVER (PARTITION BY ts::DATE, user_id ORDER BY {MS}, event_id) AS gap FROM events),
  i AS (SELECT *, sum(CASE WHEN gap <= 7200000 THEN 0 ELSE 1 END) OVER (PARTITION BY day, user_id ORDER BY ms, event_id) AS island FROM g)
  SELECT strftime(day, '%Y-%m-%d') AS date, min(event_id) AS least_event, count(*) AS turn_count, 2 * count(*) AS n_messages, string_agg('ask about ' || event_type, '|' ORDER BY ms, event_id) AS said
  FROM i GROUP BY day, user_id, island HAVING count(*) > 1 AND bool_and(event_id % 7 <> 0)""")
def win_multi(spark, sf_dir):
    """Episodes as conversations; an address in any turn drops the episode."""
    reply = F.when(F.col("event_id") % 7 == 0, "mail a@x.org").otherwise("all good")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    config = Config(episode_gap_minutes=120)
    built = selection.episodes(_sample(_read(spark, sf_dir, "events"), F.concat(F.lit("ask about "), "event_type"), reply, user, user, F.lit(0.9)), config)
    told = selection.multi_turn(built).join(built.select("episode_id", F.array_min(F.transform("turns", lambda x: x["line_no"])).alias("least_event")), "episode_id")
    said = F.array_join(F.transform(F.filter("messages", lambda m: m["role"] == "user"), lambda m: m["content"]), "|")
    return told.select("date", "least_event", "turn_count", F.size("messages").cast("long").alias("n_messages"), said.alias("said"))


# ---------------------------------------------------------------- exports


def _stable(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _told_of(messages: list[dict]) -> str:
    return hashlib.sha256(_stable({"date": "2026-01-01", "messages": messages, "request_id": "r"}).encode()).hexdigest()


ASK_CODE, ASK_TOOL, CODE_REPLY = _user("请写一个 python 排序函数"), [{"role": "system", "content": "be brief"}, *_user("find a train")], _say(content="def sort(): pass")
TOOL_REPLY = {"role": "assistant", "content": None, "tool_calls": [_call("c9")]}
META = {"source_date": "2026-01-01", "risk_labels": [], "model_bucket": "openai"}
CODE_META = META | {"route_label": "code_generation", "intent_label": "write_code", "score_bucket": "high", "value_labels": ["code_task", "well_formed_response"]}
TOOL_META = META | {"route_label": "tool_agent", "intent_label": "use_tool", "score_bucket": "high", "value_labels": ["tool_task"]}
CODE_TEXTS = {"instruction": "", "input": "请写一个 python 排序函数", "output": "def sort(): pass", "messages": [*ASK_CODE, {"role": "assistant", "content": "def sort(): pass"}]}
TOOL_PARTS = {"messages": ASK_TOOL, "tools": TOOLS, "response_message": TOOL_REPLY}
BUCKETS = {"prompt_tokens_bucket": "lt_512", "completion_tokens_bucket": "lt_512", "client_type_bucket": "unknown", "model_bucket": "openai"}
CODE_FEATURES = BUCKETS | {"message_count": 1, "has_tools": False, "route_label": "code_generation", "intent_label": "write_code"}
TOOL_FEATURES = BUCKETS | {"message_count": 2, "has_tools": True, "route_label": "tool_agent", "intent_label": "use_tool"}
V1 = {"schema_version": "selected_training.v1"}
#: A record, and what each export makes of it (nothing: no row). Position 1: sft, tool use, router; 4: the selected ones in that order; 7: the label queue, with a model's label of low confidence.
EXPORTED = [
    (
        _record(ASK_CODE, CODE_REPLY, model="gpt-4o"), _stable(CODE_TEXTS | {"sample_id": _told_of(ASK_CODE), "metadata": {"source_date": "2026-01-01", "model": "gpt-4o"}}), None,
        _stable({"sample_id": _told_of(ASK_CODE), "input": "请写一个 python 排序函数", "features": {"message_count": 1, "has_tools": False, "prompt_tokens": 0, "client_type": ""}, "labels": {"weak_model_label": "gpt-4o", "rule_label": "code_generation", "model_label": {"label": "reasoning", "confidence": 0.5}, "final_label": "reasoning", "confidence": "low"}}),
        _stable(V1 | CODE_TEXTS | {"metadata": CODE_META}), None, _stable(V1 | {"input": "请写一个 python 排序函数", "features": CODE_FEATURES, "labels": {"final_label": "code_generation", "rule_label": "code_generation"}, "metadata": CODE_META}),
        _stable({"schema_version": "label_queue.v2", "reason": "low_confidence_route", "features": CODE_FEATURES, "labels": {"route_label": "code_generation", "intent_label": "write_code", "confidence": "low"}}),
    ),
    (
        _record(ASK_TOOL, TOOL_REPLY, model="gpt-4o", tools=TOOLS), None, _stable(TOOL_PARTS | {"sample_id": _told_of(ASK_TOOL), "metadata": {"source_date": "2026-01-01", "finish_reason": "stop", "model": "gpt-4o"}}),
        _stable({"sample_id": _told_of(ASK_TOOL), "input": "find a train", "features": {"message_count": 2, "has_tools": True, "prompt_tokens": 0, "client_type": ""}, "labels": {"weak_model_label": "gpt-4o", "rule_label": "tool_agent", "model_label": None, "final_label": "tool_agent", "confidence": "medium"}}),
        None, _stable(V1 | TOOL_PARTS | {"metadata": TOOL_META}), _stable(V1 | {"input": "find a train", "features": TOOL_FEATURES, "labels": {"final_label": "tool_agent", "rule_label": "tool_agent"}, "metadata": TOOL_META}), None,
    ),
]


def _exported(k: int) -> str:
    return f"SELECT json, count(*) AS n FROM (SELECT {expected(EXPORTED, k)} AS json FROM documents) WHERE json IS NOT NULL GROUP BY json"


def _annotated(spark, sf_dir) -> DataFrame:
    """Annotated samples of the records; what they may be used for is taken as selected."""
    rows = scoring.annotate(_logs(spark, sf_dir, EXPORTED).where("reason is null").drop("reason"))
    return rows.withColumn("selected", F.col("use_for"))


def _lines(rows: DataFrame) -> DataFrame:
    """Distinct exported records, keys sorted, and how often they come."""

    def run(frames):
        for f in frames:
            yield f.assign(json=[_stable(json.loads(x)) for x in f["json"]])

    return rows.groupBy("json").agg(F.count("*").alias("n")).mapInPandas(run, "json string, n long")


def _model_route(rows: DataFrame) -> tuple[Column, Column]:
    """A model's label, of low confidence, for samples without tools."""
    return F.when(~F.col("has_tools"), "reasoning"), F.when(~F.col("has_tools"), F.lit(0.5))


@query(_exported(1))
def exp_sft_lines(spark, sf_dir):
    return _lines(exports.sft(_annotated(spark, sf_dir)))


@query(_exported(2))
def exp_tool_lines(spark, sf_dir):
    return _lines(exports.tool_use(_annotated(spark, sf_dir)))


@query(_exported(3))
def exp_router_lines(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return _lines(exports.router(rows, *_model_route(rows)))


@query(_exported(4))
def exp_sel_sft_lines(spark, sf_dir):
    return _lines(exports.selected_sft(_annotated(spark, sf_dir)))


@query(_exported(5))
def exp_sel_tool_lines(spark, sf_dir):
    return _lines(exports.selected_tool_use(_annotated(spark, sf_dir)))


@query(_exported(6))
def exp_sel_router_lines(spark, sf_dir):
    return _lines(exports.selected_router(_annotated(spark, sf_dir)))


@query(_exported(7))
def exp_queue_lines(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return _lines(exports.label_queue(rows, *_model_route(rows)))


@query(f"""SELECT '{{"date":"2026-01-01","reason":"' || reason || '","schema_version":"selection_report.v1"}}' AS json, count(*) AS n FROM (SELECT {expected(RECORDS, 1)} AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY 1""")
def snk_reject_lines(spark, sf_dir):
    return _lines(exports.rejects(_logs(spark, sf_dir, RECORDS)))


# ---------------------------------------------------------------- labels and synthetic samples


@query("SELECT source AS payload, count(*) AS asked FROM documents WHERE source IS NOT NULL GROUP BY source")
def jn_cache(spark, sf_dir):
    """One question for equal payloads."""
    _, answers = labels.ask(_read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("payload")), lambda payload: '{"label": "reasoning", "confidence": 1}', labels.parse_route, labels.ROUTE_SCHEMA)
    return answers.where("model_label = 'reasoning'").select("payload", "asked")


ROUTER = {"task_type": "router", "topic": "b", "input": "x", "label": "reasoning"}
SFT = {"task_type": "sft", "topic": "b", "messages": _user("q"), "response": "r"}
TOOL = {"task_type": "tool_use_sft", "topic": "b", "messages": _user("q"), "tools": TOOLS, "response_message": {"role": "assistant", "content": None, "tool_calls": [_call()]}}
#: A generator's answer, the kinds of the samples in it, and why it is refused.
BATCHES = [
    (json.dumps({"samples": [ROUTER, SFT, TOOL]}), "router,sft,tool_use_sft", None), ("```json\n" + json.dumps([SFT]) + "\n```", "sft", None), ("```\n" + json.dumps([ROUTER]) + "\n```", "router", None), ("no json", "", "any"), ("{}", "", "any"), ("[]", "", "any"),
    (json.dumps([ROUTER, {**SFT, "response": " "}]), "router", None), (json.dumps([{**ROUTER, "label": "other"}]), "", "any"), (json.dumps([{**ROUTER, "topic": ""}]), "", "any"), (json.dumps([{**SFT, "messages": [_say()]}]), "", "any"),
    (json.dumps([ROUTER, {"deep": [{"client_ip": 1}]}]), "", "audit-like key"), (json.dumps([{**ROUTER, "request_body": {}}]), "", "audit-like key"), (json.dumps([{**TOOL, "tools": []}]), "", "any"), (json.dumps([{**TOOL, "response_message": _say()}]), "", "any"),
]


@query(f"SELECT doc_id AS batch_index, {expected(BATCHES, 1)} AS kinds, {expected(BATCHES, 2)} AS problem FROM documents")
def syn_batches(spark, sf_dir):
    def run(frames):
        for f in frames:
            kinds, problems = [], []
            for i, answer in zip(f["batch_index"], f["answer"], strict=True):
                try:
                    kinds.append(",".join(sorted(s["task_type"] for s in synthetic.parse_batch(answer, {"batch_index": int(i)}))))
                    problems.append(None)
                except ValueError as e:
                    kinds.append("")
                    problems.append("audit-like key" if str(e) == "audit-like key" else "any")
            yield f[["batch_index"]].assign(kinds=kinds, problem=problems)

    return _docs(spark, sf_dir).select(F.col("doc_id").alias("batch_index"), given(BATCHES).alias("answer")).mapInPandas(run, "batch_index long, kinds string, problem string")
