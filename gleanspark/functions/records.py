"""One logged request as JSON: strict parsing, checks in order, redaction of trees, hashing. Runs inside executors."""

from __future__ import annotations

import json
import math
import re
from datetime import datetime, timedelta, timezone

from gleanspark.functions.text import CODE_TOKENS, LEAKAGE_PATTERNS, REDACTION_PATTERNS
from gleanspark.operators.scoring import content_hash, stable_json

# ---- Fixed values: request parameters that pass, usage fields and their bound, forbidden names, size limits.
SAFE_PARAMS = ("model", "temperature", "top_p", "max_tokens", "presence_penalty", "frequency_penalty", "stop", "stream", "tool_choice", "response_format", "seed", "n")
USAGE_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens")
MAX_USAGE = 1_000_000_000
FORBIDDEN_KEYS = {"sample_id", "request_id", "file_path_hash", "tenant_hash", "user_hash", "session_hash", "task_fingerprint_internal", "content_hash", "index_order", "source_id", "sampleId"}
FORBIDDEN_PARTS = ("hash", "fingerprint", "requestid", "sampleid")
MAX_PROMPT, MAX_RESPONSE = 200_000, 100_000


def _python(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace("(?iU)", "(?i)").replace("(?U)", ""))


REDACTIONS = [(name.upper(), name, _python(p)) for name, p in REDACTION_PATTERNS]
#: What a match of a kind can't do without, where that is cheaper to look for.
NEEDS = {"email": re.compile("@"), "phone": re.compile(r"1\d{10}"), "cn_id": re.compile(r"[1-9]\d{16}"), "bank_card": re.compile(r"\d[ -]?\d[ -]?\d[ -]?\d"), "ip": re.compile(r"\d\.\d")}
DIGIT = re.compile(r"\d")
LEAKS = [(name, _python(p)) for name, p in LEAKAGE_PATTERNS]
CODE = _python(CODE_TOKENS)
TIME = re.compile(r"(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,6}))?(?:Z|([+-])(\d{2}):?(\d{2}))?")


def _finite(text: str) -> float:
    if not math.isfinite(value := float(text)):
        raise ValueError(text)
    return value


def _no_constant(name: str) -> None:
    raise ValueError(name)


def parse(text: str):
    """Strict JSON: no NaN, no infinity, not even by overflow."""
    return json.loads(text, parse_float=_finite, parse_constant=_no_constant)


# ---- redaction


def redact_text(text: str, hits: dict[str, int]) -> str:
    """Each distinct match of a kind as a numbered placeholder; counts of distinct matches are added to ``hits``."""
    for label, name, pattern in REDACTIONS:
        if name in NEEDS and (name != "email" and not DIGIT.search(text) or not NEEDS[name].search(text)):
            continue
        seen: dict[str, str] = {}
        text = pattern.sub(lambda m, seen=seen, label=label: seen.setdefault(m[0], f"<{label}_{len(seen) + 1}>"), text)
        if seen:
            hits[name] = hits.get(name, 0) + len(seen)
    return text


def redact_tree(value, hits: dict[str, int]):
    """All strings of a JSON value redacted, keys too; keys that become alike get a number."""
    if isinstance(value, str):
        return redact_text(value, hits)
    if isinstance(value, list):
        return [redact_tree(x, hits) for x in value]
    if not isinstance(value, dict):
        return value
    out: dict = {}
    for key, item in value.items():
        base = name = redact_text(key, hits)
        n = 1
        while name in out:
            n += 1
            name = f"{base}__{n}"
        out[name] = redact_tree(item, hits)
    return out


# ---- shapes


def is_content(value) -> bool:
    parts = value if isinstance(value, list) else [value]
    return all(isinstance(p, str) or isinstance(value, list) and isinstance(p, dict) and isinstance(p.get("text", ""), str) for p in parts)


def is_message(value) -> bool:
    return isinstance(value, dict) and isinstance(value.get("role"), str) and is_content(value.get("content"))


def is_function(value, call: bool) -> bool:
    if not isinstance(value, dict) or not isinstance(value.get("name"), str) or not value["name"]:
        return False
    kinds = {"arguments": str, "description": str, "parameters": dict}
    return ("arguments" in value or not call) and all(isinstance(value[k], kind) for k, kind in kinds.items() if k in value)


def is_tool(value) -> bool:
    return isinstance(value, dict) and value.get("type") == "function" and is_function(value.get("function"), call=False)


def is_call(value) -> bool:
    return isinstance(value, dict) and isinstance(value.get("id"), str) and value["id"] != "" and value.get("type") == "function" and is_function(value.get("function"), call=True)


def is_reply(value) -> bool:
    if not isinstance(value, dict):
        return False
    calls = value.get("tool_calls")
    if calls is not None and not (isinstance(calls, list) and all(map(is_call, calls))):
        return False
    return calls is not None if value.get("content") is None else is_content(value["content"])


def usage_of(value) -> dict[str, int] | None:
    """The three token counts that are there, as integers, or None if any is no count."""
    if not isinstance(value, dict):
        return None
    out = {}
    for key in USAGE_FIELDS:
        if key in value:
            n = value[key]
            if isinstance(n, bool) or not isinstance(n, int | float) or not 0 <= n <= MAX_USAGE or n != int(n):
                return None
            out[key] = int(n)
    return out


def text_of(content, any_type: bool = False) -> str:
    """The stripped text of a message's content; of parts, those of type text (any with text if ``any_type``, and then no bare strings)."""
    if isinstance(content, str):
        return content.strip()
    found = []
    for part in content if isinstance(content, list) else []:
        if isinstance(part, str):
            found.append("" if any_type else part.strip())
        elif isinstance(part, dict) and isinstance(part.get("text"), str) and (any_type or part.get("type") in (None, "text")):
            found.append(part["text"].strip())
    return "\n".join(filter(None, found))


def last_user(messages: list) -> str:
    return next((text_of(m.get("content")) for m in reversed(messages) if m.get("role") == "user"), "")


def tool_names(tools: list, reply: dict) -> list[str]:
    owners = [*tools, *(reply.get("tool_calls") or [])]
    return sorted({o["function"]["name"] for o in owners if isinstance(o, dict) and isinstance(o.get("function"), dict) and isinstance(o["function"].get("name"), str)})


def time_ms(raw: dict) -> int | None:
    """timestamp_ms if a finite number, else the ISO timestamp; no offset: UTC."""
    n = raw.get("timestamp_ms")
    if isinstance(n, int | float) and not isinstance(n, bool) and math.isfinite(n):
        return int(n)
    m = TIME.fullmatch(raw["timestamp"]) if isinstance(raw.get("timestamp"), str) else None
    if not m:
        return None
    try:
        at = datetime(*map(int, m.groups()[:6]), tzinfo=timezone.utc)
    except ValueError:
        return None
    if m[8]:
        shift = timedelta(hours=int(m[9]), minutes=int(m[10]))
        at -= shift if m[8] == "+" else -shift
    return int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 1000 + int(((m[7] or "") + "000")[:3])


# ---- tool traces and export safety


def _call_problem(call, known: set[str]) -> str | None:
    if not is_call(call):
        return "invalid_tool_call"
    if known and call["function"]["name"] not in known:
        return "unknown_tool_name"
    try:
        good = isinstance(json.loads(call["function"]["arguments"] or "{}"), dict)
    except ValueError:
        good = False
    return None if good else "invalid_tool_arguments"


def tool_trace(messages: list, tools: list, reply: dict) -> str | None:
    """What is wrong with a conversation's tool calls, or None.

    Calls of the history are answered by tool messages before anyone else speaks, ids are used once, and the reply has calls.
    """
    if not all(isinstance(t, dict) and t.get("type") == "function" and is_function(t.get("function"), call=False) for t in tools):
        return "invalid_tool_definition"
    known = {t["function"]["name"] for t in tools}
    used: set[str] = set()
    waiting: set[str] = set()

    def take(calls, again: set[str]) -> str | None:
        if not isinstance(calls, list):
            return "invalid_tool_call"
        for call in calls:
            if problem := _call_problem(call, known):
                return problem
            if call["id"] in used:
                return "duplicate_tool_call_id"
            used.add(call["id"])
            again.add(call["id"])
        return None

    for message in messages:
        calls = message.get("tool_calls") if message.get("role") == "assistant" else None
        if message.get("role") == "tool":
            if message.get("tool_call_id") not in waiting:
                return "unmatched_tool_result"
            waiting.discard(message["tool_call_id"])
        elif waiting:
            return "missing_tool_result"
        elif calls and (problem := take(calls, waiting)):
            return problem
    if waiting:
        return "missing_tool_result"
    return take(reply["tool_calls"], set()) if reply.get("tool_calls") else "missing_tool_calls"


def leak(text: str, max_chars: int = 1200) -> str | None:
    if len(text) > max_chars:
        return "too_long"
    if not (bare := text.strip()):
        return "empty"
    for name, pattern in LEAKS:
        if pattern.search(text):
            return name
    if sum(1 for _ in CODE.finditer(text)) >= 12:
        return "code_heavy"
    return "placeholder_only" if bare[0] == "<" and bare[-1] == ">" else None


def unsafe(value) -> str | None:
    """The first forbidden key or leaking string of a JSON value, or None."""
    if isinstance(value, str):
        return leak(value) if value else None
    if isinstance(value, dict):
        for key, item in value.items():
            if key in FORBIDDEN_KEYS or any(p in key.lower() for p in FORBIDDEN_PARTS):
                return f"forbidden key {key}"
            if problem := unsafe(item):
                return problem
    elif isinstance(value, list):
        return next((p for p in map(unsafe, value) if p), None)
    return None


# ---- the record


class Rejected(Exception):
    pass


def _need(good: bool, reason: str) -> None:
    if not good:
        raise Rejected(reason)


def canonical(date: str, line: int, index: dict, raw, hash_id, whole: bool = True) -> dict:
    """The sample of a logged request, or Rejected with the first reason that applies. The record ``canonical`` only if ``whole``."""
    _need(isinstance(raw, dict), "bad_detail_json")
    _need(raw.get("status") == "success", "status_not_success")
    body = raw.get("request_body") or {}
    messages = body.get("messages") if isinstance(body, dict) else None
    _need(isinstance(messages, list) and bool(messages), "missing_messages")
    _need(all(map(is_message, messages)), "invalid_messages")
    tools = body.get("tools")
    tools = [] if tools is None else tools
    _need(isinstance(tools, list) and all(map(is_tool, tools)), "invalid_tools")
    answer = raw.get("response_body") or {}
    choices = answer.get("choices") if isinstance(answer, dict) else None
    _need(isinstance(choices, list) and bool(choices) and isinstance(choices[0], dict), "missing_choices")
    reply = choices[0].get("message")
    _need(is_reply(reply), "invalid_response_message")
    usage = usage_of(answer.get("usage"))
    _need(usage is not None, "invalid_usage")
    _need(bool(text_of(reply.get("content"), any_type=True) or reply.get("tool_calls")), "empty_assistant_response")
    _need(len(stable_json(messages)) <= MAX_PROMPT, "prompt_too_long")
    _need(len(stable_json(reply)) <= MAX_RESPONSE, "response_too_long")

    hits: dict[str, int] = {}
    messages, tools, reply = (redact_tree(x, hits) for x in (messages, tools, reply))
    params = {k: redact_tree(body[k], hits) for k in SAFE_PARAMS if k in body}
    params |= {"client_type": raw.get("client_type") or "", "adapter_type": raw.get("adapter_type") or "", "is_stream": bool(raw.get("is_stream"))}
    request_id = raw.get("request_id") or index["request_id"]
    finish, has_tools = choices[0].get("finish_reason"), bool(tools or reply.get("tool_calls"))
    model = raw.get("model") or body.get("model")
    at = time_ms(raw)
    sample_id = content_hash({"date": date, "request_id": request_id, "messages": messages})
    spoken = [{"role": m["role"], "content": c} for m in messages if (c := text_of(m["content"]))]
    source = {
        "date": date, "request_id": request_id, "file_path_hash": hash_id(index["file_path"]), "tenant_hash": hash_id(raw.get("tenant_id")), "user_hash": hash_id(raw.get("user_id")),
        "session_hash": hash_id(raw.get("session_id")), "event_time": raw["timestamp"] if isinstance(raw.get("timestamp"), str) else None, "event_time_ms": at,
        "index_order": [date, line, line], "index_order_only": at is None,
    }
    kinds = ["router"] + (["tool_use_sft"] if has_tools else ["sft"] if finish != "length" else [])
    full = None
    if whole:
        full = {
            "schema_version": "audit_canonical.v2",
            "sample_id": sample_id,
            "source": source,
            "request": {"model": model, "request_path": raw.get("request_path"), "messages": messages, "tools": tools, "tool_choice": params.get("tool_choice"), "params": params},
            "response": {"message": reply, "finish_reason": finish, "usage": usage},
            "routing": {"weak_model_label": model, "weak_expert_label": choices[0].get("routed_experts"), "label_confidence": "weak"},
            "quality": {"status": "accepted", "task_types": kinds, "pii_redacted": bool(hits), "redaction_stats": hits, "content_hash": content_hash({"messages": messages, "response": reply})},
        }
    problem = tool_trace(messages, tools, reply) if has_tools else None
    return {
        "sample_id": sample_id, "date": date, "tenant_hash": source["tenant_hash"], "user_hash": source["user_hash"], "session_hash": source["session_hash"], "event_time_ms": at, "line_no": line,
        "model": model if isinstance(model, str) else None, "client_type": params["client_type"] if isinstance(params["client_type"], str) else None, "user_text": last_user(messages), "response_text": text_of(reply.get("content")),
        "message_count": len(messages), "messages_chars": len(stable_json(messages)), "has_tools": has_tools, "tool_names": tool_names(tools, reply),
        "prompt_tokens": usage.get("prompt_tokens", 0), "completion_tokens": usage.get("completion_tokens", 0), "finish_reason": finish if isinstance(finish, str) else None,
        "redaction_hits": sum(hits.values()), "has_user_text": any(m["role"] == "user" for m in spoken), "tool_trace": problem,
        "history_unsafe": unsafe(spoken) is not None, "tool_unsafe": has_tools and unsafe([messages, tools, reply]) is not None,
        "messages_json": stable_json(messages), "spoken_json": stable_json(spoken), "tools_json": stable_json(tools), "response_json": stable_json(reply), "canonical": stable_json(full) if whole else None,
    }
