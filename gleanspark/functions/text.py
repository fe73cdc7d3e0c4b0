"""Text functions as Column expressions, and the few that need Python as vectorised UDFs.

Patterns carry ``(?U)``: word, digit and space classes, and word boundaries, follow Unicode.
"""

from __future__ import annotations

import hashlib
import hmac as _hmac
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---- Fixed values: patterns, word lists and thresholds that define results.

REDACTION_PATTERNS = (
    ("email", r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("secret", r"(?iU)\b(?:bearer\s+)?(?:sk-|ak-|api[_-]?key[:=]?|secret[:=]?)[A-Za-z0-9_\-]{16,}\b"),
    ("phone", r"(?U)(?<!\d)(?:\+?86[- ]?)?1[3-9]\d{9}(?!\d)"),
    ("cn_id", r"(?U)(?<!\d)[1-9]\d{5}(?:18|19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx](?!\d)"),
    ("bank_card", r"(?U)(?<!\d)\d(?:[ -]?\d){15,18}(?!\d)"),
    ("ip", r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b"),
)
LEAKAGE_PATTERNS = (
    ("secret", r"(?iU)\b(?:bearer\s+)?(?:sk-|ak-|api[_-]?key[:=]?|secret[:=]?|token[:=]?)[A-Za-z0-9_\-]{12,}\b"),
    ("url", r"(?iU)\bhttps?://\S+"),
    ("email", REDACTION_PATTERNS[0][1]),
    ("phone", REDACTION_PATTERNS[2][1]),
    ("cn_id", REDACTION_PATTERNS[3][1]),
    ("bank_card", REDACTION_PATTERNS[4][1]),
    ("ip", REDACTION_PATTERNS[5][1]),
    ("uuid", r"(?U)\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
    ("file_path", r"(?U)(?:(?:^|\s)(?:/|\.\.?/|~[/\\]|[A-Za-z]:[\\/])[^\s]+|[\w.\-]+(?:/|\\)[\w.\-/\\]+)"),
    ("long_literal", r"(?U)\b[A-Za-z0-9+/=_-]{32,}\b"),
    ("code_block", r"(?U)```|\bTraceback \(most recent call last\)|\bException:\s|\bError:\s"),
    ("redaction_placeholder", r"(?U)<[A-Z_]+_\d+>"),
)
CODE_TOKENS = r"(?U)[{};=]|\b(def|class|import|SELECT|function|const|var)\b"
GREETINGS = ("hi", "hello", "hey", "你好", "您好", "嗨", "哈喽")
CONTINUATIONS = ("继续", "上面", "上一", "刚才", "前面", "接着", "继续上面的", "that", "previous")
CONTROL_TEXTS = (
    "continue", "retry", "again", "test", "ok", "yes", "no", "a", "b", "<num>", "1", "2",
    "继续", "重试", "再来", "测试", "不对", "好的", "可以", "嗯", "是", "否",
)
URL = r"(?iU)\bhttps?://\S+"
#: A path below a segment ends in its last part with a dot before its end. Written as units, each of parts without such a dot and one with it, so that
#: every repetition is possessive: Java recurses for each turn of one that may be given back.
SEGMENT, PLAIN = r"(?:[A-Za-z0-9_.-]++|<[A-Za-z_]+_\d+>)", r"(?:(?:[A-Za-z0-9_-]++\.?+|\.)(?![A-Za-z0-9_.-])|<[A-Za-z_]+_\d+>)"
PATH = (
    r"(?U)(?:(?:^|\s)(?:/|\.\.?/|~[/\\]|[A-Za-z]:[\\/])\S+|"
    r"(?:^|\s)" + SEGMENT + r"(?:(?:[/\\]" + PLAIN + r")*+[/\\][A-Za-z0-9_.-]*\.[A-Za-z0-9_.-]+)++)"
)
PLACEHOLDER = r"(?iU)<[A-Z_]+_\d+>"
NUMBER = r"(?U)(?=\d)(?<!\w)\d+(?:\.\d+)?(?!\w)"
PUNCTUATION = r"[，。！？；：、,.!?;:()/\\\[\]{}\"'`]+"
#: Characters that count as white space although Java's class leaves them out.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.translate(c, SEPARATORS, "    "), r"(?U)^\s++|(?<!\s)\s++$", "")  # a run inside is looked at once


def normalize(c: Column) -> Column:
    """Stripped, lower-cased, runs of white space as one space; null as empty."""
    spaced = F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), SEPARATORS, "    "), r"(?U)\s+", " ")
    return F.lower(F.trim(spaced))


def normalize_for_dedupe(c: Column, max_chars: int = 1200) -> Column:
    """Normalised text with URLs, paths, placeholders and numbers as marks, without punctuation, and with
    adjacent repeats of control words collapsed."""
    text = normalize(c)
    one = F.array(text)  # names the text once, as below
    for pattern, mark, needs in ((URL, " <url> ", ("://",)), (PATH, " <path> ", ("/", "\\")), (PLACEHOLDER, " <redacted> ", ("<",))):
        one = F.transform(one, lambda x: F.when(reduce(Column.__or__, [x.contains(n) for n in needs]), F.regexp_replace(x, pattern, mark)).otherwise(x))  # noqa: B023
    text = F.get(one, F.lit(0))
    for pattern, mark in ((NUMBER, " <num> "), (PUNCTUATION, " ")):
        text = F.regexp_replace(text, pattern, mark)
    text = F.trim(F.regexp_replace(text, " {2,}", " "))  # normalize left no other white space
    controls = F.array(*[F.lit(w) for w in CONTROL_TEXTS])
    # the one-element array names the words once, so they are not split anew for each of them
    kept = F.transform(F.array(F.split(text, " ")), lambda w: F.filter(w, lambda t, i: ~((i > 0) & (F.get(w, i - 1) == t) & F.array_contains(controls, t))))
    return F.substring(F.array_join(F.get(kept, F.lit(0)), " "), 1, max_chars)


def dedupe_tokens(normalized: Column) -> Column:
    """Words and character 3-grams of a normalised text, repeats included."""
    words = F.when(normalized == "", F.array().cast("array<string>")).otherwise(F.split(normalized, " "))
    grams = F.regexp_extract_all(F.replace(normalized, F.lit(" "), F.lit("")), F.lit("(?s)(?=(...))"), F.lit(1))
    return F.concat(words, grams)


def weights(tokens, cache: dict) -> int:
    """The SimHash of tokens as a signed long; ``cache`` keeps their hashes."""
    if not len(tokens):
        return 0
    for t in tokens:
        if t not in cache:
            cache[t] = hashlib.sha256(t.encode()).digest()[7::-1]  # the first 8 bytes, least significant first
    bits = np.unpackbits(np.frombuffer(b"".join(cache[t] for t in tokens), dtype=np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = 2 * bits.sum(axis=0, dtype=np.int64) >= len(tokens)
    return int.from_bytes(np.packbits(on, bitorder="little").tobytes(), "little", signed=True)


def hamming64(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are alike."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def hash_identifier(c: Column) -> Column:
    """16 hex digits of SHA-256; null and empty give an empty string."""
    text = c.cast("string")
    return F.when(text.isNull() | (text == ""), "").otherwise(F.substring(F.sha2(text, 256), 1, 16))


def hmac_digest(key: str, length: int):
    """A vectorised HMAC-SHA256 prefix; empty without a key."""

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        if not key:
            return pd.Series([""] * len(values))
        return values.map(lambda v: _hmac.new(key.encode(), str(v).encode(), hashlib.sha256).hexdigest()[:length])

    return run


def redact(df: DataFrame, column: str, out: str = "redacted", stats: str = "redaction_stats") -> DataFrame:
    """``df`` with ``out``, where each distinct match of a kind has a numbered placeholder, and ``stats``, a map of
    distinct matches by kind. Kinds go in order, each over what the ones before left."""
    now, counts = df.withColumn(out, F.coalesce(F.col(column), F.lit(""))), []
    for k, (name, pattern) in enumerate(REDACTION_PATTERNS):
        m, d, g = f"__m{k}", f"__d{k}", f"__g{k}"  # matches, distinct matches, what lies between
        now = now.withColumn(m, F.regexp_extract_all(out, F.lit(pattern), F.lit(0)))
        now = now.withColumns({d: F.array_distinct(m), g: F.when(F.size(m) > 0, F.split(out, pattern, -1))})
        now = now.withColumn(out, F.when(F.size(m) > 0, F.concat(F.get(g, F.lit(0)), F.array_join(_placed(name, m, d, g), ""))).otherwise(F.col(out)))
        counts.append(F.when(F.size(d) > 0, F.struct(F.lit(name).alias("key"), F.size(d).alias("value"))))
    now = now.withColumn(stats, F.map_from_entries(F.array_compact(F.array(*counts))))
    return now.drop(*[f"__{x}{k}" for k in range(len(REDACTION_PATTERNS)) for x in "mdg"])


def _placed(name: str, m: str, d: str, g: str) -> Column:
    """Each match's placeholder with the text that follows it."""
    number = lambda x: F.array_position(F.col(d), x).cast("string")
    return F.transform(m, lambda x, i: F.concat(F.lit(f"<{name.upper()}_"), number(x), F.lit(">"), F.get(g, i + 1)))


def redaction_hits(stats: Column) -> Column:
    return F.aggregate(F.map_values(stats), F.lit(0), lambda a, b: a + b)


def leakage(c: Column, max_chars: int = 1200) -> Column:
    """Why a text may not be exported, or null: the first failing check."""
    reason = F.when(c.isNull(), F.lit(None).cast("string")).when(F.length(c) > max_chars, "too_long").when(strip(c) == "", "empty")
    for name, pattern in LEAKAGE_PATTERNS:
        reason = reason.when(c.rlike(pattern), name)
    reason = reason.when(F.regexp_count(c, F.lit(CODE_TOKENS)) >= 12, "code_heavy")
    return reason.when(strip(c).startswith("<") & strip(c).endswith(">"), "placeholder_only")


def is_control(normalized: Column) -> Column:
    """Whether a text, normalised for dedupe, is a control word or a continuation. A bare number is one."""
    return normalized.isin(*[w for w in CONTROL_TEXTS if w not in ("1", "2")], *CONTINUATIONS)


def model_bucket(c: Column) -> Column:
    low = F.lower(c)
    return F.when(c.isNull() | (c == ""), "unknown").when(low.contains("deepseek"), "deepseek").when(low.contains("glm"), "glm").when(low.contains("gpt") | low.contains("openai"), "openai").when(low.contains("qwen"), "qwen").otherwise("other")


def client_bucket(c: Column) -> Column:
    low = F.lower(c)
    return F.when(c.isNull() | (c == ""), "unknown").when(low.isin("opencode", "web", "api", "sdk", "cli"), low).otherwise("other")


def token_bucket(c: Column) -> Column:
    return F.when(c.isNull(), "unknown").when(c < 512, "lt_512").when(c < 4096, "512_4k").when(c < 16000, "4k_16k").when(c < 64000, "16k_64k").otherwise("gte_64k")


def score_bucket(c: Column) -> Column:
    return F.when(c.isNull(), "unknown").when(c < 0.4, "low").when(c < 0.7, "medium").when(c < 0.9, "high").otherwise("excellent")


def timestamp_ms(c: Column) -> Column:
    """Epoch milliseconds of an ISO date and time; without offset: UTC; anything else or no such date: null."""
    pattern = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:\.(\d{1,6}))?(Z|[+-]\d{2}:?\d{2})?$"
    part = lambda k: F.regexp_extract(c, pattern, k)
    seconds = F.unix_timestamp(F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2)), F.lit("yyyy-MM-dd HH:mm:ss")))
    zone = F.regexp_replace(part(4), "[Z:]", "")
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    offset = F.when(zone == "", 0).otherwise(sign * (F.substring(zone, 2, 2).try_cast("int") * 3600 + F.substring(zone, 4, 2).try_cast("int") * 60))
    millis = F.when(part(3) == "", 0).otherwise(F.rpad(F.substring(part(3), 1, 3), 3, "0").try_cast("int"))
    return F.when(c.rlike(pattern), (seconds - offset) * 1000 + millis)


def k_suppressed(counts: DataFrame, key: str, n: str, k: int) -> DataFrame:
    """Counts by key with those below ``k`` folded into one row."""
    shown = F.when(F.col(n) >= k, F.col(key)).otherwise("suppressed_small_count")
    return counts.groupBy(shown.alias(key)).agg(F.sum(n).alias(n))
