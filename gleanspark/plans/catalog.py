"""Queries over the tables, one or more for each operator, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.functions import text as t
from gleanspark.operators import exports, labels, reports, samples, scoring, selection, synthetic
from gleanspark.operators.scoring import Config
from gleanspark.sources import audit
from gleanspark.sources.tables import spread, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Documents for expressions that cost more than reading: doc_id, text and the columns ``more``."""
    return spread(_read(spark, sf_dir, "documents").select("doc_id", "text", *more))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.from_conversations(spread(_read(spark, sf_dir, "conversations")))


# ---------------------------------------------------------------- samples in SQL

WORDS = {name: "|".join(words) for name, words in (*scoring.ROUTE_WORDS, *scoring.INTENT_WORDS)}
GREETINGS = ", ".join(f"'{g}'" for g in t.GREETINGS)
#: The sample adapter, classification and score. Redaction is only told, not done: rows with personal data score low either way.
SAMPLES = rf"""
  turns AS (
    SELECT conv_id, turn, role, text AS content,
      last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS last_user,
      count(*) OVER w AS message_count,
      sum(length(role) + length(text) + 23) OVER w + count(*) OVER w + 1 AS messages_chars,
      sum(len(regexp_split_to_array(text, '\s+'))) OVER w AS prompt_tokens,
      max((role = 'user' AND trim(text) <> '')::INT) OVER w AS any_user
    FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  ), slim AS (
    SELECT sha256(conv_id || ':' || turn) AS sample_id, conv_id, turn, message_count, messages_chars, prompt_tokens, any_user,
      regexp_replace(coalesce(last_user, ''), '^\s+|\s+$', '', 'g') AS user_text,
      regexp_replace(content, '^\s+|\s+$', '', 'g') AS response_text,
      ['gpt-4o', 'qwen-max', 'glm-4', 'deepseek-chat', 'mistral'][conv_id % 5 + 1] AS model
    FROM turns WHERE role = 'assistant' AND message_count > 0
  ), classified AS (
    SELECT *, lower(regexp_replace(user_text, '\s+', ' ', 'g')) AS normalized,
      CASE WHEN prompt_tokens >= 64000 OR messages_chars >= 120000 THEN 'long_context'
           WHEN regexp_matches(lower(user_text), 'python|代码|函数|bug|sql|shell|脚本') THEN 'code_generation'
           WHEN regexp_matches(lower(user_text), '{WORDS["reasoning"]}') THEN 'reasoning'
           WHEN regexp_matches(lower(user_text), '{WORDS["domain_qa"]}') THEN 'domain_qa'
           ELSE 'general_chat' END AS route_label
    FROM slim
  ), intents AS (
    SELECT *,
      CASE WHEN normalized IN ({GREETINGS}) OR length(normalized) <= 2 THEN 'greeting_or_probe'
           WHEN regexp_matches(lower(user_text), '{WORDS["debug_code"]}') THEN 'debug_code'
           WHEN regexp_matches(lower(user_text), '{WORDS["write_code"]}') THEN 'write_code'
           WHEN regexp_matches(lower(user_text), '{WORDS["summarize_or_transform"]}') THEN 'summarize_or_transform'
           WHEN regexp_matches(lower(user_text), '{WORDS["analyze_reason"]}') THEN 'analyze_reason'
           WHEN regexp_matches(lower(user_text), '{WORDS["domain_lookup"]}') THEN 'domain_lookup'
           WHEN user_text <> '' THEN 'answer_question' ELSE 'unknown' END AS intent_label
    FROM classified
  ), based AS (
    SELECT *, 0.5::DOUBLE + (CASE WHEN route_label = 'code_generation' OR intent_label IN ('write_code', 'debug_code') THEN 0.25 ELSE 0 END)::DOUBLE
        + (CASE WHEN route_label = 'reasoning' OR intent_label = 'analyze_reason' THEN 0.2 ELSE 0 END)::DOUBLE
        + (CASE WHEN route_label = 'domain_qa' OR intent_label = 'domain_lookup' THEN 0.15 ELSE 0 END)::DOUBLE
        + (CASE WHEN length(response_text) >= 8 THEN 0.1 ELSE 0 END)::DOUBLE AS base
    FROM intents
  ), scored AS (
    SELECT *, least(1.0::DOUBLE, CASE WHEN user_text = '' THEN 0::DOUBLE
        WHEN normalized IN ({GREETINGS}) OR (length(normalized) <= 2 AND route_label = 'general_chat') THEN least(base, 0.2::DOUBLE)
        WHEN length(normalized) < 4 AND route_label = 'general_chat' THEN least(base, 0.3::DOUBLE) ELSE base END) AS deterministic_score
    FROM based
  ), labelled AS (
    SELECT *, CASE WHEN deterministic_score < 0.4 THEN 'low' WHEN deterministic_score < 0.7 THEN 'medium' WHEN deterministic_score < 0.9 THEN 'high' ELSE 'excellent' END AS score_bucket,
      CASE WHEN user_text = '' THEN ['empty_user_text']
           WHEN normalized IN ({GREETINGS}) OR (length(normalized) <= 2 AND route_label = 'general_chat') THEN ['greeting_or_probe']
           WHEN length(normalized) < 4 AND route_label = 'general_chat' THEN ['too_short_low_information'] ELSE [] END AS reject_reasons
    FROM scored
  )
"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.annotate(_samples(spark, sf_dir))


# ---------------------------------------------------------------- classification, scores, reports


@query(f"WITH {SAMPLES} SELECT sample_id, route_label FROM labelled")
def cls_route(spark, sf_dir):
    return scoring.classify(_samples(spark, sf_dir)).select("sample_id", "route_label")


@query(f"WITH {SAMPLES} SELECT sample_id, intent_label FROM labelled")
def cls_intent(spark, sf_dir):
    return scoring.classify(_samples(spark, sf_dir)).select("sample_id", "intent_label")


@query(f"""WITH {SAMPLES} SELECT sample_id, substr(sha256('{{"intent":"' || intent_label || '","route":"' || route_label || '","tools":[],"user":' || to_json(normalized) || '}}'), 1, 24) AS task_fingerprint,
  route_label || ':' || intent_label AS task_bucket FROM labelled""")
def cls_fingerprint(spark, sf_dir):
    return _scored(spark, sf_dir).select("sample_id", "task_fingerprint", "task_bucket")


@query(f"WITH {SAMPLES} SELECT sample_id, deterministic_score, score_bucket, array_to_string(reject_reasons, ',') AS reject_reasons FROM labelled")
def scr_det(spark, sf_dir):
    return scoring.score(scoring.classify(_samples(spark, sf_dir))).select("sample_id", "deterministic_score", "score_bucket", F.array_join("reject_reasons", ",").alias("reject_reasons"))


@query(f"""WITH {SAMPLES}, uses AS (
  SELECT sample_id, CASE WHEN len(reject_reasons) = 0 AND deterministic_score >= 0.6 THEN 'router_classification' || CASE WHEN response_text <> '' AND any_user = 1 THEN ',sft' ELSE '' END ELSE '' END AS use_for FROM labelled
) SELECT * FROM uses""")
def scr_usefor(spark, sf_dir):
    return _scored(spark, sf_dir).select("sample_id", F.array_join("use_for", ",").alias("use_for"))


STATS = """
  counts AS (
    SELECT section, key, count(*) AS n FROM (
      SELECT 'route_counts' AS section, route_label AS key FROM labelled
      UNION ALL SELECT 'intent_counts', intent_label FROM labelled
      UNION ALL SELECT 'score_counts', score_bucket FROM labelled
      UNION ALL SELECT 'route_intent_score_counts', route_label || '|' || intent_label || '|' || score_bucket FROM labelled
      UNION ALL SELECT 'reject_reasons', unnest(reject_reasons) FROM labelled
      UNION ALL SELECT 'risk_labels', 'low_information' FROM labelled WHERE len(reject_reasons) > 0
    ) GROUP BY ALL
  )
"""


@query(f"WITH {SAMPLES}, {STATS} SELECT section, CASE WHEN n >= 5 THEN key ELSE 'suppressed_small_count' END AS key, sum(n)::BIGINT AS n FROM counts GROUP BY 1, 2")
def agg_quality_stats(spark, sf_dir):
    return reports.quality_stats(_scored(spark, sf_dir))


@query(f"WITH {SAMPLES}, {STATS} SELECT CASE WHEN n >= 5 THEN key ELSE 'suppressed_small_count' END AS key, sum(n)::BIGINT AS n FROM counts WHERE section = 'route_intent_score_counts' GROUP BY 1")
def agg_user_task(spark, sf_dir):
    return reports.user_task_stats(_scored(spark, sf_dir))


@query(f"""WITH {SAMPLES} SELECT 'models' AS section, model AS key, count(*) AS n FROM labelled GROUP BY model
  UNION ALL SELECT 'total', 'accepted', count(*) FROM labelled UNION ALL SELECT 'finish_reasons', 'stop', count(*) FROM labelled
  UNION ALL SELECT 'task_types', 'router', count(*) FROM labelled UNION ALL SELECT 'task_types', 'sft', count(*) FROM labelled""")
def agg_stats(spark, sf_dir):
    return reports.stats(_scored(spark, sf_dir))


# ---------------------------------------------------------------- exports


@query(f"WITH {SAMPLES} SELECT sample_id, user_text AS input, response_text AS output FROM labelled WHERE response_text <> '' AND any_user = 1")
def exp_sft(spark, sf_dir):
    return _scored(spark, sf_dir).where(scoring.exportable_sft()).select("sample_id", F.col("user_text").alias("input"), F.col("response_text").alias("output"))


@query()
def exp_sft_json(spark, sf_dir):
    history = samples.histories(_read(spark, sf_dir, "conversations"))
    rows = _scored(spark, sf_dir).join(history, "sample_id").withColumn("spoken_json", F.to_json("messages"))
    return exports.sft(rows)


@query(f"""WITH {SAMPLES} SELECT sample_id, user_text AS input, message_count, CAST(prompt_tokens AS BIGINT) AS prompt_tokens, route_label AS rule_label, route_label AS final_label, 'medium' AS confidence FROM labelled""")
def exp_router(spark, sf_dir):
    rows = exports.router(_scored(spark, sf_dir))
    get = lambda path: F.get_json_object("json", path)
    features = [get("$.features.message_count").cast("long").alias("message_count"), get("$.features.prompt_tokens").cast("long").alias("prompt_tokens")]
    return rows.select("sample_id", get("$.input").alias("input"), *features, get("$.labels.rule_label").alias("rule_label"), get("$.labels.final_label").alias("final_label"), get("$.labels.confidence").alias("confidence"))


def _selected(spark: SparkSession, sf_dir: str, config: Config = Config()) -> DataFrame:
    marked = selection.mark_dedupe(stored(_scored(spark, sf_dir)), config)
    return selection.apply_decisions(marked, selection.select(marked, config), config)


@query()
def exp_sel_router(spark, sf_dir):
    return exports.selected_router(_selected(spark, sf_dir))


@query()
def exp_sel_sft(spark, sf_dir):
    history = samples.histories(_read(spark, sf_dir, "conversations")).select("sample_id", F.to_json("messages").alias("spoken_json"))
    return exports.selected_sft(_selected(spark, sf_dir).join(history, "sample_id"))


@query()
def exp_sel_multi(spark, sf_dir):
    return exports.multi_turn(selection.multi_turn(selection.episodes(_selected(spark, sf_dir))))


@query()
def exp_quality(spark, sf_dir):
    return exports.quality(_selected(spark, sf_dir))


@query()
def agg_dedupe_rejected(spark, sf_dir):
    return reports.dedupe_rejected(_selected(spark, sf_dir))


# ---------------------------------------------------------------- text functions


@query("SELECT doc_id, trim(lower(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS normalized FROM documents")
def fn_normalize(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", t.normalize(F.col("text")).alias("normalized"))


@query()
def fn_norm_dedupe(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", t.normalize_for_dedupe(F.col("text")).alias("normalized"))


@query("""WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(trim(lower(text)), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) AS s FROM documents),
  m AS (SELECT doc_id, s, replace(s, ' ', '') AS c FROM n),
  l AS (SELECT doc_id, list_concat(CASE WHEN s = '' THEN [] ELSE string_split(s, ' ') END, list_transform(range(1, greatest(length(c) - 1, 1)), lambda i: substr(c, i, 3))) AS l FROM m)
  SELECT doc_id, len(l) AS n_tokens, md5(array_to_string(l, ' ')) AS digest FROM l""")
def fn_tokens(spark, sf_dir):
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.lower("text")), "[^a-z ]+", " "), " +", " "))
    rows = _read(spark, sf_dir, "documents").select("doc_id", plain.alias("s")).select("doc_id", t.dedupe_tokens(F.col("s")).alias("l"))
    return rows.select("doc_id", F.size("l").cast("long").alias("n_tokens"), F.md5(F.array_join("l", " ")).alias("digest"))


@query()
def fn_simhash(spark, sf_dir):
    rows = _texts(spark, sf_dir).select("doc_id", t.normalize_for_dedupe(F.col("text")).alias("n"))
    return _simhashes(rows)


def _simhashes(rows: DataFrame) -> DataFrame:
    """By Arrow batches of normalised texts."""
    from gleanspark.functions.text import weights

    def run(frames):
        cache: dict = {}
        for frame in frames:
            out = []
            for n in frame["n"]:
                compact = n.replace(" ", "")
                out.append(weights(n.split() + [compact[i : i + 3] for i in range(len(compact) - 2)], cache))
            if len(cache) > 200_000:
                cache.clear()
            yield frame[["doc_id"]].assign(bits=out)

    return rows.mapInPandas(run, "doc_id long, bits long").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("simhash"))


@query("SELECT doc_id, CASE WHEN source IS NULL OR source = '' THEN '' ELSE substr(sha256(source), 1, 16) END AS source_hash, substr(sha256(doc_id::VARCHAR), 1, 16) AS id_hash FROM documents")
def fn_hash_id(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", t.hash_identifier(F.col("source")).alias("source_hash"), t.hash_identifier(F.col("doc_id")).alias("id_hash"))


@query("""SELECT doc_id, CASE WHEN n_chars IS NULL THEN 'unknown' WHEN n_chars < 512 THEN 'lt_512' WHEN n_chars < 4096 THEN '512_4k' WHEN n_chars < 16000 THEN '4k_16k' WHEN n_chars < 64000 THEN '16k_64k' ELSE 'gte_64k' END AS tokens,
  CASE WHEN n_chars / 10000.0 < 0.4 THEN 'low' WHEN n_chars / 10000.0 < 0.7 THEN 'medium' WHEN n_chars / 10000.0 < 0.9 THEN 'high' ELSE 'excellent' END AS score,
  CASE WHEN lang IN ('opencode', 'web', 'api', 'sdk', 'cli') THEN lang ELSE 'other' END AS client, 'other' AS model FROM documents""")
def fn_buckets(spark, sf_dir):
    n = F.col("n_chars")
    return _read(spark, sf_dir, "documents").select("doc_id", t.token_bucket(n).alias("tokens"), t.score_bucket(n / 10000.0).alias("score"), t.client_bucket(F.col("lang")).alias("client"), t.model_bucket(F.col("source")).alias("model"))


@query("SELECT doc_id, bit_count(xor(doc_id, n_chars))::INT AS distance FROM documents")
def fn_hamming(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", t.hamming64(F.col("doc_id"), F.col("n_chars")).alias("distance"))


@query("""WITH w AS (SELECT doc_id, list_distinct(regexp_split_to_array(lower(text), '\\s+')) AS l FROM documents)
  SELECT a.doc_id, round(len(list_intersect(a.l, b.l))::DOUBLE / (len(a.l) + len(b.l) - len(list_intersect(a.l, b.l))), 9) AS similarity FROM w a JOIN w b ON b.doc_id = a.doc_id + 1""")
def fn_jaccard(spark, sf_dir):
    words = _read(spark, sf_dir, "documents").select("doc_id", F.split(F.lower("text"), r"\s+").alias("l"))
    pairs = words.join(words.select((F.col("doc_id") - 1).alias("doc_id"), F.col("l").alias("r")), "doc_id")
    return pairs.select("doc_id", F.round(t.jaccard(F.col("l"), F.col("r")), 9).alias("similarity"))


@query()
def red_text(spark, sf_dir):
    rows = t.redact(_texts(spark, sf_dir), "text")
    return rows.select("doc_id", "redacted", F.array_join(F.transform(F.map_entries("redaction_stats"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("hits"))


@query("""SELECT doc_id, len(list_distinct(regexp_extract_all(coalesce(text, ''), '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b'))) AS emails FROM documents""")
def red_count(spark, sf_dir):
    rows = t.redact(_texts(spark, sf_dir), "text")
    return rows.select("doc_id", F.coalesce(F.try_element_at("redaction_stats", F.lit("email")), F.lit(0)).cast("long").alias("emails"))


@query()
def leak_scan(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", t.leakage(F.col("text")).alias("reason"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def fn_time_ms(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", t.timestamp_ms(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("ms"))


# ---------------------------------------------------------------- ordered operators over events


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples: the user is user and session, the type is the task."""
    e = _read(spark, sf_dir, "events")
    user = F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 16)
    none = F.array().cast("array<string>")
    return e.select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("sample_id"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("").alias("tenant_hash"), user.alias("user_hash"), user.alias("session_hash"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"), F.col("event_id").alias("line_no"), F.col("event_type").alias("route_label"), F.lit("unknown").alias("intent_label"), F.lit(0.6).alias("final_score"), F.lit("medium").alias("score_bucket"),
        F.col("event_type").alias("task_fingerprint"), F.col("event_type").alias("user_text"), F.col("props").alias("response_text"), F.col("event_type").alias("dedupe_text"), user.alias("session_key"),
        none.alias("use_for"), none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"),
    )


@query("""SELECT event_id, coalesce((lag(epoch_us(ts) // 1000, 8) OVER (PARTITION BY ts::DATE, user_id, event_type ORDER BY (epoch_us(ts) // 1000), event_id, sha256(event_id::VARCHAR))) >= (epoch_us(ts) // 1000) - 14400000, false) AS burst FROM events""")
def win_burst(spark, sf_dir):
    marked = selection.mark_noise(_events(spark, sf_dir), Config(burst_minutes=240))
    return marked.select(F.col("line_no").alias("event_id"), F.array_contains("reject_reasons", "debug_burst").alias("burst"))


@query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, trim(lower(text)) ORDER BY turn) AS n, trim(lower(text)) IN ('ok', 'yes', 'no', 'continue', 'retry', 'again', 'test') AS control FROM conversations WHERE role = 'user')
  SELECT conv_id, turn, control AND n > 2 AS repeated FROM c""")
def win_control(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations").where("role = 'user'")
    none = F.array().cast("array<string>")
    rows = c.select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), F.lit("d").alias("date"), F.col("conv_id").cast("string").alias("session_key"), t.normalize_for_dedupe(F.col("text")).alias("dedupe_text"), F.lit("t").alias("task_fingerprint"),
        F.lit(None).cast("long").alias("event_time_ms"), F.col("turn").alias("line_no"), none.alias("use_for"), none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"), "conv_id", "turn",
    )
    return selection.mark_noise(rows).select("conv_id", "turn", F.array_contains("reject_reasons", "debug_noise_repeat").alias("repeated"))


@query("""WITH g AS (SELECT *, (epoch_us(ts) // 1000) AS ms, ts::DATE AS day, (epoch_us(ts) // 1000) - lag((epoch_us(ts) // 1000)) OVER (PARTITION BY ts::DATE, user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS gap FROM events),
  i AS (SELECT *, sum(CASE WHEN gap <= 1800000 THEN 0 ELSE 1 END) OVER (PARTITION BY day, user_id ORDER BY ms, event_id) AS island FROM g)
  SELECT substr(sha256('{"source_date":"' || strftime(day, '%Y-%m-%d') || '","turns":["' || string_agg(sha256(event_id::VARCHAR), '","' ORDER BY ms, event_id) || '"]}'), 1, 32) AS episode_id,
    strftime(day, '%Y-%m-%d') AS date, count(*) AS turn_count, CASE WHEN min(event_type) = max(event_type) THEN min(event_type) ELSE 'mixed' END AS route_label, count(*) > 1 AS eligible
  FROM i GROUP BY day, user_id, island""")
def win_episode(spark, sf_dir):
    return selection.episodes(_events(spark, sf_dir)).select("episode_id", "date", "turn_count", "route_label", "eligible")


@query()
def win_neardup(spark, sf_dir):
    docs = _texts(spark, sf_dir, "lang", "source")
    none = F.array().cast("array<string>")
    rows = docs.select(
        F.col("doc_id").cast("string").alias("sample_id"), F.lit("d").alias("date"), F.col("doc_id").alias("line_no"), F.lit(None).cast("long").alias("event_time_ms"), F.lit(0.6).alias("final_score"), none.alias("value_labels"),
        F.concat_ws(":", "lang", "source").alias("dedupe_bucket"), t.normalize_for_dedupe(F.col("text")).alias("dedupe_text"), F.array(F.lit("sft")).alias("use_for"),
        none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"),
    )
    return selection.mark_near_duplicates(rows).select(F.col("line_no").alias("doc_id"), F.array_join("reject_reasons", ",").alias("reject_reasons"), F.array_join("risk_labels", ",").alias("risk_labels"))


@query()
def win_select(spark, sf_dir):
    return selection.select(selection.mark_dedupe(stored(_scored(spark, sf_dir)))).select("kind", "sample_id", "decision")


@query()
def win_select_quota(spark, sf_dir):
    config = Config(max_sft_per_user=5, max_router_per_user=8)
    return selection.select(selection.mark_dedupe(stored(_scored(spark, sf_dir)), config), config).select("kind", "sample_id", "decision")


@query("SELECT event_id, user_id, n AS position FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) WHERE n <= 3")
def srt_topk(spark, sf_dir):
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("value").desc(), "event_id"))
    return _read(spark, sf_dir, "events").select("event_id", "user_id", nth.alias("position")).where("position <= 3")


@query("WITH c AS (SELECT user_id::VARCHAR AS key, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) SELECT CASE WHEN n >= 5 THEN key ELSE 'suppressed_small_count' END AS key, sum(n)::BIGINT AS n FROM c GROUP BY 1")
def fn_kthresh(spark, sf_dir):
    counts = _read(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy(F.col("user_id").cast("string").alias("key")).agg(F.count("*").alias("n"))
    return t.k_suppressed(counts, "key", "n", 5)


# ---------------------------------------------------------------- joins, sets, labels, synthetic samples


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def jn_resume(spark, sf_dir):
    return synthetic.unseen(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels"), "doc_id")


@query("""WITH w AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS l FROM documents)
  SELECT doc_id, array_to_string(list_sort(list_intersect(l, ['the', 'der', 'le', 'el'])), ',') AS common, len(l) AS n_words FROM w""")
def set_ops(spark, sf_dir):
    words = F.array_distinct(F.split(F.lower("text"), " "))
    rows = _read(spark, sf_dir, "documents").select("doc_id", words.alias("l"))
    return rows.select("doc_id", F.array_join(F.array_sort(F.array_intersect("l", F.array(*[F.lit(w) for w in ("the", "der", "le", "el")]))), ",").alias("common"), F.size("l").cast("long").alias("n_words"))


def _route_answer(payload: str) -> str:
    """A stand-in for a model: its label follows from the payload."""
    p = json.loads(payload)["sample"]["features"]
    return json.dumps({"label": "reasoning" if p["message_count"] > 2 else "general_chat", "confidence": 0.9 if p["prompt_tokens_bucket"] == "lt_512" else 0.5})


@query(f"WITH {SAMPLES} SELECT sample_id, CASE WHEN message_count > 2 THEN 'reasoning' ELSE 'general_chat' END AS final_label, CASE WHEN prompt_tokens < 512 THEN 'high' ELSE 'low' END AS confidence FROM labelled")
def lab_apply_route(spark, sf_dir):
    rows = labels.label_routes(_scored(spark, sf_dir), _route_answer)
    label, word = scoring.final_route(F.col("model_label"), F.col("model_confidence"))
    return rows.select("sample_id", label.alias("final_label"), word.alias("confidence"))


def _quality_answer(payload: str) -> str:
    p = json.loads(payload)["sample"]["features"]
    return json.dumps({"quality_score": 0.3 if p["message_count"] > 3 else 0.95, "risk_labels": ["duplicate", "made_up"] if p["message_count"] == 1 else []})


@query(f"""WITH {SAMPLES}, asked AS (
    SELECT *, CASE WHEN len(reject_reasons) = 0 AND deterministic_score >= 0.6 THEN CASE WHEN message_count > 3 THEN 0.3 ELSE 0.95 END END::DOUBLE AS answer FROM labelled
  ), judged AS (
    SELECT *, CASE WHEN answer < deterministic_score THEN answer ELSE deterministic_score END AS final_score,
      list_concat(reject_reasons, CASE WHEN answer IS NOT NULL AND message_count = 1 THEN ['model_risk'] ELSE [] END, CASE WHEN answer < deterministic_score AND answer < 0.6 THEN ['model_downranked'] ELSE [] END) AS reasons
    FROM asked
  ) SELECT sample_id, final_score, array_to_string(reasons, ',') AS reject_reasons,
    CASE WHEN len(reasons) = 0 AND deterministic_score >= 0.6 AND final_score >= 0.6 THEN 'router_classification' || CASE WHEN response_text <> '' AND any_user = 1 THEN ',sft' ELSE '' END ELSE '' END AS use_for
  FROM judged""")
def lab_apply_quality(spark, sf_dir):
    rows = labels.label_quality(_scored(spark, sf_dir), _quality_answer)
    return rows.select("sample_id", "final_score", F.array_join("reject_reasons", ",").alias("reject_reasons"), F.array_join("use_for", ",").alias("use_for"))


#: Answers of a model by doc_id modulo 6: good, out of range, wrong name, labels that are no list, repeated labels, a reason that is no text.
ANSWERS = (
    '{"quality_score": 0.5, "value_labels": ["code_task", "x"], "risk_labels": []}', '{"quality_score": 1.5}', '{"score": 0.5}',
    '{"quality_score": 0.25, "value_labels": 3}', '{"quality_score": 1, "risk_labels": ["duplicate", "duplicate"], "reason": "r"}', '{"quality_score": 0.5, "reason": 7}',
)


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 0.5 WHEN 4 THEN 1.0 END::DOUBLE AS score, CASE WHEN doc_id % 6 = 0 THEN 'code_task' ELSE '' END AS value_labels,
  CASE WHEN doc_id % 6 = 4 THEN 'duplicate' ELSE '' END AS risk_labels, CASE WHEN doc_id % 6 NOT IN (0, 4) THEN 'labeler_invalid_response' END AS error FROM documents""")
def lab_parse(spark, sf_dir):
    answer = F.get(F.array(*[F.lit(a) for a in ANSWERS]), (F.col("doc_id") % 6).cast("int"))
    rows, _ = labels.ask(_read(spark, sf_dir, "documents").select("doc_id", answer.alias("payload")), lambda payload: payload, labels.parse_quality, labels.QUALITY_SCHEMA)
    return rows.select("doc_id", F.col("model_score").alias("score"), F.array_join("model_values", ",").alias("value_labels"), F.array_join("model_risks", ",").alias("risk_labels"), F.col("label_error").alias("error"))


@query(rf"""WITH {SAMPLES} SELECT 'requests' AS section, 'classify_route' AS key, count(*) AS n FROM (SELECT DISTINCT message_count, CASE WHEN prompt_tokens < 512 THEN 0 WHEN prompt_tokens < 4096 THEN 1 WHEN prompt_tokens < 16000 THEN 2 WHEN prompt_tokens < 64000 THEN 3 ELSE 4 END AS b,
    CASE WHEN len(regexp_split_to_array(response_text, '\s+')) < 512 THEN 0 WHEN len(regexp_split_to_array(response_text, '\s+')) < 4096 THEN 1 WHEN len(regexp_split_to_array(response_text, '\s+')) < 16000 THEN 2 ELSE 3 END AS c, route_label, intent_label, CASE WHEN model LIKE '%mistral%' THEN 'other' ELSE model END AS m FROM labelled)""")
def lab_stats(spark, sf_dir):
    _, stats = labels.route_answers(_scored(spark, sf_dir), _route_answer)
    return stats.where("section = 'requests'")


@query("""SELECT 'synthetic-' || substr(sha256('{"input":' || to_json(text) || ',"label":"general_chat","task_type":"router","topic":"b"}'), 1, 24) AS sample_id, 'router' AS task_type FROM benchmark""")
def syn_parse(spark, sf_dir):
    sample = F.struct(F.lit("router").alias("task_type"), F.lit("b").alias("topic"), F.col("text").alias("input"), F.lit("general_chat").alias("label"))
    answers = _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("batch_index"), F.to_json(F.struct(F.array(sample).alias("samples"))).alias("answer"))
    return synthetic.parse_answers(answers).select("sample_id", "task_type")


# ---------------------------------------------------------------- logged records made from documents


def _logged(spark: SparkSession, sf_dir: str, tools: bool = False) -> DataFrame:
    """A log record of each document; what is wrong with it depends on its language."""
    docs = spread(_read(spark, sf_dir, "documents"))
    by = lambda de, fr, es, en: F.when(F.col("lang") == "de", de).when(F.col("lang") == "fr", fr).when(F.col("lang") == "es", es).otherwise(en)
    lit, user = F.lit, F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    function = lambda name, arguments: F.struct(lit("c1").alias("id"), lit("function").alias("type"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))
    if tools:
        call = function(by(lit("g"), lit("f"), lit("f"), lit("f")), by(lit("{}"), lit("[1]"), lit("{}"), lit('{"a": 1}')))
        reply = F.struct(lit("assistant").alias("role"), lit("done").alias("content"), F.when(F.col("lang") != "es", F.array(call)).alias("tool_calls"))
        body = F.struct(F.array(user).alias("messages"), F.array(F.struct(lit("function").alias("type"), F.struct(lit("f").alias("name")).alias("function"))).alias("tools"))
        status, tokens = lit("success"), lit(5)
    else:
        reply = F.struct(lit("assistant").alias("role"), by(lit("ok"), lit("  "), lit("ok"), F.col("source")).alias("content"))
        body, status, tokens = F.struct(F.array(user).alias("messages")), by(lit("error"), lit("success"), lit("success"), lit("success")), by(lit(5), lit(5), lit(-1), lit(5))
    record = F.struct(
        status.alias("status"), F.concat(lit("r"), F.col("doc_id")).alias("request_id"), F.col("source").alias("user_id"), lit("gpt-4o").alias("model"), body.alias("request_body"),
        F.struct(F.array(F.struct(reply.alias("message"), lit("stop").alias("finish_reason"))).alias("choices"), F.struct(tokens.alias("prompt_tokens")).alias("usage")).alias("response_body"),
    )
    return docs.select(lit("2026-01-01").alias("date"), F.col("doc_id").alias("line_no"), F.concat(lit("r"), F.col("doc_id")).alias("request_id"), F.concat(F.col("doc_id"), lit(".json")).alias("file_path"), F.to_json(record).alias("raw"))


REASONS = """CASE WHEN lang = 'de' THEN 'status_not_success' WHEN lang = 'es' THEN 'invalid_usage' WHEN lang = 'fr' THEN 'empty_assistant_response' WHEN length(text) > 199000 THEN 'prompt_too_long' END"""


@query(f"SELECT doc_id AS line_no, {REASONS} AS reason FROM documents")
def val_chain(spark, sf_dir):
    return audit.canonicalise(_logged(spark, sf_dir)).select("line_no", "reason")


@query("SELECT doc_id AS line_no, CASE lang WHEN 'de' THEN 'unknown_tool_name' WHEN 'fr' THEN 'invalid_tool_arguments' WHEN 'es' THEN 'missing_tool_calls' END AS tool_trace, 'tool_agent' AS route_label FROM documents")
def val_tooltrace(spark, sf_dir):
    return scoring.classify(audit.canonicalise(_logged(spark, sf_dir, tools=True)).where("reason is null")).select("line_no", "tool_trace", "route_label")


@query()
def red_tree(spark, sf_dir):
    return audit.canonicalise(_logged(spark, sf_dir)).where("reason is null").select("line_no", "sample_id", "redaction_hits", "messages_json")


#: What only exports print.
PRINTED = ("messages_json", "tools_json", "response_json")


@query()
def exp_sel_tool(spark, sf_dir):
    read = audit.canonicalise(_logged(spark, sf_dir, tools=True), without=("canonical", "spoken_json")).where("reason is null")
    rows = selection.with_kind_keys(selection.with_dedupe_columns(scoring.annotate(read)))
    used = F.array_contains("use_for", "tool_use_sft")
    texts = ("reason", "user_text", "response_text", "normalized")
    rows = rows.withColumns({c: F.when(used, F.col(c)) for c in PRINTED}).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.drop(*texts))  # records are parsed once
    marked = selection.mark_near_duplicates(stored(selection.mark_noise(rows.drop(*PRINTED))))
    chosen = selection.apply_decisions(marked, selection.select(marked)).where(F.array_contains("selected", "tool_use_sft"))
    return exports.selected_tool_use(chosen.join(rows.select("row", *PRINTED), "row"))


@query()
def exp_tool(spark, sf_dir):
    return exports.tool_use(scoring.annotate(audit.canonicalise(_logged(spark, sf_dir, tools=True)).where("reason is null").drop("reason")))


@query(f"SELECT coalesce({REASONS}, 'accepted') AS reason, count(*) AS n FROM documents GROUP BY 1")
def cli_run(spark, sf_dir):
    read = audit.canonicalise(_logged(spark, sf_dir))
    return read.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))
