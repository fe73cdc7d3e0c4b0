"""The synthesis command: settings, request, state, resuming; and the near-duplicate fold against a plain version."""

import json

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import text as t
from gleanspark.operators import selection
from gleanspark.operators.scoring import Config
from gleanspark.plans import catalog, synthesis
from gleanspark.sources import audit, tables


def test_settings(tmp_path):
    env = tmp_path / ".env"
    env.write_text("# note\nexport DEEPSEEK_API_KEY='k'\nDEEPSEEK_BASE_URL = http://x/ \n=odd\nnothing\n")
    found = synthesis.settings(str(env), {"DEEPSEEK_API_KEY": "other", "DEEPSEEK_TIMEOUT": "7"})
    assert found == {"api_key": "k", "base_url": "http://x", "model": "deepseek-v4-flash", "timeout": 7, "retries": 10}
    with pytest.raises(SystemExit):
        synthesis.settings(str(tmp_path / "none"), {})
    with pytest.raises(SystemExit):
        synthesis.settings(str(env), {"DEEPSEEK_MAX_RETRIES": "0"})
    with pytest.raises(SystemExit):
        synthesis.main(["--target-count", "0"])


def test_request():
    body = synthesis.request_body("m", 3, 5)
    assert body["response_format"] == {"type": "json_object"} and body["model"] == "m"
    asked = body["messages"][1]["content"]
    assert "json" in asked and "5 invented" in asked and "batch 3" in asked and all(label in asked for label in synthesis.ROUTES)
    assert all(synthesis.synthetic.normalise(shape) for shape in synthesis.SHAPES.values())


def test_run_resumes(spark, tmp_path):
    def generate(batch):
        return json.dumps({"samples": [{"task_type": "router", "topic": "t", "input": f"question {n}", "label": "reasoning"} for n in (0, batch + 1)]})

    root = str(tmp_path / "out")
    first = synthesis.run(spark, generate, root, 3, 2, "m", per_round=2)
    assert (first["completed"], first["written"]) == (3, 3)  # one of the four samples repeats
    second = synthesis.run(spark, generate, root, 5, 2, "m", per_round=2)
    assert (second["completed"], second["written"]) == (5, 2)
    assert synthesis.run(spark, generate, root, 5, 2, "m", per_round=2)["written"] == 0
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{root}/samples.jsonl").collect()]
    assert len({x["sample_id"] for x in lines}) == 5 and all(x["source"]["generator_model"] == "m" for x in lines)
    state = json.loads((tmp_path / "out" / "state.json").read_text())
    assert (state["completed"], state["target_count"], state["next_batch_index"]) == (5, 5, 4)


def plain_near(rows, least=0.88, bits=4, most=128):
    """near or saturated by id, over (bucket, id, text) rows in rank order: every text against every representative."""
    import hashlib

    def features(text):
        compact = text.replace(" ", "")
        tokens = text.split() + [compact[i : i + 3] for i in range(len(compact) - 2)]
        votes = [0] * 64
        for token in tokens:
            h = int.from_bytes(hashlib.sha256(token.encode()).digest()[:8], "big")
            votes = [v + (1 if h >> b & 1 else -1) for b, v in enumerate(votes)]
        return tokens, sum(1 << b for b, v in enumerate(votes) if v >= 0), compact, {compact[i : i + 2] for i in range(len(compact) - 1)}

    def alike(one, other):
        if (one[1] ^ other[1]).bit_count() <= bits or len(set(one[0]) & set(other[0])) / len(set(one[0]) | set(other[0])) >= least:
            return True
        short, long = sorted((one, other), key=lambda x: len(x[2]))
        return len(short[2]) / len(long[2]) <= least and len(short[3] & long[3]) / len(short[3]) >= least

    kept, out = {}, {}
    for bucket, id_, text in rows:
        new, seen = features(text), kept.setdefault(bucket, [])
        if len(text) < 16 or len(new[0]) < 4:
            continue
        for other_text, other in seen:
            if other_text == text or alike(new, other):
                if other_text != text:
                    out[id_] = "near"
                break
        else:
            if len(seen) < most:
                seen.append((text, new))
            else:
                out[id_] = "saturated"
    return out


@pytest.mark.parametrize("most", [128, 3])
def test_near_duplicates_against_plain_version(spark, most):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", F.substring("text", 1, 300).alias("text"))
    changed = docs.select((F.col("doc_id") + 100_000).alias("doc_id"), "lang", F.concat("text", F.when(F.col("doc_id") % 2 == 0, F.lit(" more")).otherwise(F.lit(" other words that were not there before, quite a few of them"))).alias("text"))
    short = docs.select((F.col("doc_id") + 200_000).alias("doc_id"), "lang", F.substring("text", 1, 12).alias("text"))
    none = F.array().cast("array<string>")
    rows = docs.union(changed).union(short).select(
        F.col("doc_id").cast("string").alias("sample_id"), F.lit("d").alias("date"), F.col("doc_id").alias("line_no"), F.lit(None).cast("long").alias("event_time_ms"), F.lit(0.6).alias("final_score"), none.alias("value_labels"),
        F.coalesce("lang", F.lit("none")).alias("dedupe_bucket"), t.normalize_for_dedupe(F.col("text")).alias("dedupe_text"), F.array(F.lit("sft")).alias("use_for"),
        none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"),
    )
    marked = selection.mark_near_duplicates(rows, Config(max_representatives=most)).collect()
    found = {r["line_no"]: "near" if "near_duplicate_content" in r["reject_reasons"] else "saturated" for r in marked if r["reject_reasons"] or r["risk_labels"]}
    ordered = sorted(((r["dedupe_bucket"], r["line_no"], r["dedupe_text"]) for r in rows.collect()), key=lambda r: r[1])
    want = plain_near(ordered, most=most)
    assert found == want and len(set(want.values())) == (1 if most == 128 else 2)


def test_text_features_of_odd_texts():
    cache: dict = {}
    for text in ("", " ", "a", "ab", "\x00\x01", "日本 語", "𝄞𝄞 𝄞", "x" * 5000):
        bits, n, tokens, token_marks, pairs, pair_marks = selection.text_features(text, cache)
        compact = text.replace(" ", "")
        assert n == len(compact) and pairs == len({compact[i : i + 2] for i in range(n - 1)})
        assert tokens == len({*text.split(), *(compact[i : i + 3] for i in range(n - 2))})
        assert -(1 << 63) <= bits < 1 << 63
        for size, marks in ((tokens, token_marks), (pairs, pair_marks)):
            assert len(marks) == selection.MARKS // 8 and (size > 0) == any(marks) and int.from_bytes(marks, "big").bit_count() <= size


def test_spread_deals_tables_of_few_row_groups(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    dealt = tables.spread(docs)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(dealt.collect()) == sorted(docs.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        assert tables.spread(docs) is docs
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    dealt.write.option("parquet.block.size", 1024).parquet(str(tmp_path / "a b"))
    many = spark.read.parquet(str(tmp_path / "a b"))
    assert tables.spread(many) is many
    none = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    assert tables.spread(none).count() == 0


@pytest.mark.parametrize("most", [128, 3])
def test_search_for_representatives_agrees_with_fold(spark, monkeypatch, most):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    more = docs.select((F.col("doc_id") + 100_000).alias("doc_id"), "lang", F.concat(F.substring("text", 1, 300), F.when(F.col("doc_id") % 2 == 0, F.lit(" more")).otherwise(F.lit(" and quite a few other words that were not there before"))).alias("text"))
    none, k = F.array().cast("array<string>"), F.col("doc_id")
    rows = docs.select("doc_id", "lang", F.substring("text", 1, 300).alias("text")).union(more).union(docs.select(k + 200_000, "lang", F.substring("text", 1, 300))).repartition(5).select(
        k.cast("string").alias("sample_id"), F.lit("d").alias("date"), k.alias("line_no"), F.when(k % 3 > 0, k * 7 % 11).alias("event_time_ms"), (k % 4 * 0.1 + 0.6).alias("final_score"),
        F.when(k % 5 == 0, F.array(F.lit("code_task"))).otherwise(none).alias("value_labels"), F.coalesce("lang", F.lit("none")).alias("dedupe_bucket"), t.normalize_for_dedupe(F.col("text")).alias("dedupe_text"),
        F.array(F.lit("sft")).alias("use_for"), none.alias("reject_reasons"), none.alias("risk_labels"), none.alias("suppressed_use_for"), none.alias("matched_reasons"),
    ).cache()

    def marked() -> list:
        return sorted((r["line_no"], r["reject_reasons"], r["risk_labels"]) for r in selection.mark_near_duplicates(rows, Config(max_representatives=most)).collect())

    folded = marked()
    monkeypatch.setattr(selection, "FOLD_ROWS", 0)
    monkeypatch.setattr(selection, "FIRST_ROWS", 2)  # several searches
    monkeypatch.setattr(selection, "BUCKETS", 3)
    assert marked() == folded and any(r[2] for r in folded)


def test_selected_tool_use_parses_each_record_once(spark, monkeypatch):
    seen, canonicalise = spark.sparkContext.accumulator(0), audit.canonicalise

    def counted(raw, *args, **kwargs):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return canonicalise(raw.mapInArrow(run, raw.schema), *args, **kwargs)

    monkeypatch.setattr(audit, "canonicalise", counted)
    assert catalog.exp_sel_tool(spark, "/root/testdata/sf0.001").collect()
    assert seen.value == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
