"""The pipeline stage by stage, each against a plain version on its own input."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanspark.llm import exact_dedup, langid, mixing, packing, simhash
from gleanspark.llm.common import scratch
from gleanspark.llm.queries import default_tokenizer
from tests.llm.test_dedup import brute_components, fingerprint, lower
from tests.llm.test_mixing_packing import check_packed, size

SF = "/root/testdata/sf0.001"


def plain_language(docs, rows):
    model = langid.train(docs.where(langid.fold(F.col("doc_id"), 5) != 0))
    keep = []
    for r in rows:
        raw = np.frombuffer((r["text"] or "").encode(), dtype=np.uint8)
        total, n = np.zeros((1, len(model.labels) + 1)), 0
        for _, buckets in langid.subwords(raw):
            total += model.table[buckets].sum(axis=0, dtype=np.float64)
            n += len(buckets)
        best = model.scores(total, np.array([n]))[1][0]
        if any(c.isalpha() for c in r["text"] or "") and best >= model.reject_below:
            keep.append(r)
    return keep


def plain_exact(rows):
    best: dict = {}
    for r in rows:
        key = lower(r["text"])
        if key not in best or r["doc_id"] > best[key]["doc_id"]:
            best[key] = r
    return list(best.values())


def plain_near(rows):
    root = brute_components({r["doc_id"]: fingerprint(r["text"]) for r in rows}, 4)
    return [r for r in rows if root[r["doc_id"]] == r["doc_id"]]


def check_mix(before, after):
    """Each source's words: the most that whole documents allow within its target."""
    totals, taken, source = defaultdict(int), defaultdict(int), {}
    for r in before:
        totals[r["source"]] += size(r["text"])
        source[r["doc_id"]] = r
    assert set(after) <= set(before)
    copies = Counter(after)
    assert max(copies.values()) <= 3
    for r, n in copies.items():
        taken[r["source"]] += n * size(r["text"])
    names = sorted(totals)
    for name, target in zip(names, mixing.targets([totals[s] for s in names], (5, 2, 1), 1.0, 3), strict=True):
        passes, reach = int(target) // totals[name], {0}
        for r in before:
            if r["source"] == name:
                reach |= {x + size(r["text"]) for x in reach if x + size(r["text"]) <= totals[name]}
        assert taken[name] == passes * totals[name] + max(x for x in reach if x <= int(target) - passes * totals[name])


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing", "packing"]
    plain = [lambda d, rows: plain_language(d, rows), lambda _, rows: plain_exact(rows), lambda _, rows: plain_near(rows)]
    for (_, stage), check in zip(corpus_pipeline.STAGES, plain, strict=False):
        after = scratch(stage(spark, docs, SF))
        assert after.columns == columns
        assert Counter(after.collect()) == Counter(check(docs, docs.collect()))
        docs = after
    mixed = scratch(corpus_pipeline.STAGES[3][1](spark, docs, SF))
    assert mixed.columns == columns
    check_mix(docs.collect(), mixed.collect())
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, SF).collect()
    encode, expected = packing.byte_bpe(*default_tokenizer()), Counter()
    for r in mixed.collect():
        ids = np.append(encode(r["text"] or ""), 2).astype("<u4")
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            expected[r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    check_packed(packed, expected, 1024)
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF).collect()) == Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_odd_documents_pass_every_stage(spark, odd_docs):
    docs = odd_docs.select(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = scratch(stage(spark, docs, SF))
        assert docs.count() > 0


def test_no_documents_pass_every_stage(spark, no_docs):
    docs = no_docs.select(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, SF))
        assert docs.count() == 0


@pytest.fixture(scope="module")
def hot(spark):
    """Groups that hold a third of all rows and more: their rows take the broadcast way."""
    copies = spark.range(2500).select("id", F.lit("The same text in every row of a large group").alias("text"))
    others = spark.range(2500, 4000).select("id", F.concat_ws(" ", F.lit("text"), F.col("id"), F.col("id") * 7, F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    return copies.unionByName(others).withColumnRenamed("id", "doc_id").withColumns({"source": F.lit("s"), "lang": F.lit("en"), "n_chars": F.lit(1)})


def test_hot_groups(hot):
    exact = {r["doc_id"]: r for r in exact_dedup.annotate(hot).collect()}
    assert len(exact) == 4000 and all(exact[i]["keep_id"] == 2499 and exact[i]["group_size"] == 2500 and exact[i]["kept"] == (i == 2499) for i in range(2500))
    assert all(exact[i]["kept"] and exact[i]["group_size"] == 1 for i in range(2500, 4000))
    near = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(hot).collect()}
    assert len(near) == 4000 and all(near[i] == 0 for i in range(2500))
    mixed = mixing.mix_report(hot)
    assert mixed.count() == 4000 and mixed.agg(F.sum("taken")).first()[0] == mixed.agg(F.first("target")).first()[0]


def test_pieces_can_carry_their_ids(spark, docs):
    rows = packing.pack(docs.limit(20), tokenizer=default_tokenizer(), capacity=256, with_ids=True).collect()
    assert rows and all(len(r["ids"]) == r["length"] <= 256 and zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in rows)
