"""Language ID, toxicity, media columns, licenses."""

import hashlib
import re
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from gleanspark.llm import langid, licenses, media, queries, toxicity


def test_language_id(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_of_odd_texts(spark, odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = {r["doc_id"]: r for r in langid.predict(odd_docs, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (0, 1, 2, 9, 14))
    assert got[7]["lang_pred"] in ("en", "de")
    assert langid.predict(no_docs, model).count() == 0
    none = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.predict(odd_docs, none).collect()} == {"und"}


def test_samples_stay_bounded_when_ids_repeat(spark, monkeypatch):
    rows = [(i % 7, f"some words {i % 11} of text {i % 7}", "en") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = []
    monkeypatch.setattr(langid, "_calibrated", lambda model, held, no: pieces.extend(held) or model)
    assert langid.train(docs, max_docs=3).labels == ["en"] and len(pieces) <= 3
    sample = []
    monkeypatch.setattr(toxicity, "distinct_texts", lambda texts: sample.extend(texts) or list(range(len(texts))))
    toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")), max_docs=3)
    least = {k: min(t for i, t, _ in rows if i == k) for k in range(7)}
    assert len(sample) == 3 and set(sample) <= set(least.values())


def test_blocks_do_not_matter(spark, docs, monkeypatch):
    import numpy as np

    model = langid.Model(["a", "b"], np.random.default_rng(0).random((1 << langid.LOG_BUCKETS, 3)), np.zeros(2), 1.0, 0.0)
    raw = np.frombuffer("".join(r["text"] for r in docs.limit(9).collect()).encode(), dtype=np.uint8)
    at = np.array([0, 5, 5, 900, 901, len(raw)])
    whole = langid.sums(model, raw, at)
    monkeypatch.setattr(langid, "BLOCK", 64)
    parts = langid.sums(model, raw, at)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()


def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = queries.op4_toxicity(spark, sf).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit >= 0.85 * sum(r["toxic"] for r in rows) and hit >= 0.95 * sum(r["predicted"] for r in rows)
    assert docs.count() == queries.op4_toxicity(spark, sf).count()


def test_toxicity_of_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, "x"), (7, 0, "x"), (None, 1, "x"), (8, None, "x")], "doc_id long, toxic int, score string")
    model = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model)
    assert got.count() == odd_docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels)).count() == 0
    untaught = toxicity.train(odd_docs, labels.where("false"))
    rows = spark.createDataFrame([(1, "you IDIOT, you moron"), (2, "a fine day")], "doc_id long, text string")
    low, high = sorted(r["score"] for r in toxicity.score(rows, untaught).collect())
    assert low < 0.3 <= high


def test_label_model_discounts_voters_that_repeat_each_other():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    vote = lambda hit, false: np.where(y, rng.random(4000) < hit, rng.random(4000) < false).astype(float)
    own = vote(0.5, 0.05)
    votes = np.stack([own, own, own, vote(0.5, 0.05), vote(0.6, 0.02), vote(0.0, 0.6)], axis=1)
    q, rates, discount = toxicity.label_model(votes, votes[:, :5].max(axis=1))
    assert ((q > 0.5) == y).mean() > 0.8
    assert discount[:3].max() < 0.5 < discount[3] and rates[1, 4] > 5 * rates[0, 4]


def test_voters_accuracies_follow_from_their_agreement():
    """Without a label, estimated precision comes near the true one, and labels follow, for voters that fire on at most 0.3 % of clean texts."""
    import numpy as np

    rng = np.random.default_rng(1)
    y = rng.random(5000) < 0.15
    hit, false = rng.uniform(0.2, 0.6, 12), rng.uniform(0.0, 0.003, 12)
    terms = np.where(y[:, None], rng.random((5000, 12)) < hit, rng.random((5000, 12)) < false).astype(float)
    x = np.hstack([terms, np.zeros((5000, len(toxicity.STYLE) + 2))])
    votes = toxicity.votes_of(x, 12)
    q, _, _ = toxicity.label_model(votes[:, votes.any(axis=0)], toxicity.start_of(x, 12), 0.15)
    estimated, true = (q @ terms) / terms.sum(axis=0), (y @ terms) / terms.sum(axis=0)
    assert np.abs(estimated - true).max() < 0.1 and ((q > 0.5) == y).mean() > 0.95


@pytest.mark.parametrize("name", ["odd_docs", "docs"])
def test_media_round_trip(spark, request, name, tmp_path):
    df = request.getfixturevalue(name)
    rows, folder = media.store(df, folder=f"file://{tmp_path}")
    got = media.features(media.metadata(rows, folder), folder).join(df.select("doc_id", "text").distinct().withColumnRenamed("doc_id", "d"), F.expr("doc_id <=> d")).collect()
    same: dict = {}
    for r in got:
        payload, n = media.payload_of(r["text"])
        if hashlib.sha256(payload).hexdigest() != r["digest"]:
            continue  # another row of a repeated id
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (n, len(payload), r["digest"])
        assert r["payload_bytes"] % 64 == 0 and r["payload_bytes"] >= 64 and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert (r["width"], r["height"], r["bits"]) == (64, len(payload) // 64, 8) and r["media_bytes"] == r["length"]
        same.setdefault(r["digest"], set()).add((r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in same.values()) and rows.count() == df.count()
    r = got[0]
    with tarfile.open(tmp_path / r["shard"]) as tar:
        body = tar.extractfile(f"{r['digest']}.png").read()
    assert hashlib.sha256(body).hexdigest() == r["media_sha256"] and hashlib.sha256(media.from_png(body)).hexdigest() == r["digest"]


def test_media_of_nothing(no_docs):
    rows, folder = media.store(no_docs)
    assert media.features(media.metadata(rows, folder), folder).count() == 0
    with pytest.raises(ValueError):
        media.png_header(b"x" * 33)


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_licenses(text):
    """All detections of all rules by Python's re, without keyword or gate, then the same suppression over pairs."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = TOKEN.findall(low)
    base = [(i, label) for i in range(len(words)) for phrase, label in licenses.BASE if words[i : i + len(phrase.split())] == phrase.split()]
    found = sorted((m.start(), -m.end(), -p, label) for label, _, rx, p in licenses.rules() for m in re.finditer(rx, low))
    kept = [d for i, d in enumerate(found) if not any(-e[1] >= -d[1] and -e[2] >= -d[2] for e in found[:i])]
    labels = {label for _, label in base} | {d[3] for d in kept}
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), len(kept), max([-d[2] / 100 for d in kept] + [0.5] * bool(base), default=0.0))


CASES = [
    "Released under the MIT License.",
    "mit   license mit-license, MIT\nLicense; the mit licence",
    "Licensed under the Apache License, Version 2.0. See http://www.apache.org/licenses/LICENSE-2.0",
    "GNU Lesser General Public License version 2.1, GNU General Public License v3 and GPL license",
    "SPDX-License-Identifier: BSD-3-Clause\nSPDX-License-Identifier: MIT",
    "Creative Commons Attribution-ShareAlike; creative commons attribution 4.0 license",
    "Copyright (c) 2020 x. All rights reserved.",
    "permit license", "mitt license", "license", "", None, "MIT License " * 300,
]


def test_licenses(spark, docs, odd_docs, no_docs):
    assert len(licenses.rules()) > 200
    rows = [(i, x) for i, x in enumerate(CASES)] + [(1000 + r["doc_id"], r["text"]) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.report(df).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["n_detections"], r["score"]) == brute_licenses(text), text
    assert licenses.report(odd_docs).count() == odd_docs.count() and licenses.report(no_docs).count() == 0
