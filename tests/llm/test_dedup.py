"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleanspark.llm import bloom, components, exact_dedup, simhash, xxh


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected_groups(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(hashlib.sha256(lower(r["text"]).encode()).hexdigest(), []).append(r["doc_id"])
    return groups


@pytest.mark.parametrize("name", ["odd_docs", "docs"])
def test_exact_dedup(request, name):
    df = request.getfixturevalue(name)
    groups = expected_groups(df.collect())
    got = exact_dedup.annotate(df).collect()
    assert sorted(got[0].asDict()) == ["doc_id", "group_size", "keep_id", "kept", "text_sha256"]
    assert len(got) == df.count()
    for r in got:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r["kept"]]
    assert Counter(r["text_sha256"] for r in kept) == {sha: 1 for sha in groups} and all(r["doc_id"] == r["keep_id"] for r in kept)
    rows = exact_dedup.drop_duplicates(df)
    assert rows.columns == df.columns
    key = lambda rs: Counter((r["doc_id"], r["text"]) for r in rs)
    by_sha = {hashlib.sha256(lower(r["text"]).encode()).hexdigest(): r["doc_id"] for r in rows.collect()}
    assert rows.count() == len(groups) and by_sha == {r["text_sha256"]: r["doc_id"] for r in kept}, key


def test_empty_tables(no_docs):
    assert exact_dedup.annotate(no_docs).count() == exact_dedup.drop_duplicates(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == simhash.drop_near_duplicates(no_docs).count() == 0


def test_filter_never_loses_a_repeat(spark):
    keys = spark.range(5000).select((F.col("id") % 4000).alias("v")).select("v", F.xxhash64("v").alias("h"))
    blocks = bloom.n_blocks(5000)
    probed = bloom.probe(keys, "h", bloom.build_repeated(keys, "h", blocks), blocks, "maybe")
    assert probed.where("v < 1000 and not maybe").count() == 0
    assert probed.where("v >= 1000 and maybe").count() < 600
    assert bloom.n_blocks(10**12) == 1 << bloom.MAX_LOG_BLOCKS


def fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """prints: {node: bits}; the least node of each one's component."""
    nodes = sorted(prints)
    bits = np.array([prints[n] for n in nodes], dtype=np.uint64)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for i, n in enumerate(nodes):
        for j in np.nonzero(np.bitwise_count(bits[i] ^ bits) <= distance)[0]:
            a, b = find(n), find(nodes[j])
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", ["odd_docs", "docs"])
def test_near_duplicates(request, name):
    df = request.getfixturevalue(name)
    rows = df.collect()
    got = simhash.near_duplicates(df).collect()
    assert Counter((r["doc_id"], int(r["fingerprint"], 16)) for r in got) == Counter((r["doc_id"], fingerprint(r["text"])) for r in rows)
    # rows that share an id are documents of their own: give them nodes of their own
    nodes = {(r["doc_id"], k): fingerprint(r["text"]) for k, r in enumerate(rows) if r["doc_id"] is not None}
    want = brute_components(nodes, 4)
    assert Counter((r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None) == Counter((n[0], root[0]) for n, root in want.items())


def test_long_texts_in_blocks(monkeypatch):
    texts = ["", "a b", "x" * 3000, "a b c d e " * 300, " " * 900 + "b c d e f"]
    monkeypatch.setattr(simhash, "BLOCK", 200)
    for text in texts:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        assert int(simhash.fingerprints(raw, np.array([0, len(raw)]), 4)[0]) == fingerprint(text)


def test_xxh64():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 3000, dtype=np.uint8)
    start, length = rng.integers(0, 2000, 800), rng.integers(0, 200, 800)
    got = xxh.xxh64(raw, start, length)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(raw[a : a + n].tobytes(), 42) for a, n in zip(start, length, strict=True)]


@pytest.mark.parametrize("thresholds", [[(64, 4)], [(32, 2), (32, 1)], [(22, 1), (21, 0), (21, 1)], None])
def test_links_lose_nothing(spark, monkeypatch, thresholds):
    """A chain, a dense ball, and noise; any valid allotment of thresholds finds the same components."""
    rng = np.random.default_rng(2)
    value, prints = 0, {}
    n_noise = 60 if thresholds == [(64, 4)] else 600
    for k in range(20):  # a chain of steps of four bits
        value ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        prints[k] = value
    centre = int(rng.integers(1 << 62))
    for k in range(20, 200):
        prints[k] = centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False))
    for k in range(200, 200 + n_noise):
        prints[k] = int(rng.integers(1 << 62)) * 2 + 1
    if thresholds == [(64, 4)]:
        prints = {k: v for k, v in prints.items() if k < 24}  # 679,120 probes a fingerprint
    unique = {}
    for k, v in prints.items():
        unique.setdefault(v, k)
    classes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)), k) for v, k in unique.items()], "fp long, node long")
    if thresholds:
        bits = iter(rng.permutation(64).tolist())
        plan = [(sorted(next(bits) for _ in range(w)), e) for w, e in thresholds]
        monkeypatch.setattr(simhash, "plan", lambda *_: plan)
    stars = components.components(simhash.link(classes, 4)).collect()
    got = {k: k for k in unique.values()} | {r["u"]: r["v"] for r in stars}
    assert got == brute_components({k: v for v, k in unique.items()}, 4)


def test_large_buckets_are_searched_and_split(monkeypatch):
    rng = np.random.default_rng(3)
    fp = np.unique(np.concatenate([rng.integers(0, 1 << 30, 400, dtype=np.uint64) << np.uint64(30), np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 60, 300).astype(np.uint64))]))
    node, stored = np.arange(len(fp)), np.ones(len(fp), dtype=bool)
    want = brute_components({int(k): int(v) for k, v in zip(node, fp, strict=True)}, 4)
    for split in (1 << 16, 50):
        monkeypatch.setattr(simhash, "SPLIT", split)
        a, b = simhash._links(np.zeros(len(fp), int), np.zeros(len(fp), int), fp, node, stored, 4)
        got = {int(k): int(k) for k in node} | dict(zip(a.tolist(), b.tolist(), strict=True))
        assert got == want


def test_plan_sums_to_the_distance():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500.0)
    for n in (1000, 10**6, 10**9):
        parts = simhash.plan(n, both * n / 1000, 4)
        used = [b for bits, _ in parts for b in bits]
        assert sum(e + 1 for _, e in parts) == 5 and len(used) == len(set(used))


def test_one_document_of_each_group_stays(docs):
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(found.values()))
