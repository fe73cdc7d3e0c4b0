"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact size in words. Sources, sorted by code point with null last, take
the given weights in turn and share the budget; a target stops at ``max_repeat`` times its
source's size and the excess is reshared by weight. Within a source, whole passes come first. The
remaining budget takes an even share of every size, then a bounded-knapsack dynamic
program over the sizes left fits the remainder, an eighth of the budget or more where that fits better. Of each size the documents with the smallest
seeded hash of doc_id are selected, so reruns agree.

Null text: size 0. Documents of size 0 are never selected beyond whole passes (they take no words). Rows
that repeat a doc_id are one choice: if the cut falls between them, all are taken. A null doc_id
hashes like any value. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import WORD, scratch, without

#: The most words that the even shares and the greedy step leave for the dynamic program.
DP_WORDS = 1 << 16
#: Hash ranges within a size: a hot size is ranked in so many parts.
RANGES = 256
#: Cut tables of up to so many rows (about 40 bytes each) are broadcast, after counting; larger ones are shuffled.
BROADCAST_ROWS = 400_000
LEAST = -(2**63)


def targets(sizes: list[int], weights: tuple[float, ...], share: float, max_repeat: int) -> list[float]:
    """Target words of each source, given in order."""
    w = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    caps = [float(max_repeat * s) for s in sizes]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(w[i] for i in open_)
        over = [i for i in open_ if left * w[i] / total > caps[i]]
        if not over:
            for i in open_:
                out[i] = left * w[i] / total
            break
        for i in over:
            out[i] = caps[i]
        left -= sum(caps[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def even_share(lengths: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """How many items of each length make ``words`` at one rate for all; what rounding takes from a length goes to the next longer one."""
    order = np.argsort(lengths, kind="stable")
    total = int((lengths * counts).sum())
    ends = [n * words // total for n in accumulate(np.where(lengths > 0, counts, 0)[order].tolist())]
    take = np.zeros_like(counts)
    take[order] = np.diff([0, *ends])
    return take


def fit_subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many items of each length to take so that their sum comes near to ``budget`` from below; nearest, if the program alone can take the budget."""
    if budget >= int((lengths * counts).sum()):
        return counts.copy()
    none = np.zeros_like(counts)
    if budget <= 0:
        return none
    best = whole = _filled(lengths, counts, none, budget) if budget <= DP_WORDS else None
    goal = int((whole * lengths).sum()) if whole is not None else budget
    nearest, reserve = -1, min(DP_WORDS, budget) // 8
    # leave more to the program until it fits as well as it can
    while reserve < budget and nearest < goal and (nearest < 0 or reserve <= DP_WORDS):
        take = even_share(lengths, counts, budget - reserve)
        if int((take * lengths).sum()) <= budget:
            take = _filled(lengths, counts, take, budget)
            if (total := int((take * lengths).sum())) > nearest:
                nearest, best = total, take
        reserve = max(1, 2 * reserve)
    if whole is not None and nearest < goal:
        return whole
    return best if best is not None else _filled(lengths, counts, none, budget)


def _filled(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> np.ndarray:
    """``take`` and what the dynamic program adds to it."""
    take = take.copy()
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):  # greedy down to what the program takes
        if lengths[i] > 0 and left > DP_WORDS:
            more = min(int(counts[i] - take[i]), (left - DP_WORDS) // int(lengths[i]))
            take[i] += more
            left -= more * int(lengths[i])
    items = []  # binary parts of each count: (length index, number)
    for i in np.nonzero((lengths > 0) & (lengths <= left) & (counts > take))[0]:
        n, part = min(int(counts[i] - take[i]), left // int(lengths[i])), 1
        while n > 0:
            items.append((i, min(part, n)))
            n -= part
            part *= 2
    items = [items[k] for k in np.random.default_rng(len(items)).permutation(len(items))]  # no length comes first
    reach, parent = np.zeros(left + 1, dtype=bool), np.full(left + 1, -1, dtype=np.int64)
    reach[0] = True
    for k, (i, n) in enumerate(items):
        if reach[left]:
            break
        weight = int(lengths[i]) * n
        if weight <= left:
            new = np.zeros_like(reach)
            new[weight:] = reach[:-weight]
            new &= ~reach
            parent[new] = k
            reach |= new
    at = int(np.nonzero(reach)[0][-1])
    while at > 0:
        i, n = items[parent[at]]
        take[i] += n
        at -= int(lengths[i]) * n
    return take


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    group["take"] = fit_subset(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), int(group["budget"].iloc[0]))
    return group[["source_no", "size", "n", "take"]]


def _order(doc_id: Column, seed: int) -> tuple[Column, Column, Column]:
    """Seeded order of documents: hash range, hash, id."""
    h = F.xxhash64(F.lit(seed), doc_id)
    return F.pmod(h, F.lit(RANGES)).cast("int"), h, F.coalesce(doc_id.cast("long"), F.lit(LEAST))


def plan(docs: DataFrame, *, doc_id: str, text: str, source: str, weights: tuple, share: float, max_repeat: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, sources, cuts).

    sizes: one slim row a document. sources: one row a source with its target. cuts: one row a (source, size) with
    the whole passes and the last document, in seeded order, of the extra pass. Only one row per source reaches the driver.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = scratch(docs.select(F.col(doc_id).alias("id"), F.col(source).cast("string").alias("source"), words.alias("size")))
    by_source = {r["source"]: r["s"] for r in sizes.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    names = sorted((s for s in by_source if s is not None)) + ([None] if None in by_source else [])
    goal = targets([by_source[s] for s in names], weights, share, max_repeat)
    rows = []
    for no, (name, target) in enumerate(zip(names, goal, strict=True)):
        total = by_source[name]
        passes = min(max_repeat, int(target) // total) if total else 0
        rows.append((no, name, total, target, passes, int(target) - passes * total if passes < max_repeat else 0))
    sources = spark.createDataFrame(rows, "source_no int, source string, source_size long, target double, passes int, budget long")
    counts = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    counts = counts.join(sources, counts["source"].eqNullSafe(sources["source"])).select("source_no", "size", "n", "budget")
    fitted = scratch(counts.groupBy("source_no").applyInPandas(_fit, "source_no int, size long, n long, take long"))
    # The cut: the take-th document of a size in seeded order, found by counting hash ranges and ranking in one of them.
    b, h, i = _order(F.col("id"), seed)
    partly = fitted.where("take > 0 and take < n")
    keyed = sizes.join(F.broadcast(sources.select("source_no", F.col("source").alias("name"))), F.col("source").eqNullSafe(F.col("name")))
    keyed = keyed.join(partly.select("source_no", "size"), ["source_no", "size"], "left_semi").select("source_no", "size", b.alias("b"), h.alias("h"), i.alias("i"))
    ranges = keyed.groupBy("source_no", "size", "b").agg(F.count("*").alias("k"))
    before = F.sum("k").over(Window.partitionBy("source_no", "size").orderBy("b")) - F.col("k")
    last = ranges.withColumn("before", before).join(partly, ["source_no", "size"]).where("before < take and take <= before + k")
    last = last.withColumn("nth", F.col("take") - F.col("before")).select("source_no", "size", "b", "nth")
    ranked = keyed.join(last, ["source_no", "size", "b"]).withColumn("rank", F.row_number().over(Window.partitionBy("source_no", "size", "b").orderBy("h", "i")))
    cut = ranked.where("rank = nth").select("source_no", "size", F.struct("b", "h", "i").alias("cut"))
    cuts = fitted.join(cut, ["source_no", "size"], "left").select("source_no", "size", (F.col("take") == F.col("n")).alias("all"), "cut")
    return sizes, sources, scratch(cuts)


def _copies(rows: DataFrame, sources: DataFrame, cuts: DataFrame, doc_id: str, seed: int) -> DataFrame:
    """``rows`` with columns source, size: adds copies, source_size and target."""
    named = F.broadcast(sources.withColumnRenamed("source", "name"))
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    small = cuts.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(cuts) if small else cuts, ["source_no", "size"])
    b, h, i = _order(F.col(doc_id), seed)
    extra = F.col("all") | F.coalesce(F.struct(b.alias("b"), h.alias("h"), i.alias("i")) <= F.col("cut"), F.lit(False))
    copies = F.col("passes") + F.when(extra & (F.col("budget") > 0) & (F.col("size") > 0), 1).otherwise(0)
    return rows.withColumn("copies", copies).drop("source_no", "all", "cut", "passes", "budget")


def mix_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = (5, 2, 1), share: float = 1.0, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """Each document with size, source_size, target, taken (words, repeats counted) and copies."""
    sizes, sources, cuts = plan(docs, doc_id=doc_id, text=text, source=source, weights=weights, share=share, max_repeat=max_repeat, seed=seed)
    out = _copies(sizes, sources, cuts, "id", seed)
    return out.select(F.col("id").alias(doc_id), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = (5, 2, 1), share: float = 1.0, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """The mixed corpus: every row of ``docs``, all its columns, as often as the mix takes it. Texts are not shuffled unless there are very many (source, size) pairs."""
    _, sources, cuts = plan(docs, doc_id=doc_id, text=text, source=source, weights=weights, share=share, max_repeat=max_repeat, seed=seed)
    columns = docs.columns
    words = F.coalesce(F.regexp_count(F.col("__row")[text], F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"))
    rows = rows.select("__row", F.col("__row")[doc_id].alias("__id"), F.col("__row")[source].cast("string").alias("source"), words.alias("size"))
    taken = _copies(rows, sources, cuts, "__id", seed).where("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__n")).select("__row.*")
