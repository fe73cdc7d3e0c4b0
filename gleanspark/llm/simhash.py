"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprint: texts are lower-cased (A-Z), cut into words at ASCII white space and into word
shingles, repeats included (a text of fewer words is one shingle; none: fingerprint zero). A bit is set if it is
set in over half of the shingles' XXH64 (seed 42).

Linking: equal fingerprints are one class first, so copies cost nothing. Correlated bits
are grouped into m parts; if the parts' thresholds plus one sum to the distance plus one, two
fingerprints within the distance agree in some part within its threshold. A dynamic program
allots thresholds (-1: part unused) to the least estimated cost from statistics over all classes;
m is chosen by the same cost. Each class is stored under its value of every used part and probes all values
within the threshold; members of a bucket are verified on all 64 bits. A bucket emits
a spanning forest of its links, never its pairs. Components follow from the forests.

Null text counts as empty. Rows that repeat a doc_id count as documents of their own but share
that id. Rows with a null doc_id get their fingerprint, and a component only if another id reaches them
(else null). An empty table gives an empty result. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, lgamma, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm import bloom
from gleanspark.llm.common import join_groups, scratch
from gleanspark.llm.components import components, local_roots
from gleanspark.llm.langid import text_bytes
from gleanspark.llm.xxh import xxh64

U = np.uint64
#: Bytes of text handled at once: bounds memory however long a text is.
BLOCK = 1 << 20
#: Estimated seconds to shuffle a row and to verify a pair; only their ratio counts.
ROW_S, PAIR_S = 2e-6, 3e-9
#: Buckets of up to so many rows are verified pair by pair, larger ones by a search that leaves out what it has reached;
#: beyond SPLIT rows a bucket is split by the other bits first.
SMALL, SPLIT = 128, 1 << 16

_spread = np.zeros(256, dtype=U)
for _bit in range(8):
    _spread |= ((np.arange(256, dtype=U) >> U(_bit)) & U(1)) << U(8 * _bit)
SPREAD = _spread
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
LOWER = _lower


# ---------------------------------------------------------------- fingerprints


def _words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with single spaces, word starts, word ends, document of each word) of texts between the offsets."""
    low = LOWER[raw]
    space = (low == 32) | ((low >= 9) & (low <= 13))
    new = np.zeros(len(low) + 1, dtype=bool)
    new[at] = True
    start, end = ~space, ~space
    start[1:] &= space[:-1] | new[1:-1]
    end[:-1] &= space[1:] | new[1:-1]
    keep = ~space
    keep[1:] |= ~space[:-1]
    place = np.cumsum(keep) - 1
    starts, ends = np.nonzero(start)[0], np.nonzero(end)[0]
    low[space] = 32
    return low[keep], place[starts], place[ends] + 1, np.searchsorted(at, starts, side="right") - 1


def _bit_counts(h: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """How many of each document's hashes have each bit: (docs, 64). ``doc`` is sorted."""
    counts = np.zeros((docs, 64), dtype=np.int64)
    if not len(h):
        return counts
    cut = np.zeros(len(h), dtype=bool)
    cut[0] = True
    cut[1:] = doc[1:] != doc[:-1]
    runs = np.append(np.nonzero(cut)[0], len(h))
    first = np.concatenate([np.arange(a, b, 255) for a, b in zip(runs[:-1], runs[1:], strict=True)])
    for k in range(8):  # 8 counters of a byte in a word: at most 255 hashes are added up at once
        lanes = np.add.reduceat(SPREAD[((h >> U(8 * k)) & U(255)).astype(np.intp)], first)
        np.add.at(counts[:, 8 * k : 8 * k + 8], doc[first], lanes[:, None].view(np.uint8).reshape(-1, 8).astype(np.int64))
    return counts


def _shingled(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bit counts, number of shingles) of each text between the offsets."""
    docs = len(at) - 1
    if not len(raw):
        return np.zeros((docs, 64), dtype=np.int64), np.zeros(docs, dtype=np.int64)
    text, start, end, doc = _words(raw, at)
    n = np.bincount(doc, minlength=docs)
    first = np.nonzero(np.append(True, doc[1:] != doc[:-1]))[0] if len(doc) else np.zeros(0, dtype=np.int64)
    full = np.nonzero(doc[width - 1 :] == doc[: len(doc) - width + 1])[0] if len(doc) >= width else np.zeros(0, dtype=np.int64)
    few = first[n[doc[first]] < width] if len(first) else first
    lo = np.concatenate([full, few])
    hi = np.concatenate([full + width - 1, few + n[doc[few]] - 1])
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    h = xxh64(text, start[lo], end[hi] - start[lo])
    return _bit_counts(h, doc[lo], docs), np.bincount(doc[lo], minlength=docs)


def _long(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long text, block by block; the last words of a block go before the next."""
    counts, n, carry, pos = np.zeros((1, 64), dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8), 0
    while pos < len(raw):
        hi = min(pos + BLOCK, len(raw))
        while hi < len(raw) and not (raw[hi] == 32 or 9 <= raw[hi] <= 13):
            hi += 1
        piece = np.concatenate([carry, raw[pos:hi]])
        text, start, _, _ = _words(piece, np.array([0, len(piece)]))
        if len(start) >= width or hi == len(raw) and not n[0] and len(start):
            c, k = _shingled(piece, np.array([0, len(piece)]), width)
            counts, n = counts + c, n + k
        keep = start[-(width - 1)] if len(start) >= width - 1 and width > 1 else 0
        carry = np.concatenate([text[keep:] if width > 1 else text[:0], np.array([32], dtype=np.uint8)])
        pos = hi
    return counts, n


def fingerprints(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The fingerprint (uint64) of each text between the offsets."""
    out, docs, lo = np.zeros(len(at) - 1, dtype=U), len(at) - 1, 0
    while lo < docs:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK, side="right")) - 1)
        own, base = at[lo : hi + 1], int(at[lo])
        piece = raw[base : int(own[-1])]
        counts, n = _shingled(piece, own - base, width) if hi > lo + 1 or len(piece) <= 2 * BLOCK else _long(piece, width)
        bits = (2 * counts > n[:, None]).astype(np.uint8)
        out[lo:hi] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
        lo = hi
    return out


def fingerprint_table(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """id, fp (the 64 bits as a signed long) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(raw, at, width).view(np.int64))], names=["id", "fp"])

    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "id long, fp long")


# ---------------------------------------------------------------- the plan of parts and thresholds


def _bit_matrix(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(classes: DataFrame) -> tuple[int, np.ndarray]:
    """(classes, 64 x 64 counts of bits set together) over all classes: 4096 sums, whatever the size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64), dtype=np.int64)
        for batch in batches:
            bits = _bit_matrix(batch.column(0).to_numpy()).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], names=["k", "n"])

    rows = classes.select("fp").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(4096)
    for r in rows:
        both[r["k"]] = r["n"]
    return classes.count(), both.reshape(64, 64)


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m parts of like size: each takes the free bit that correlates most with what it holds."""
    free, parts = set(range(64)), []
    for k in range(m):
        width = 64 // m + (k < 64 % m)
        part = [max(free, key=lambda i: (corr[i, list(free)].sum(), -i))]
        free.remove(part[0])
        while len(part) < width:
            part.append(best := max(free, key=lambda i: (corr[i, part].mean(), -i)))
            free.remove(best)
        parts.append(sorted(part))
    return parts


def within(part: list[int], n: int, both: np.ndarray, most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0, 1, ... ``most`` bits of a part: a beta-binomial with the
    mean and variance that the joint bit counts give."""
    w = len(part)
    p = both / max(n, 1)
    one = np.diag(p)
    differ = 2 * one * (1 - one)
    mean = float(differ[part].sum())
    p11 = p[np.ix_(part, part)]
    p10 = one[part][:, None] - p11
    p01, p00 = p10.T, 1 - p11 - p10 - p10.T
    joint = 2 * (p11 * p00 + p10 * p01)
    np.fill_diagonal(joint, differ[part])
    variance = float(joint.sum()) - mean**2
    q = min(max(mean / w, 1e-6), 1 - 1e-6)
    over = min(max(variance / (w * q * (1 - q)), 1.0001), w - 0.0001 if w > 1 else 1.0001)
    s = (w - over) / (over - 1) if w > 1 else 1e4
    a, b = max(q * s, 1e-6), max((1 - q) * s, 1e-6)
    lb = lambda x, y: lgamma(x) + lgamma(y) - lgamma(x + y)
    return list(np.minimum(1, np.cumsum([comb(w, k) * exp(lb(k + a, w - k + b) - lb(a, b)) for k in range(min(most, w) + 1)])))


def allot(parts: list[list[int]], n: int, both: np.ndarray, distance: int) -> tuple[float, list[int]]:
    """The thresholds of least estimated cost that sum, plus one each, to the distance plus one."""
    table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        near, nxt = within(part, n, both, distance), {}
        for used, (cost, chosen) in table.items():
            for units in range(distance + 2 - used):
                e = units - 1
                if e >= len(near):
                    continue
                rows = n * (1 + sum(comb(len(part), k) for k in range(1, e + 1))) if units else 0
                total = cost + (rows * ROW_S + n * n / 2 * near[e] * PAIR_S if units else 0.0)
                if used + units not in nxt or total < nxt[used + units][0]:
                    nxt[used + units] = (total, [*chosen, e])
        table = nxt
    return table.get(distance + 1, (float("inf"), []))


def plan(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each used part."""
    one = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(one, one)) / np.outer(spread, spread))
    options = []
    for m in range(1, distance + 2):
        parts = group_bits(corr, m)
        cost, thresholds = allot(parts, n, both, distance)
        options.append((cost, m, [(p, e) for p, e in zip(parts, thresholds, strict=False) if e >= 0]))
    return min(options)[2]


# ---------------------------------------------------------------- probing and verifying


def flips(bits: list[int], most: int) -> np.ndarray:
    """All masks of 1 to ``most`` of the bits."""
    level, out = [(0, -1)], []
    for _ in range(most):
        level = [(mask | 1 << b, k) for mask, last in level for k, b in enumerate(bits) if k > last]
        out += [mask for mask, _ in level]
    return np.array(out, dtype=U)


def _close(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def _search(fp: np.ndarray, node: np.ndarray, stored: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links of one bucket: each row is compared with those not reached yet."""
    todo = np.arange(len(fp))
    while len(todo):
        queue, todo = [int(todo[0])], todo[1:]
        while queue and len(todo):
            u = queue.pop()
            hit = _close(fp[todo], fp[u], distance)
            if not stored[u]:
                hit &= stored[todo]
            if hit.any():
                reached = todo[hit]
                yield np.full(len(reached), node[u]), node[reached]
                queue += reached.tolist()
                todo = todo[~hit]


def _bucket(fp: np.ndarray, node: np.ndarray, stored: np.ndarray, distance: int, used: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of one large bucket. Beyond SPLIT rows: again by parts of the bits not used, which lose no link."""
    same = fp ^ fp[0]
    varying = [b for b in range(64) if not used >> b & 1 and bool(((same >> U(b)) & U(1)).any())]
    if len(fp) <= SPLIT or len(varying) <= 2 * (distance + 1):
        yield from _search(fp, node, stored, distance)
        return
    for k in range(distance + 1):
        mask = sum(1 << b for b in varying[k :: distance + 1])
        key = fp & U(mask)
        order = np.argsort(key, kind="stable")
        edge = np.concatenate([[0], np.nonzero(np.diff(key[order]))[0] + 1, [len(order)]])
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            own = order[lo:hi]
            if hi - lo > 1 and stored[own].any():
                yield from _bucket(fp[own], node[own], stored[own], distance, used | mask)


def _links(part: np.ndarray, key: np.ndarray, fp: np.ndarray, node: np.ndarray, stored: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, least node) of whole buckets, rows sorted by bucket."""
    new = np.append(True, (part[1:] != part[:-1]) | (key[1:] != key[:-1]))
    first = np.append(np.nonzero(new)[0], len(key))
    size = np.diff(first)
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    left = np.repeat(np.where(size <= SMALL, first[1:], 0), size) - np.arange(len(key)) - 1  # rows after this one in a small bucket
    for step in range(1, SMALL):
        at = np.nonzero(left >= step)[0]
        if not len(at):
            break
        at = at[_close(fp[at], fp[at + step], distance) & (stored[at] | stored[at + step])]
        a.append(node[at])
        b.append(node[at + step])
        if sum(map(len, a)) > 1 << 20:
            x, y = local_roots(np.concatenate(a), np.concatenate(b))
            a, b = [x], [y]
    for k in np.nonzero(size > SMALL)[0]:
        own = slice(first[k], first[k + 1])
        if stored[own].any():
            for x, y in _bucket(fp[own], node[own], stored[own], distance, 0):
                a.append(x)
                b.append(y)
    return local_roots(np.concatenate(a), np.concatenate(b))


def link(classes: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect all classes (fp, node) within the distance; a forest of each bucket."""
    n, both = bit_statistics(classes)
    parts = [(k, sum(1 << b for b in bits), flips(bits, e)) for k, (bits, e) in enumerate(plan(n, both, distance))]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(k: int, key: np.ndarray, fp: np.ndarray, node: np.ndarray, stored: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int32)), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(node), pa.array(np.full(len(key), stored))], names=["part", "key", "fp", "node", "stored"])

        for batch in batches:
            fp, node = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy()
            for k, mask, masks in parts:
                yield rows(k, fp & U(mask), fp, node, True)
                each = max(1, (1 << 16) // max(1, len(fp)))
                for lo in range(0, len(masks), each):
                    some = masks[lo : lo + each]
                    yield rows(k, ((fp & U(mask))[None, :] ^ some[:, None]).ravel(), np.tile(fp, len(some)), np.tile(node, len(some)), False)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            part, key, fp, node, stored = (np.concatenate(x) for x in zip(*rows, strict=True))
            x, y = _links(part, key, fp.view(U), node, stored, distance)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            changed = np.nonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))[0]
            cut = int(changed[-1]) + 1 if len(changed) else 0  # the last bucket may go on in the next batch
            if cut or held and (held[-1][0][-1] != rows[0][0] or held[-1][1][-1] != rows[1][0]):
                yield out([*held, tuple(x[:cut] for x in rows)])
                held = []
            held.append(tuple(x[cut:] for x in rows))
        if held:
            yield out(held)

    entries = classes.select("fp", "node").mapInArrow(spread, "part int, key long, fp long, node long, stored boolean")
    # 16 bytes a row besides the key; a bucket is whole in a task, and large ones are split within it.
    return entries.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """Each document with fingerprint (16 hex digits), component_id (smallest doc_id reachable) and class_size (documents with its fingerprint)."""
    prints = scratch(fingerprint_table(docs, doc_id=doc_id, text=text, width=width))
    classes = scratch(prints.groupBy("fp").agg(F.min("id").alias("node"), F.count("*").alias("class_size")))
    stars = components(link(classes.where("node is not null"), distance))
    labelled = classes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("fp", "class_size", F.coalesce("root", "node").alias("component_id"))
    joined = join_groups(prints, labelled, "fp", "class_size", prints.count())
    return joined.select(F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs``, all their columns, of one document per component: the smallest doc_id. Rows with a null doc_id stay.

    Rows that a Bloom filter of the dropped ids lets through meet those ids in a join; all others, texts and all, stay where they are.
    """
    found = near_duplicates(docs, doc_id=doc_id, text=text, width=width, distance=distance)
    dropped = scratch(found.where(F.col(doc_id) != F.col("component_id")).select(F.xxhash64(doc_id).alias("__h"), F.col(doc_id).alias("__gone")))
    blocks = bloom.n_blocks(dropped.count())
    probed = bloom.probe(docs.withColumn("__h", F.xxhash64(F.col(doc_id).cast("long"))), "__h", bloom.build(dropped, "__h", blocks), blocks, "__maybe")
    stays = probed.where("not __maybe").drop("__h", "__maybe")
    checked = probed.where("__maybe").drop("__h", "__maybe").join(dropped.select("__gone"), F.col(doc_id) == F.col("__gone"), "left_anti")
    return stays.unionByName(checked)
