"""Noise, near-duplicates, selection under quotas, and episodes.

Ordered, greedy steps see slim rows only. Noise is two windows. Selection under a binding quota is a fold: rows are dealt by the fold's key, sorted
by rank and streamed through a bounded state, never held as a group. Near-duplicates depend on a bucket's few representatives alone: a fold over
the first open rows finds these, then all rows meet them where they are; small buckets are folded whole. Selection without a binding quota is a window over the duplicate keys.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import namedtuple
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanspark.functions import text as t
from gleanspark.operators.scoring import Config, use_for
from gleanspark.sources.tables import stored

# ---- Fixed values: kinds of use, and rejects that deduplication gives.
KINDS = ("router_classification", "sft", "tool_use_sft")
ALL_BITS = (1 << 64) - 1
DEDUPE_REASONS = ("duplicate_content", "normalized_duplicate_content", "near_duplicate_content", "debug_noise_repeat", "debug_burst")


def _add(array: Column | str, flag: Column, value: str) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.when(flag, F.array_union(array, F.array(F.lit(value)))).otherwise(array)


def suppress(df: DataFrame, flag: Column, reason: str, risk: str) -> DataFrame:
    """Clears every use of flagged rows; the reason becomes a reject, the risk a label."""
    flag = F.coalesce(flag, F.lit(False))
    return df.withColumns(
        {
            "suppressed_use_for": F.when(flag, F.array_union("suppressed_use_for", "use_for")).otherwise(F.col("suppressed_use_for")),
            "use_for": F.when(flag, F.array().cast("array<string>")).otherwise(F.col("use_for")),
            "risk_labels": _add("risk_labels", flag, risk),
            "matched_reasons": _add("matched_reasons", flag, reason),
            "reject_reasons": _add("reject_reasons", flag, reason),
        }
    )


def with_dedupe_columns(annotated: DataFrame) -> DataFrame:
    """Adds dedupe_text, dedupe_bucket, session_key and the empty marks."""
    part = lambda c, name: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(f"missing_{name}"))
    none = F.array().cast("array<string>")
    return annotated.withColumns(
        {
            "dedupe_text": t.normalize_for_dedupe(F.col("user_text")),
            "dedupe_bucket": F.concat_ws(":", "route_label", "intent_label", "score_bucket"),
            "session_key": F.concat_ws(":", part("tenant_hash", "tenant"), part("user_hash", "user"), part("session_hash", "session")),
            "suppressed_use_for": none,
            "matched_reasons": none,
        }
    )


def event_order() -> list[Column]:
    return [F.col("event_time_ms").asc_nulls_last(), F.col("date"), F.col("line_no"), F.col("sample_id")]


def rank_order() -> list[Column]:
    return [F.col("final_score").desc(), (F.size("value_labels") > 0).desc(), *event_order()]


def mark_noise(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Control words repeated within a session, and bursts of one task within a session."""
    if not config.dedupe or not config.noise_filter:
        return df
    control = t.is_control(F.col("dedupe_text"))
    nth = F.row_number().over(Window.partitionBy("date", "session_key", "dedupe_text").orderBy(*event_order()))
    timed = F.col("event_time_ms").isNotNull()
    tasks = Window.partitionBy("date", "session_key", "task_fingerprint", timed).orderBy("event_time_ms", "line_no", "sample_id")
    window_ms = max(0, int(config.burst_minutes * 60_000))
    since = F.lag("event_time_ms", config.task_burst).over(tasks)
    out = df.withColumns({"__repeat": control & (nth > config.control_repeats), "__burst": timed & (since >= F.col("event_time_ms") - window_ms)})
    out = suppress(out, F.col("__repeat"), "debug_noise_repeat", "debug_noise")
    return suppress(out, F.col("__burst"), "debug_burst", "debug_burst").drop("__repeat", "__burst")


def fold(df: DataFrame, keys: list[str], order: list[Column], start: Callable[[], object], step: Callable, result: str, keep: list[str] | None = None) -> DataFrame:
    """Streams rows by key in order through ``step(state, row) -> tuple of strings``; a state lives for one key. Returns the columns ``keep``
    (all by default) with the result's fields."""
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    kept = [c for c in df.columns if keep is None or c in keep]
    at = [df.columns.index(c) for c in kept]
    added = StructType.fromDDL(result)
    schema = StructType([*[df.schema[c] for c in kept], *added.fields])
    row_type = namedtuple("Row", df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for row in map(row_type._make, zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                key = tuple(getattr(row, k) for k in keys)
                if key != now:
                    now, state = key, start()
                out.append(step(state, row))
            new = [pa.array([r[i] for r in out], pa.string()) for i in range(len(added.fields))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), *new], names=schema.names)

    return ordered.mapInArrow(run, schema)


#: A set's marks: a bit for each member's hash, in 64 words.
MARKS = 4096
FEATURES = "bits long, n_chars int, n_tokens int, token_marks binary, n_pairs int, pair_marks binary"


def _listed(text: str) -> tuple[list[str], str]:
    """Words and character 3-grams, repeats included, and the text without spaces."""
    compact = text.replace(" ", "")
    return text.split() + [compact[i : i + 3] for i in range(len(compact) - 2)], compact


def _grams(text: str, n: int) -> set[str]:
    return {text[i : i + n] for i in range(len(text) - n + 1)}


def _packed(hashes: np.ndarray) -> bytes:
    marks = np.zeros(MARKS, dtype=bool)
    marks[hashes] = True
    return np.packbits(marks).tobytes()


def text_features(text: str, cache: dict) -> tuple:
    """The fields of FEATURES: SimHash, length without spaces, and size and marks of the sets of tokens and of character pairs."""
    listed, compact = _listed(text)
    bits, tokens = t.weights(listed, cache), set(listed)
    digests = np.frombuffer(b"".join(cache[x] for x in tokens), dtype="<u8")
    points = np.frombuffer(compact.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    pairs = np.unique(points[:-1] << np.uint64(32) | points[1:])
    spread = (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)  # the product's top 12 bits
    return bits, len(compact), len(tokens), _packed((digests % MARKS).astype(np.int64)), len(pairs), _packed(spread.astype(np.int64))


def with_text_features(df: DataFrame, config: Config) -> DataFrame:
    """Rows whose ``dedupe_text`` is long enough to be compared, with FEATURES; where the rows are, in any order."""
    schema = StructType([*df.schema.fields, *StructType.fromDDL(FEATURES).fields])
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    text_at = df.columns.index("dedupe_text")

    def enough(text: str | None) -> bool:
        if not text or len(text) < config.min_chars:
            return False
        return text.count(" ") + 1 + max(0, len(text) - text.count(" ") - 2) >= config.min_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for whole in batches:
            texts = whole.column(text_at).to_pylist()
            at = [i for i, text in enumerate(texts) if enough(text)]
            rows = []
            for i in at:
                if len(cache) > 100_000:
                    cache.clear()
                rows.append(text_features(texts[i], cache))
            batch = whole.take(pa.array(at, pa.int64()))
            new = [pa.array([r[k] for r in rows], type_) for k, type_ in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)


class Representatives:
    """The first texts of a bucket that no earlier one resembles, at most ``max_representatives``.

    A new text meets all of them at once, in arrays: SimHash bits, then marks, which bound from below what one set lacks of the other. The sets
    themselves are made only of pairs that the marks leave open.
    """

    def __init__(self, config: Config) -> None:
        self.config, self.texts, self.known, self.sets = config, [], {}, {}
        self.bits, self.sizes = np.zeros(16, np.uint64), np.zeros((16, 3), np.int64)
        self.marks = np.zeros((16, 2, MARKS // 64), np.uint64)

    def check(self, text: str, features: tuple | None = None) -> str:
        """'' | 'near' | 'saturated', by the text's FEATURES, which are computed where none are given. A new text becomes a representative."""
        features = features or text_features(text, {})
        if (found := self.state(text, features, len(self.texts))) or text in self.known:
            return found
        self.add(text, features)
        return ""

    def state(self, text: str, features: tuple, k: int) -> str:
        """The same for a text that the first ``k`` representatives precede; nothing is added."""
        if self.known.get(text, k) < k:
            return ""
        return "near" if self.resembles(text, features, k) else "saturated" if k >= self.config.max_representatives else ""

    def add(self, text: str, features: tuple) -> None:
        own, n_chars, n_tokens, token_marks, n_pairs, pair_marks = features
        k = len(self.texts)
        if k == len(self.bits):
            self.bits, self.sizes, self.marks = (np.concatenate([a, np.zeros_like(a)]) for a in (self.bits, self.sizes, self.marks))
        self.bits[k], self.sizes[k] = np.uint64(own & ALL_BITS), (n_chars, n_tokens, n_pairs)
        self.marks[k] = [np.frombuffer(m, np.uint64) for m in (token_marks, pair_marks)]
        self.texts.append(text)
        self.known[text] = k

    def resembles(self, text: str, features: tuple, k: int) -> bool:
        """Any of the first ``k`` representatives, by SimHash or by sets."""
        own, n_chars, n_tokens, token_marks, n_pairs, pair_marks = features
        if (np.bitwise_count(self.bits[:k] ^ np.uint64(own & ALL_BITS)) <= self.config.simhash_hamming).any():
            return True
        marks = np.stack([np.frombuffer(m, np.uint64) for m in (token_marks, pair_marks)])
        return self.alike(text, np.array([n_chars, n_tokens, n_pairs], np.int64), marks, k)

    def alike(self, text: str, sizes: np.ndarray, marks: np.ndarray, k: int) -> bool:
        """Jaccard over tokens, or containment over 2-grams where one text is clearly shorter."""
        least = self.config.jaccard
        its, its_marks = self.sizes[:k], self.marks[:k]
        lacks = np.bitwise_count(marks & ~its_marks).sum(axis=2, dtype=np.int64)  # of its tokens and pairs, what the new text has beyond them
        its_lacks = np.bitwise_count(its_marks & ~marks).sum(axis=2, dtype=np.int64)
        most = np.minimum(sizes[1] - lacks[:, 0], its[:, 1] - its_lacks[:, 0])
        both = sizes[1] + its[:, 1]
        own = None
        for i in np.nonzero(most >= least * (both - most))[0]:
            own = own or self._sets(text)
            one, other = own[0], self._sets_of(i)[0]
            shared = len(one & other)
            if shared >= least * (len(one) + len(other) - shared):
                return True
        is_shorter = sizes[0] <= its[:, 0]
        short, long = np.minimum(sizes[0], its[:, 0]), np.maximum(sizes[0], its[:, 0])
        pairs, missing = np.where(is_shorter, sizes[2], its[:, 2]), np.where(is_shorter, lacks[:, 1], its_lacks[:, 1])
        for i in np.nonzero((short > 0) & (short / np.maximum(long, 1) <= 0.88) & (pairs > 0) & (missing <= (1 - least) * pairs + 1))[0]:
            own = own or self._sets(text)
            one, other = (own[1], self._sets_of(i)[1]) if is_shorter[i] else (self._sets_of(i)[1], own[1])
            if len(one & other) / len(one) >= least:
                return True
        return False

    @staticmethod
    def _sets(text: str) -> tuple[set[str], set[str]]:
        listed, compact = _listed(text)
        return set(listed), _grams(compact, 2)

    def _sets_of(self, i: int) -> tuple[set[str], set[str]]:
        if i not in self.sets:
            self.sets[i] = self._sets(self.texts[i])
        return self.sets[i]


#: Rows of a bucket up to which a fold over it is one task. Open rows that a task gives to the search for representatives of larger buckets at once, and
#: buckets searched together: both bound what a task and the driver hold.
FOLD_ROWS, FIRST_ROWS, BUCKETS = 10_000, 256, 64
FEATURE_NAMES = tuple(f.split()[0] for f in FEATURES.split(", "))


def _rank(row) -> tuple:
    """``rank_order`` in Python."""
    score = row.final_score
    first = (1, 0.0) if score is None else (0, -float("inf") if score != score else -score)
    return first, not row.value_labels, row.event_time_ms is None, row.event_time_ms or 0, *((x is not None, x or type_()) for x, type_ in ((row.date, str), (row.line_no, int), (row.sample_id, str)))


def _features(row) -> tuple:
    return tuple(getattr(row, name) for name in FEATURE_NAMES)


def _rows(batch: pa.RecordBatch, row_type: Callable) -> Iterator:
    return map(row_type, zip(*(c.to_pylist() for c in batch.columns), strict=True))


def _holding(reps: dict, config: Config) -> dict[tuple, Representatives]:
    """Representatives by bucket, of (rank, text, features) in order."""
    out = {}
    for key, listed in reps.items():
        out[key] = Representatives(config)
        for _, text, features in listed:
            out[key].add(text, features)
    return out


def find_representatives(rows: DataFrame, keys: list[str], config: Config) -> dict[tuple, list[tuple]]:
    """(rank, text, FEATURES) of each bucket's representatives, in order: at most ``max_representatives`` a bucket.

    A row that resembles a known representative can't become one. Of the others each task gives its first in rank order, and marks the one where it
    stops; up to the first mark nothing is missing, so a fold over them finds what a fold over all rows would. A bucket that is neither full
    nor at its end is searched again, with what was found; each search finds one more at least.
    """
    columns = [*keys, "sample_id", "line_no", "event_time_ms", "final_score", "value_labels", "dedupe_text", *FEATURE_NAMES]
    rows = rows.select(*dict.fromkeys(columns))
    row_type, names = namedtuple("Row", rows.columns)._make, rows.columns
    given = StructType([*rows.schema.fields, *StructType.fromDDL("stops boolean").fields])
    given_type, key_at = namedtuple("Row", given.names)._make, [names.index(k) for k in keys]
    text_at = names.index("dedupe_text")
    reps: dict[tuple, list[tuple]] = {}
    left = None  # buckets that are not settled; None: all

    def search(first: int) -> DataFrame:
        known, open_ = reps, left

        def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            holding, now, n, texts = _holding(known, config), None, 0, set()
            for batch in batches:
                at, stops = [], []
                places = zip(*(batch.column(i).to_pylist() for i in (*key_at, text_at)), strict=True)
                for i, (*key, text) in enumerate(places):
                    if (key := tuple(key)) != now:
                        now, n, texts = key, 0, set()
                    if n > first or open_ is not None and key not in open_ or text in texts:
                        continue
                    if key in holding:
                        row = row_type([c[i].as_py() for c in batch.columns])
                        seen = holding[key]
                        if text in seen.known or seen.resembles(text, _features(row), len(seen.texts)):
                            continue
                    n += 1
                    texts.add(text)
                    at.append(i)
                    stops.append(n > first)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, pa.array(stops, pa.bool_())], names=given.names)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            holding, now, over = _holding(known, config), None, False
            for batch in batches:
                at, stops = [], []
                for i, row in enumerate(_rows(batch, given_type)):
                    if (key := tuple(getattr(row, k) for k in keys)) != now:
                        now, over = key, False
                        seen = holding.pop(key, None) or Representatives(config)
                    if over:
                        continue
                    n = len(seen.texts)
                    seen.check(row.dedupe_text, _features(row))
                    full = len(seen.texts) >= config.max_representatives
                    over = full or row.stops
                    if len(seen.texts) > n:
                        at.append(i)
                        stops.append(False)
                    if over and not full:  # a mark of its own: nothing is known of what follows
                        at.append(i)
                        stops.append(True)
                rows_ = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows_.columns[:-1], pa.array(stops, pa.bool_())], names=given.names)

        firsts = rows.sortWithinPartitions(*keys, *rank_order()).mapInArrow(give, given)
        return firsts.repartition(*keys).sortWithinPartitions(*keys, *rank_order()).mapInArrow(find, given)

    first = FIRST_ROWS
    while left is None or left:
        found, left_now = {k: list(v) for k, v in reps.items()}, set()
        for r in search(first).collect():
            row = given_type(r)
            key = tuple(getattr(row, k) for k in keys)
            if row.stops:
                left_now.add(key)
            else:
                found.setdefault(key, []).append((_rank(row), row.dedupe_text, tuple(bytes(x) if isinstance(x, bytearray) else x for x in _features(row))))
        reps, left, first = {k: sorted(v, key=lambda r: r[0]) for k, v in found.items()}, left_now, first * 2
    return reps


def near_states(rows: DataFrame, keys: list[str], row_id: list[str], reps: dict[tuple, list[tuple]], config: Config) -> DataFrame:
    """``row_id`` and ``near`` of the rows that resemble an earlier representative or come after the last one there may be: where the rows are, in any order."""
    schema = StructType([*[rows.schema[c] for c in row_id], *StructType.fromDDL("near string").fields])
    row_type = namedtuple("Row", rows.columns)._make
    id_at = [rows.columns.index(c) for c in row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = _holding(reps, config)
        ranks = {key: [r[0] for r in listed] for key, listed in reps.items()}
        for batch in batches:
            at, states, before = [], [], {}
            for i, row in enumerate(_rows(batch, row_type)):
                key = tuple(getattr(row, k) for k in keys)
                k = bisect_left(ranks.get(key, ()), _rank(row))
                if (what := (key, k, row.dedupe_text)) not in before:
                    before[what] = holding.setdefault(key, Representatives(config)).state(row.dedupe_text, _features(row), k)
                if before[what]:
                    at.append(i)
                    states.append(before[what])
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(i) for i in id_at), pa.array(states, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def mark_near_duplicates(df: DataFrame, config: Config = Config()) -> DataFrame:
    """In rank order within a bucket, rows that resemble an earlier representative."""
    if not config.dedupe or not config.near_duplicates:
        return df
    keys = ["date", "dedupe_bucket"]
    open_ = (F.size("reject_reasons") == 0) & (F.size("use_for") > 0)
    slim = df.where(open_).select(*keys, "sample_id", "line_no", "event_time_ms", "final_score", "value_labels", "dedupe_text")
    row_id = ["date", "sample_id", "line_no"]
    rows = stored(with_text_features(slim, config))  # read by every search and by the last pass
    sizes = rows.groupBy(*keys).count().collect()
    small, large = ([tuple(r[k] for k in keys) for r in sizes if (r["count"] > FOLD_ROWS) == is_large] for is_large in (False, True))
    parts = []
    if small or not large:
        step = lambda state, row: (state.check(row.dedupe_text, _features(row)),)
        own = rows if not large else rows.where(~_among(keys, large))
        parts.append(fold(own, keys, rank_order(), lambda: Representatives(config), step, "near string", keep=row_id).where("near <> ''"))
    for i in range(0, len(large), BUCKETS):
        own = rows.where(_among(keys, large[i : i + BUCKETS]))
        parts.append(near_states(own, keys, row_id, find_representatives(own, keys, config), config))
    checked = stored(reduce(DataFrame.union, [p.select(*row_id, "near") for p in parts]))  # what follows reads it more than once
    found = checked.dropDuplicates(row_id)
    out = df.join(found, row_id, "left")
    out = out.withColumn("risk_labels", _add("risk_labels", F.coalesce(F.col("near") == "saturated", F.lit(False)), "dedupe_state_saturated"))
    return suppress(out, F.col("near") == "near", "near_duplicate_content", "near_duplicate").drop("near")


def _among(keys: list[str], buckets: list[tuple]) -> Column:
    """Rows of these buckets."""
    by: dict[tuple, list] = {}
    for *before, last in buckets:
        by.setdefault(tuple(before), []).append(last)
    return reduce(Column.__or__, (reduce(Column.__and__, (F.col(k) == v for k, v in zip(keys, before)), F.col(keys[-1]).isin(lasts)) for before, lasts in by.items()))


def mark_dedupe(annotated: DataFrame, config: Config = Config()) -> DataFrame:
    """Noise first, then near-duplicates over what it left."""
    noisy = mark_noise(with_dedupe_columns(use_for(annotated, config)), config)
    return mark_near_duplicates(noisy, config)


def duplicate_key(kind: str, text: str, response: Column) -> Column:
    """A hash that two rows of a kind share if they are the same: text, route and intent; for SFT the reply, for tool use the tools."""
    extra = {"sft": response, "tool_use_sft": F.to_json(F.sort_array("tool_names"))}.get(kind, F.lit(""))
    return F.sha2(F.to_json(F.array(F.col(text), F.col("route_label"), F.col("intent_label"), extra)), 256)


def with_kind_keys(df: DataFrame) -> DataFrame:
    """Adds kind_keys: for each kind a sample may be used for, whether it leaks and its duplicate keys. Selection needs no message texts besides."""
    leaks = lambda c: (F.col(c) != "") & t.leakage(F.col(c)).isNotNull()
    unsafe = {"router_classification": leaks("user_text"), "sft": leaks("user_text") | leaks("response_text") | F.col("history_unsafe"), "tool_use_sft": F.col("tool_unsafe")}
    normal = t.normalize_for_dedupe(F.col("response_text"))
    of = lambda kind: F.struct(F.lit(kind).alias("kind"), unsafe[kind].alias("unsafe"), duplicate_key(kind, "normalized", F.col("response_text")).alias("exact"), duplicate_key(kind, "dedupe_text", normal).alias("normal"))
    return df.withColumn("kind_keys", F.array_compact(F.array(*[F.when(F.array_contains("use_for", kind), of(kind)) for kind in KINDS])))


def candidates(marked: DataFrame) -> DataFrame:
    """A row per sample and kind it may be used for, with duplicate keys, leak flag and order columns; no message texts."""
    rows = marked.where(F.size("reject_reasons") == 0)
    rows = rows if "kind_keys" in marked.columns else with_kind_keys(rows)
    rows = rows.withColumn("k", F.explode("kind_keys")).where(F.array_contains("use_for", F.col("k.kind")))
    return rows.select(
        "date", "k.kind", "sample_id", "line_no", "event_time_ms", "final_score", "value_labels",
        F.coalesce(F.nullif(F.col("user_hash"), F.lit("")), F.lit("unknown")).alias("user"), F.col("task_fingerprint").alias("task"), "k.unsafe", "k.exact", "k.normal",
    )


class Selection:
    """Counters and keys of the rows emitted so far."""

    def __init__(self, config: Config) -> None:
        self.config, self.exact, self.normal, self.users, self.tasks, self.valued = config, set(), set(), {}, {}, {}

    def decide(self, row) -> str:
        c = self.config
        most = {"router_classification": c.max_router_per_user, "sft": c.max_sft_per_user}.get(row.kind, c.max_tool_use_per_user)
        valued = len(row.value_labels) > 0
        if self.users.get(row.user, 0) >= most or self.tasks.get(row.task, 0) >= c.max_per_task or valued and self.valued.get(row.task, 0) >= c.max_high_value_per_task:
            return "quota_exceeded"
        if row.exact in self.exact:
            return "duplicate_content"
        if c.dedupe and row.normal in self.normal:
            return "normalized_duplicate_content"
        if row.unsafe:
            return "leakage_scan_failed"
        self.exact.add(row.exact)
        out = "selected"
        if row.normal in self.normal or len(self.normal) < c.max_seen_hashes:
            self.normal.add(row.normal)
        elif c.dedupe:
            out = "selected_saturated"
        for counter, key in ((self.users, row.user), (self.tasks, row.task), *([(self.valued, row.task)] if valued else [])):
            counter[key] = counter.get(key, 0) + 1
        return out


def quota_free(rows: DataFrame, config: Config = Config()) -> bool:
    """Whether no quota and no cap can bind: then who is selected depends on duplicate keys alone."""
    value = F.when(F.size("value_labels") > 0, 1).otherwise(0)
    users = rows.groupBy("date", "kind", "user").count().groupBy("kind").agg(F.max("count").alias("n")).collect()
    tasks = rows.groupBy("date", "kind", "task").agg(F.count("*").alias("n"), F.sum(value).alias("v")).agg(F.max("n"), F.max("v")).first()
    keys = rows.groupBy("date", "kind").count().agg(F.max("count")).first()[0] or 0
    most = {"router_classification": config.max_router_per_user, "sft": config.max_sft_per_user, "tool_use_sft": config.max_tool_use_per_user}
    return all(r["n"] <= most[r["kind"]] for r in users) and (tasks[0] or 0) <= config.max_per_task and (tasks[1] or 0) <= config.max_high_value_per_task and keys <= config.max_seen_hashes


def decide_by_windows(rows: DataFrame, config: Config = Config()) -> DataFrame:
    """Decisions where no quota binds: of the rows with a key, the first safe one is selected; unsafe ones before it fail, later ones repeat it."""
    key = "normal" if config.dedupe else "exact"
    window = Window.partitionBy("date", "kind", key).orderBy(*rank_order())
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.when(~F.col("unsafe"), F.col("exact")), ignorenulls=True).over(running)
    earlier = F.sum(F.when(~F.col("unsafe"), 1).otherwise(0)).over(window.rowsBetween(Window.unboundedPreceding, -1))
    repeats = F.when(F.col("exact") == first, "duplicate_content").otherwise("normalized_duplicate_content")
    return rows.withColumn("decision", F.when(F.coalesce(earlier, F.lit(0)) > 0, repeats).when(F.col("unsafe"), "leakage_scan_failed").otherwise("selected"))


def decide_by_fold(rows: DataFrame, config: Config = Config()) -> DataFrame:
    """Decisions under quotas: a fold in rank order for each date and kind."""
    return fold(rows, ["date", "kind"], rank_order(), lambda: Selection(config), lambda state, row: (state.decide(row),), "decision string")


def select(marked: DataFrame, config: Config = Config()) -> DataFrame:
    """date, kind, sample_id, line_no, decision of every candidate."""
    rows = stored(candidates(marked))  # slim rows, used by the check of quotas and by the decision
    decided = decide_by_windows(rows, config) if quota_free(rows, config) else decide_by_fold(rows, config)
    return decided.select("date", "kind", "sample_id", "line_no", "decision")


def apply_decisions(marked: DataFrame, decided: DataFrame, config: Config = Config()) -> DataFrame:
    """Samples after selection: risks, uses and rejects that the decisions entail, and ``selected``, the kinds emitted.

    A duplicate loses one use, and is a reject once none is left; a leak rejects at once; a quota only marks.
    """
    per = decided.groupBy("date", "sample_id", "line_no").agg(F.collect_set(F.struct("kind", "decision")).alias("d"))
    out = marked.join(per, ["date", "sample_id", "line_no"], "left").withColumn("d", F.coalesce("d", F.expr("cast(array() as array<struct<kind:string,decision:string>>)")))
    with_ = lambda *names: F.transform(F.filter("d", lambda x: x["decision"].isin(*names)), lambda x: x["kind"])
    repeated, leaked = with_("duplicate_content", "normalized_duplicate_content"), with_("leakage_scan_failed")
    reasons = F.array_distinct(F.transform(F.filter("d", lambda x: x["decision"].isin("duplicate_content", "normalized_duplicate_content")), lambda x: x["decision"]))
    left = F.array_except("use_for", F.concat(leaked, repeated)) if config.dedupe else F.array_except("use_for", leaked)
    out = out.withColumns({"__repeated": repeated, "__leaked": leaked, "__left": left, "__reasons": reasons, "selected": with_("selected", "selected_saturated"), "__quota": F.size(with_("quota_exceeded")) > 0, "__full": F.size(with_("selected_saturated")) > 0})
    dup, leak = F.size("__repeated") > 0, F.size("__leaked") > 0
    risks = _add(_add(_add(_add("risk_labels", dup, "duplicate"), F.col("__quota"), "quota_exceeded"), leak, "leakage_scan_failed"), F.col("__full"), "dedupe_state_saturated")
    rejects = _add("reject_reasons", leak, "leakage_scan_failed")
    if config.dedupe:
        rejects = F.when(dup & (F.size("__left") == 0), F.array_union(rejects, "__reasons")).otherwise(rejects)
    return out.withColumns({"risk_labels": risks, "reject_reasons": rejects, "use_for": F.col("__left")}).drop("d", "__repeated", "__leaked", "__left", "__reasons", "__quota", "__full")


def episodes(samples: DataFrame, config: Config = Config()) -> DataFrame:
    """Runs of turns of one session, none further from the last than the gap; rows without time, user or session stand alone."""
    alone = F.col("event_time_ms").isNull() | (F.coalesce("user_hash", F.lit("")) == "") | (F.coalesce("session_hash", F.lit("")) == "")
    own = F.when(alone, F.concat_ws(":", "line_no", "sample_id"))
    session = Window.partitionBy("date", "user_hash", "session_hash", "__own").orderBy(*event_order())
    gap = F.col("event_time_ms") - F.lag("event_time_ms").over(session)
    rows = samples.withColumn("__own", own).withColumn("__new", F.when(gap <= config.episode_gap_minutes * 60_000, 0).otherwise(1))
    rows = rows.withColumn("__island", F.sum("__new").over(session.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    turn = F.struct("event_time_ms", "line_no", "sample_id", "route_label", "intent_label", "score_bucket", "user_text", "response_text")
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise("mixed")
    clean = (F.size("reject_reasons") == 0) & (F.col("final_score") >= 0.6)
    grouped = rows.groupBy("date", "user_hash", "session_hash", "__own", "__island").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.count("*").alias("turn_count"),
        one("route_label").alias("route_label"),
        one("intent_label").alias("intent_label"),
        F.min("final_score").alias("min_score"),
        F.max(F.coalesce("session_hash", F.lit("")) == "").alias("missing_session_fallback"),
        F.max(F.col("event_time_ms").isNull()).alias("index_order_only"),
        F.min(clean).alias("clean"),
        F.min((F.col("user_text") != "") & (F.col("response_text") != "")).alias("both_texts"),
        F.min(F.col("final_score") >= config.multi_turn_min_score).alias("good"),
    )
    ids = F.array_join(F.transform("turns", lambda x: x["sample_id"]), '","')
    episode = F.substring(F.sha2(F.concat(F.lit('{"source_date":"'), "date", F.lit('","turns":["'), ids, F.lit('"]}')), 256), 1, 32)
    eligible = (F.col("turn_count") > 1) & ~F.col("missing_session_fallback") & ~F.col("index_order_only") & F.col("clean")
    return grouped.select(
        episode.alias("episode_id"), "date", "turn_count", "route_label", "intent_label", t.score_bucket(F.col("min_score")).alias("score_bucket"), "min_score",
        "missing_session_fallback", "index_order_only", eligible.alias("eligible"), (eligible & F.col("both_texts") & F.col("good")).alias("exportable"), "turns",
    )


def multi_turn(built: DataFrame) -> DataFrame:
    """Eligible episodes as alternating messages; one unsafe turn drops the episode."""
    unsafe = F.exists("turns", lambda x: t.leakage(x["user_text"]).isNotNull() | t.leakage(x["response_text"]).isNotNull())
    pair = lambda x: F.array(F.struct(F.lit("user").alias("role"), x["user_text"].alias("content")), F.struct(F.lit("assistant").alias("role"), x["response_text"].alias("content")))
    return built.where(F.col("exportable") & ~unsafe).select("episode_id", "date", "turn_count", "route_label", "intent_label", "score_bucket", F.flatten(F.transform("turns", pair)).alias("messages"))
