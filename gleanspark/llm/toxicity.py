"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters: a fixed lexicon; words, word beginnings and dense beginnings (one word in a hundred starts so) that a bounded sample of labelled documents
ties to toxic texts; patterns of style; and silence, when no term votes. Labels choose these candidate terms and give the balance of both classes, nothing else: they
don't vote, nor does the label model see them. It takes votes as drawn given a hidden label: EM, started from how many terms vote, estimates each voter's rates
under both labels from the voters' agreement alone, and the correlation of voters' residuals discounts those that repeat each other. A logistic classifier over
votes, vote counts and style is trained on the posterior labels.

Training reads at most ``max_docs`` labelled documents, those with the smallest seeded hash of doc_id; rows that repeat one of these ids count once,
with the least text, and so do near copies among them. Scoring reads every whole text. Null and empty texts have no votes and
score by the intercept alone. An empty table gives an empty result. Without any labelled row only the lexicon and the patterns vote. Columns of ``docs``
other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.simhash import fingerprints

#: Common insults, English, German, French, Spanish.
LEXICON = """
idiot idiots moron morons stupid loser losers scum pathetic worthless trash clown disgusting dumb imbecile jerk bastard
filthy vermin garbage ugly hate despicable
dummkopf trottel arschloch abschaum dreckig widerlich blödmann vollidiot schwachkopf
crétin imbécile connard salaud ordure débile pourriture minable
imbécil estúpido estúpida basura asqueroso asquerosa inútil tonto payaso escoria
""".split()
MAX_DOCS = 8000
#: A word ("="), beginning ("^") or dense beginning ("+") is a voter if so many distinct toxic documents of the sample have it, and at most one clean one for
#: each PURITY of them.
SUPPORT, PURITY, MAX_LEARNED = {"=": 3, "^": 6, "+": 3}, {"=": 6, "^": 20, "+": 6}, 400
BEGINNINGS = (4, 5, 6, 7)
#: A beginning is dense in a text if at least two words, and one in so many, start so.
DENSE = 100
#: Pattern voters; the last holds if words that begin like a term are dense.
STYLE = ("shouting", "bangs", "symbols", "dense terms")
WORDS = re.compile(r"[^\W\d_]+")
POOLED = 30
#: Correlations below are taken for noise.
NOISE = 0.2


def style_of(text: str) -> list[bool]:
    """Pattern voters that need no term: shouting, doubled exclamation marks, strings of symbols."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    lower = int(((raw >= 97) & (raw <= 122)).sum())
    return [upper > 20 and upper > lower, text.count("!!") >= 3, sum(text.count(x) for x in ("***", "$$$", "%%%", "###")) >= 3]


def n_words(text: str) -> int:
    """Words of a text, near enough for densities: white space is counted, not split at."""
    return text.count(" ") + text.count("\n") + 1


class Voters:
    """Finds words (kind "="), word beginnings ("^") and dense beginnings ("+") in whole texts by one automaton."""

    def __init__(self, terms: list[tuple[str, str]]) -> None:
        self.terms, self.automaton = terms, ahocorasick.Automaton()
        by_text: dict[str, list[tuple[int, str]]] = defaultdict(list)
        for k, (kind, term) in enumerate(terms):
            by_text[term].append((k, kind))
        for term, uses in by_text.items():
            self.automaton.add_word(term, (len(term), uses))
        self.automaton.make_automaton()

    def counts(self, text: str) -> tuple[dict[int, int], int, bool]:
        """(how often each term that votes occurs, words that a term begins, whether these are dense)."""
        low, out, starts = text.lower(), Counter(), set()
        for end, (n, uses) in self.automaton.iter(low):
            if (start := end - n + 1) and low[start - 1].isalpha():
                continue
            longer = end + 1 < len(low) and low[end + 1].isalpha()
            for k, kind in uses:
                if kind != "=" or not longer:
                    out[k] += 1
                    starts.add(start)
        least = max(2, -(-n_words(low) // DENSE))
        return {k: n for k, n in out.items() if self.terms[k][0] != "+" or n >= least}, len(starts), len(starts) >= least


@dataclass
class Model:
    terms: list[tuple[str, str]]
    weights: np.ndarray  # terms' votes, style, log count of all terms, intercept


def _features(voters: Voters, text: str) -> np.ndarray:
    m = len(voters.terms)
    x = np.zeros(m + len(STYLE) + 2)
    found, words, dense = voters.counts(text)
    x[list(found)] = 1
    x[m : m + len(STYLE)] = [*style_of(text), dense]
    x[-2] = np.log1p(words)
    x[-1] = 1
    return x


def distinct_texts(texts: list[str], bits: int = 8) -> list[int]:
    """Indices of texts without their near copies in the list."""
    joined = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)
    prints = fingerprints(np.frombuffer(b"".join(joined), dtype=np.uint8), at, 2)
    kept: list[int] = []
    for i, p in enumerate(prints):
        if not kept or np.bitwise_count(prints[kept] ^ p).min() > bits:
            kept.append(i)
    return kept


def learned_terms(texts: list[str], toxic: list[int]) -> list[tuple[str, str]]:
    """Terms that enough toxic and few enough clean texts have; of terms in the same texts, one: rather a word, else the longest."""
    hits: dict[tuple[str, str], list[int]] = defaultdict(list)
    clean: Counter = Counter()
    found = [Counter(w for w in WORDS.findall(text.lower()) if len(w) > 2) for text in texts]
    least = [max(2, -(-n_words(text) // DENSE)) for text in texts]

    def begun(i: int, among=None) -> Counter:
        """How many words of a text have each beginning."""
        out: Counter = Counter()
        for w, n in found[i].items():
            for k in BEGINNINGS:
                if len(w) >= k and (among is None or w[:k] in among):
                    out[w[:k]] += n
        return out

    for i in np.nonzero(toxic)[0].tolist():
        for w in found[i]:
            hits["=", w].append(i)
        for w, n in begun(i).items():
            hits["^", w].append(i)
            if n >= least[i]:
                hits["+", w].append(i)
    hits = {t: at for t, at in hits.items() if len(at) >= SUPPORT[t[0]]}
    begin = {term for kind, term in hits if kind != "="}
    for i in np.nonzero(np.array(toxic) == 0)[0].tolist():
        clean.update(("=", w) for w in found[i] if ("=", w) in hits)
        for w, n in begun(i, begin).items():
            clean.update([("^", w), ("+", w)] if n >= least[i] else [("^", w)])
    good = [t for t, at in hits.items() if clean[t] * PURITY[t[0]] <= len(at)]
    alike = {tuple(hits[t]): t for t in sorted(good, key=lambda t: ("^+=".index(t[0]), len(t[1]), t[1]))}
    return sorted(alike.values(), key=lambda t: (-len(hits[t]), t))[:MAX_LEARNED]


def label_model(votes: np.ndarray, start: np.ndarray, balance: float | None = None, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of label 1, rates under both labels, discounts) of votes, by EM from ``start``.

    A voter that does not fire abstains: terms of one language say nothing about texts in another. ``balance`` is the share of label 1 (none: that of ``start``). Rates of
    rare voters lean towards the mean of all voters (POOLED documents' worth of it).
    """
    q = np.clip(start.astype(float), 0.02, 0.98)
    prior = np.clip(q.mean() if balance is None else balance, 0.01, 0.99)
    for _ in range(rounds):
        rates = np.stack([_rates(1 - q, votes), _rates(q, votes)])
        expected = q[:, None] * rates[1] + (1 - q)[:, None] * rates[0]
        residual = votes - expected
        norm = np.sqrt((residual**2).sum(axis=0) + 1e-9)
        correlation = residual.T @ residual / np.outer(norm, norm)
        correlation[correlation < NOISE] = 0
        np.fill_diagonal(correlation, 1)
        discount = 1 / correlation.sum(axis=1)
        z = np.log(prior / (1 - prior)) + votes @ (discount * np.log(rates[1] / rates[0]))
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return q, rates, discount


def _rates(q: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """How often each voter fires among documents of weights ``q``."""
    fires, n = q @ votes, q.sum()
    return (fires + POOLED * max(fires.mean(), 0.01) / max(n, 1.0)) / (n + POOLED)


def fit_linear(x: np.ndarray, q: np.ndarray, rounds: int = 15, ridge: float = 0.2) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the last feature, the intercept, is not shrunk."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - q) + penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w - np.clip(np.linalg.solve(h, g), -4, 4)
    return w


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_docs: int = MAX_DOCS, seed: int = 3) -> Model:
    """A model from the labelled documents. At most ``max_docs`` of them reach the driver."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("__y"))
    known = known.orderBy(F.xxhash64(F.lit(seed), doc_id), doc_id).limit(max_docs).withColumnRenamed(doc_id, "__id")
    found = docs.join(F.broadcast(known), F.col(doc_id) == F.col("__id")).select("__id", F.coalesce(F.col(text), F.lit("")).alias("t"), "__y")
    rows = found.groupBy("__id").agg(F.min("t").alias("t"), F.first("__y").alias("__y")).toArrow()
    data = sorted(zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True))
    data = [data[i] for i in distinct_texts([x[1] for x in data])]
    texts, toxic = [x[1] for x in data], [x[2] for x in data]
    lexicon = [("=", w) for w in dict.fromkeys(LEXICON)]
    learned = [t for t in learned_terms(texts, toxic) if t not in lexicon]
    voters = Voters([*lexicon, *learned])
    m = len(voters.terms)
    if not texts:
        w = np.zeros(m + len(STYLE) + 2)
        w[:m], w[-1] = 3.0, -3.0
        return Model(voters.terms, w)
    x = np.array([_features(voters, t) for t in texts])
    votes = votes_of(x, m)
    used = votes.any(axis=0)
    q, _, _ = label_model(votes[:, used], start_of(x, m), float(np.mean(toxic)) if any(toxic) else 0.1)
    return Model(voters.terms, fit_linear(x, q))


def votes_of(x: np.ndarray, m: int) -> np.ndarray:
    """Votes of the ``m`` terms, the patterns of style, and silence."""
    return np.hstack([x[:, : m + len(STYLE)], ~x[:, :m].any(axis=1)[:, None]])


def start_of(x: np.ndarray, m: int) -> np.ndarray:
    """Where EM starts: no term 0, one 1/2, more 1."""
    return np.minimum(x[:, :m].sum(axis=1), 2) / 2


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and votes (how many terms vote) of every document."""
    terms, weights = model.terms, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(terms)
        for batch in batches:
            scores, votes = np.empty(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int32)
            for i, value in enumerate(batch.column(1)):
                x = _features(voters, value.as_py() or "")
                scores[i], votes[i] = x @ weights, int(x[: len(terms)].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(scores, -30, 30)))), pa.array(votes)], names=[doc_id, "score", "votes"])

    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType()), T.StructField("votes", T.IntegerType())])
    return docs.select(doc_id, text).mapInArrow(run, schema)
