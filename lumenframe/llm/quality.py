"""Quality classifier from weak labels.

Eleven heuristic labellers look at a text and each vote good, bad or nothing. Their votes overlap, so
how often each is right can be estimated without any true label: expectation-maximisation over the
counts of vote patterns of all documents finds the share of good texts and, for each labeller, how
often it votes good on good and on bad texts; what it starts from counts as HELD votes. The posteriors of a bounded sample of documents then
train a logistic scorer on hashed features: words, word shapes, and coarse values of what the
labellers measure. The scorer rates every document from its whole text.

Only pattern counts (at most 3^11 rows), the sample's features and the weights leave the executors.

Cases: null, empty and white texts have no votes and no features but their emptiness, and aren't
kept; texts of any length are read whole; a text that scores THRESHOLD exactly is kept; repeated rows
get equal results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts

#: Hash buckets of features, documents in the training sample, texts' tokens remembered.
BUCKETS, SAMPLE, CACHE = 1 << 16, 6000, 200_000
THRESHOLD = 0.5

#: What is measured of a text, and the labellers: (measure, bad below or above, good below or above).
#: Bounds are (low, high): bad outside of the first pair, good inside of the second.
LABELLERS = {
    "letters": ((0.5, 1.01), (0.7, 1.01)),
    "symbols": ((-1, 0.08), (-1, 0.03)),
    "capitals": ((-1, 0.5), (-1, 0.25)),
    "capital_words": ((-1, 0.5), (-1, 0.25)),
    "distinct_words": ((0.25, 1.01), (0.45, 1.01)),
    "top_word": ((-1, 0.2), (-1, 0.12)),
    "distinct_pairs": ((0.4, 1.01), (0.7, 1.01)),
    "repeats": ((-1, 0.3), (-1, 0.1)),
    "distinct_lines": ((0.6, 1.01), (0.85, 1.01)),
    "symbol_words": ((-1, 0.3), (-1, 0.1)),
    "word_length": ((1.5, 16), (2.5, 10)),
}
#: Words below which a measure says too little: no vote.
FEW = {"letters": 12, "symbols": 8, "capitals": 8, "capital_words": 8, "distinct_words": 25, "top_word": 25, "distinct_pairs": 12, "repeats": 8, "distinct_lines": 25, "symbol_words": 8, "word_length": 20}
#: How often a labeller votes good on bad and on good texts, before any vote is seen, and the number of
#: votes that this counts as; the same for the share of good texts.
BEFORE, SHARE, HELD = (0.5, 0.995), 0.85, 20
NAMES = tuple(LABELLERS)


def shape(token: str) -> str:
    """Kinds of characters in order, runs as one: `Aa,` of `Word,`."""
    return "".join(k for k, _ in groupby(("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c for c in token))


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


class Reader:
    """Turns texts into measures and features; remembers tokens, and the few kinds that they come in."""

    def __init__(self, features: bool = True) -> None:
        self.features = features
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.kind_of, self.word_of = array("q"), array("q")
        self.kinds: dict[tuple, int] = {}
        #: Of each kind: characters, letters, capitals, symbols, whether it counts as a word of symbols, of capitals; and its shape.
        self.facts, self.shape_of = np.zeros((1024, 6)), np.zeros(1024, np.int64)
        self.shapes: dict[str, int] = {}
        self.shape_buckets: list[int] = []

    def kind(self, key: tuple, facts: tuple, form: str) -> int:
        if form not in self.shapes:
            self.shapes[form] = len(self.shapes)
            self.shape_buckets.append(bucket("s:" + form))
        i = self.kinds[key] = len(self.kinds)
        if i == len(self.facts):
            self.facts, self.shape_of = np.concatenate([self.facts, self.facts * 0]), np.concatenate([self.shape_of, self.shape_of * 0])
        self.facts[i], self.shape_of[i] = facts, self.shapes[form]
        return i

    def token(self, token: str) -> int:
        i = self.at[token] = len(self.kind_of)
        word = token[:-1] if token[-1] in ".,;:" else token
        if word.isalpha() and (word[1:].islower() or len(word) == 1):
            key = (len(token), len(word), word[0].isupper(), token[len(word) :])
            kind = self.kinds.get(key)
            if kind is None:
                kind = self.kind(key, (len(token), len(word), int(word[0].isupper()), 0, 0, 0), shape(token))
        else:
            letters, symbols = sum(map(str.isalpha, token)), sum(not c.isalnum() and c not in ".,;:?'\"()-" for c in token)
            capitals = sum(map(str.isupper, token))
            facts = (len(token), letters, capitals, symbols, int(3 * symbols > len(token) or not any(map(str.isalnum, token))), int(1 < letters == capitals))
            form = shape(token)
            kind = self.kinds.get((*facts, form))
            if kind is None:
                kind = self.kind((*facts, form), facts, form)
        self.kind_of.append(kind)
        self.word_of.append(bucket("w:" + token.lower()) if self.features else 0)
        return i

    def read(self, text: str | None) -> tuple[list[float] | None, int, np.ndarray, np.ndarray]:
        """Measures in the order of NAMES (None without words), words, buckets, and their values."""
        tokens = (text or "").split()
        if not tokens:
            return None, 0, np.array([bucket("empty")]), np.ones(1)
        if len(self.at) > CACHE:
            self.forget()
        get, new = self.at.get, self.token
        at = np.array([new(t) if (i := get(t)) is None else i for t in tokens])
        n = len(at)
        distinct, times = np.unique(at, return_counts=True)
        kinds = np.frombuffer(self.kind_of, np.int64)[distinct]
        chars, letters, capitals, symbols, odd, loud = times @ self.facts[kinds]
        lines = [x for x in text.split("\n") if x.strip()]
        pairs = len(np.unique(at[1:] * (CACHE * 4) + at[:-1])) / (n - 1) if n > 1 else 1.0
        repeats = float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0
        measures = [letters / chars, symbols / chars, capitals / max(1, letters), loud / n, len(distinct) / n, times.max() / n, pairs, repeats, len(set(lines)) / max(1, len(lines)), odd / n, chars / n]
        if not self.features:
            return measures, n, np.zeros(0), np.zeros(0)
        shapes = np.bincount(self.shape_of[kinds], weights=times)
        there = np.flatnonzero(shapes)
        size = min(4, n.bit_length() // 2)
        coarse = [bucket(f"m:{name}:{0 if n < FEW[name] else round(value * (4 if name == 'word_length' else 20)) + 1}:{size}") for name, value in zip(NAMES, measures, strict=True)]
        # Words weigh little each, and together no more than a measure.
        return measures, n, np.concatenate([np.frombuffer(self.word_of, np.int64)[distinct], [self.shape_buckets[i] for i in there], coarse]).astype(np.int64), np.concatenate([times / n, np.sqrt(shapes[there] / n), np.ones(len(coarse))])


def votes(measures: list[float] | None, words: int) -> list[int]:
    """Per labeller 1 good, 0 bad, 2 nothing."""
    if measures is None:
        return [2] * len(NAMES)
    out = []
    for name, value in zip(NAMES, measures, strict=True):
        (low, high), (good_low, good_high) = LABELLERS[name]
        out.append(2 if words < FEW[name] else 0 if not low <= value <= high else 1 if good_low <= value <= good_high else 2)
    return out


def code(vote: list[int]) -> int:
    return sum(v * 3**i for i, v in enumerate(vote))


def decode(pattern: int) -> list[int]:
    return [pattern // 3**i % 3 for i in range(len(NAMES))]


class Labels:
    """The share of good texts and the labellers' rates, by expectation-maximisation over pattern counts."""

    def __init__(self, counts: dict[int, int], rounds: int = 200):
        patterns = np.array([decode(p) for p in counts], np.int64).reshape(-1, len(NAMES))
        n = np.array(list(counts.values()), np.float64)
        good, bad = (patterns == 1).astype(float), (patterns == 0).astype(float)
        self.share, self.rates = SHARE, np.tile([[x] for x in BEFORE], len(NAMES))  # P(votes good | bad), P(votes good | good)
        for _ in range(rounds if len(n) else 0):
            weight = self._posterior(good, bad)
            for c, w in enumerate((n * (1 - weight), n * weight)):
                self.rates[c] = (w @ good + HELD * BEFORE[c]) / (w @ (good + bad) + HELD)
            self.share = (n @ weight + HELD * SHARE) / (n.sum() + HELD)

    def _posterior(self, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        logs = [good @ np.log(r) + bad @ np.log1p(-r) for r in np.clip(self.rates, 1e-4, 1 - 1e-4)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)) * (1 - self.share) / self.share)

    def posterior(self, pattern: int) -> float:
        vote = np.array([decode(pattern)])
        return float(self._posterior((vote == 1).astype(float), (vote == 0).astype(float))[0])


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with adaptive steps."""
    weights, seen, bias = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2), 0.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value, label = rows[i]
            miss = 1 / (1 + np.exp(-np.clip(weights[at] @ value + bias, -30, 30))) - label
            slope = miss * value + decay * weights[at]
            seen[at] += slope * slope
            weights[at] -= rate * slope / np.sqrt(seen[at])
            bias -= 0.02 * miss
    return weights, bias


def _patterns(docs: DataFrame, fields: str, features: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(features)
        for batch in in_parts(batches):
            found = []
            for text in batch.column("text").to_pylist():
                measures, n, at, value = reader.read(text)
                found.append((code(votes(measures, n)), at, value))
            columns = [pa.array([x for x, _, _ in found], pa.int32())]
            if features:
                columns += [pa.array([x.astype(np.int32).tobytes() for _, x, _ in found], pa.binary()), pa.array([x.astype(np.float32).tobytes() for _, _, x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "at", "value"][: len(columns)])

    return docs.select("text").mapInArrow(run, fields)


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[Labels, np.ndarray, float]:
    """Labels from all documents, and the scorer's weights from about `sample` different ones, chosen by a hash of id and text."""
    counted = _patterns(docs, "pattern int", False).groupBy("pattern").agg(F.count("*").alias("n")).collect()
    labels = Labels({r["pattern"]: r["n"] for r in counted})
    total = sum(r["n"] for r in counted)
    rate = int(min(1.0, sample / max(1, total)) * (1 << 24))
    chosen = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id", "text", F.lit("quality")), F.lit(1 << 24)) < rate).dropDuplicates(["doc_id", "text"])
    rows = _patterns(chosen, "pattern int, at binary, value binary", True).toPandas()
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32).astype(np.float64), labels.posterior(p)) for p, a, v in zip(rows["pattern"], rows["at"], rows["value"], strict=True)]
    return labels, *train_scorer(rows)


def scored(docs: DataFrame, labels: Labels, weights: np.ndarray, bias: float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, weak (posterior of the votes), score and keep of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((labels, weights, bias))
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = kept.drop("_text").schema.add("weak", "double").add("score", "double").add("keep", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights, bias = shared.value
        reader, known = Reader(), {}
        for batch in in_parts(batches):
            weak, score = [], []
            for text in batch.column("_text").to_pylist():
                measures, n, at, value = reader.read(text)
                pattern = code(votes(measures, n))
                if pattern not in known:
                    known[pattern] = labels.posterior(pattern)
                weak.append(known[pattern])
                score.append(float(1 / (1 + np.exp(-np.clip(weights[at] @ value + bias, -30, 30)))) if measures else 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(weak, pa.float64()), pa.array(score, pa.float64()), pa.array([s >= THRESHOLD for s in score], pa.bool_())], names=[*keep, "weak", "score", "keep"])

    return kept.mapInArrow(run, schema)


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, weak, score, keep of every document, by a model of the same documents."""
    return scored(docs, *train(docs))


def accepted(docs: DataFrame, labels: Labels, weights: np.ndarray, bias: float) -> DataFrame:
    """The rows of docs that the scorer keeps."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        reader = Reader()
        for batch in in_parts(batches):
            keep = []
            for text in batch.column("text").to_pylist():
                measures, _, at, value = reader.read(text)
                keep.append(measures is not None and bool(weights[at] @ value + bias >= 0))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
