"""Language-model scoring by masked pseudo-likelihood.

A small network looks at SPAN words on either side of a masked word and predicts the word; the log
probabilities of all words of a text, each masked in turn, sum to its score. A word's probability is
that of its class, by the network, times its share of the class, by its own count. The commonest words
are classes of their own, other words that the network knows share classes by frequency, and all
others share classes by hash; among the words around, these stand for their hash bucket. Counts of the
NEAR commonest words go where texts are scored; those of all others stay a distributed table that is
joined with the texts' words. A word that was never met would count once. The probabilities of all
words and of one unmet word a class of the last kind sum to one.

Vocabulary and shares come from the counts of all words of all documents. The network, in numpy, is
trained where the documents lie: each scan partition trains a copy on all its documents, copies are
averaged by their words, in two steps so that none gathers all, and a second round starts from the
average. So what training reads, what is
gathered and the words with counts grow with the corpus; only the network, its words and the NEAR
commonest counts reach the driver.

Cases: null, empty and white texts have no words, log_prob 0 and a null mean; texts of any length are
read whole; repeated rows get equal results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .wordhash import U, chunks, word_hashes

#: Words known by name, buckets of others; words seen on each side; classes alone, of known, of unknown words.
VOCABULARY, BUCKETS, SPAN = 4096, 512, 2
ALONE, KNOWN, UNKNOWN = 32, 24, 8
#: Sizes of embedding and hidden layer.
EMBED, HIDDEN = 16, 32
ROUNDS, RATE = 2, 0.1
#: Words in a step of training, at first and at last.
STEPS = 256, 2048
#: Words whose counts are sent to all tasks; the counts of others are joined.
NEAR = 65_536
#: Distinct words that a partition counts before it passes them on; tokens scored at once.
HELD, AT_ONCE = 500_000, 4096
#: Words of a partition that are put in random order at once.
TRAINED = 400_000


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of all words of all texts, and how often they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words of chunks wait until they are as many as those counted, so each is merged a few times only.
        words, times, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def merge() -> None:
            nonlocal words, times, waiting
            if waiting:
                found, counts = (np.concatenate([x, *(w[k] for w in waiting)]) for k, x in enumerate((words, times)))
                by_word = np.argsort(found)
                found, counts = found[by_word], counts[by_word]
                begins = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
                words, times, waiting = found[begins], np.add.reduceat(counts, begins) if len(begins) else counts, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(times)], names=["word", "n"])

        for batch in batches:
            for _, texts in chunks(batch.column("text").to_pylist()):
                waiting.append(np.unique(word_hashes(texts)[0].astype(np.int64), return_counts=True))
                if sum(len(w) for w, _ in waiting) > max(HELD // 4, len(words)):
                    merge()
                if len(words) > HELD:
                    yield out()
                    words, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        merge()
        yield out()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Ids of words, their classes, and their log shares of these; for a bucket, the share of a word met once.

    near, near_counts: words outside of words, with their counts.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, buckets: np.ndarray, near: np.ndarray | None = None, near_counts: np.ndarray | None = None):
        near = np.zeros(0, np.int64) if near is None else near
        by_hash = np.argsort(near)
        self.near, self.near_log = near[by_hash], np.log((np.zeros(0) if near_counts is None else near_counts)[by_hash].astype(np.float64))
        order = np.argsort(words)
        self.words = words[order]
        n = np.concatenate([counts[order], np.maximum(buckets, 0)]).astype(np.float64)
        self.size = len(n)
        self.cls = np.zeros(self.size, np.int64)
        by_count = np.argsort(-n[: len(words)], kind="stable")
        self.cls[by_count[:ALONE]] = np.arange(len(by_count[:ALONE]))
        rest = by_count[ALONE:]
        mass = np.cumsum(n[rest])
        self.cls[rest] = ALONE + np.minimum(KNOWN - 1, (KNOWN * (mass - n[rest]) / max(1.0, mass[-1] if len(mass) else 1.0)).astype(np.int64))
        self.cls[len(words) :] = ALONE + KNOWN + np.arange(len(buckets)) % UNKNOWN
        self.class_mass = np.bincount(self.cls, n, minlength=ALONE + KNOWN + UNKNOWN)
        self.class_mass[ALONE + KNOWN :] += 1  # a word that was never met
        n[len(words) :] = 1
        self.share = np.log(n / self.class_mass[self.cls])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        words = hashes.astype(np.int64)
        if not len(self.words):
            return len(self.words) + (hashes % U(BUCKETS)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, len(self.words) + (hashes % U(BUCKETS)).astype(np.int64))

    def near_logs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log counts of words that have no id of their own, and which of them are beyond near (with 0)."""
        words = hashes.astype(np.int64)
        if not len(self.near):
            return np.zeros(len(words)), np.ones(len(words), bool)
        at = np.minimum(np.searchsorted(self.near, words), len(self.near) - 1)
        far = self.near[at] != words
        return np.where(far, 0.0, self.near_log[at]), far

    def padded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words with SPAN marks of an edge between texts; where words lie, where each text's begin among them, and their hashes."""
        hashes, begins = word_hashes(texts)
        return *self.spaced(self.ids(hashes), begins), begins, hashes

    def spaced(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids with SPAN marks of an edge between texts, and where the words lie."""
        at = np.arange(len(ids)) + SPAN * (np.repeat(np.arange(len(begins) - 1), np.diff(begins)) + 1)
        out = np.full(len(ids) + SPAN * len(begins), self.size)
        out[at] = ids
        return out, at


OFFSETS = np.array([o for o in range(-SPAN, SPAN + 1) if o])


class Network:
    """Embeddings of the words around, a hidden layer, and scores of classes."""

    def __init__(self, vocabulary: Vocabulary):
        rng = np.random.default_rng(11)
        draw = lambda *shape: (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
        bias = np.log(np.maximum(vocabulary.class_mass, 1e-9) / vocabulary.class_mass.sum()).astype(np.float32)
        self.parts = [draw(vocabulary.size + 1, EMBED) * 8, draw(len(OFFSETS) * EMBED, HIDDEN), np.zeros(HIDDEN, np.float32), draw(HIDDEN, len(bias)) * 0.1, bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for i, p in enumerate(self.parts):
            self.parts[i] = flat[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        return self

    def train(self, ids: np.ndarray, at: np.ndarray, target: np.ndarray, squares: list[np.ndarray], seed: int, seen: int = 0) -> None:
        """One pass over the words at `at`, in random order, with adaptive steps, after `seen` words before.

        Steps grow with the words seen. Words are columns, so that sums over classes run along memory.
        """
        order = np.random.default_rng(seed).permutation(len(at))
        at, target, ids = at[order], target[order], ids.astype(np.uint16)
        embed, first, shift, second, bias = self.parts
        x_held, sorted_held = np.empty((STEPS[1] * len(OFFSETS), EMBED), np.float32), np.empty((STEPS[1] * len(OFFSETS), EMBED), np.float32)
        begin = 0
        while begin < len(order):
            step = min(STEPS[1], max(STEPS[0], 1 << ((seen + begin) // 64).bit_length()))
            around = ids[at[begin : begin + step, None] + OFFSETS].ravel()
            own = target[begin : begin + step]
            begin += step
            n, scale = len(own), np.float32(1 / len(own))
            x = np.take(embed, around, axis=0, out=x_held[: len(around)], mode="clip").reshape(n, -1)
            hidden = first.T @ x.T
            hidden += shift[:, None]
            np.tanh(hidden, out=hidden)
            share = second.T @ hidden
            share += bias[:, None]
            share -= share.max(axis=0)
            np.exp(share, out=share)
            share *= 1 / share.sum(axis=0)
            share[own, np.arange(n)] -= 1
            back = second @ share
            back *= 1 - hidden * hidden
            slopes = [(back @ x).T * scale, back.sum(axis=1) * scale, hidden @ share.T * scale, share.sum(axis=1) * scale]
            to_embed = (back.T @ first.T).reshape(-1, EMBED)
            for part, slope, square in zip(self.parts[1:], slopes, squares[1:], strict=True):
                square += slope * slope
                part -= RATE * slope / np.sqrt(square)
            # Ids have 16 bits, which sort in linear time.
            by_id = np.argsort(around, kind="stable")
            around = around[by_id]
            begins = np.flatnonzero(np.append(True, around[1:] != around[:-1]))
            rows = around[begins]
            slope = np.add.reduceat(np.take(to_embed, by_id, axis=0, out=sorted_held[: len(by_id)], mode="clip"), begins, axis=0) * scale
            square = squares[0][rows] + slope * slope
            squares[0][rows] = square
            slope /= np.sqrt(square, out=square)
            slope *= np.float32(RATE)
            embed[rows] -= slope

    def squares(self) -> list[np.ndarray]:
        return [np.full(p.shape, 1e-4, np.float32) for p in self.parts]

    def tables(self) -> list[np.ndarray]:
        """What each id adds to the hidden layer at each offset."""
        embed, first = self.parts[:2]
        return [np.ascontiguousarray(embed @ first[k * EMBED : (k + 1) * EMBED]) for k in range(len(OFFSETS))]

    def log_classes(self, ids: np.ndarray, at: np.ndarray, target: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Log probability of the class of every word, from both sides."""
        out = np.empty(len(at))
        for begin in range(0, len(at), AT_ONCE):
            here = at[begin : begin + AT_ONCE]
            hidden = tables[0][ids[here + OFFSETS[0]]]
            for k in range(1, len(OFFSETS)):
                hidden += tables[k][ids[here + OFFSETS[k]]]
            hidden += self.parts[2]
            np.tanh(hidden, out=hidden)
            scores = self.parts[3].T @ hidden.T
            scores += self.parts[4][:, None]
            scores -= scores.max(axis=0)
            own = scores[target[begin : begin + AT_ONCE], np.arange(len(here))]
            np.exp(scores, out=scores)
            out[begin : begin + AT_ONCE] = own - np.log(scores.sum(axis=0))
        return out


def _averaged(copies: DataFrame) -> np.ndarray | None:
    """The mean of networks (part, weight, flat) by weight, in two steps of about the root of their number, in the order of part."""

    def mean(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        weight = np.array(group.column("weight").to_pylist(), np.float64)
        total = np.zeros(1)
        for w, flat in zip(weight, group.column("flat").to_pylist(), strict=True):
            total = total + w * np.frombuffer(flat, np.float32)
        return pa.table({"part": group.column("part")[:1], "weight": [weight.sum()], "flat": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())})

    fields = "part long, weight double, flat binary"
    copies = materialize(copies, "copies")
    groups = max(1, math.isqrt(copies.count()))
    some = copies.groupBy(F.pmod("part", F.lit(groups)).alias("group")).applyInArrow(mean, fields)
    found = some.groupBy(F.lit(0).alias("all")).applyInArrow(mean, fields).first()
    return None if found is None else np.frombuffer(found["flat"], np.float32)


def learned(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and (word, n) of all words."""
    counts = materialize(counted(docs), "words")
    known = counts.orderBy(F.col("n").desc(), "word").limit(VOCABULARY + NEAR).toPandas()
    known, near = known[:VOCABULARY], known[VOCABULARY:]
    per_bucket = np.zeros(BUCKETS)
    # Hashes are unsigned: the bucket is the lowest bits.
    for r in counts.groupBy(F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        per_bucket[r["bucket"]] = r["n"]
    words, n = known["word"].to_numpy(np.int64), known["n"].to_numpy(np.int64)
    np.subtract.at(per_bucket, words & (BUCKETS - 1), n)
    return Vocabulary(words, n, per_bucket, near["word"].to_numpy(np.int64), near["n"].to_numpy(np.int64)), counts


def _binary(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Runs of values as binaries, from where each begins (one more than runs)."""
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer((begins * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column that _binary made, and where each row's begin."""
    size, buffers = np.dtype(dtype).itemsize, column.buffers()
    at = np.frombuffer(buffers[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(buffers[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return np.frombuffer(values.tobytes(), dtype), (at - at[0]) // size


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """row (a number of its own), doc_id, ids of its words, and the hashes of those that share an id; written, as it is read three times."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for begin, texts in chunks(batch.column("text").to_pylist()):
                hashes, begins = word_hashes(texts)
                ids = vocabulary.ids(hashes)
                other = ids >= len(vocabulary.words)
                others = np.concatenate(([0], np.cumsum(other)))[begins]
                rows = pa.array(np.arange(row, row + len(texts)))
                row += len(texts)
                yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id").slice(begin, len(texts)), _binary(ids.astype(np.uint16), begins), _binary(hashes[other], others)], names=["row", "doc_id", "ids", "others"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "row long, doc_id long, ids binary, others binary")
    return materialize(some, "word-ids")


def trained(texts: DataFrame, vocabulary: Vocabulary) -> Network:
    """The network, from all rows of encoded texts."""
    network = Network(vocabulary)
    for turn in range(ROUNDS):
        shared = texts.sparkSession.sparkContext.broadcast((vocabulary, network))

        def copy(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            vocabulary, network = shared.value
            network = Network(vocabulary).load(network.flat())
            squares, seen = network.squares(), 0
            for batch in batches:
                values, begins = _values(batch.column("ids"), np.uint16)
                cuts = np.append(np.unique(np.searchsorted(begins, np.arange(0, begins[-1], TRAINED))), len(begins) - 1)
                for a, b in zip(cuts, cuts[1:], strict=False):
                    ids, at = vocabulary.spaced(values[begins[a] : begins[b]], begins[a : b + 1] - begins[a])
                    network.train(ids, at, vocabulary.cls[ids[at]], squares, turn * 1000 + seen % 997, seen)
                    seen += len(at)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(seen)]), pa.array([network.flat().tobytes()], pa.binary())], names=["part", "weight", "flat"])

        flat = _averaged(texts.select("ids").mapInArrow(copy, "part long, weight double, flat binary"))
        if flat is not None:
            network = Network(vocabulary).load(flat)
    return network


def train(docs: DataFrame) -> tuple[Vocabulary, Network, DataFrame]:
    """The vocabulary, the network, and (word, n) of all words."""
    vocabulary, counts = learned(docs)
    return vocabulary, trained(encoded(docs, vocabulary), vocabulary), counts


def scored(docs: DataFrame, vocabulary: Vocabulary, network: Network, counts: DataFrame) -> DataFrame:
    """doc_id, n_words, log_prob, mean_log_prob of every row of docs."""
    return _scored(encoded(docs, vocabulary), vocabulary, network, counts)


def _scored(texts: DataFrame, vocabulary: Vocabulary, network: Network, counts: DataFrame) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network = shared.value
        tables = network.tables()
        for batch in batches:
            values, begins = _values(batch.column("ids"), np.uint16)
            hashes, _ = _values(batch.column("others"), np.uint64)
            ids, at = vocabulary.spaced(values, begins)
            logs = network.log_classes(ids, at, vocabulary.cls[values], tables) + vocabulary.share[values]
            other = np.flatnonzero(values >= len(vocabulary.words))
            more, far = vocabulary.near_logs(hashes)
            logs[other] += more
            sums = np.diff(np.concatenate(([0.0], np.cumsum(logs)))[begins])
            words = pa.ListArray.from_arrays(pa.array(np.searchsorted(other[far], begins), pa.int32()), pa.array(hashes[far].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(np.diff(begins)), pa.array(sums), words], names=["row", "doc_id", "n_words", "sums", "words"])

    some = materialize(texts.mapInArrow(run, "row long, doc_id long, n_words long, sums double, words array<long>"), "scores")
    # Words met once add nothing.
    logs = counts.filter("n > 1").select("word", F.log("n").alias("log_n"))
    far = some.select("row", F.explode("words").alias("word")).join(logs.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum("log_n").alias("more"))
    log_prob = F.col("sums") + F.coalesce("more", F.lit(0.0))
    found = some.drop("words").join(far, "row", "left").select("doc_id", "n_words", log_prob.alias("log_prob"))
    return found.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def score(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of the same documents."""
    vocabulary, counts = learned(docs)
    texts = encoded(docs, vocabulary)
    return _scored(texts, vocabulary, trained(texts, vocabulary), counts)
