"""Lexical retrieval packing: windows filled with a document's neighbours in a BM25 index.

Texts become token ids once, which are written. A first pass over them counts in how many of all
documents each id lies, and the mean length. Then every partition is dealt with as it is read, in
shards of at most SHARD_TOKENS tokens or SHARD_DOCS documents, so only counts are shuffled and memory
is bounded; a seed's neighbours are sought in its own shard. A shard has an inverted index of its
documents' token ids with BM25 weights by the counts of all documents. The first document that isn't
used up is the seed of the next window: what it has left comes first, then all documents of the shard
that have tokens left and share any id with it, most alike first, until the window is full; only if
none shares an id, others in order. The last piece of a window is cut where the window ends and the
rest of its document stays for later, so every window is full. What is left at a shard's end is cut
into windows whose sizes are powers of two, which need no padding.

Cases: a null or empty text is a document of the end id only; a text longer than a window fills whole
windows by itself first; documents that are equally alike come in the order of the scan; ids may be
null or repeat, each row is packed; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, materialize
from .tokens import encoder

#: Tokens in a window, and the id that ends a document.
WINDOW, END_ID = 2048, 1
SHARD_TOKENS, SHARD_DOCS = 3_000_000, 4096
K1, B = 1.2, 0.75
#: A term in more than one of DENSE documents is common; seeds scored at once.
DENSE, AHEAD = 8, 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Index:
    """BM25 weights of a shard's documents by term. whole: df by term, number and mean length of all documents, if there are others.

    Terms of many documents are rows of a dense matrix, so that AHEAD seeds are scored by one matrix
    product; those of few have lists. Columns of documents that are used up are dropped by halves.
    """

    def __init__(self, docs: list[np.ndarray], whole: tuple[np.ndarray, int, float] | None = None):
        found = [np.unique(d, return_counts=True) for d in docs]
        sizes = np.array([len(t) for t, _ in found])
        self.at = np.concatenate(([0], np.cumsum(sizes)))
        self.terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        times = np.concatenate([c for _, c in found]).astype(np.float64)
        lengths = np.array([len(d) for d in docs], np.float64)
        holder = np.repeat(np.arange(len(docs)), sizes)
        here = np.bincount(self.terms)
        df, n, mean = whole or (here, len(docs), lengths.mean())
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[self.terms] * times * (K1 + 1) / (times + K1 * (1 - B + B * (lengths / mean)[holder]))
        common = np.flatnonzero(here * DENSE > len(docs))
        self.row = np.full(len(here), -1)
        self.row[common] = np.arange(len(common))
        row = self.row[self.terms]
        self.dense = np.zeros((len(common), len(docs)), np.float32)
        self.dense[row[row >= 0], holder[row >= 0]] = weight[row >= 0]
        rare = np.flatnonzero(row < 0)
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        self.holders, self.weights = holder[rare], weight[rare]
        self.lists = np.searchsorted(self.terms[rare], np.arange(len(here) + 1))
        #: Documents by column, and scores of the seeds that were scored ahead.
        self.live, self.ahead = np.arange(len(docs)), {}

    def _drop(self, left: np.ndarray) -> None:
        keep = left[self.live] > 0
        kept = keep[self.holders]
        self.lists = np.concatenate(([0], np.cumsum(kept)))[self.lists]
        self.holders, self.weights = (np.cumsum(keep) - 1)[self.holders[kept]], self.weights[kept]
        self.dense, self.live = np.ascontiguousarray(self.dense[:, keep]), self.live[keep]

    def _score(self, seeds: list[int]) -> None:
        """Scores of all documents with a column, for every seed."""
        asked = np.zeros((len(seeds), len(self.dense)), np.float32)
        own = [self.terms[self.at[d] : self.at[d + 1]] for d in seeds]
        for i, terms in enumerate(own):
            rows = self.row[terms]
            asked[i, rows[rows >= 0]] = 1
        scores = asked @ self.dense
        for score, terms in zip(scores, own, strict=True):
            terms = terms[self.row[terms] < 0]
            spans = [(a, b) for a, b in zip(self.lists[terms].tolist(), self.lists[terms + 1].tolist(), strict=True) if a < b]
            if spans:
                score += np.bincount(np.concatenate([self.holders[a:b] for a, b in spans]), np.concatenate([self.weights[a:b] for a, b in spans]), len(score)).astype(np.float32)
        self.ahead = {d: (self.live, score) for d, score in zip(seeds, scores, strict=True)}

    def neighbours(self, doc: int, left: np.ndarray) -> Iterator[int]:
        """All documents with tokens left that share a term with doc, most alike first, equal ones by number; left must not fall but for those given."""
        if doc not in self.ahead:
            if np.count_nonzero(left) * 2 < len(self.live):
                self._drop(left)
            self._score([doc, *(doc + 1 + np.flatnonzero(left[doc + 1 :] > 0)[: AHEAD - 1]).tolist()])
        live, score = self.ahead.pop(doc)
        open_ = (score > 0) & (left[live] > 0) & (live != doc)
        live, score, most = live[open_], score[open_], 32
        while len(live):
            if len(live) > most:
                near = score >= np.partition(score, len(score) - most)[len(score) - most]
            else:
                near = np.ones(len(live), bool)
            yield from live[near][np.argsort(-score[near], kind="stable")].tolist()
            live, score, most = live[~near], score[~near], most * 4


def pack(docs: list[np.ndarray], window: int = WINDOW, whole: tuple[np.ndarray, int, float] | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of pieces (document, start, length); every id of docs lies in exactly one."""
    sizes = np.array([len(d) for d in docs])
    left, index, last = sizes.copy(), Index(docs, whole), []
    for seed in range(len(docs)):
        while left[seed] >= window:
            yield [(seed, int(sizes[seed] - left[seed]), window)]
            left[seed] -= window
        if not left[seed]:
            continue
        pieces, room = [], window

        def take(doc: int) -> None:
            nonlocal room
            n = int(min(room, left[doc]))
            if n:
                pieces.append((doc, int(sizes[doc] - left[doc]), n))
                left[doc] -= n
                room -= n

        take(seed)
        for doc in index.neighbours(seed, left):
            take(doc)
            if not room:
                break
        after = seed + 1
        while room and after < len(docs):
            take(after)
            after += 1
        if room:
            last = pieces
        else:
            yield pieces
    # Only the last window may have room; every document is used up then.
    total = sum(n for _, _, n in last)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        pieces = []
        while size:
            doc, start, n = last[0]
            part = min(n, size)
            pieces.append((doc, start, part))
            last[0:1] = [(doc, start + part, n - part)] if n > part else []
            size -= part
        yield pieces


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (four bytes each) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in in_parts(batches):
            ids = [np.append(encode(text or ""), END_ID).astype("<u4").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def counted(tokens: DataFrame) -> tuple[np.ndarray, int, float] | None:
    """In how many documents every id lies, their number, and their mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(0, np.int64), 0, 0
        for batch in in_parts(batches):
            docs = [np.frombuffer(ids, "<u4") for ids in batch.column("ids").to_pylist()]
            if docs:
                more = np.bincount(np.concatenate([np.unique(d) for d in docs]))
                df, more = (np.pad(x, (0, max(len(df), len(more)) - len(x))) for x in (df, more))
                df, n, length = df + more, n + len(docs), length + sum(map(len, docs))
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, (-1, -2)).astype(np.int64)), pa.array(np.append(df[met], (n, length)).astype(np.int64))], names=["term", "n"])

    found = tokens.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    by = dict(zip(found["term"].tolist(), found["n"].tolist(), strict=True))
    n, length = by.pop(-1, 0), by.pop(-2, 0)
    if not n:
        return None
    df = np.zeros(max(by) + 1, np.int64)
    df[list(by)] = list(by.values())
    return df, n, length / n


def packed(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = materialize(tokenized(docs, path), "tokens")
    shared = docs.sparkSession.sparkContext.broadcast(counted(tokens))

    def shard(ids: list, docs: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        columns: list[list] = [[] for _ in range(7)]
        count = 0
        for pieces in pack(docs, window, shared.value):
            offset = 0
            for doc, start, n in pieces:
                crc = zlib.crc32(docs[doc][start : start + n].astype("<u4").tobytes())
                for column, value in zip(columns, (ids[doc], start, n, crc, len(docs[doc]), first + count, offset), strict=True):
                    column.append(value)
                offset += n
            count += 1
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]), first + count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Up to 2^32 windows a partition; a partition that is read again gives the same ones.
        first = TaskContext.get().partitionId() << 32
        ids, held, tokens = [], [], 0
        for batch in in_parts(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids.append(doc_id)
                held.append(np.frombuffer(raw, "<u4"))
                tokens += len(held[-1])
                if tokens >= SHARD_TOKENS or len(ids) >= SHARD_DOCS:
                    out, first = shard(ids, held, first)
                    yield out
                    ids, held, tokens = [], [], 0
        if ids:
            yield shard(ids, held, first)[0]

    return tokens.mapInArrow(run, SCHEMA)
