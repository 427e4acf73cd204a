"""Language identification by words first, then by shorter and shorter character n-grams.

Training counts the words of labelled documents by language, and from them the n-grams of words with
a mark at either end. A known word adds its log frequency in each language to the document's scores.
An unknown word adds the mean log frequency of its n-grams of the longest length at which it has a
known one, from MAX_N down to 1. The softmax of the sums gives language and score.

Training reads at most about PER_LANG different texts of each language, chosen by a hash of the text at a
rate that each language's count sets; counts and choice run over the whole table, and copies of a text train once. Of each language the model
keeps its MAX_WORDS commonest words and MAX_GRAMS commonest n-grams of each length, so a small language
loses none to a large one, and what is broadcast is bounded by the number of languages.

Cases: null texts and texts without a letter are `und` with score 0; so is everything if nothing can
be learned from; repeated rows get equal results; languages that score alike go by name, the first wins; texts of any length are
read whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_parts, materialize

UNKNOWN = "und"
PER_LANG, MAX_WORDS, MAX_GRAMS, MAX_N = 3000, 60_000, 20_000, 5
#: Words that a prediction remembers before it starts anew.
CACHE = 150_000

#: Runs of letters and of numbers that are no digits, such as fractions and Roman numerals.
RUNS = re.compile(r"[^\W\d_]+")


def letter_runs(text: str) -> list[str]:
    """Runs of letters (`str.isalpha`)."""
    runs = RUNS.findall(text)
    if all(map(str.isalpha, runs)):
        return runs
    return [x for run in runs for x in "".join(c if c.isalpha() else " " for c in run).split()]


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def log_frequencies(counts: list[dict[str, int]], most: int, least: int = 1) -> tuple[dict[str, int], np.ndarray]:
    """The `most` commonest keys of each language, and their smoothed log frequencies less the mean over languages."""
    total: Counter = Counter()
    for c in counts:
        total.update(c)
    kept = sorted({k for c in counts for k in sorted((k for k in c if total[k] >= least), key=lambda k: (-c[k], k))[:most]})
    return logs_of(kept, np.array([[c.get(k, 0) for c in counts] for k in kept], float))


def logs_of(kept: list[str], table: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    """Places of keys, and their smoothed log frequencies by language less the mean over languages."""
    if not kept:
        return {}, np.zeros((0, 0), np.float32)
    logs = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * len(kept))
    return {k: i for i, k in enumerate(kept)}, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


class Model:
    """What is learned, and what it scores a text."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        """counts: language, word, times."""
        self.langs = sorted({lang for lang, _, _ in counts})
        words: list[dict[str, int]] = [{} for _ in self.langs]
        by_n = [[Counter() for _ in self.langs] for _ in range(MAX_N + 1)]
        at = {lang: i for i, lang in enumerate(self.langs)}
        for lang, word, times in counts:
            words[at[lang]][word] = times
            for n in range(1, MAX_N + 1):
                for gram in grams(word, n):
                    by_n[n][at[lang]][gram] += times
        # A word met once says less than its n-grams do.
        self.words, self.word_rows = log_frequencies(words, MAX_WORDS, least=2)
        self.grams = [log_frequencies(c, MAX_GRAMS) for c in by_n]
        self.forget()

    @classmethod
    def of_tables(cls, langs: list[str], tables: dict[int, tuple[list[str], np.ndarray]]) -> "Model":
        """A model from keys and their counts by language: of words under 0, of n-grams under their length."""
        model = cls([])
        none = [], np.zeros((0, len(langs)))
        model.langs = langs
        model.words, model.word_rows = logs_of(*tables.get(0, none))
        model.grams = [logs_of(*(tables.get(n, none) if n else none)) for n in range(MAX_N + 1)]
        model.forget()
        return model

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("raw", "cache", "rows")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.forget()

    def forget(self) -> None:
        self.raw: dict[str, int] = {}
        self.cache: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.langs)), np.float32)  # row 0: nothing to score
        self.n_rows = 1

    def word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return self.word_rows[known]
        for n in range(MAX_N, 0, -1):
            index, rows = self.grams[n]
            found = [index[g] for g in grams(word, n) if g in index]
            if found:
                return rows[found].mean(axis=0, dtype=np.float64).astype(np.float32)
        return np.zeros(len(self.langs), np.float32)

    def add(self, row: np.ndarray) -> int:
        if self.n_rows == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.n_rows] = row
        self.n_rows += 1
        return self.n_rows - 1

    def token(self, token: str) -> int:
        """The row of a run without white space: the sum over its words. Row 0 if it has no letter."""
        words = letter_runs(token.lower())
        if len(words) == 1:
            at = self.cache.get(words[0])
            if at is None:
                at = self.cache[words[0]] = self.add(self.word(words[0]))
        else:
            at = self.add(sum(map(self.word, words))) if words else 0
        self.raw[token] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNKNOWN, 0.0
        if self.n_rows > CACHE or len(self.raw) > 2 * CACHE:
            self.forget()
        get, token = self.raw.get, self.token
        at = [i for i in ((get(t) or token(t)) for t in text.split()) if i]
        if not at:
            return UNKNOWN, 0.0
        sums = self.rows[at].sum(axis=0, dtype=np.float64)
        best = int(sums.argmax())
        return self.langs[best], float(1 / np.exp(np.clip(sums - sums[best], -700, 0)).sum())


def _common(counted: DataFrame, langs: list[str], most: int) -> DataFrame:
    """(size, key, counts): of (lang, size, key, n) the keys that are among the `most` commonest of their size in any language, with their counts by language."""
    order = Window.partitionBy("lang", "size").orderBy(F.col("n").desc(), "key")
    kept = counted.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= most).select("size", "key").distinct()
    by = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    wide = counted.join(kept, ["size", "key"], "left_semi").groupBy("size", "key").agg(by.alias("by"))
    return wide.select("size", "key", F.array(*(F.coalesce(F.element_at("by", F.lit(lang)), F.lit(0)).cast("double") for lang in langs)).alias("counts"))


def train(labelled: DataFrame, per_lang: int = PER_LANG) -> Model:
    """A model from text and lang of rows doc_id, text, lang; rows without either are left out.

    Words and n-grams are counted in the cluster; only those that the model keeps reach the driver.
    """
    labelled = labelled.select("text", "lang").filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([])
    # The rate falls with a language's count: a hash below it chooses the same documents each time.
    rate = F.create_map(*(x for lang, n in counts.items() for x in (F.lit(lang), F.lit(per_lang / n))))
    chosen = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(rate, F.col("lang")) * (1 << 20)
    found = labelled.filter(chosen).select("text", "lang").distinct().select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("key"))
    words = materialize(found.groupBy("lang", "key").agg(F.count("*").alias("n")), "language-words")

    def runs(n: int) -> Column:
        marked = F.concat(F.lit("<"), F.col("key"), F.lit(">")) if n > 1 else F.col("key")
        last = F.char_length(marked) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.struct(F.lit(n).alias("size"), F.substring(marked, i, F.lit(n)).alias("gram")))).otherwise(F.array())

    parts = words.select("lang", "n", F.explode(F.flatten(F.array(*map(runs, range(1, MAX_N + 1))))).alias("part"))
    of_grams = materialize(parts.groupBy("lang", "part.size", F.col("part.gram").alias("key")).agg(F.sum("n").alias("n")), "language-grams")
    again = words.groupBy("key").agg(F.sum("n").alias("all")).filter("all > 1").select("key")
    langs = sorted(counts)
    found = _common(words.join(again, "key", "left_semi").withColumn("size", F.lit(0)), langs, MAX_WORDS).unionByName(_common(of_grams, langs, MAX_GRAMS)).toArrow()
    sizes = found.column("size").to_numpy()
    tables = {}
    for n in range(MAX_N + 1):
        own = found.filter(pa.array(sizes == n))
        tables[n] = own.column("key").to_pylist(), own.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
    return Model.of_tables(langs, tables)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, lang_pred and score of every row; only text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in in_parts(batches):
            found = [predict(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def held_out() -> "F.Column":
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those not held out."""
    model = train(docs.filter(~held_out()))
    return identify(docs.withColumn("held_out", held_out()), model, ("doc_id", "held_out"))


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs whose language can be told with a score of `least`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in in_parts(batches):
            found = map(predict, batch.column("text").to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
