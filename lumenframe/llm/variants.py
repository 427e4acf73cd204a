"""Grouping of spelling variants: a self-join of the vocabulary's trie with sets of active nodes.

1. Words are counted: tasks count their own before the shuffle.
2. The vocabulary is dealt over partitions of the trie. Words whose common prefix has PREFIX or more
   code points meet under that prefix. Words that first differ at c < PREFIX agree, but for one edit,
   in all that follows: they meet under their first c and last FIXED - c code points. A prefix of more
   than HOT words is cut by longer prefixes in the same way, and what is still hot by patterns of whole
   words with one hole, which hold a word for each code point of the hole at most.
3. In a partition the words' rests make a trie. Going down, a node's set of active nodes (those whose
   strings lie within one edit) follows from its parent's set: nodes stay at one more edit, their
   children are met by the same code point or at one more edit. Where a terminal node is active for
   another at distance one, the two words are near.
4. A pair belongs to the one partition of its common prefix. Partitions send on, a word, the number
   of near words and the most frequent one: no pairs travel, and no word's neighbours are gathered.
5. A word's form is its most frequent near word, if that is RATIO times as frequent; roots follow by
   jumps over ever longer chains, written each round. Each form is RATIO times as frequent as the
   word before, so chains are short.

Cases: null and empty texts have no words; a null doc_id counts as empty in the hash; repeated rows
count again; texts and words of any length are read whole; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, join_small, materialize
from .repair import CRC32, CRC_TABLE

#: Code points that a word has at least, occurrences that it has at least, and how much more frequent its form is.
LEAST, OFTEN, RATIO = 7, 2, 10
#: One run in so many loses a code point.
DAMAGED = 31
#: Code points of a partition's prefix, and of prefix and suffix together (one less than a word has at least).
PREFIX, FIXED = 3, LEAST - 1
#: Words of a partition above which it is cut further, and words that a task counts before it sends them on.
HOT, HELD = 20_000, 500_000
RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST},}}")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_of(doc_id: object, text: str) -> Iterator[str]:
    """Words of a text: lower-cased runs, some without one of their code points by a hash of id and run."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    crc = zlib.crc32
    for run in RUN.findall(text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")):
        h = crc(run.encode(), seed)
        if h % DAMAGED:
            yield run
        elif len(run) > LEAST:
            k = h % len(run)
            yield run[:k] + run[k + 1 :]


def vocabulary(docs: DataFrame, often: int = OFTEN) -> DataFrame:
    """(word, n) of words that occur `often` times in all documents (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    held.update(words_of(doc_id, text))
                    if len(held) > HELD:
                        yield flush()
        if held:
            yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


class Trie:
    """Words' nodes as parallel lists: children by code point, and the terminal word of each (-1 for none)."""

    def __init__(self, words: list[str]):
        self.kids: list[dict[str, int]] = [{}]
        self.word = [-1]
        for i, w in enumerate(words):
            at = 0
            for c in w:
                below = self.kids[at].get(c)
                if below is None:
                    below = self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                    self.word.append(-1)
                at = below
            self.word[at] = i

    def below(self, active: dict[int, int], c: str) -> dict[int, int]:
        """The active nodes, with their distances, of the child by c of a node with these active nodes."""
        kids, out = self.kids, {}
        for node, d in active.items():
            if d == 0:
                out.setdefault(node, 1)  # c is left out
                for k, kid in kids[node].items():
                    if k == c:
                        out[kid] = 0
                        for more in kids[kid].values():  # a code point more after c
                            out.setdefault(more, 1)
                    else:
                        out.setdefault(kid, 1)  # another one in place of c
            else:
                kid = kids[node].get(c)
                if kid is not None:
                    out.setdefault(kid, 1)
        return out

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Pairs of words at distance one, each in both orders."""
        waiting = [(0, {0: 0} | dict.fromkeys(self.kids[0].values(), 1))]
        while waiting:
            node, active = waiting.pop()
            own = self.word[node]
            if own >= 0:
                for other, d in active.items():
                    if d and self.word[other] >= 0:
                        yield own, self.word[other]
            for c, kid in self.kids[node].items():
                waiting.append((kid, self.below(active, c)))


def common_prefix(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def _ends(c: Column | int, s: Column | int) -> Column:
    """The first c and last s code points of a word, with their numbers."""
    c, s = (F.lit(x) if isinstance(x, int) else x for x in (c, s))
    return F.concat(c.cast("string"), F.lit(":"), s.cast("string"), F.lit(":"), F.substring("word", F.lit(1), c), F.lit("|"), F.when(s > 0, F.substring("word", F.char_length("word") - s + 1, s)).otherwise(""))


def _group(key: Column, first: int | Column, last: int | Column, whole: bool) -> Column:
    """A partition: first and last code points that its words share; its pairs' common prefix is `first`, or at least that."""
    return F.struct(key.alias("key"), *((F.lit(x) if isinstance(x, int) else x).cast("int").alias(n) for x, n in ((first, "first"), (last, "last"))), F.lit(whole).alias("whole"))


def _dealt(words: DataFrame, groups: list[Column], hot: int) -> tuple[DataFrame, DataFrame]:
    """Rows (word, n, group) of partitions that aren't hot, and words with the partitions that are."""
    rows = words.select("word", "n", F.explode(F.array(*groups)).alias("group"))
    sizes = materialize(rows.groupBy(F.col("group.key").alias("key")).agg(F.count("*").alias("_size")).filter(F.col("_size") > hot).select("key", F.lit(True).alias("_hot")), "hot-partitions")
    rows = join_small(rows.withColumn("key", F.col("group.key")), sizes, "key")
    return rows.filter("_hot is null").select("word", "n", "group"), rows.filter("_hot").select("word", "n", "group")


def dealt(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n, group): every word in the partitions in which it can meet near words."""
    cold, many = _dealt(words, [_group(_ends(PREFIX, 0), PREFIX, 0, True), *(_group(_ends(c, FIXED - c), c, FIXED - c, False) for c in range(PREFIX))], hot)
    long = many.filter("group.whole")
    finer, more = _dealt(long.select("word", "n"), [*(_group(_ends(c, FIXED - c), c, FIXED - c, False) for c in range(PREFIX, FIXED)), _group(_ends(FIXED, 0), FIXED, 0, True)], hot)
    still = many.filter("not group.whole").unionByName(more)
    # Of each word as one of the two lengths m that its pairs' longer word has: all but one of m code points are fixed.
    first = F.col("group.first")
    holes = F.when(F.col("group.whole"), F.sequence(first, F.greatest(first, F.char_length("word")))).otherwise(F.array(first))
    spread = still.select("word", "n", F.explode(holes).alias("c")).select("word", "n", "c", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("m"))
    spread = spread.filter(F.col("c") < F.col("m"))
    last = F.col("m") - F.col("c") - 1
    holed = spread.select("word", "n", _group(F.concat(F.col("m").cast("string"), F.lit("/"), _ends(F.col("c"), last)), F.col("c"), last, False).alias("group"), "m")
    return cold.withColumn("m", F.lit(0)).unionByName(finer.withColumn("m", F.lit(0))).unionByName(holed)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, form_n, form) of partitions that follow each other: near words of each word, and the most frequent one."""
    key: str | None = None
    words: list[str] = []
    counts: list[int] = []
    how: tuple = ()
    out: list[tuple[str, int, int, str]] = []

    def join() -> None:
        if len(words) < 2:
            return
        first, last, whole, m = how
        rests = [w[first : len(w) - last] for w in words]
        found: dict[int, list] = {}
        for i, j in Trie(rests).pairs():
            a, b = words[i], words[j]
            shared = common_prefix(a, b)
            if (shared == first or whole) and (not m or max(len(a), len(b)) == m):
                best = found.setdefault(i, [0, 0, b])
                best[0] += 1
                if counts[j] > best[1] or counts[j] == best[1] and b < best[2]:
                    best[1:] = counts[j], b
        out.extend((words[i], *best) for i, best in found.items())

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        for k, word, n, *rest in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "first", "last", "whole", "m")), strict=True):
            if k != key:
                join()
                key, how = k, tuple(rest)
                words.clear()
                counts.clear()
            words.append(word)
            counts.append(n)
        if len(out) > 10_000:
            yield flush()
    join()
    yield flush()


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n, n_near, form_n, form) of every word (word, n): its near words' number and, if there are any, the most frequent one."""
    parts = dealt(words, hot).select("word", "n", "group.*", "m").repartition("key").sortWithinPartitions("key")
    found = parts.mapInArrow(_near, "word string, n_near long, form_n long, form string")
    both = words.select("word", "n", *(F.lit(None).cast(t).alias(c) for c, t in (("n_near", "long"), ("form_n", "long"), ("form", "string")))).unionByName(found.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))))
    found = both.groupBy("word").agg(F.max("n").alias("n"), F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"), best.alias("best"))
    return found.select("word", "n", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def grouped(docs: DataFrame, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary of documents (doc_id, text)."""
    words = materialize(vocabulary(docs), "vocabulary")
    is_form = F.col("form_n") >= ratio * F.col("n")
    found = materialize(near_words(words, hot).select("word", "n", "n_near", *(F.when(is_form, F.col(c)).alias(c) for c in ("form", "form_n"))), "near-words")
    roots = materialize(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # each round doubles the length of the chains that a root closes
        jumps = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialize(join_hot(roots, jumps, ["root"]), "roots")
        roots = further.select("word", F.coalesce("next", "root").alias("root"))
        if further.filter("next is not null").isEmpty():
            break
    whole = join_hot(found, roots, ["word"])
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL for op13, over the same rows.
SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), keyed AS (SELECT run, count(*) AS times, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (SELECT run, times, {CRC32.format("k")} AS h FROM keyed, crc),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, n, i, substring(word, 1, i - 1) AS a, substring(word, i + 1) AS b FROM holes),
pairs AS (
  SELECT x.word, y.word AS near, y.n FROM shorter x JOIN shorter y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM shorter x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM shorter x JOIN words y ON x.a || x.b = y.word
), best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS form, max(n) AS form_n FROM pairs GROUP BY 1),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chains AS (SELECT word, word AS root, form AS next FROM formed UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON f.word = c.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)
"""
