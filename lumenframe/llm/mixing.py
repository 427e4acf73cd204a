"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Every source gets a share of the mix in proportion to its weight, clamped at `max_epochs` times its
own size; what a clamp frees is shared out again by weight until no source is above its clamp. A
target of r times a source's size then means floor(r) whole repetitions of all its documents and one
seeded fractional repetition: documents in a seeded order until the rest of the target is met, the
last one in part.

The order within a source is never a window over the whole source. Sizes are summed by (source,
bucket of the seeded number) first; running sums over these buckets tell which lie wholly inside or
outside of the repetition, and only the documents of the one bucket that the target cuts are ranked.

Cases: null text has size 0 and is never taken; a null source is a source of its own, after all
others; equal ids are separate rows and take part once each; an empty table gives no rows; extra
columns are ignored. Reruns give equal results, as the seeded number depends on doc_id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, materialize, n_words

#: Weights by rank of the source name, repeating.
WEIGHTS = (3, 1, 2)
#: The mix has this share of all sizes, and no source more than this many times its own.
TOTAL, MAX_EPOCHS = 1.5, 2
SEED = "mix-1"
#: Bits of the seeded number, and documents in a bucket on average.
BITS, PER_BUCKET = 52, 1000


def sized(docs: DataFrame, seed: str = SEED, rows: bool = False) -> DataFrame:
    """doc_id, source, size and u, a seeded number of BITS bits; and the whole row, if asked for."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    row = [F.struct(*docs.columns).alias("row")] if rows else []
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("u"), *row)


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from source, source_size: one row a source.

    With sources ordered by cap / weight, a source is clamped iff its cap is at most its weight times
    the level that remains once all before it are clamped; so one pass of running sums finds the
    fixed point of clamping and sharing out again. Windows run over the sources, not the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs).withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(total))).withColumn("all_weight", F.sum("weight").over(everything))
    left = F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left / weight_left).withColumn("clamped", ratio <= F.col("level"))
    level = F.min(F.when(~F.col("clamped"), F.struct(ratio.alias("ratio"), F.col("source").isNull(), "source", "level"))).over(everything)["level"]
    return levelled.select("source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, max_epochs: int = MAX_EPOCHS, seed: str = SEED, rows: bool = False) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, taken, and the row itself if asked for. Sums of taken meet round(target)."""
    base = materialize(sized(docs, seed, rows), "mix-sizes")
    sources = materialize(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, max_epochs), "mix-targets")
    buckets = 1 << min(20, (base.count() // PER_BUCKET).bit_length())
    bucket = F.shiftright("u", BITS - buckets.bit_length() + 1)
    part = sources.withColumn("words", F.round("target").cast("long")).withColumn("whole", F.coalesce(F.expr("try_divide(words, source_size)"), F.lit(0)).cast("long"))
    part = part.withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
    sums = base.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
    cut = part.alias("p").join(sums.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") >= F.col("rest")), "left")
    cut = materialize(cut.select(F.col("p.source").alias("of"), "source_size", "target", "whole", "rest", F.coalesce("bucket", F.lit(-1)).alias("cut"), F.coalesce("before", F.lit(0)).alias("before")), "mix-cuts")
    placed = join_small(base, cut, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", bucket)
    repeated = F.col("size") * F.col("whole")
    sure = placed.filter("bucket <> cut").withColumn("taken", repeated + F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    ranked = placed.filter("bucket = cut").withColumn("room", room).withColumn("taken", repeated + F.greatest(F.lit(0), F.least("room", "size"))).drop("room")
    return sure.unionByName(ranked).select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), *(["row"] if rows else []))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as rows of documents: a document comes as often as taken / size rounds to. Rows with equal ids have shares of their own."""
    times = F.expr("cast(round(try_divide(taken, size)) as int)")
    found = mix(docs, rows=True, **how).select("row", times.alias("times")).filter("times > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


#: DuckDB SQL for op10, over the same rows.
SQL = r"""
WITH base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS u
  FROM documents
), sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighed AS (
  SELECT *, source_size * 2 AS cap, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         1.5 * CAST((SELECT sum(source_size) FROM sums) AS DOUBLE) AS goal
  FROM sums
), levelled AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
         (goal - coalesce(CAST(sum(cap) OVER w AS DOUBLE), 0)) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
  FROM weighed WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level THEN CAST(cap AS DOUBLE)
              ELSE weight * (SELECT level FROM levelled l WHERE l.ratio > l.level ORDER BY ratio, source ASC NULLS LAST LIMIT 1) END AS target
  FROM levelled
), parts AS (
  SELECT b.doc_id, b.size, b.u, b.source, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS words,
         CASE WHEN t.source_size = 0 THEN 0 ELSE CAST(round(t.target) AS BIGINT) // t.source_size END AS whole
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * whole + greatest(0, least(size, words - whole * source_size - coalesce(sum(size) OVER w, 0))) AS BIGINT) AS taken
FROM parts WINDOW w AS (PARTITION BY source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""
