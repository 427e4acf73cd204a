"""Queries of signal accessors: a line of an order is a measurement, its supplier's nation a field, its order a peak."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import accessors, pixels, radiometry
from .registry import query, table

LINES = "m AS (SELECT l_suppkey % 20 AS field_i, l_orderkey AS field_peak_i, l_linenumber % 2 AS channel_i, l_partkey % 3 AS cycle_i, CAST(l_extendedprice AS DOUBLE) AS signal, CAST(l_discount AS DOUBLE) AS noise FROM lineitem)"
FRAMES = "f AS (SELECT s_suppkey % 20 AS field_i, s_nationkey % 2 AS channel_i, s_suppkey % 3 AS cycle_i, avg(s_acctbal) AS quality, avg(s_nationkey - 12.0) AS aln_y, avg(s_suppkey % 7 - 3.0) AS aln_x FROM supplier GROUP BY ALL)"
PEAKS = "p AS (SELECT o_custkey % 20 AS field_i, o_orderkey AS field_peak_i, CAST(o_totalprice AS DOUBLE) / 100 AS aln_y, CAST(o_custkey AS DOUBLE) AS aln_x FROM orders)"


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select((F.col("l_suppkey") % 20).alias("field_i"), F.col("l_orderkey").alias("field_peak_i"), (F.col("l_linenumber") % 2).alias("channel_i"), (F.col("l_partkey") % 3).alias("cycle_i"), F.col("l_extendedprice").cast("double").alias("signal"), F.col("l_discount").cast("double").alias("noise"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.groupBy((F.col("s_suppkey") % 20).alias("field_i"), (F.col("s_nationkey") % 2).alias("channel_i"), (F.col("s_suppkey") % 3).alias("cycle_i")).agg(F.avg("s_acctbal").alias("quality"), F.avg(F.col("s_nationkey") - 12.0).alias("aln_y"), F.avg(F.col("s_suppkey") % 7 - 3.0).alias("aln_x"))


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("field_i"), F.col("o_orderkey").alias("field_peak_i"), (F.col("o_totalprice").cast("double") / 100).alias("aln_y"), F.col("o_custkey").cast("double").alias("aln_x"))


@query(f"WITH {LINES} SELECT field_i, channel_i, count(*) AS n, count(*) FILTER (noise = 0) AS n_null, round(sum(CASE WHEN noise <> 0 THEN signal / noise END), 2) AS snr_sum FROM m GROUP BY ALL")
def signal_to_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accessors.signal_to_noise(measured(spark, sf_dir))
    return rows.groupBy("field_i", "channel_i").agg(F.count("*").alias("n"), F.count_if(F.col("snr").isNull()).alias("n_null"), F.round(F.sum("snr"), 2).alias("snr_sum"))


@query(f"WITH {LINES} SELECT field_peak_i, channel_i, cycle_i, signal FROM m WHERE field_i IN (3, 7)")
def signal_of_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessors.measure(accessors.of_fields(measured(spark, sf_dir), [3, 7]), "signal").drop("field_i")


@query(f"WITH {FRAMES} SELECT field_i, count(DISTINCT channel_i) AS n_channels, count(DISTINCT cycle_i) AS n_cycles, count(*) AS n_frames FROM f GROUP BY 1")
def frame_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessors.frame_counts(frames(spark, sf_dir))


@query(f"WITH {PEAKS} SELECT row_number() OVER (ORDER BY field_i, field_peak_i) - 1 AS peak_i, * FROM p")
def peak_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessors.locations(peaks(spark, sf_dir))


@query(f"WITH {PEAKS} SELECT field_i, count(*) AS n, round(sum(aln_y), 4) AS y, round(sum(aln_x), 4) AS x FROM p GROUP BY 1")
def nested_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = accessors.nested_locations(peaks(spark, sf_dir), ["field_i"])
    total = lambda k: F.round(F.aggregate("places", F.lit(0.0), lambda a, p: a + F.get(p, F.lit(k))), 4)
    return nested.select("field_i", F.size("places").cast("long").alias("n"), total(0).alias("y"), total(1).alias("x"))


@query(f"""WITH {PEAKS}, fits AS (SELECT l_suppkey % 20 AS field_i, l_orderkey AS field_peak_i, max(l_quantity) AS width FROM lineitem GROUP BY ALL)
SELECT row_number() OVER (ORDER BY p.field_i, p.field_peak_i) - 1 AS peak_i, p.field_i, p.field_peak_i, CAST(width AS DOUBLE) AS width FROM p LEFT JOIN fits USING (field_i, field_peak_i)""")
def peaks_with_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("field_i"), F.col("l_orderkey").alias("field_peak_i")).agg(F.max("l_quantity").cast("double").alias("width"))
    return accessors.with_fits(peaks(spark, sf_dir), fits).select("peak_i", "field_i", "field_peak_i", "width")


@query(f"""WITH {FRAMES}, c AS (SELECT field_i, cycle_i, avg(aln_y) AS y, avg(aln_x) AS x FROM f GROUP BY ALL)
SELECT field_i, count(*) AS n, round(sum(y), 6) AS y, round(sum(x), 6) AS x FROM c GROUP BY 1""")
def cycle_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = accessors.offsets(frames(spark, sf_dir))
    total = lambda k: F.round(F.aggregate("offsets", F.lit(0.0), lambda a, p: a + F.get(p, F.lit(k))), 6)
    return found.select("field_i", F.size("offsets").cast("long").alias("n"), total(0).alias("y"), total(1).alias("x"))


@query(f"""WITH p AS (SELECT o_custkey % 20 AS field_i, o_orderkey AS field_peak_i, (o_orderkey * 7919 % 100000) / 10.0 AS aln_y, CAST(o_orderkey % 997 AS DOUBLE) AS aln_x FROM orders),
d AS (SELECT a.field_i, a.field_peak_i, min(sqrt((a.aln_y - b.aln_y) ** 2 + (a.aln_x - b.aln_x) ** 2)) AS nn FROM p a JOIN p b ON a.field_i = b.field_i AND a.field_peak_i <> b.field_peak_i AND b.aln_y BETWEEN a.aln_y - 25 AND a.aln_y + 25 AND b.aln_x BETWEEN a.aln_x - 25 AND a.aln_x + 25 GROUP BY ALL)
SELECT p.field_i, p.field_peak_i, round(CASE WHEN nn <= 25 THEN nn END, 6) AS nn FROM p LEFT JOIN d USING (field_i, field_peak_i)""")
def neighbour_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("field_i"), F.col("o_orderkey").alias("field_peak_i"), (F.col("o_orderkey") * 7919 % 100000 / 10.0).alias("aln_y"), (F.col("o_orderkey") % 997).cast("double").alias("aln_x"))
    return accessors.neighbour_distance(at, 25.0).withColumn("nn", F.round("nn", 6))


@query(f"""WITH {LINES}, one AS (SELECT field_peak_i, channel_i * 3 + cycle_i AS spot, max(signal) AS signal, max(channel_i) AS c FROM m GROUP BY ALL)
SELECT field_peak_i, 3 * (max(c) + 1) AS n, round(sum(signal * (spot + 1)), 2) AS weighted FROM one GROUP BY 1""")
def flat_radmats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark, sf_dir).groupBy("field_peak_i", "channel_i", "cycle_i").agg(F.max("signal").alias("signal")).withColumn("field_i", F.lit(0))
    flat = accessors.radmat_rows(rows, 3)
    weighted = F.aggregate(F.transform("flat", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return flat.select("field_peak_i", F.size("flat").cast("long").alias("n"), F.round(weighted, 2).alias("weighted"))


@query(f"""WITH {LINES}, t AS (SELECT channel_i, cycle_i, quantile_cont(signal, 0.99) AS p99 FROM m WHERE signal > 0 GROUP BY ALL),
b AS (SELECT channel_i, cycle_i, p99, least(floor(signal / p99 * 100), 99) AS bin, count(*) AS n FROM m JOIN t USING (channel_i, cycle_i) WHERE signal > 0 AND signal <= p99 GROUP BY ALL),
w AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY channel_i, cycle_i ORDER BY n DESC, bin) = 1)
SELECT channel_i, cycle_i, round(p99, 4) AS p99, round((bin + 0.5) / 100 * p99, 4) AS mode FROM w""")
def channel_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = radiometry.signal_levels(measured(spark, sf_dir))
    return found.select("channel_i", "cycle_i", F.round("p99", 4).alias("p99"), F.round((F.col("peak_bin") + 0.5) / 100 * F.col("p99"), 4).alias("mode"))


@query(f"WITH {LINES} SELECT field_i, field_peak_i, cycle_i, max(signal) FILTER (channel_i = 0) AS x, max(signal) FILTER (channel_i = 1) AS y FROM m GROUP BY ALL HAVING x IS NOT NULL AND y IS NOT NULL")
def channel_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessors.channel_pairs(measured(spark, sf_dir), 0, 1)


@query(f"""WITH {FRAMES}, {PEAKS}, g AS (SELECT field_i, avg(quality) AS mean_quality, max(greatest(abs(aln_y), abs(aln_x))) AS worst_alignment FROM f GROUP BY 1), c AS (SELECT field_i, count(*) AS n_peaks FROM p GROUP BY 1)
SELECT field_i, coalesce(n_peaks, 0) AS n_peaks, round(mean_quality, 6) AS mean_quality, worst_alignment, row_number() OVER (ORDER BY mean_quality DESC, field_i) AS place FROM g LEFT JOIN c USING (field_i)""")
def sigproc_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accessors.overview(frames(spark, sf_dir), peaks(spark, sf_dir)).withColumn("mean_quality", F.round("mean_quality", 6))


@query(f"WITH {LINES}, {FRAMES} SELECT m.field_i, m.channel_i, count(*) AS n, count(quality) AS n_known, round(sum(quality), 2) AS quality FROM m LEFT JOIN f USING (field_i, channel_i, cycle_i) GROUP BY ALL")
def measurements_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accessors.with_metadata(measured(spark, sf_dir), frames(spark, sf_dir))
    return rows.groupBy("field_i", "channel_i").agg(F.count("*").alias("n"), F.count("quality").alias("n_known"), F.round(F.sum("quality"), 2).alias("quality"))


VIEWS = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))) AS p FROM embeddings)"


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as frames of eight rows, their labels as fields."""
    pixel = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("field_i"), F.lit(0).cast("long").alias("channel_i"), F.col("vec_id").cast("long").alias("cycle_i"), F.lit(8).alias("height"), pixel.alias("pixels"))


@query(f"WITH {VIEWS}, u AS (SELECT vec_id, unnest(p) AS v, generate_subscripts(p, 1) - 1 AS i FROM v) SELECT vec_id AS cycle_i, round(sum(v), 6) AS total, round(avg(v), 6) AS mean, round(sum(v * (i // 8)) / sum(v), 6) AS y, round(sum(v * (i % 8)) / sum(v), 6) AS x FROM u GROUP BY 1")
def frame_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.frame_statistics(views(spark, sf_dir)).select("cycle_i", *(F.round(c, 6).alias(c) for c in ("total", "mean", "y", "x")))


@query(f"WITH {VIEWS}, u AS (SELECT vec_id, unnest(p) AS v, generate_subscripts(p, 1) - 1 AS i FROM v) SELECT vec_id AS cycle_i, CAST(i // 32 AS INT) AS region_y, CAST(i % 8 // 4 AS INT) AS region_x, round(avg(v), 6) AS mean FROM u GROUP BY ALL")
def frame_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.frame_regions(views(spark, sf_dir), 2).select("cycle_i", "region_y", "region_x", F.round("mean", 6).alias("mean"))


@query(f"WITH {VIEWS}, u AS (SELECT label, vec_id, unnest(p) AS v, generate_subscripts(p, 1) - 1 AS i FROM v), s AS (SELECT label, i, sum(v) AS v, count(*) AS n FROM u GROUP BY ALL) SELECT label AS field_i, max(n) AS n, round(sum(v * (i + 1)), 4) AS weighted, round(max(v), 6) AS brightest FROM s GROUP BY 1")
def frame_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pixels.stacked(views(spark, sf_dir))
    weighted = F.aggregate(F.transform("total", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return found.select("field_i", "n", F.round(weighted, 4).alias("weighted"), F.round(F.array_max("total"), 6).alias("brightest"))
