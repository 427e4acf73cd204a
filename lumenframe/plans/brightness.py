"""Radiometry queries: a user is a peak, an event type a channel, an event's number mod 8 its cycle, value less 50 its signal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import radiometry
from ..operators.quantiles import exact_quantiles
from .calls import TYPES
from .registry import query, table

CYCLES, CHANNELS, BETA = 8, len(TYPES), 40.0
ROWS = "rows_ AS (SELECT user_id AS peak_i, list_position(['click','error','purchase','signup','view'], event_type) - 1 AS channel_i, event_id % 8 AS cycle_i, value - 50 AS signal, value / 10 AS noise, user_id % 10 AS field_i FROM events)"
# A left join on the cycle keeps cycles without a measurement.
TRACES = f"""{ROWS}, cells AS (SELECT peak_i, channel_i, cycle_i, avg(signal) AS v FROM rows_ GROUP BY ALL), pc AS (SELECT DISTINCT peak_i, channel_i, c FROM rows_ CROSS JOIN (SELECT unnest(range(0, 8)) AS c)),
traces AS (SELECT pc.peak_i, pc.channel_i, list(coalesce(v, 0) ORDER BY c) AS trace FROM pc LEFT JOIN cells ON pc.peak_i = cells.peak_i AND pc.channel_i = cells.channel_i AND pc.c = cells.cycle_i GROUP BY ALL),
life AS (SELECT peak_i, channel_i, trace, list_position(list_transform(range(1, 9), lambda k: round(list_sum(trace[1:k]) / sqrt(k), 7)), list_max(list_transform(range(1, 9), lambda k: round(list_sum(trace[1:k]) / sqrt(k), 7)))) AS life FROM traces)"""


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("peak_i"), (F.array_position(F.array(*map(F.lit, TYPES)), F.col("event_type")) - 1).alias("channel_i"), (F.col("event_id") % CYCLES).alias("cycle_i"), (F.col("value") - 50).alias("signal"), (F.col("value") / 10).alias("noise"), (F.col("user_id") % 10).alias("field_i"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.traces(rows(spark, sf_dir), CYCLES)


@query(f"WITH {ROWS}, cells AS (SELECT peak_i, channel_i, cycle_i, avg(signal) AS v FROM rows_ GROUP BY ALL), p AS (SELECT DISTINCT peak_i FROM rows_), g AS (SELECT peak_i, unnest(range(0, 40)) AS cell FROM p) SELECT g.peak_i, round(sum(coalesce(v, 0) * (cell + 1)), 4) AS weighted FROM g LEFT JOIN cells c ON g.peak_i = c.peak_i AND c.channel_i = cell // 8 AND c.cycle_i = cell % 8 GROUP BY 1")
def df_to_radmat(spark: SparkSession, sf_dir: str) -> DataFrame:
    mats = radiometry.to_radmat(rows(spark, sf_dir), CHANNELS, CYCLES)
    return mats.select("peak_i", F.round(arrays.sum_of(F.transform("radmat", lambda v, i: v * (i + 1))), 4).alias("weighted"))


@query(f"WITH {ROWS}, cells AS (SELECT peak_i, channel_i, cycle_i, avg(signal) AS v FROM rows_ GROUP BY ALL), p AS (SELECT DISTINCT peak_i FROM rows_), g AS (SELECT peak_i, unnest(range(0, 40)) AS cell FROM p) SELECT g.peak_i, cell // 8 AS channel_i, cell % 8 AS cycle_i, round(coalesce(v, 0), 6) AS signal FROM g LEFT JOIN cells c ON g.peak_i = c.peak_i AND c.channel_i = cell // 8 AND c.cycle_i = cell % 8")
def radmat_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.to_long(radiometry.to_radmat(rows(spark, sf_dir), CHANNELS, CYCLES), CYCLES).withColumn("signal", F.round("signal", 6))


@query(f"""WITH {TRACES}, u AS (SELECT peak_i, channel_i, life, unnest(trace) AS v, generate_subscripts(trace, 1) <= life AS alive FROM life)
SELECT peak_i, channel_i, life, round(median(v) FILTER (alive), 6) AS lif_med, round(avg(v) FILTER (alive), 6) AS lif_mean, round(stddev_pop(v) FILTER (alive), 6) AS lif_std, round(quantile_cont(v, 0.75) FILTER (alive) - quantile_cont(v, 0.25) FILTER (alive), 6) AS lif_iqr,
round(max(v) FILTER (NOT alive), 6) AS afl_max, round(avg(v) FILTER (NOT alive), 6) AS afl_mean FROM u GROUP BY ALL""")
def features_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = radiometry.life_features(traces(spark, sf_dir))
    return found.select("peak_i", "channel_i", "life", *(F.round(c, 6).alias(c) for c in ("lif_med", "lif_mean", "lif_std", "lif_iqr", "afl_max", "afl_mean")))


@query(f"""WITH {TRACES}, e AS (SELECT *, CASE WHEN life = 8 THEN list_append(trace, 0.0) ELSE trace[1:life] END AS t FROM life),
r AS (SELECT peak_i, channel_i, life, trace, CASE WHEN len(t) < 2 THEN NULL ELSE list_max(list_transform(range(2, len(t) + 1), lambda i: t[i] - t[i-1])) / 40.0 END AS rise FROM e)
SELECT peak_i, channel_i, round(rise, 6) AS rise, NOT coalesce(rise > 1.0 AND life > 1 AND trace[1] > 32.0, false) AS good FROM r""")
def monotonic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.monotonic(traces(spark, sf_dir), BETA).select("peak_i", "channel_i", F.round("rise", 6).alias("rise"), F.coalesce("good", F.lit(True)).alias("good"))


@query(f"WITH {ROWS}, c AS (SELECT channel_i, avg(signal) AS m FROM rows_ GROUP BY 1) SELECT channel_i, round(sqrt(avg((signal - m) ** 2) FILTER (signal <= m)), 6) AS below, round(sqrt(avg((signal - m) ** 2) FILTER (signal >= m)), 6) AS above FROM rows_ JOIN c USING (channel_i) GROUP BY 1")
def half_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rows(spark, sf_dir)
    centred = r.join(r.groupBy("channel_i").agg(F.avg("signal").alias("m")), "channel_i")
    return centred.groupBy("channel_i").agg(F.round(radiometry.half_std(F.col("signal"), F.col("m")), 6).alias("below"), F.round(radiometry.half_std(F.col("signal"), F.col("m"), above=True), 6).alias("above"))


@query(f"WITH {ROWS} SELECT channel_i, round(4 * coalesce(sqrt(avg(signal ** 2) FILTER (signal <= 0)), 0), 6) AS threshold FROM rows_ GROUP BY 1")
def dark_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.dark_thresholds(rows(spark, sf_dir), 4.0).withColumn("threshold", F.round("threshold", 6))


@query(f"WITH {ROWS} SELECT channel_i, round(4 * coalesce(sqrt(avg(signal ** 2) FILTER (signal <= 0)), 0), 6) AS threshold FROM rows_ WHERE cycle_i = 7 GROUP BY 1")
def dark_threshold_last_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.dark_thresholds(rows(spark, sf_dir), 4.0, last_only=True).withColumn("threshold", F.round("threshold", 6))


@query(f"WITH {ROWS} SELECT channel_i, least(floor((noise - 0) / (40.0 / 50)), 49)::INT AS bin, count(*) AS n FROM rows_ WHERE noise BETWEEN 0 AND 40 GROUP BY ALL")
def noise_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.histogram(rows(spark, sf_dir), "noise", 0.0, 40.0, 50, ("channel_i",))


@query("SELECT least(floor((l_quantity - 0) / (50.0 / 10)), 9)::INT AS x_bin, least(floor((l_discount - 0) / (0.1 / 10)), 9)::INT AS y_bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 AND l_discount BETWEEN 0 AND 0.1 GROUP BY ALL")
def hist2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.histogram_2d(table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount", (0.0, 50.0), (0.0, 0.1), 10)


@query("""WITH q AS (SELECT l_returnflag, min(l_extendedprice) AS q0, quantile_cont(l_extendedprice, 0.25) AS q1, median(l_extendedprice) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS q4 FROM lineitem GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence FROM q)
SELECT f.l_returnflag, round(q0, 6) AS q0, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(q4, 6) AS q4, round(low_fence, 6) AS low_fence, round(high_fence, 6) AS high_fence, count(*) FILTER (l_extendedprice < low_fence OR l_extendedprice > high_fence) AS n_outliers FROM f JOIN lineitem USING (l_returnflag) GROUP BY ALL""")
def boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = radiometry.box_plot(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")
    return found.select("l_returnflag", *(F.round(c, 6).alias(c) for c in ("q0", "q1", "q2", "q3", "q4", "low_fence", "high_fence")), "n_outliers")


@query("SELECT event_type, round(quantile_cont(value, 0), 6) AS p0, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 1), 6) AS p100 FROM events GROUP BY 1")
def distr_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = exact_quantiles(table(spark, sf_dir, "events"), ["event_type"], "value", [0.0, 0.25, 0.5, 0.75, 1.0])
    return p.select("event_type", *(F.round(f"q{i}", 6).alias(n) for i, n in enumerate(("p0", "p25", "p50", "p75", "p100"))))


@query(f"""WITH {ROWS}, ok AS (SELECT peak_i FROM rows_ WHERE channel_i = 2 AND field_i NOT IN (3, 4) GROUP BY 1 HAVING count(*) > 0 AND coalesce(bool_and(signal > -49) FILTER (cycle_i <= 1), true) AND max(signal) <= 250 AND coalesce(bool_and(signal <= 200) FILTER (cycle_i = 0), true))
SELECT peak_i, count(*) AS n_rows, round(sum(signal), 4) AS total FROM rows_ WHERE peak_i IN (SELECT peak_i FROM ok) GROUP BY 1""")
def peak_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = radiometry.filter_peaks(rows(spark, sf_dir), 2, -49.0, on_through=1, max_any=250.0, max_first=200.0, reject_fields=[3, 4])
    return kept.groupBy("peak_i").agg(F.count("*").alias("n_rows"), F.round(F.sum("signal"), 4).alias("total"))


@query(f"""WITH {ROWS}, p AS (SELECT peak_i, any_value(field_i) AS field_i, max(noise) AS max_noise, min(signal) > -3.4028234663852886e38 AND max(signal) < 3.4028234663852886e38 AS in_range FROM rows_ GROUP BY 1)
SELECT peak_i, field_i <> 3 AS aligned, field_i <> 7 AS in_focus, max_noise < 25 AS low_noise, in_range, field_i <> 3 AND field_i <> 7 AND max_noise < 25 AND in_range AS pass_quality FROM p""")
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rows(spark, sf_dir)
    peaks = r.select("peak_i", "field_i").distinct().join(radiometry.max_noise(r), "peak_i").join(radiometry.in_float_range(r), "peak_i")
    fields = r.select("field_i").distinct().withColumn("aligned", F.col("field_i") != 3).withColumn("in_focus", F.col("field_i") != 7)
    return radiometry.build_filter(peaks, fields, 25.0)


@query(f"""WITH {ROWS}, t AS (SELECT channel_i, cycle_i, quantile_cont(signal, 0.99) AS p99 FROM rows_ GROUP BY ALL),
b AS (SELECT channel_i, cycle_i, least(floor(signal / (p99 / 100)), 99)::INT AS bin, count(*) AS n FROM rows_ JOIN t USING (channel_i, cycle_i) WHERE signal >= 0 AND signal <= p99 AND p99 > 0 GROUP BY ALL),
k AS (SELECT channel_i, cycle_i, bin AS peak_bin FROM b QUALIFY row_number() OVER (PARTITION BY channel_i, cycle_i ORDER BY n DESC, bin) = 1)
SELECT channel_i, cycle_i, round(p99, 6) AS p99, peak_bin FROM t LEFT JOIN k USING (channel_i, cycle_i)""")
def signal_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radiometry.signal_levels(rows(spark, sf_dir)).withColumn("p99", F.round("p99", 6))


@query("WITH t AS (SELECT l_orderkey, list(l_quantity > 10 ORDER BY l_linenumber, l_quantity, l_partkey, l_suppkey) AS on_ FROM lineitem GROUP BY 1) SELECT l_orderkey, coalesce(list_position(on_, false) - 1, len(on_)) AS run FROM t")
def leading_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the run of leading TRUE: how many lines of an order are above 10 before the first that isn't."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_partkey", "l_suppkey"))).alias("x"))
    return lines.select("l_orderkey", arrays.run_of_true(F.transform("x", lambda r: r["l_quantity"] > 10)).alias("run"))


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), 6) AS mean_6, coalesce(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS rise FROM events")
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.round(F.avg("value").over(order.rowsBetween(0, 5)), 6).alias("mean_6"), F.coalesce(F.col("value") - F.lag("value").over(order), F.lit(0.0)).alias("rise"))
