"""Evaluation queries: an event is a call; its type is the true class, class and score derive from its user and value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate
from .registry import query, table

TYPES = ("click", "error", "purchase", "signup", "view")
CALLS = """calls AS (SELECT event_id AS row_i, list_position(['click','error','purchase','signup','view'], event_type) AS true_i,
  CASE WHEN event_id % 3 <> 0 THEN list_position(['click','error','purchase','signup','view'], event_type) ELSE user_id % 6 END AS pred_i,
  least(1000, CAST(round(value * 2) AS BIGINT)) AS m, least(1000, CAST(round(value * 2) AS BIGINT)) / 1000.0 AS score FROM events)"""
CURVES = f"""{CALLS}, steps AS (SELECT unnest(range(1, 51)) AS step), classes AS (SELECT true_i AS class_i, count(*) AS n_true FROM calls GROUP BY 1),
by_t AS (SELECT class_i, step, n_true, count(*) FILTER (pred_i = class_i AND m >= 1000 - 20 * step) AS pred, count(*) FILTER (pred_i = class_i AND true_i = class_i AND m >= 1000 - 20 * step) AS hits
  FROM classes CROSS JOIN steps CROSS JOIN calls GROUP BY ALL),
raw AS (SELECT *, CASE WHEN pred = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / pred END AS prec, CAST(hits AS DOUBLE) / n_true AS raw FROM by_t),
curves AS (SELECT class_i, step, 1 - step / 50.0 AS threshold, prec, raw * (1 - class_i / 10.0) AS recall, raw, (raw - coalesce(lag(raw) OVER w, 0)) * prec AS area FROM raw WINDOW w AS (PARTITION BY class_i ORDER BY step))"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    true = F.array_position(F.array(*map(F.lit, TYPES)), F.col("event_type"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("row_i"), true.alias("true_i"), F.when(F.col("event_id") % 3 != 0, true).otherwise(F.col("user_id") % 6).alias("pred_i"), (F.least(F.lit(1000), F.round(F.col("value") * 2).cast("long")) / 1000).alias("score"))


def recalls(spark: SparkSession) -> DataFrame:
    return spark.range(1, 6).select(F.col("id").alias("class_i"), (1 - F.col("id") / 10).alias("pep_recall"))


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.pr_curves(calls(spark, sf_dir), recalls(spark))


@query(f"WITH {CALLS} SELECT pred_i, true_i, count(*) AS n FROM calls GROUP BY ALL")
def conf_mat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(calls(spark, sf_dir))


@query(f"WITH {CALLS} SELECT CASE WHEN m >= 300 THEN pred_i ELSE 0 END AS pred_i, true_i, count(*) AS n FROM calls GROUP BY ALL")
def conf_mat_at_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(calls(spark, sf_dir), 0.3)


@query(f"WITH {CALLS}, cm AS (SELECT pred_i, true_i, count(*) AS n FROM calls GROUP BY ALL) SELECT pred_i, true_i, CAST(floor(n * (true_i * 1.5)) AS BIGINT) AS n FROM cm")
def conf_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    abundance = spark.range(1, 6).select(F.col("id").alias("class_i"), (F.col("id") * 1.5).alias("abundance"))
    return evaluate.scaled_by_abundance(evaluate.confusion(calls(spark, sf_dir)), abundance).select("pred_i", "true_i", "n")


@query(f"""WITH {CALLS}, p AS (SELECT pred_i AS class_i, count(*) AS n_pred, count(*) FILTER (pred_i = true_i) AS n_correct FROM calls GROUP BY 1), t AS (SELECT true_i AS class_i, count(*) AS n_true FROM calls GROUP BY 1)
SELECT class_i, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true, coalesce(n_correct, 0) AS n_correct,
  CASE WHEN coalesce(n_pred, 0) = 0 THEN 0 ELSE CAST(n_correct AS DOUBLE) / n_pred END AS prec, CASE WHEN coalesce(n_true, 0) = 0 THEN 0 ELSE CAST(n_correct AS DOUBLE) / n_true END AS recall FROM p FULL JOIN t USING (class_i)""")
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.precision_recall(evaluate.confusion(calls(spark, sf_dir)))


@query(f"""WITH {CALLS}, p AS (SELECT pred_i AS class_i, count(*) FILTER (m >= 200 AND true_i = pred_i) AS n_tp, count(*) FILTER (m >= 200 AND true_i <> pred_i) AS n_fp, min(score) AS min_score, max(score) AS max_score FROM calls WHERE pred_i <> 0 GROUP BY 1),
t AS (SELECT true_i AS class_i, count(*) AS n_true, count(*) FILTER (true_i <> pred_i) AS n_fn FROM calls GROUP BY 1),
j AS (SELECT class_i, n_tp, n_fp, n_fn, n_fn + CAST(round_even(n_true * (1 - (1 - class_i / 10.0)), 0) AS BIGINT) AS n_fn_corr, min_score, max_score FROM p LEFT JOIN t USING (class_i))
SELECT *, CAST(n_tp AS DOUBLE) / (n_tp + n_fp) AS prec, CAST(n_tp AS DOUBLE) / (n_tp + n_fn) AS recall, CAST(n_tp AS DOUBLE) / (n_tp + n_fn_corr) AS recall_corr FROM j""")
def class_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.class_evaluation(calls(spark, sf_dir), recalls(spark), 0.2)


@query(f"WITH {CURVES} SELECT class_i, step, round(threshold, 6) AS threshold, round(prec, 9) AS prec, round(recall, 9) AS recall, round(sum(area) OVER (PARTITION BY class_i ORDER BY step), 9) AS auc FROM curves QUALIFY raw > 0")
def pr_curve_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves(spark, sf_dir).select("class_i", "step", *(F.round(c, d).alias(c) for c, d in (("threshold", 6), ("prec", 9), ("recall", 9), ("auc", 9))))


@query(f"""WITH {CURVES}, ok AS (SELECT class_i, max(step) FILTER (prec >= 0.7) AS best FROM curves WHERE raw > 0 GROUP BY 1)
SELECT o.class_i, round(coalesce(threshold, 0), 6) AS threshold, round(coalesce(prec, 0), 9) AS prec, round(coalesce(recall, 0), 9) AS recall FROM ok o LEFT JOIN curves c ON o.class_i = c.class_i AND o.best = c.step""")
def pr_at_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.recall_at_precision(curves(spark, sf_dir), 0.7).select("class_i", F.round("threshold", 6).alias("threshold"), F.round("prec", 9).alias("prec"), F.round("recall", 9).alias("recall"))


@query(f"WITH {CURVES} SELECT class_i, round(threshold, 6) AS threshold, round(prec, 9) AS prec, round(recall, 9) AS recall FROM curves WHERE raw > 0 AND recall > 0.2 QUALIFY row_number() OVER (PARTITION BY class_i ORDER BY prec DESC, step) = 1")
def best_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best_precision(curves(spark, sf_dir), 0.2).select("class_i", F.round("threshold", 6).alias("threshold"), F.round("prec", 9).alias("prec"), F.round("recall", 9).alias("recall"))


@query(f"WITH {CURVES} SELECT DISTINCT class_i FROM curves WHERE prec > 0.69 AND recall > 0.3")
def classes_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.above_both(curves(spark, sf_dir), 0.69, 0.3)


@query(f"""WITH {CURVES}, best AS (SELECT class_i, max(prec) AS best FROM curves WHERE recall > 0 GROUP BY 1), grid AS (SELECT unnest(range(0, 51)) AS p)
SELECT p / 50.0 AS prec, CAST(count(class_i) FILTER (floor(round(best * 50, 7)) >= p) AS BIGINT) AS n_classes FROM grid CROSS JOIN best GROUP BY p""")
def observability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.observability(curves(spark, sf_dir))


FDR = """runs AS (SELECT *, count(*) OVER w AS n_above, sum(CASE WHEN pred_i > 0 AND pred_i % 2 = 0 THEN 1 ELSE 0 END) OVER w AS decoys, sum(CASE WHEN pred_i <> true_i THEN 1 ELSE 0 END) OVER w AS wrongs FROM calls WINDOW w AS (ORDER BY m DESC, row_i ROWS UNBOUNDED PRECEDING))"""


@query(f"WITH {CALLS}, {FDR} SELECT row_i, n_above, round(CAST(decoys AS DOUBLE) / n_above, 9) AS fdr FROM runs")
def fdr_decoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = evaluate.running_fdr(calls(spark, sf_dir).withColumn("is_decoy", (F.col("pred_i") > 0) & (F.col("pred_i") % 2 == 0)))
    return runs.select("row_i", "n_above", F.round("fdr", 9).alias("fdr"))


@query(f"WITH {CALLS}, {FDR} SELECT row_i, round(CAST(wrongs AS DOUBLE) / n_above, 9) AS truth_fdr, round(CASE WHEN wrongs = 0 THEN 0 ELSE CAST(decoys AS DOUBLE) / wrongs END, 9) AS p_wrong_is_decoy FROM runs")
def fdr_explore(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = evaluate.running_fdr(calls(spark, sf_dir).withColumn("is_decoy", (F.col("pred_i") > 0) & (F.col("pred_i") % 2 == 0)))
    return runs.select("row_i", F.round("truth_fdr", 9).alias("truth_fdr"), F.round("p_wrong_is_decoy", 9).alias("p_wrong_is_decoy"))


@query(f"""WITH {CALLS}, cm AS (SELECT pred_i, true_i, count(*) AS n FROM calls GROUP BY ALL),
fp AS (SELECT pred_i AS class_i, 'fp' AS kind, true_i AS other_i, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY pred_i) AS weight, n, pred_i = true_i AS own FROM cm),
fn AS (SELECT true_i AS class_i, 'fn' AS kind, pred_i AS other_i, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY true_i) AS weight, n, pred_i = true_i AS own FROM cm),
r AS (SELECT *, row_number() OVER (PARTITION BY class_i, kind ORDER BY n DESC, other_i) AS rank FROM (SELECT * FROM fp UNION ALL SELECT * FROM fn) WHERE NOT own AND class_i <> 0)
SELECT class_i, kind, other_i, weight, rank FROM r WHERE rank <= 2""")
def false_calls_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.top_falses(evaluate.confusion(calls(spark, sf_dir)), 2)


@query(f"WITH {CALLS} SELECT row_i, pred_i, score FROM calls WHERE score > (SELECT quantile_cont(score, 0.9) FROM calls)")
def calls_above_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.above_percentile(calls(spark, sf_dir), 0.9).select("row_i", "pred_i", "score")


@query(f"WITH {CALLS} SELECT row_i, CASE WHEN true_i = pred_i THEN score ELSE 0 END AS score FROM calls")
def calls_thresholded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.thresholded(calls(spark, sf_dir), F.col("true_i") == F.col("pred_i")).select("row_i", "score")


@query(f"WITH {CALLS} SELECT row_i, CASE WHEN pred_i = 0 THEN true_i ELSE pred_i END AS pred_i, CASE WHEN pred_i = 0 THEN score / 2 ELSE score END AS score FROM calls")
def runner_up_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir).withColumn("runnerup_i", F.col("true_i")).withColumn("runnerup_score", F.col("score") / 2)
    return evaluate.runner_up_for_nul(rows).select("row_i", "pred_i", "score")


@query(f"WITH {CALLS} SELECT row_i, CASE WHEN true_i IN (2, 4) THEN true_i ELSE 0 END AS y FROM calls")
def poi_vs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = spark.range(1, 6).select(F.col("id").alias("class_i"), (F.col("id") % 2 == 0).alias("is_poi"))
    return evaluate.poi_or_all(calls(spark, sf_dir), classes).select("row_i", "y")


@query(f"WITH {CALLS} SELECT pred_i AS class_i, count(*) AS n, round(avg(score), 9) AS mean_score FROM calls GROUP BY 1")
def average_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.average_scores(calls(spark, sf_dir)).withColumn("mean_score", F.round("mean_score", 9))


@query(f"WITH {CALLS}, g AS (SELECT unnest(range(0, 9)) AS class_i) SELECT class_i, CAST(count(row_i) AS BIGINT) AS n FROM g LEFT JOIN calls ON pred_i = class_i GROUP BY 1")
def prediction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.prediction_counts(calls(spark, sf_dir), spark.range(9).withColumnRenamed("id", "class_i"))


@query(f"WITH {CURVES} SELECT round(sum(area) FILTER (class_i = 1), 9) AS auc FROM curves WHERE raw > 0")
def area_under_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = curves(spark, sf_dir).filter("class_i = 1").withColumn("recall", F.col("recall") / 0.9)
    return evaluate.area(one, "recall", "prec", "step").select(F.round("auc", 9).alias("auc"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS s FROM embeddings), u AS (SELECT vec_id, unnest(s) AS score, generate_subscripts(s, 1) AS class_i FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_i) AS k FROM u)
SELECT a.vec_id, a.class_i AS pred_i, a.score, b.class_i AS runnerup_i, b.score AS runnerup_score FROM r a JOIN r b USING (vec_id) WHERE a.k = 1 AND b.k = 2""")
def winner_and_runner_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("s"), F.sequence(F.lit(1), F.size("embedding")).alias("c"))
    first, second = evaluate.top_two("c", "s")
    return rows.select("vec_id", first["class"].alias("pred_i"), first["score"].alias("score"), second["class"].alias("runnerup_i"), second["score"].alias("runnerup_score"))
