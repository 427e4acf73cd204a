"""More evaluation queries: an event is a call, as in the module of calls, with a runner-up's score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, survey
from .calls import CALLS, calls, recalls
from .registry import query, table

CLASSES = "classes AS (SELECT * FROM (VALUES (1, 'MKPL', true, 2), (2, 'AP', false, 0), (3, 'GGK', true, 0), (4, 'PPP', false, 1), (5, 'TREE', true, 1)) v(class_i, seqstr, is_poi, n_ptms))"


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "MKPL", True, 2), (2, "AP", False, 0), (3, "GGK", True, 0), (4, "PPP", False, 1), (5, "TREE", True, 1)], "class_i int, seqstr string, is_poi boolean, n_ptms int")


@query(f"WITH {CALLS} SELECT row_i, true_i, pred_i, score FROM calls WHERE m > 700 AND pred_i <> 0")
def calls_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.kept(calls(spark, sf_dir), (F.col("score") > 0.7) & (F.col("pred_i") != 0))


@query(f"WITH {CALLS}, {CLASSES} SELECT class_i, seqstr FROM classes WHERE class_i IN (SELECT pred_i FROM calls WHERE m >= 995)")
def called_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.called_peptides(calls(spark, sf_dir), classes(spark), 0.995).select("class_i", "seqstr")


@query("""WITH p AS (SELECT p_partkey AS class_i, upper(regexp_replace(p_name || p_type, '[^A-Za-z]', '', 'g')) AS seqstr, p_size, p_retailprice FROM part), flus AS (SELECT class_i, class_i || '..' AS flustr FROM p WHERE p_size <> 3)
SELECT class_i, seqstr, flustr, seqstr[2] = 'P' AS p2, CASE WHEN p_size > 25 THEN p_retailprice ELSE 0 END AS abundance FROM p LEFT JOIN flus USING (class_i)""")
def peptide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as peptides: letters of name and type, prices as abundance of the large ones."""
    letters = F.upper(F.regexp_replace(F.concat("p_name", "p_type"), "[^A-Za-z]", ""))
    peps = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("class_i"), letters.alias("seqstr"), "p_size", "p_retailprice")
    flus = peps.filter("p_size <> 3").select("class_i", F.concat(F.col("class_i").cast("string"), F.lit("..")).alias("flustr"))
    abundance = peps.filter("p_size > 25").select("class_i", F.col("p_retailprice").alias("abundance"))
    return evaluate.peptide_report(peps.select("class_i"), peps.select("class_i", "seqstr"), flus, abundance)


@query(f"""WITH {CALLS}, steps AS (SELECT unnest(range(1, 51)) AS step), c AS (SELECT pred_i, true_i, step, count(*) FILTER (m >= 1000 - 20 * step) AS n FROM calls CROSS JOIN steps WHERE pred_i <> 0 GROUP BY ALL),
s AS (SELECT pred_i, true_i, step, CAST(floor(n * (true_i * 1.5)) AS BIGINT) AS n FROM c), p AS (SELECT pred_i AS class_i, step, sum(n) AS n_pred, sum(n) FILTER (pred_i = true_i) AS hits FROM s GROUP BY ALL),
t AS (SELECT true_i AS class_i, CAST(floor(count(*) * (true_i * 1.5)) AS BIGINT) AS n_true FROM calls GROUP BY true_i)
SELECT class_i, step, round(1 - step / 50.0, 9) AS threshold, round(CASE WHEN n_pred = 0 THEN 0 ELSE hits / n_pred END, 9) AS prec, round(CASE WHEN n_true = 0 THEN 0 ELSE hits / n_true END * (1 - class_i / 10.0), 9) AS recall FROM p JOIN t USING (class_i)""")
def pr_with_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    abundance = spark.range(1, 6).select(F.col("id").alias("class_i"), (F.col("id") * 1.5).alias("abundance"))
    found = evaluate.pr_with_abundance(calls(spark, sf_dir), abundance, recalls(spark))
    return found.select("class_i", "step", *(F.round(c, 9).alias(c) for c in ("threshold", "prec", "recall")))


@query(f"""WITH {CALLS}, g AS (SELECT pred_i AS class_i, m, count(*) AS n, count(*) FILTER (pred_i = true_i) AS h FROM calls GROUP BY ALL), r AS (SELECT class_i, m, sum(n) OVER w AS n, sum(h) OVER w AS h FROM g WINDOW w AS (PARTITION BY class_i ORDER BY m DESC)),
t AS (SELECT pred_i AS class_i, count(*) FILTER (pred_i = true_i) AS n_true FROM calls GROUP BY 1)
SELECT class_i, m / 1000.0 AS score, round(h / n, 9) AS prec, round(CASE WHEN n_true = 0 THEN 0 ELSE h / n_true END, 9) AS recall FROM r JOIN t USING (class_i)""")
def exact_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = calls(spark, sf_dir).select(F.col("pred_i").alias("class_i"), "score", (F.col("pred_i") == F.col("true_i")).alias("is_true"))
    return evaluate.exact_curve(scores).select("class_i", "score", F.round("prec", 9).alias("prec"), F.round("recall", 9).alias("recall"))


@query(f"""WITH {CALLS}, steps AS (SELECT unnest(range(1, 51)) AS step), k AS (SELECT true_i AS class_i, count(*) AS n_true FROM calls GROUP BY 1),
b AS (SELECT class_i, step, n_true, count(*) FILTER (pred_i = class_i AND m >= 1000 - 20 * step) AS pred, count(*) FILTER (pred_i = class_i AND true_i = class_i AND m >= 1000 - 20 * step) AS hits FROM k CROSS JOIN steps CROSS JOIN calls GROUP BY ALL),
c AS (SELECT class_i, step, CAST(hits AS DOUBLE) / pred AS prec, CAST(hits AS DOUBLE) / n_true * (1 - class_i / 10.0) AS recall FROM b WHERE hits > 0)
SELECT class_i, round(coalesce(max_by(recall, step) FILTER (prec > 0.9), 0), 9) AS recall FROM c GROUP BY 1""")
def recall_of_last_precise_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.last_recall_above(evaluate.pr_curves(calls(spark, sf_dir), recalls(spark)), 0.9).withColumn("recall", F.round("recall", 9))


@query(f"""WITH {CALLS}, sites AS (SELECT * FROM (VALUES (1, 4), (1, 9), (4, 9)) v(class_i, site)), u AS (SELECT row_i, true_i, pred_i, m * (1000 - m) AS mm, unnest(list_distinct([true_i, pred_i])) AS class_i FROM calls)
SELECT site, count(*) AS n, round(sum(mm / 1000000.0), 4) AS score FROM (SELECT DISTINCT row_i, mm, site FROM u JOIN sites USING (class_i)) GROUP BY 1""")
def site_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir).withColumn("true_i", F.col("true_i").cast("long")).withColumn("pred_i", F.col("pred_i").cast("long")).withColumn("runnerup_score", 1 - F.col("score"))
    sites = spark.createDataFrame([(1, 4), (1, 9), (4, 9)], "class_i long, site int")
    return evaluate.site_calls(rows, sites).groupBy("site").agg(F.count("*").alias("n"), F.round(F.sum("score"), 4).alias("score"))


@query(f"""WITH {CALLS}, s AS (SELECT 'before' AS "when", pred_i, true_i FROM calls UNION ALL SELECT 'after', CASE WHEN m >= 400 THEN pred_i ELSE 0 END, true_i FROM calls)
SELECT "when", count(*) FILTER (pred_i = 2) AS n, count(*) FILTER (pred_i = 2 AND true_i = 2) AS n_correct, count(*) FILTER (pred_i = 2 AND true_i = 2) / count(*) FILTER (pred_i = 2) AS prec, count(*) FILTER (pred_i = 2 AND true_i = 2) / count(*) FILTER (true_i = 2) AS recall FROM s GROUP BY 1""")
def before_and_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.before_and_after(calls(spark, sf_dir), 0.4, 2)


@query(f"""WITH {CALLS}, l AS (SELECT * FROM (VALUES (1, '00'), (2, '10'), (3, '11'), (9, '22')) v(row, label)) SELECT l.row AS "row", label, count(pred_i) AS n FROM l LEFT JOIN (SELECT * FROM calls WHERE m >= 500) ON pred_i = l.row GROUP BY ALL""")
def score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.score_counts(calls(spark, sf_dir), spark.createDataFrame([(1, "00"), (2, "10"), (3, "11"), (9, "22")], "row int, label string"), 0.5)


@query("WITH s AS (SELECT p_partkey AS pep_i, p_brand || p_size % 5 AS dyeseq FROM part WHERE p_size % 5 > 0), f AS (SELECT dyeseq, min(pep_i) AS canonical_i, count(*) AS n FROM s GROUP BY 1) SELECT pep_i, canonical_i, n FROM s JOIN f USING (dyeseq)")
def canonical_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 5
    seqs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pep_i"), F.when(size > 0, F.concat(F.col("p_brand"), size.cast("string"))).otherwise("").alias("dyeseq"))
    first, canonical = evaluate.canonical_peptides(seqs)
    return canonical.join(first.select(F.col("pep_i").alias("canonical_i"), "n"), "canonical_i").select("pep_i", "canonical_i", "n")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority < '3'")
def passing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderpriority") < "3").alias("pass_all"))
    return evaluate.passing(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), filters, "l_orderkey")


@query(f"""WITH {CALLS}, {CLASSES}, n AS (SELECT class_i, count(*) AS n FROM classes JOIN calls ON true_i = class_i WHERE is_poi GROUP BY 1 ORDER BY n DESC, class_i LIMIT 2), steps AS (SELECT unnest(range(1, 51)) AS step),
b AS (SELECT class_i, step, count(*) FILTER (pred_i = class_i AND true_i = class_i AND m >= 1000 - 20 * step) AS hits FROM n CROSS JOIN steps CROSS JOIN calls GROUP BY ALL)
SELECT class_i, count(*) AS n_steps FROM b WHERE hits > 0 GROUP BY 1""")
def breakout_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.breakout_curves(calls(spark, sf_dir), recalls(spark), classes(spark), "poi", most=2)
    return found.groupBy("class_i").agg(F.count("*").alias("n_steps"))


@query(f"WITH {CALLS}, r AS (SELECT CASE WHEN row_i % 2 = 0 THEN 'even' ELSE 'odd' END AS run, pred_i FROM calls) SELECT run, pred_i AS class_i, count(*) AS n FROM r GROUP BY ALL")
def calls_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir)
    return evaluate.across_runs({"even": rows.filter("row_i % 2 = 0"), "odd": rows.filter("row_i % 2 = 1")}).groupBy("run", F.col("pred_i").alias("class_i")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT l_orderkey AS pro_i, l_discount AS nn_dist, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber) AS rank FROM lineitem)
SELECT rank, count(DISTINCT pro_i) AS n_proteins, round(avg(nn_dist), 9) AS avg_dist, min(nn_dist) AS min_dist FROM s WHERE rank <= 4 GROUP BY 1""")
def neighbour_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pro_i"), F.col("l_discount").alias("nn_dist"), F.lit(0).alias("pep_len"), F.lit(0).alias("n_dyes"), F.col("l_linenumber").alias("pep_i"))
    return survey.neighbour_metrics(survey.ranked(line, 4)).withColumn("avg_dist", F.round("avg_dist", 9))


@query("""WITH s AS (SELECT l_suppkey AS pro_i, l_partkey % 200 AS start, l_partkey % 200 + CAST(l_quantity AS BIGINT) AS stop FROM lineitem), r AS (SELECT pro_i, unnest(range(start, stop)) AS spot FROM s)
SELECT pro_i, round(count(DISTINCT spot) / 300.0, 9) AS coverage FROM r GROUP BY 1""")
def coverage_of_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_partkey") % 200
    spans = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pro_i"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("stop"))
    return survey.coverage_of_spans(spans, spans.select("pro_i", F.lit(300).alias("pro_len")).distinct()).withColumn("coverage", F.round("coverage", 9))


@query("WITH a AS (SELECT 'small' AS scheme, p_brand, count(*) AS n FROM part WHERE p_size < 10 GROUP BY ALL UNION ALL SELECT 'large', p_brand, count(*) FROM part WHERE p_size >= 10 GROUP BY ALL) SELECT * FROM a")
def stacked_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    by = lambda rows: rows.groupBy("p_brand").agg(F.count("*").alias("n"))
    return survey.of_schemes({"small": by(part.filter("p_size < 10")), "large": by(part.filter("p_size >= 10"))})
