"""Report queries: sweeps, per-run tables, field quality, survey assembly; carriers as in the other modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import seq
from ..functions.arrays import safe_divide
from .calls import CALLS, calls
from .registry import query, table
from .sequences import FLU, PEPS, flus, placed


@query(f"""WITH {CALLS}, cuts AS (SELECT unnest(range(1, 11)) AS cut), classes AS (SELECT DISTINCT true_i AS class_i FROM calls),
c AS (SELECT cut, class_i, count(*) FILTER (pred_i = class_i AND true_i = class_i AND m >= cut * 100) AS tp, count(*) FILTER (pred_i = class_i AND m >= cut * 100) AS p, count(*) FILTER (true_i = class_i) AS t FROM cuts CROSS JOIN classes CROSS JOIN calls GROUP BY ALL)
SELECT class_i, string_agg(cut, ',' ORDER BY cut) AS cuts, round(sum(CAST(tp AS DOUBLE) / p), 9) AS prec_sum, round(sum(CAST(tp AS DOUBLE) / t), 9) AS recall_sum FROM c WHERE tp > 0 GROUP BY 1""")
def pr_info_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of each class at ten cutoffs, those with any hit, as lists by class."""
    rows = calls(spark, sf_dir)
    # A score counts at all cutoffs up to its own: one row a class and cutoff after the first sum.
    top = F.least(F.lit(10), F.floor(F.round(F.col("score") * 10, 6))).cast("int")
    by_cut = rows.withColumn("cut", top).groupBy(F.col("pred_i").alias("class_i"), "cut").agg(F.count("*").alias("p"), F.count_if(F.col("pred_i") == F.col("true_i")).alias("tp"))
    grid = rows.groupBy(F.col("true_i").alias("class_i")).agg(F.count("*").alias("t")).withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(10))))
    down = Window.partitionBy("class_i").orderBy(F.col("cut").desc()).rowsBetween(Window.unboundedPreceding, 0)
    runs = grid.join(by_cut, ["class_i", "cut"], "left").na.fill(0).withColumn("p", F.sum("p").over(down)).withColumn("tp", F.sum("tp").over(down)).filter("cut > 0 and tp > 0")
    return runs.groupBy("class_i").agg(F.array_join(F.transform(F.array_sort(F.collect_list("cut")), lambda x: x.cast("string")), ",").alias("cuts"), F.round(F.sum(safe_divide(F.col("tp"), F.col("p"))), 9).alias("prec_sum"), F.round(F.sum(safe_divide(F.col("tp"), F.col("t"))), 9).alias("recall_sum"))


@query(f"WITH {CALLS} SELECT pred_i AS class_i, count(*) AS n FROM calls WHERE m >= 250 AND pred_i IN (1, 3) GROUP BY 1")
def count_at_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls(spark, sf_dir).filter("score >= 0.25 and pred_i in (1, 3)").groupBy(F.col("pred_i").alias("class_i")).agg(F.count("*").alias("n"))


@query(f"""WITH {CALLS}, e AS (SELECT pred_i AS class_i, row_i % 3 AS run FROM calls WHERE m >= 100), g AS (SELECT unnest(range(0, 6)) AS class_i)
SELECT g.class_i, count(*) FILTER (run = 0) / 3.0 AS run_0, count(*) FILTER (run = 1) / 3.0 AS run_1, count(*) FILTER (run = 2) / 3.0 AS run_2 FROM g LEFT JOIN e USING (class_i) GROUP BY 1""")
def class_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls above a score by class and run, over the number of cycles."""
    rows = calls(spark, sf_dir).filter("score >= 0.1").withColumn("run", F.col("row_i") % 3)
    wide = rows.groupBy(F.col("pred_i").alias("class_i")).pivot("run", [0, 1, 2]).count()
    grid = spark.range(6).withColumnRenamed("id", "class_i")
    return grid.join(wide, "class_i", "left").select("class_i", *((F.coalesce(str(r), F.lit(0)) / 3.0).alias(f"run_{r}") for r in range(3)))


@query(f"WITH {CALLS} SELECT row_i % 4 AS run, count(DISTINCT pred_i) AS n_classes, string_agg(DISTINCT pred_i, ',' ORDER BY pred_i) AS classes FROM calls WHERE m > 300 GROUP BY 1")
def run_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir).filter("score > 0.3").groupBy((F.col("row_i") % 4).alias("run")).agg(F.array_sort(F.collect_set("pred_i")).alias("c"))
    return rows.select("run", F.size("c").cast("long").alias("n_classes"), F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("classes"))


@query(f"""WITH {CALLS}, b AS (SELECT pred_i AS class_i, row_i % 4 AS run, avg(CASE WHEN pred_i = true_i THEN 1.0 ELSE 0 END) AS prec, count(*) AS n FROM calls GROUP BY ALL),
w AS (SELECT class_i, run FROM b QUALIFY row_number() OVER (PARTITION BY class_i ORDER BY prec DESC, n DESC, run) = 1)
SELECT run, count(*) AS n_won, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM w), 9) AS share FROM w GROUP BY 1""")
def best_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of classes that each run is best at, by precision, then calls."""
    by = calls(spark, sf_dir).groupBy(F.col("pred_i").alias("class_i"), (F.col("row_i") % 4).alias("run")).agg(F.avg(F.when(F.col("pred_i") == F.col("true_i"), 1.0).otherwise(0.0)).alias("prec"), F.count("*").alias("n"))
    won = by.groupBy("class_i").agg(F.max_by("run", F.struct("prec", "n", -F.col("run"))).alias("run"))
    return won.groupBy("run").agg(F.count("*").alias("n_won")).withColumn("share", F.round(F.col("n_won") / F.sum("n_won").over(Window.partitionBy()), 9))


@query("""SELECT l_suppkey AS field_i, l_linenumber AS channel_i, round(max(sqrt(l_discount ** 2 + l_tax ** 2)), 9) AS max_shift, round(avg(l_quantity), 9) AS mean_quality, max(sqrt(l_discount ** 2 + l_tax ** 2)) <= 0.12 AS aligned FROM lineitem GROUP BY ALL""")
def field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest shift and mean quality of each field and channel; well aligned where the shift is small."""
    shift = F.max(F.sqrt(F.pow("l_discount", F.lit(2)) + F.pow("l_tax", F.lit(2))))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("field_i"), F.col("l_linenumber").alias("channel_i")).agg(F.round(shift, 9).alias("max_shift"), F.round(F.avg("l_quantity"), 9).alias("mean_quality"), (shift <= 0.12).alias("aligned"))


@query("WITH m AS (SELECT l_suppkey AS field_i, avg(l_quantity) AS q FROM lineitem GROUP BY 1) SELECT field_i, round(q, 9) AS q FROM m WHERE (SELECT count(*) FROM m) <= 20 OR q > (SELECT median(q) FROM m)")
def calibration_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with more than the median quality, if there are more than twenty."""
    by = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("field_i")).agg(F.avg("l_quantity").alias("q"))
    few = by.agg(F.median("q").alias("m"), F.count("*").alias("n"))
    return by.join(F.broadcast(few), (F.col("n") <= 20) | (F.col("q") > F.col("m"))).select("field_i", F.round("q", 9).alias("q"))


@query(f"""WITH {PEPS} SELECT doc_id, pep_in_pro, pep_stop - pep_start AS pep_len, coalesce(pep[2] = 'P', false) AS p2, pep_start, md5(pep) AS digest FROM spans""")
def survey_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir, "lysc").select(F.col("pro_i").alias("doc_id"), "pep_in_pro", F.char_length("pep").alias("pep_len"), (F.substring("pep", 2, 1) == "P").alias("p2"), "pep_start", F.md5("pep").alias("digest"))


@query(f"WITH {FLU}, c AS (SELECT flustr, count(DISTINCT (doc_id, pep_in_pro)) AS n_peps FROM flus GROUP BY 1) SELECT flustr, n_peps FROM c ORDER BY n_peps DESC, flustr LIMIT 10")
def peptides_per_flu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten patterns that most peptides share."""
    return flus(spark, sf_dir).groupBy("flustr").agg(F.count("*").alias("n_peps")).orderBy(F.col("n_peps").desc(), "flustr").limit(10)


@query(f"""WITH {FLU}, c AS (SELECT doc_id, flustr, count(*) OVER (PARTITION BY flustr) AS k, n FROM flus)
SELECT count(*) FILTER (k = 1) AS n_unique, round(CAST(coalesce(sum(n) FILTER (k = 1), 0) AS DOUBLE) / sum(n), 9) AS coverage, max(n) AS longest FROM c""")
def survey_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    peps = flus(spark, sf_dir).groupBy("flustr").agg(F.count("*").alias("k"), F.sum(F.char_length("pep")).alias("n"), F.max(F.char_length("pep")).alias("longest"))
    return peps.agg(F.count_if(F.col("k") == 1).alias("n_unique"), F.round(F.coalesce(F.sum(F.when(F.col("k") == 1, F.col("n"))), F.lit(0)) / F.sum("n"), 9).alias("coverage"), F.max("longest").alias("longest"))


@query("WITH a AS (SELECT l_suppkey AS field_i, avg(l_discount) AS dy, avg(l_tax) AS dx FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity - dy, 9) AS raw_y, round(l_extendedprice - dx, 6) AS raw_x, l_suppkey % 5 AS region FROM lineitem JOIN a ON l_suppkey = field_i")
def raw_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places before alignment: aligned ones less their field's shift; and the region of each."""
    line = table(spark, sf_dir, "lineitem")
    shifts = line.groupBy("l_suppkey").agg(F.avg("l_discount").alias("dy"), F.avg("l_tax").alias("dx"))
    return line.join(shifts, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_quantity") - F.col("dy"), 9).alias("raw_y"), F.round(F.col("l_extendedprice") - F.col("dx"), 6).alias("raw_x"), (F.col("l_suppkey") % 5).alias("region"))


@query("WITH r AS (SELECT l_suppkey AS pep_i, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) AS recall FROM lineitem GROUP BY 1) SELECT pep_i, round(recall, 9) AS recall, rank() OVER (ORDER BY recall DESC) AS place, count(*) FILTER (recall > 0) OVER () AS n_some FROM r")
def labelability_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptides by recall; the table has one row a peptide."""
    by = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("pep_i")).agg(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("recall"))
    some = F.count_if(F.col("recall") > 0).over(Window.partitionBy())
    return by.select("pep_i", F.round("recall", 9).alias("recall"), F.rank().over(Window.orderBy(F.col("recall").desc())).alias("place"), some.alias("n_some"))


@query("SELECT o_custkey AS pro_i, bool_or(o_orderstatus = 'F') AS is_poi, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_ptms FROM orders GROUP BY 1")
def poi_and_ptms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("pro_i")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("is_poi"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_ptms"))
