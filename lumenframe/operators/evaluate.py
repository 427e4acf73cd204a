"""Evaluation of calls: rows (row_i, true_i, pred_i, score), one a classified read; class 0 is "no call".

Threshold sweeps bin every score once and take suffix sums over bins, so no plan holds calls times
thresholds. Windows run by class, or over one row a threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import safe_divide
from .quantiles import exact_quantiles
from .relational import PER_BUCKET, even_buckets, running


def thresholded(calls: DataFrame, keep: Column) -> DataFrame:
    """Scores of rows outside of the mask become 0; all rows stay."""
    return calls.withColumn("score", F.when(keep, F.col("score")).otherwise(F.lit(0.0)))


def above_percentile(calls: DataFrame, q: float) -> DataFrame:
    """Rows with a score strictly above the exact percentile."""
    cut = exact_quantiles(calls, [], "score", [q]).select(F.col("q0").alias("cut"))
    return calls.join(F.broadcast(cut), F.col("score") > F.col("cut")).drop("cut")


def correct(calls: DataFrame) -> DataFrame:
    return calls.filter("true_i = pred_i")


def runner_up_for_nul(calls: DataFrame) -> DataFrame:
    """Where class 0 won, the runner-up takes its place."""
    nul = F.col("pred_i") == 0
    return calls.withColumn("score", F.when(nul, F.col("runnerup_score")).otherwise(F.col("score"))).withColumn("pred_i", F.when(nul, F.col("runnerup_i")).otherwise(F.col("pred_i")))


def poi_or_all(calls: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes of proteins that aren't of interest become 0; classes has (class_i, is_poi)."""
    return calls.join(classes.select(F.col("class_i").alias("true_i"), "is_poi"), "true_i", "left").withColumn("y", F.when(F.coalesce("is_poi", F.lit(False)), F.col("true_i")).otherwise(0)).drop("is_poi")


def confusion(calls: DataFrame, at: float | None = None) -> DataFrame:
    """(pred_i, true_i, n): counts; calls with a score below `at` count as class 0."""
    pred = F.col("pred_i") if at is None else F.when(F.col("score") >= at, F.col("pred_i")).otherwise(0)
    return calls.select(pred.alias("pred_i"), "true_i").groupBy("pred_i", "true_i").agg(F.count("*").alias("n"))


def scaled_by_abundance(matrix: DataFrame, abundance: DataFrame) -> DataFrame:
    """Counts times their true class's abundance, cut to whole numbers; abundance has (class_i, abundance)."""
    joined = matrix.join(abundance.select(F.col("class_i").alias("true_i"), "abundance"), "true_i", "left")
    return joined.withColumn("n", (F.col("n") * F.coalesce("abundance", F.lit(0.0))).cast("long")).drop("abundance")


def precision_recall(matrix: DataFrame) -> DataFrame:
    """(class_i, n_pred, n_true, n_correct, prec, recall) of every class in a confusion matrix; 0 where nothing is divided by."""
    rows = matrix.groupBy(F.col("pred_i").alias("class_i")).agg(F.sum("n").alias("n_pred"), F.sum(F.when(F.col("pred_i") == F.col("true_i"), F.col("n")).otherwise(0)).alias("n_correct"))
    cols = matrix.groupBy(F.col("true_i").alias("class_i")).agg(F.sum("n").alias("n_true"))
    both = rows.join(cols, "class_i", "full_outer").na.fill(0)
    return both.select("class_i", "n_pred", "n_true", "n_correct", safe_divide(F.col("n_correct"), F.col("n_pred")).alias("prec"), safe_divide(F.col("n_correct"), F.col("n_true")).alias("recall"))


def class_evaluation(calls: DataFrame, recalls: DataFrame, at: float = 0.0) -> DataFrame:
    """Per class but 0: hits, misses, misses with what the lab lost, and score range; recalls has (class_i, pep_recall).

    Only hits and false hits are thresholded; misses aren't.
    """
    hit = F.col("score") >= at
    by_pred = calls.filter("pred_i <> 0").groupBy(F.col("pred_i").alias("class_i")).agg(F.count_if(hit & (F.col("true_i") == F.col("pred_i"))).alias("n_tp"), F.count_if(hit & (F.col("true_i") != F.col("pred_i"))).alias("n_fp"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
    by_true = calls.filter("true_i <> 0").groupBy(F.col("true_i").alias("class_i")).agg(F.count("*").alias("n_true"), F.count_if(F.col("true_i") != F.col("pred_i")).alias("n_fn"))
    both = by_pred.join(by_true, "class_i", "left").join(recalls, "class_i", "left").na.fill(0, ["n_true", "n_fn"]).na.fill(1.0, ["pep_recall"])
    lost = F.bround(F.col("n_true") * (1 - F.col("pep_recall"))).cast("long")
    both = both.withColumn("n_fn_corr", F.col("n_fn") + lost)
    ratio = lambda miss: safe_divide(F.col("n_tp"), F.col("n_tp") + F.col(miss))
    return both.select("class_i", "n_tp", "n_fp", "n_fn", "n_fn_corr", ratio("n_fp").alias("prec"), ratio("n_fn").alias("recall"), ratio("n_fn_corr").alias("recall_corr"), "min_score", "max_score")


def pr_curves(calls: DataFrame, recalls: DataFrame, n_steps: int = 50) -> DataFrame:
    """(class_i, step, threshold, prec, recall, auc): for each class, at thresholds 1 - 1/n, ..., 0.

    recall is scaled by the class's pep_recall, auc, a running sum of recall steps times precision,
    is not. Steps before the first recall are left out.
    """
    # The first step whose threshold is at most the score; scores have at most nine decimals.
    step = F.greatest(F.lit(1), F.ceil(F.round((1 - F.col("score")) * n_steps, 7))).cast("int")
    binned = calls.withColumn("step", F.least(step, F.lit(n_steps)))
    by_pred = binned.groupBy(F.col("pred_i").alias("class_i"), "step").agg(F.count("*").alias("n_pred"), F.count_if(F.col("pred_i") == F.col("true_i")).alias("n_correct"))
    totals = calls.groupBy(F.col("true_i").alias("class_i")).agg(F.count("*").alias("n_true"))
    grid = totals.filter("class_i <> 0").withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_steps))))
    upto = Window.partitionBy("class_i").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    runs = grid.join(by_pred, ["class_i", "step"], "left").na.fill(0)
    runs = runs.withColumn("pred", F.sum("n_pred").over(upto)).withColumn("hits", F.sum("n_correct").over(upto))
    runs = runs.withColumn("prec", safe_divide(F.col("hits"), F.col("pred"))).withColumn("raw", safe_divide(F.col("hits"), F.col("n_true")))
    rise = F.col("raw") - F.coalesce(F.lag("raw").over(Window.partitionBy("class_i").orderBy("step")), F.lit(0.0))
    runs = runs.withColumn("area", rise * F.col("prec")).withColumn("auc", F.sum("area").over(upto)).filter("raw > 0")
    scaled = runs.join(recalls, "class_i", "left")
    return scaled.select("class_i", "step", (1 - F.col("step") / n_steps).alias("threshold"), "prec", (F.col("raw") * F.coalesce("pep_recall", F.lit(1.0))).alias("recall"), "auc")


def recall_at_precision(curves: DataFrame, precision: float) -> DataFrame:
    """Per class the lowest threshold with at least this precision; zeros if there is none."""
    good = F.col("prec") >= precision
    best = curves.groupBy("class_i").agg(F.max(F.when(good, F.struct("step", "threshold", "prec", "recall"))).alias("best"))
    zero = lambda c: F.coalesce(F.col("best")[c], F.lit(0.0)).alias(c)
    return best.select("class_i", zero("threshold"), zero("prec"), zero("recall"))


def above_both(curves: DataFrame, precision: float, recall: float) -> DataFrame:
    """Classes with a point above both bounds."""
    return curves.groupBy("class_i").agg(F.bool_or((F.col("prec") > precision) & (F.col("recall") > recall)).alias("ok")).filter("ok").select("class_i")


def best_precision(curves: DataFrame, least_recall: float) -> DataFrame:
    """Per class the point of highest precision among those with more recall; the first of equals."""
    best = curves.filter(F.col("recall") > least_recall).groupBy("class_i").agg(F.max_by(F.struct("threshold", "prec", "recall"), F.struct("prec", -F.col("step"))).alias("b"))
    return best.select("class_i", "b.threshold", "b.prec", "b.recall")


def observability(curves: DataFrame, n_points: int = 51) -> DataFrame:
    """(prec, n_classes): classes that reach each precision with some recall."""
    best = curves.filter("recall > 0").groupBy("class_i").agg(F.max("prec").alias("best"))
    # A class counts at every point up to its own: one row a point after the first sum.
    reach = best.select(F.floor(F.round(F.col("best") * (n_points - 1), 7)).cast("int").alias("point")).groupBy("point").agg(F.count("*").alias("n"))
    grid = best.sparkSession.range(n_points).select(F.col("id").cast("int").alias("point")).join(reach, "point", "left")
    down = Window.orderBy(F.col("point").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return grid.select((F.col("point") / (n_points - 1)).alias("prec"), F.coalesce(F.sum("n").over(down), F.lit(0)).alias("n_classes"))


def running_fdr(calls: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Adds n_above, fdr and truth_fdr: shares of decoys, and of wrong calls, among calls with at least this rank by score.

    calls has is_decoy. Ranks go by score, then row_i. Sums go by even buckets of that order first, so no
    task sorts all calls, nor all calls of one score.
    """
    wrong, decoy = (F.col("pred_i") != F.col("true_i")).cast("int"), F.col("is_decoy").cast("int")
    bucket = even_buckets(calls, F.struct((-F.col("score")).alias("s"), F.col("row_i").alias("r")), per_bucket)
    runs = running(calls, [F.col("score").desc(), F.col("row_i")], {"n_above": F.lit(1).cast("long"), "decoys": decoy, "wrongs": wrong}, bucket, upto=0)
    return runs.select(*calls.columns, "n_above", (F.col("decoys") / F.col("n_above")).alias("fdr"), (F.col("wrongs") / F.col("n_above")).alias("truth_fdr"), safe_divide(F.col("decoys"), F.col("wrongs")).alias("p_wrong_is_decoy"))


def top_falses(matrix: DataFrame, n: int) -> DataFrame:
    """(class_i, kind, other_i, weight, rank): per class the n largest shares of other classes in its row (FP) and column (FN)."""
    off = F.col("pred_i") != F.col("true_i")
    out = []
    for kind, own, other in (("fp", "pred_i", "true_i"), ("fn", "true_i", "pred_i")):
        totals = matrix.groupBy(own).agg(F.sum("n").alias("total"))
        rows = matrix.filter(off & (F.col(own) != 0) & (F.col("n") > 0)).join(totals, own).withColumn("weight", F.col("n") / F.col("total"))
        rank = F.row_number().over(Window.partitionBy(own).orderBy(F.col("n").desc(), other))
        out.append(rows.withColumn("rank", rank).filter(F.col("rank") <= n).select(F.col(own).alias("class_i"), F.lit(kind).alias("kind"), F.col(other).alias("other_i"), "weight", "rank"))
    return out[0].unionByName(out[1])


def prediction_counts(calls: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_i, n): calls of every class in classes (class_i), 0 where there are none."""
    return classes.join(calls.groupBy(F.col("pred_i").alias("class_i")).agg(F.count("*").alias("n")), "class_i", "left").na.fill(0, ["n"])


def average_scores(calls: DataFrame, by: str = "pred_i") -> DataFrame:
    return calls.groupBy(F.col(by).alias("class_i")).agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))


def area(points: DataFrame, x: str, y: str, order: str) -> DataFrame:
    """Rectangular area under y over x from 0, one row."""
    step = F.col(x) - F.coalesce(F.lag(x).over(Window.orderBy(order)), F.lit(0.0))
    return points.withColumn("_a", step * F.col(y)).agg(F.sum("_a").alias("auc"))


def top_two(classes: str, scores: str) -> tuple[Column, Column]:
    """Winner and runner-up, as structs (score, class), of parallel arrays; equal scores go to the smaller class."""
    order = F.array_sort(F.zip_with(classes, scores, lambda c, s: F.struct((-s).alias("neg"), c.alias("class"))))
    pick = lambda i: F.struct((-F.get(order, F.lit(i))["neg"]).alias("score"), F.get(order, F.lit(i))["class"].alias("class"))
    return pick(0), pick(1)


def kept(calls: DataFrame, keep: Column) -> DataFrame:
    """The row filter: rows outside of the mask, or for which it is null, are gone."""
    return calls.filter(keep)


def called_peptides(calls: DataFrame, peps: DataFrame, at: float = 0.0) -> DataFrame:
    """Rows of peps (class_i, ...) that were called at least once with this score: distinct first, then joined."""
    called = calls.filter((F.col("score") >= at) & (F.col("pred_i") != 0)).select(F.col("pred_i").alias("class_i")).distinct()
    return peps.join(called, "class_i", "left_semi")


def peptide_report(peps: DataFrame, strings: DataFrame, flus: DataFrame, abundance: DataFrame | None = None) -> DataFrame:
    """peps (class_i, ...) with their sequence (class_i, seqstr), whether its second residue is proline, pattern (class_i, flustr) and abundance, 0 if unknown."""
    out = peps.join(strings, "class_i", "left").join(flus, "class_i", "left").withColumn("p2", F.coalesce(F.substring("seqstr", 2, 1) == "P", F.lit(False)))
    return out if abundance is None else out.join(abundance, "class_i", "left").na.fill(0.0, ["abundance"])


def pr_with_abundance(calls: DataFrame, abundance: DataFrame, recalls: DataFrame, n_steps: int = 50) -> DataFrame:
    """(class_i, step, threshold, prec, recall): curves of counts that are scaled by their true class's abundance and cut to whole numbers at every threshold.

    abundance: (class_i, abundance); recalls: (class_i, pep_recall). Calls below a threshold count as class 0.
    """
    step = F.least(F.greatest(F.lit(1), F.ceil(F.round((1 - F.col("score")) * n_steps, 7))), F.lit(n_steps)).cast("int")
    # Cells of the confusion matrix by first step, then running sums by cell: no plan holds calls times thresholds.
    cells = calls.filter("pred_i <> 0").groupBy("pred_i", "true_i", step.alias("step")).agg(F.count("*").alias("n"))
    grid = cells.select("pred_i", "true_i").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_steps))))
    upto = Window.partitionBy("pred_i", "true_i").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    runs = grid.join(cells, ["pred_i", "true_i", "step"], "left").na.fill(0, ["n"]).withColumn("n", F.sum("n").over(upto))
    scaled = scaled_by_abundance(runs, abundance)
    by_pred = scaled.groupBy(F.col("pred_i").alias("class_i"), "step").agg(F.sum("n").alias("n_pred"), F.sum(F.when(F.col("pred_i") == F.col("true_i"), F.col("n")).otherwise(0)).alias("hits"))
    totals = scaled_by_abundance(calls.groupBy("true_i").agg(F.count("*").alias("n")), abundance).select(F.col("true_i").alias("class_i"), F.col("n").alias("n_true"))
    rows = by_pred.join(totals, "class_i").join(recalls, "class_i", "left")
    recall = safe_divide(F.col("hits"), F.col("n_true")) * F.coalesce("pep_recall", F.lit(1.0))
    return rows.select("class_i", "step", (1 - F.col("step") / n_steps).alias("threshold"), safe_divide(F.col("hits"), F.col("n_pred")).alias("prec"), recall.alias("recall"))


def exact_curve(scores: DataFrame) -> DataFrame:
    """(class_i, score, prec, recall) at every distinct score: scores has (class_i, score, is_true), a row a read and class."""
    by = scores.groupBy("class_i", "score").agg(F.count("*").alias("n"), F.sum(F.col("is_true").cast("long")).alias("hits"))
    down = Window.partitionBy("class_i").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    runs = by.withColumn("n", F.sum("n").over(down)).withColumn("hits", F.sum("hits").over(down))
    total = scores.groupBy("class_i").agg(F.sum(F.col("is_true").cast("long")).alias("n_true"))
    return runs.join(total, "class_i").select("class_i", "score", (F.col("hits") / F.col("n")).alias("prec"), safe_divide(F.col("hits"), F.col("n_true")).alias("recall"))


def last_recall_above(curves: DataFrame, precision: float) -> DataFrame:
    """(class_i, recall) at the last step whose precision is above the bound; 0 if there is none."""
    best = curves.groupBy("class_i").agg(F.max(F.when(F.col("prec") > precision, F.struct("step", "recall"))).alias("b"))
    return best.select("class_i", F.coalesce("b.recall", F.lit(0.0)).alias("recall"))


def site_calls(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """Calls whose true or called peptide has a site: score is the product with the runner-up's; sites: (class_i, site). One row a call and site."""
    both = calls.select("row_i", "true_i", "pred_i", (F.col("score") * F.col("runnerup_score")).alias("score"), F.explode(F.array_distinct(F.array("true_i", "pred_i"))).alias("class_i"))
    return both.join(sites, "class_i").select("row_i", "true_i", "pred_i", "score", "site").distinct()


def before_and_after(calls: DataFrame, at: float, class_i: int) -> DataFrame:
    """(when, n, n_correct, prec, recall) of one class without a threshold and with it."""
    out = []
    for when, threshold in (("before", None), ("after", at)):
        out.append(precision_recall(confusion(calls, threshold)).filter(F.col("class_i") == class_i).select(F.lit(when).alias("when"), F.col("n_pred").alias("n"), "n_correct", "prec", "recall"))
    return out[0].unionByName(out[1])


def across_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """Calls of several runs, stacked with the run's name."""
    out = None
    for name, calls in runs.items():
        tagged = calls.withColumn("run", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def breakout_curves(calls: DataFrame, recalls: DataFrame, classes: DataFrame, subset: str = "all", most: int = 50, n_steps: int = 50) -> DataFrame:
    """Curves of the classes that are of interest ("poi"), have sites ("ptm") or all, of the `most` with most true calls; classes: (class_i, is_poi, n_ptms)."""
    wanted = {"all": F.lit(True), "poi": F.col("is_poi"), "ptm": F.col("n_ptms") > 0}[subset]
    counts = calls.groupBy(F.col("true_i").alias("class_i")).agg(F.count("*").alias("n"))
    chosen = classes.filter(wanted).join(counts, "class_i").orderBy(F.col("n").desc(), "class_i").limit(most).select("class_i")
    return pr_curves(calls, recalls, n_steps).join(F.broadcast(chosen), "class_i", "left_semi")


def score_counts(calls: DataFrame, labels: DataFrame, at: float = 0.0) -> DataFrame:
    """(row, label, n): calls of at least this score by class, with the label of the class's row from 1; labels: (row, label)."""
    counts = calls.filter((F.col("score") >= at) & (F.col("pred_i") > 0)).groupBy(F.col("pred_i").alias("row")).agg(F.count("*").alias("n"))
    return labels.join(counts, "row", "left").na.fill(0, ["n"])


def canonical_peptides(seqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dyeseq, pep_i, n): the first peptide and the number of peptides of each dye sequence; and (pep_i, canonical_i). seqs: (pep_i, dyeseq)."""
    lit = seqs.filter("dyeseq is not null and dyeseq <> ''")
    first = lit.groupBy("dyeseq").agg(F.min("pep_i").alias("pep_i"), F.count("*").alias("n"))
    return first, lit.join(first.select("dyeseq", F.col("pep_i").alias("canonical_i")), "dyeseq").select("pep_i", "canonical_i")


def passing(radmats: DataFrame, filters: DataFrame, key: str = "row_i") -> DataFrame:
    """Rows whose filter row says pass_all, before they are classified."""
    return radmats.join(filters.filter("pass_all").select(key), key, "left_semi")


def nearest_classes(radmats: DataFrame, tracks: DataFrame, likely: DataFrame, k: int, sigma: float, block: int = 2000) -> DataFrame:
    """(row_i, pred_i, score): reads by the peptides of their k nearest expected tracks, with weights that fall by a normal law of width sigma.

    radmats: (row_i, radmat) in dyes; tracks: (dyt_i, vec); likely: (dyt_i, pep_i, p). Reads meet the broadcast
    tracks of their own experiment, which are bounded by its scheme, block by block.
    """
    known = tracks.select("dyt_i", F.col("vec").cast("array<double>").alias("vec")).orderBy("dyt_i").toPandas()
    spark = radmats.sparkSession
    shared = spark.sparkContext.broadcast((known["dyt_i"].to_numpy(), np.array(known["vec"].tolist(), float).reshape(len(known), -1)))

    def run(batches):
        ids, vecs = shared.value
        for batch in batches:
            rows = []
            for begin in range(0, batch.num_rows, block):
                part = batch.slice(begin, block)
                x = np.array(part.column("radmat").to_pylist(), float)
                d = ((x * x).sum(axis=1)[:, None] + (vecs * vecs).sum(axis=1)[None, :] - 2 * x @ vecs.T).clip(0)
                near = np.argsort(d, axis=1, kind="stable")[:, :k]
                weight = np.exp(-np.take_along_axis(d, near, axis=1) / (2 * sigma * sigma))
                rows.append((np.repeat(part.column("row_i").to_numpy(), near.shape[1]), ids[near].ravel(), weight.ravel()))
            columns = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["row_i", "dyt_i", "w"])

    near = radmats.select(F.col("row_i").cast("long").alias("row_i"), F.col("radmat").cast("array<double>").alias("radmat")).mapInArrow(run, "row_i long, dyt_i long, w double")
    by = near.join(likely, "dyt_i").groupBy("row_i", "pep_i").agg(F.sum(F.col("w") * F.col("p")).alias("w"))
    total = by.groupBy("row_i").agg(F.sum("w").alias("all"), F.max_by("pep_i", F.struct("w", -F.col("pep_i"))).alias("pred_i"), F.max("w").alias("best"))
    return total.select("row_i", "pred_i", safe_divide(F.col("best"), F.col("all")).alias("score"))
