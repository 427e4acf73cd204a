"""Random forest of radmats, and its two best classes."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import top_two
from .sampling import stratified


def train(rows: DataFrame, n_trees: int = 100, depth: int = 20, per_class: int | None = None, seed: int = 1) -> tuple[RandomForestClassificationModel, list[int]]:
    """A forest of (row_i, radmat, class_i) and its classes in the order of its labels."""
    if per_class is not None:
        rows = stratified(rows, "class_i", per_class, "row_i", f"forest-{seed}")
    classes = sorted(r["class_i"] for r in rows.select("class_i").distinct().collect())
    label = (F.array_position(F.array(*map(F.lit, classes)), F.col("class_i")) - 1).cast("double")
    data = rows.select(array_to_vector("radmat").alias("features"), label.alias("label"))
    return RandomForestClassifier(numTrees=n_trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, maxBins=64).fit(data), classes


def classify(rows: DataFrame, model: RandomForestClassificationModel, classes: list[int], keep: tuple[str, ...] = ()) -> DataFrame:
    """(row_i, pred_i, score, runnerup_i, runnerup_score), and the columns to keep."""
    scored = model.transform(rows.select("row_i", *keep, array_to_vector("radmat").alias("features"))).withColumn("p", vector_to_array("probability"))
    first, second = top_two("c", "p")
    scored = scored.withColumn("c", F.array(*(F.lit(c) for c in classes)))
    return scored.select("row_i", *keep, first["class"].alias("pred_i"), first["score"].alias("score"), second["class"].alias("runnerup_i"), second["score"].alias("runnerup_score"))


def out_of_fold(rows: DataFrame, folds: int = 2, **how) -> DataFrame:
    """Calls of all rows, each by a forest that was trained on the other folds only; a row's fold is a hash of row_i."""
    fold = F.pmod(F.xxhash64("row_i"), F.lit(folds))
    out = None
    for k in range(folds):
        model, classes = train(rows.filter(fold != k), **how)
        found = classify(rows.filter(fold == k), model, classes)
        out = found if out is None else out.unionByName(found)
    return out


def importances(model: RandomForestClassificationModel, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feature_i, importance) of every cell of a radmat, and (class_i, n) of the training rows."""
    spark = rows.sparkSession
    features = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())], "feature_i int, importance double")
    return features, rows.groupBy("class_i").agg(F.count("*").alias("n"))
