"""Queries that SQL can't say: simulation, forests, step regions, image fields and fits, over whole carrier tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, seq
from ..operators import fit, forest, images, relational, simulate, steps
from . import brightness, workflow
from .registry import query, table

JOB = workflow.Job(labels=["DE", "R"], n_cycles=5, n_samples=20)


def named_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names of parts as proteins, digested after K."""
    names = table(spark, sf_dir, "part").filter("p_name is not null").select("p_name").distinct()
    return workflow.digested(relational.numbered(names, "p_name", "pro_i").select("pro_i", seq.letters(F.col("p_name")).alias("tokens")), JOB)


@query()
def dye_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.simulated(named_peptides(spark, sf_dir), JOB)[0]


@query()
def radmat_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, chem = workflow.simulated(named_peptides(spark, sf_dir), JOB)
    return simulate.radmats(found, chem, simulate.Gains())


@query()
def survey_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.surveyed(named_peptides(spark, sf_dir), JOB)


@query()
def rf_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors are radmats, their labels classes; the forest classifies its own training rows, as labels don't follow from vectors here."""
    rows = table(spark, sf_dir, "embeddings").filter("label is not null").select(F.col("vec_id").alias("row_i"), F.col("embedding").cast("array<double>").alias("radmat"), F.col("label").alias("class_i"))
    model, classes = forest.train(rows, n_trees=10, depth=6)
    return forest.classify(rows, model, classes)


@query()
def rf_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes are the signs of a vector's first two components; each row is classified by a forest that wasn't trained on it."""
    e = F.col("embedding")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_i"), e.cast("array<double>").alias("radmat"), (1 + (F.get(e, F.lit(0)) > 0).cast("int") + 2 * (F.get(e, F.lit(1)) > 0).cast("int")).alias("class_i"))
    return forest.out_of_fold(rows, n_trees=100, depth=8)


@query()
def step_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's and a user's values, in order, are traces."""
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("peak_i"), F.lit(0).alias("channel_i")).agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("x"))
    return steps.step_regions(events.select("peak_i", "channel_i", F.transform("x", lambda r: r["value"]).alias("trace")), floor=20.0)


@query()
def image_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic field a region: frames are aligned, peaks found and measured."""
    return images.fields(images.synthetic_frames(table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("field_i"))))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * power(0.7, greatest(CAST(l_quantity AS INT) % 4 - 1, 0)), 6) AS by_count, round(l_extendedprice * CASE WHEN CAST(l_quantity AS INT) % 4 > 0 THEN 0.7 ELSE 1 END, 6) AS by_presence FROM lineitem")
def fret_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, k = table(spark, sf_dir, "lineitem"), F.col("l_quantity").cast("int") % 4
    price = F.col("l_extendedprice")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(simulate.fret(price, k, 0.3, True, self_quench=True), 6).alias("by_count"), F.round(simulate.fret(price, k, 0.3, False), 6).alias("by_presence"))


@query()
def bootstrap_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_quantity").alias("key")).agg(F.count("*").alias("n"))
    return fit.resampled(counts, 50, lambda n: [float(n @ np.arange(len(n)) / max(n.sum(), 1))])


@query()
def parameter_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bleach rate and dud rate of a one-dye experiment, from the histogram of its lifespans in the events' traces."""
    lives = brightness.traces(spark, sf_dir).select(arrays.lifespan(F.col("trace")).alias("life")).groupBy("life").agg(F.count("*").alias("n"))
    n = np.zeros(brightness.CYCLES + 1)
    for r in lives.collect():
        n[r["life"]] = r["n"]
    real = n / max(n.sum(), 1)

    def error(x: np.ndarray) -> float:
        bleach, dud = np.clip(x, 1e-6, 1 - 1e-6)
        k = np.arange(1, brightness.CYCLES + 1)
        model = np.concatenate([[dud], (1 - dud) * bleach * (1 - bleach) ** (k - 1)])
        model[-1] += (1 - dud) * (1 - bleach) ** brightness.CYCLES
        return float(np.sqrt(((model - real) ** 2).sum()) * 10_000)

    low, high = np.zeros(2), np.ones(2)
    found, _ = fit.grid_search(spark, error, low, high, n_start=32, generations=3)
    best, value = fit.local_search(error, found, low, high)
    return spark.range(1).select(F.lit(float(best[0])).alias("p_bleach"), F.lit(float(best[1])).alias("p_dud"), F.lit(value).alias("rmse"))
