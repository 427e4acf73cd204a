"""Samples: seeded, with a total order, so that a rerun draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: str, *keys: str) -> Column:
    """A number in [0, 1) that depends on seed and keys alone."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(1 << 52)


def exactly(rows: DataFrame, n: int, key: str, seed: str) -> DataFrame:
    """n rows without replacement, all if there are fewer: a distributed top-n of the draws."""
    return rows.withColumn("_u", draw(seed, key)).orderBy("_u", key).limit(n).drop("_u")


def stratified(rows: DataFrame, by: str, n: int, key: str, seed: str) -> DataFrame:
    """Up to n rows of each class."""
    order = Window.partitionBy(by).orderBy("_u", key)
    return rows.withColumn("_u", draw(seed, key)).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).drop("_u", "_r")


def with_replacement(numbered: DataFrame, n: int, total: int, seed: str, row: str = "row_i") -> DataFrame:
    """n draws of rows numbered from 0 to total - 1."""
    draws = numbered.sparkSession.range(n).withColumn(row, F.floor(draw(seed, "id") * total).cast("long")).withColumnRenamed("id", "draw_i")
    return draws.join(numbered, row)


def weighted(rows: DataFrame, weight: str, n: int, key: str, seed: str) -> DataFrame:
    """n rows without replacement, likelier with weight: the largest u ** (1 / w)."""
    score = F.log(F.greatest(draw(seed, key), F.lit(1e-300))) / F.col(weight)
    return rows.filter(F.col(weight) > 0).withColumn("_s", score).orderBy(F.col("_s").desc(), key).limit(n).drop("_s")
