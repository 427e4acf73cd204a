"""Exact quantiles of groups of any size, by selecting ranks in brackets of values that get narrower."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import FEW, is_few, written

#: Rows of a bracket that are sorted at once, and bins that a bracket is cut into.
SMALL, BINS = 100_000, 4096
LARGEST = 1.7976931348623157e308


def _with(rows: DataFrame, side: DataFrame, by: list[str]) -> DataFrame:
    """rows with every row of side of their group; null is a group. Broadcast if side is counted as small."""
    named = side.withColumnsRenamed({c: f"_{c}" for c in by})
    same: Column = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_{c}")), by, F.lit(True))
    return rows.join(F.broadcast(named) if is_few(side, FEW) else named, same).drop(*(f"_{c}" for c in by))


def selected(rows: DataFrame, by: list[str], value: str, ranks: DataFrame, small: int = SMALL, bins: int = BINS) -> DataFrame:
    """(by, k, v): the value of rank k from 0 among a group's values, for each (by, k) of ranks; value is a double without null and NaN.

    A bracket of values with its counts of rows below and inside holds each rank. A round cuts it into
    bins, counts them with partial sums in every task, and goes on with the bin of the rank, from its
    least to its largest value, until few rows are inside or all are equal. What is left is counted by
    value. Groups of any size shuffle bins only, so one that holds all rows is no hot key.
    """
    v = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.col(value).cast("double")))
    slim = rows.select(*by, v.alias("_v"))
    whole = slim.groupBy(*by).agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("inside")).withColumn("below", F.lit(0).cast("long"))
    state = written(_with(ranks.select(*by, "k"), whole, by).filter("k >= 0 and k < inside"), "rank-brackets")
    open_ = (F.col("inside") > small) & (F.col("low") < F.col("high"))
    cut = ["low", "high", "below"]
    while not state.filter(open_).isEmpty():
        brackets = written(state.filter(open_).select(*by, *cut).distinct(), "brackets")
        # Halves, so that no difference of two doubles is too large.
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("_v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * bins))
        counted = _with(slim, brackets, by).filter("_v >= low and _v <= high").groupBy(*by, *cut, bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("bin_low"), F.max("_v").alias("bin_high"))
        before = F.sum("n").over(Window.partitionBy(*by, *cut).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        counted = written(counted.withColumn("bin_below", F.col("below") + F.coalesce(before, F.lit(0))), "bracket-bins")
        named = counted.select(*by, *(F.col(c).alias(f"_of_{c}") for c in cut), "n", "bin_low", "bin_high", "bin_below")
        same = (F.col("low") == F.col("_of_low")) & (F.col("high") == F.col("_of_high")) & (F.col("below") == F.col("_of_below")) & (F.col("k") >= F.col("bin_below")) & (F.col("k") < F.col("bin_below") + F.col("n"))
        narrow = _with(state.filter(open_), named, by).filter(same).select(*by, "k", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"), F.col("n").alias("inside"), F.col("bin_below").alias("below"))
        state = written(state.filter(~open_).select(*by, "k", "low", "high", "inside", "below").unionByName(narrow), "rank-brackets")
    equal = state.filter("low = high").select(*by, "k", F.col("low").alias("v"))
    left = written(state.filter("low < high").select(*by, *cut).distinct(), "brackets")
    values = _with(slim, left, by).filter("_v >= low and _v <= high").groupBy(*by, *cut, "_v").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by, *cut).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("upto", F.col("below") + F.sum("n").over(order)).select(*by, *(F.col(c).alias(f"_of_{c}") for c in cut), "_v", "n", "upto")
    same = (F.col("low") == F.col("_of_low")) & (F.col("high") == F.col("_of_high")) & (F.col("below") == F.col("_of_below")) & (F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n"))
    named = state.filter("low < high").select(*by, "k", *cut).withColumnsRenamed({c: f"_{c}" for c in by})
    join = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_{c}")), by, same)
    sorted_ = values.join(F.broadcast(named) if is_few(named) else named, join).select(*by, "k", F.col("_v").alias("v"))
    return equal.unionByName(sorted_)


def exact_quantiles(rows: DataFrame, by: list[str], value: str, shares: list[float], small: int = SMALL, bins: int = BINS) -> DataFrame:
    """(by, n, q0, q1, ...): each group's exact quantiles at shares; between two ranks in proportion. Null and NaN take no part."""
    v = F.col(value).cast("double")
    clean = rows.select(*by, v.alias("_value")).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    sizes = written(clean.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 0"), "group-sizes")
    at = [F.lit(float(s)) * (F.col("n") - 1) for s in shares]
    ends = [x for a in at for x in (F.floor(a).cast("long"), F.ceil(a).cast("long"))]
    ranks = written(sizes.select(*by, F.explode(F.array_distinct(F.array(*ends))).alias("k")), "ranks")
    found = _with(selected(clean, by, "_value", ranks, small, bins), sizes, by)
    known = found.groupBy(*by, "n").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("of"))  # two ranks a share
    said = []
    for j, a in enumerate(at):
        low, high = (F.element_at("of", f(a).cast("long")) for f in (F.floor, F.ceil))
        said.append((low + (a - F.floor(a)) * (high - low)).alias(f"q{j}"))
    return known.select(*by, "n", *said)
