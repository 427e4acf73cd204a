"""Linear unmixing: which peptides' shares best explain the counts of tracks, on sparse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import FEW, written

#: Rounds at most, rounds in one written job, and how little the residual may fall a job before it stops.
ROUNDS, EACH, ENOUGH = 200, 4, 1e-7


def _totals(pairs: DataFrame, side: DataFrame, on: str, to: str, weight: str, name: str, few: bool) -> DataFrame:
    """(to, name): sums over pairs (dyt_i, pep_i, p) of p times the side's weight; few: the side is counted as small."""
    joined = pairs.join(F.broadcast(side) if few else side, on)
    return joined.groupBy(to).agg(F.sum(F.col("p") * F.col(weight)).alias(name))


def unmixed(transition: DataFrame, counts: DataFrame, rounds: int = ROUNDS, each: int = EACH, enough: float = ENOUGH) -> DataFrame:
    """(pep_i, share): non-negative shares, summing to one, whose tracks are nearest to the counts in least squares.

    transition: (dyt_i, pep_i, p), the share of a peptide's reads that a track has; counts: (dyt_i, n).
    Multiplicative updates x <- x (A'b) / (A'A x) keep x at or above 0 and never raise the residual.
    A round is two equi-joins with the sparse table and two sums, with partial sums in every task; no
    matrix is built, and only the residual reaches the driver. Tracks without counts count as 0, and
    counts of tracks that no peptide has are a residual that no share can lower.
    """
    cells = written(transition.groupBy("dyt_i", "pep_i").agg(F.sum("p").alias("p")).filter("p > 0"), "transition")
    total = counts.agg(F.sum("n").cast("double").alias("total"))
    b = written(counts.groupBy("dyt_i").agg(F.sum("n").alias("n")).join(F.broadcast(total)).select("dyt_i", (F.col("n") / F.col("total")).alias("b")), "track-shares")
    sizes = cells.agg(F.count_distinct("dyt_i").alias("dyt_i"), F.count_distinct("pep_i").alias("pep_i")).first()
    few = {c: sizes[c] <= FEW for c in ("dyt_i", "pep_i")}
    # The numerator A'b stays the same; peptides without any of it have share 0.
    top = written(_totals(cells, b, "dyt_i", "pep_i", "b", "top", few["dyt_i"]).filter("top > 0"), "unmix-top")
    n = max(1, top.count())
    x = top.select("pep_i", (F.lit(1.0) / n).alias("x"))
    before = None
    for first in range(0, rounds, each):
        for _ in range(min(each, rounds - first)):
            y = _totals(cells, x, "pep_i", "dyt_i", "x", "y", few["pep_i"])
            bottom = _totals(cells, y, "dyt_i", "pep_i", "y", "bottom", few["dyt_i"])
            x = x.join(top, "pep_i").join(bottom, "pep_i").select("pep_i", (F.col("x") * F.col("top") / F.col("bottom")).alias("x"))
        x = written(x, "unmix-shares")
        if enough > 0:
            rest = residual(cells, b, x, few["pep_i"])
            if before is not None and before - rest <= enough * before:
                break
            before = rest
    whole = x.agg(F.sum("x").alias("whole"))
    peps = cells.select("pep_i").distinct()
    return peps.join(x, "pep_i", "left").join(F.broadcast(whole)).select("pep_i", F.coalesce(F.col("x") / F.col("whole"), F.lit(0.0)).alias("share"))


def residual(cells: DataFrame, b: DataFrame, x: DataFrame, few: bool) -> float:
    """The length of b - A x."""
    y = _totals(cells, x, "pep_i", "dyt_i", "x", "y", few)
    both = b.join(y, "dyt_i", "full_outer").select((F.coalesce("b", F.lit(0.0)) - F.coalesce("y", F.lit(0.0))).alias("r"))
    return both.agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("r")).first()["r"] or 0.0
