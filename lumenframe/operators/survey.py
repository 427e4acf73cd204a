"""Survey of candidate experiments: isolation of peptides among simulated tracks, ranks, filters, best schemes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .nearest import nearest_tracks
from .shared import dealt

__all__ = ["best_schemes", "coverage", "coverage_of_spans", "filtered", "isolation", "nearest_tracks", "neighbour_metrics", "of_schemes", "ranked"]

#: How fast confusion falls with distance.
DECAY = 0.8


def isolation(counts: DataFrame, near: DataFrame, likely: DataFrame) -> DataFrame:
    """(pep_i, score): reads-weighted chance that a peptide's tracks aren't taken for others'.

    counts: (dyt_i, pep_i, n); near: nearest_tracks; likely: most likely peptide of each track. For a
    track that is most likely this peptide's, the chance is the product over foreign neighbours of
    1 - exp(-DECAY d); else 1 less the product over its own neighbours.
    """
    p = 1 - F.exp(-DECAY * F.col("d"))
    rows = counts.join(likely.select("dyt_i", F.col("pep_i").alias("own")), "dyt_i")
    rows = rows.join(near, "dyt_i", "left").join(likely.select(F.col("dyt_i").alias("other_i"), F.col("pep_i").alias("other_pep")), "other_i", "left")
    mine = F.col("own") == F.col("pep_i")
    counted = (mine & (F.col("other_pep") != F.col("pep_i"))) | (~mine & (F.col("other_pep") == F.col("pep_i")))
    # A product as the exponential of summed logs; a neighbour at distance 0 makes it 0.
    logs = F.sum(F.when(counted & (p > 0), F.log(F.when(p > 0, p))))
    zero = F.max(F.when(counted & (p <= 0), 1).otherwise(0))
    product = F.when(zero == 1, 0.0).otherwise(F.exp(F.coalesce(logs, F.lit(0.0))))
    by_track = rows.groupBy("pep_i", "dyt_i", "n", mine.alias("mine")).agg(product.alias("product"))
    by_track = by_track.withColumn("p", F.when(F.col("mine"), F.col("product")).otherwise(1 - F.col("product")))
    return by_track.groupBy("pep_i").agg((F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("score"))


def ranked(survey: DataFrame, most: int) -> DataFrame:
    """The `most` best isolated peptides of each protein, ties to shorter ones with fewer dyes, then the smaller id."""
    order = Window.partitionBy("pro_i").orderBy(F.col("nn_dist").desc(), "pep_len", "n_dyes", "pep_i")
    return dealt(survey, "pro_i").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def filtered(survey: DataFrame, *, poi_only: bool = False, max_pep_len: int = -1, max_dyes: int = -1, max_ptms: int = -1, no_proline_2: bool = False, proteins: list[int] | None = None) -> DataFrame:
    """Limits below 0 are unset."""
    out = survey
    if proteins is not None:
        out = out.filter(F.col("pro_i").isin(proteins))
    if poi_only:
        out = out.filter("is_poi")
    for name, most in (("pep_len", max_pep_len), ("n_dyes", max_dyes), ("n_ptms", max_ptms)):
        if most >= 0:
            out = out.filter(F.col(name) <= most)
    return out.filter(~F.col("p2")) if no_proline_2 else out


def coverage(peps: DataFrame) -> DataFrame:
    """(pro_i, coverage): share of a protein's residues in peptides whose pattern no other peptide has.

    peps: (pro_i, pro_len, pep_len, flustr), all peptides of a digest, which don't overlap. Proteins are told from the same pass.
    """
    by = peps.groupBy("flustr").agg(F.count("*").alias("flu_count"), F.min("pro_i").alias("pro_i"), F.min("pep_len").alias("pep_len"))
    held = by.filter("flu_count = 1").groupBy("pro_i").agg(F.sum("pep_len").alias("held"))
    lengths = peps.groupBy("pro_i").agg(F.max("pro_len").alias("pro_len"))
    return lengths.join(held, "pro_i", "left").select("pro_i", (F.coalesce("held", F.lit(0)) / F.col("pro_len")).alias("coverage"))


def coverage_of_spans(spans: DataFrame, lengths: DataFrame) -> DataFrame:
    """(pro_i, coverage): share of residues that lie in any of the spans (pro_i, start, stop), which may overlap: spans that meet are merged first."""
    order = Window.partitionBy("pro_i").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(reach, F.col("start"))))
    held = spans.withColumn("new", new).groupBy("pro_i").agg(F.sum("new").alias("held"))
    return lengths.join(held, "pro_i", "left").select("pro_i", (F.coalesce("held", F.lit(0)) / F.col("pro_len")).alias("coverage"))


def best_schemes(ranks: DataFrame) -> DataFrame:
    """(scheme, avg_dist, min_dist, place): schemes by their proteins' mean of best distances; ranks: (scheme, pro_i, nn_dist).

    Means that agree in nine digits are ties, which go to the scheme of the smaller name: sums of the same numbers differ by their order.
    """
    best = ranks.groupBy("scheme", "pro_i").agg(F.max("nn_dist").alias("best"))
    by = best.groupBy("scheme").agg(F.avg("best").alias("avg_dist"), F.min("best").alias("min_dist"))
    return by.withColumn("place", F.row_number().over(Window.orderBy(F.round("avg_dist", 9).desc(), "scheme")))


def neighbour_metrics(ranks: DataFrame) -> DataFrame:
    """(rank, n_proteins, avg_dist, min_dist): isolation of the proteins' r-th best peptides. ranks: (pro_i, rank, nn_dist)."""
    return ranks.groupBy("rank").agg(F.countDistinct("pro_i").alias("n_proteins"), F.avg("nn_dist").alias("avg_dist"), F.min("nn_dist").alias("min_dist"))


def of_schemes(surveys: dict[str, DataFrame]) -> DataFrame:
    """Surveys of several schemes, stacked with the scheme as a key."""
    out = None
    for name, found in surveys.items():
        tagged = found.withColumn("scheme", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
