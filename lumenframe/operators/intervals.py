"""Joins of positions with the spans that hold them, by bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SALTS, join_counted, written

#: Width of a bin, and positions in a bin of one key above which they are dealt over several tasks.
WIDTH, HOT = 256, 50_000


def positions_in_spans(spans: DataFrame, positions: DataFrame, key: str, start: str = "start", stop: str = "stop", at: str = "at", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Inner join of spans (key, start, stop, ...) with the positions (key, at, ...) in them, start <= at < stop.

    Both sides meet by (key, bin): a position has one bin, a span those that it reaches into. So a key
    with very many positions is spread over its bins, and no array of a key is built. A bin with more
    than `hot` positions is salted, and spans get a copy a salt in such bins only. A span that is much
    longer than `width` is copied once a bin: choose the width by the spans.
    """
    clean = positions.filter(F.col(at).isNotNull() & F.col(key).isNotNull())
    binned = clean.withColumn("_bin", F.floor(F.col(at) / width))
    reaching = spans.filter(F.col(stop) > F.col(start)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(stop) - 1) / width))))
    many = written(binned.groupBy(key, "_bin").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).select(key, "_bin", F.lit(True).alias("_hot")), "hot-bins")
    if not many.isEmpty():
        salt = F.pmod(F.xxhash64(*(c for c in binned.columns if c not in (key, "_bin"))), F.lit(SALTS))
        binned = join_counted(binned, many, [key, "_bin"]).withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0).cast("long")).drop("_hot")
        copies = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
        reaching = join_counted(reaching, many, [key, "_bin"]).withColumn("_salt", F.explode(copies)).drop("_hot")
        joined = reaching.join(binned, [key, "_bin", "_salt"]).drop("_salt")
    else:
        joined = reaching.join(binned, [key, "_bin"])
    return joined.filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("_bin")


def peptides_with_sites(peps: DataFrame, sites: DataFrame) -> DataFrame:
    """A row for each modified site of a peptide: peps (pro_i, pep_in_pro, pep_start, pep_stop, ...) with n_ptms of the peptide and ptm, the site's place in the protein from 1.

    sites: (pro_i, ptm). Peptides without a site are left out; a site that is listed twice counts once.
    """
    at = sites.select("pro_i", "ptm", (F.col("ptm") - 1).alias("_at")).distinct()
    found = positions_in_spans(peps, at, "pro_i", "pep_start", "pep_stop", "_at").drop("_at")
    counts = found.groupBy("pro_i", "pep_in_pro").agg(F.count("*").alias("n_ptms"))
    return found.join(counts, ["pro_i", "pep_in_pro"])
