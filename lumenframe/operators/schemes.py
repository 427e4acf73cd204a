"""Surveys over many schemes in one plan: rules are rows, and a scheme is a grouping key.

A scheme is an enzyme and a list of labels. Enzymes are rows with their cut pattern, lists of labels are
rows with what each letter shows; both join proteins by their panel, so that panels of proteins may
have different rules. Digest, labelling, isolation and ranking are each done once for all schemes.
Peptides that all schemes of a panel label alike are one kind: patterns belong to kinds, and a peptide joins its kind's.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import seq
from .shared import join_counted, join_salted, written
from .survey import nearest_tracks

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGEST = "panel string, protease string, cut string"
LABELS = "panel string, labels string, channels array<string>, shown string"
#: Proteins times schemes that a task works out: a small table is few files, and each protein becomes many rows.
DEALT = 1_000_000
#: Kinds that a task labels, and kinds up to which they are broadcast.
LABELLED, KINDS = 10_000, 400_000


def rules(spark: SparkSession, panels: dict[str, tuple[list[str], list[str], int]]) -> tuple[DataFrame, DataFrame]:
    """Tables of enzymes and of lists of labels: panels gives enzymes, labels, and labels in a scheme, by panel."""
    enzymes, labels = [], []
    for panel, (proteases, known, n) in panels.items():
        enzymes += [(panel, p, seq.cut_pattern(p)) for p in proteases]
        for chosen in combinations(known, n):
            shown = "".join(next((str(i) for i, residues in enumerate(chosen) if c in residues), ".") for c in LETTERS)
            labels.append((panel, ",".join(chosen), list(chosen), shown))
    return spark.createDataFrame(enzymes, DIGEST), spark.createDataFrame(labels, LABELS)


def digested(proteins: DataFrame, enzymes: DataFrame) -> DataFrame:
    """(panel, protease, pro_i, pro_len, pep_in_pro, pep): every protein (pro_i, panel, seq) cut by all enzymes of its panel; a protease once, not once a scheme."""
    cut = join_counted(proteins, enzymes, "panel", "inner")
    pieces = F.when(F.col("seq") == "", F.array().cast("array<string>")).otherwise(F.split("seq", F.col("cut")))
    return cut.select("panel", "protease", "pro_i", F.char_length("seq").alias("pro_len"), F.posexplode(pieces).alias("pep_in_pro", "pep"))


def _held(text: Column, residues: Column) -> Column:
    """How many of text's letters are among residues."""
    return F.char_length(text) - F.char_length(F.call_function("translate", text, residues, F.lit("")))


def _parts(n_cycles: int) -> tuple[Column, Column]:
    """pep's first n_cycles letters, and the others."""
    return F.substring("pep", 1, n_cycles), F.substring("pep", F.lit(n_cycles + 1), F.char_length("pep"))


def with_kinds(peps: DataFrame, labels: DataFrame, n_cycles: int) -> DataFrame:
    """Adds kind: a text that each list of labels of the panel labels as it does pep.

    In the first n_cycles letters, those that no list names become one of them. Of the others only the
    named ones are kept, in one order, as labels count them.
    """
    chars = F.filter(F.transform(F.sequence(F.lit(1), F.char_length("text")), lambda i: F.substring("text", i, F.lit(1))), lambda c: c != "")
    named = labels.groupBy("panel").agg(F.array_join(F.flatten(F.collect_list("channels")), "").alias("text"))
    named = named.select("panel", F.array_sort(F.array_distinct(chars)).alias("_named"), F.call_function("translate", F.lit(LETTERS), F.col("text"), F.lit("")).alias("_rest"))
    named = named.withColumn("_one", F.expr("repeat(substring(_rest, 1, 1), char_length(_rest))"))
    rows = join_counted(peps, written(named, "scheme-letters"), "panel", "inner")
    head, tail = _parts(n_cycles)
    late = F.when(F.char_length("pep") <= n_cycles, "").otherwise(F.array_join(F.transform("_named", lambda c: F.repeat(c, _held(tail, c))), ""))
    return rows.withColumn("kind", F.concat(F.call_function("translate", head, F.col("_rest"), F.col("_one")), late)).drop("_named", "_rest", "_one")


def labelled(peps: DataFrame, labels: DataFrame, n_cycles: int) -> DataFrame:
    """Adds scheme, channels, flustr and n_dyes (most of any channel) for every list of labels of the panel."""
    rows = join_counted(peps, labels, "panel", "inner")
    head, tail = _parts(n_cycles)
    shown = F.rpad(F.call_function("translate", head, F.lit(LETTERS), F.col("shown")), n_cycles, " ")
    flu = F.concat(shown, F.lit(" ;"), F.array_join(F.transform("channels", lambda c: F.least(F.lit(99), _held(tail, c)).cast("string")), ","))
    most = F.array_max(F.transform("channels", lambda c: _held(F.col("pep"), c)))
    return rows.select(F.concat_ws("-", "protease", "labels").alias("scheme"), *peps.columns, "channels", flu.alias("flustr"), most.alias("n_dyes"))


def track(n_cycles: int) -> Column:
    """By channel, dyes of pep left after each cycle."""
    head, tail = _parts(n_cycles)
    left = lambda c: F.transform(F.sequence(F.lit(0), F.lit(n_cycles)), lambda t: (_held(F.substring(head, t + 1, F.lit(n_cycles)), c) + F.least(F.lit(99), _held(tail, c))).cast("double"))
    return F.flatten(F.transform("channels", left))


def isolated(kinds: DataFrame, n_cycles: int) -> DataFrame:
    """(scheme, flustr, flu_count, nn_dist) of labelled kinds: the peptides (n of a kind) of a scheme with a pattern, and how far the pattern's nearest other one in the scheme is (null if there is none)."""
    patterns = kinds.groupBy("scheme", "flustr").agg(F.sum("n").alias("flu_count"), F.first(F.struct("pep", "channels")).alias("_of"))
    patterns = patterns.select("scheme", "flustr", "flu_count", F.xxhash64("flustr").alias("dyt_i"), "_of.*").withColumn("vec", track(n_cycles)).drop("pep", "channels")
    patterns = written(patterns, "scheme-patterns")
    # Patterns that share a track are at no distance, so that only one of them is looked at.
    tracks = written(patterns.groupBy("scheme", "vec").agg(F.min("dyt_i").alias("dyt_i"), F.count("*").alias("held")), "scheme-tracks")
    near = nearest_tracks(tracks.select("scheme", "dyt_i", "vec"), 1, by="scheme").select("scheme", "dyt_i", "d")
    far = tracks.join(near, ["scheme", "dyt_i"], "left").select("scheme", "vec", F.when(F.col("held") > 1, 0.0).otherwise(F.col("d")).alias("nn_dist"))
    return patterns.join(far, ["scheme", "vec"]).select("scheme", "flustr", "flu_count", "nn_dist")


def surveyed(proteins: DataFrame, enzymes: DataFrame, labels: DataFrame, n_cycles: int) -> DataFrame:
    """The survey of all schemes: (scheme, pro_i, pro_len, pep_in_pro, pep_len, flustr, n_dyes, flu_count, nn_dist)."""
    n = -(-proteins.count() * enzymes.join(labels, "panel").count() // DEALT)
    spread = proteins.repartition(n) if n > 1 else proteins
    peps = with_kinds(digested(spread, enzymes), labels, n_cycles)
    peps = written(peps.select("panel", "protease", "pro_i", "pro_len", "pep_in_pro", F.char_length("pep").alias("pep_len"), "kind"), "scheme-peptides")
    kinds = written(peps.groupBy("panel", "protease", "kind").agg(F.count("*").alias("n")), "scheme-kinds")
    n = -(-kinds.count() // LABELLED)
    shown = written(labelled((kinds.repartition(n) if n > 1 else kinds).withColumn("pep", F.col("kind")), labels, n_cycles), "scheme-labelled")
    known = isolated(shown, n_cycles).withColumn("_i", F.monotonically_increasing_id())
    known = written(known, "scheme-isolation")
    # A kind holds numbers of patterns, so that a broadcast of all kinds stays small.
    own = join_counted(shown.select("panel", "protease", "kind", "scheme", "flustr", "n_dyes"), known.select("scheme", "flustr", "_i"), ["scheme", "flustr"], "inner")
    own = written(own.groupBy("panel", "protease", "kind").agg(F.collect_list(F.struct("_i", "n_dyes")).alias("_own")), "schemes-of-kinds")
    found = join_salted(peps, own, ["panel", "protease", "kind"], "inner", KINDS)
    found = found.select("pro_i", "pro_len", "pep_in_pro", "pep_len", F.inline("_own"))
    found = join_salted(found, known, ["_i"], "inner")
    return found.select("scheme", "pro_i", "pro_len", "pep_in_pro", "pep_len", "flustr", "n_dyes", "flu_count", "nn_dist")


def lengths(proteins: DataFrame, enzymes: DataFrame, labels: DataFrame) -> DataFrame:
    """(scheme, residues): letters of the proteins that a scheme digests; a protein of several of its panels counts once, with its longest text.

    Schemes of the same panels share one pass over their proteins.
    """
    of = enzymes.join(labels, "panel").groupBy(F.concat_ws("-", "protease", "labels").alias("scheme")).agg(F.array_sort(F.collect_set("panel")).alias("panels"))
    of = written(of, "scheme-panels")
    panels = written(of.select("panels").distinct().select("panels", F.explode("panels").alias("panel")), "panels")
    texts = join_counted(proteins.select("panel", "pro_i", F.char_length("seq").alias("n")).filter("n > 0"), panels, "panel", "inner")
    sums = texts.groupBy("panels", "pro_i").agg(F.max("n").alias("n")).groupBy("panels").agg(F.sum("n").alias("residues"))
    return of.join(sums, "panels").select("scheme", "residues")


def ranked_schemes(survey: DataFrame, n_targets: int, n_best: int = 1, residues: DataFrame | None = None) -> DataFrame:
    """(scheme, n_found, n_unique, coverage, avg_dist, min_dist, place): schemes by the isolation of their proteins' best peptides with a pattern of their own.

    n_best: peptides of a protein that count. A target protein without such a peptide is as near to
    others as can be: it counts as 0 in the mean, and makes the least distance 0. residues: lengths() of the
    same proteins and rules; without them they are taken from the survey, by all its rows.
    """
    unique = survey.filter("flu_count = 1 and nn_dist is not null")
    order = Window.partitionBy("scheme", "pro_i").orderBy(F.col("nn_dist").desc(), "pep_in_pro")
    first = unique.withColumn("_rank", F.row_number().over(order))
    best = first.groupBy("scheme", "pro_i").agg(F.count("*").alias("n_unique"), F.sum("pep_len").alias("held"), F.avg(F.when(F.col("_rank") <= n_best, F.col("nn_dist"))).alias("mean"), F.min(F.when(F.col("_rank") <= n_best, F.col("nn_dist"))).alias("least"))
    sums = best.groupBy("scheme").agg(F.count("*").alias("n_found"), F.sum("n_unique").alias("n_unique"), F.sum("held").alias("held"), F.sum("mean").alias("sum"), F.min("least").alias("least"))
    if residues is None:
        residues = survey.groupBy("scheme", "pro_i").agg(F.max("pro_len").alias("n")).groupBy("scheme").agg(F.sum("n").alias("residues"))
    every = residues.join(sums, "scheme", "left").na.fill(0, ["n_found", "n_unique", "held"]).na.fill(0.0, ["sum"])
    scored = every.select("scheme", "n_found", "n_unique", (F.col("held") / F.col("residues")).alias("coverage"), (F.col("sum") / n_targets).alias("avg_dist"), F.when(F.col("n_found") == n_targets, F.col("least")).otherwise(0.0).alias("min_dist"))
    return scored.withColumn("place", F.row_number().over(Window.orderBy(F.round("avg_dist", 9).desc(), "scheme")))  # one row a scheme
