"""Accessors: how proteins, peptides, residues, labels and calls are joined, completed and numbered."""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .shared import is_few, join_counted, join_salted, written


def left_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    return left.join(right, on, "left")


def with_abundance(pros: DataFrame, abundance: DataFrame) -> DataFrame:
    """pros with the abundance of their name; 0 where there is none."""
    return pros.join(abundance.select(F.col("name").alias("pro_id"), "abundance"), "pro_id", "left").withColumn("abundance", F.coalesce("abundance", F.lit(0.0)))


def peptides(tokens: DataFrame, spans: Column) -> DataFrame:
    """(pro_i, pep_in_pro, pep_start, pep_stop, pep) from proteins (pro_i, tokens) and their cut pieces."""
    cut = tokens.select("pro_i", "tokens", F.posexplode(spans).alias("pep_in_pro", "span"))
    return cut.select("pro_i", "pep_in_pro", F.col("span.start").alias("pep_start"), F.col("span.stop").alias("pep_stop"), F.slice("tokens", F.col("span.start") + 1, F.col("span.stop") - F.col("span.start")).alias("pep"))


def residues(peps: DataFrame) -> DataFrame:
    """(pro_i, pep_in_pro, offset, aa): a row a residue."""
    return peps.select("pro_i", "pep_in_pro", F.posexplode("pep").alias("at", "aa")).select("pro_i", "pep_in_pro", "at", "aa")


def spans_of(rows: DataFrame, keys: list[str], offset: str = "offset") -> DataFrame:
    """First offset and one past the last of each key."""
    return rows.groupBy(*keys).agg(F.min(offset).alias("pep_start"), (F.max(offset) + 1).alias("pep_stop"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Residues with channel, p_bright and p_bleach of their label; null where unlabelled. labels: (aa, ch_i, p_dud, p_bleach)."""
    of = labels.select(F.col("aa").alias("_aa"), "ch_i", (1 - F.col("p_dud")).alias("p_bright"), "p_bleach")
    return join_counted(rows, of, F.substring("aa", 1, 1) == F.col("_aa")).drop("_aa")


#: Rows in a bucket of an order on average, buckets at most, and cuts that are compared one after the other.
PER_BUCKET, MOST_BUCKETS, FLAT = 500_000, 16_384, 256


def even_buckets(rows: DataFrame, key: Column, per_bucket: int = PER_BUCKET) -> Column:
    """A number that rises with the key, for about per_bucket rows each: how many of a sample's keys are at most the key.

    The sample is a bounded number of keys with the least hashes; equal keys share a bucket, null is before all.
    """
    n = min(MOST_BUCKETS, rows.count() // per_bucket)
    if not n:
        return F.lit(0)
    picked = rows.select(key.alias("k")).filter("k is not null").orderBy(F.xxhash64("k")).limit(16 * n)
    cuts = picked.groupBy().agg(F.array_sort(F.collect_list("k")).alias("k")).select(F.filter("k", lambda _, i: i % 16 == 8).alias("k")).first()["k"]
    kind = rows.select(key.alias("k")).schema["k"].dataType
    fixed = [(F.struct(*map(F.lit, c)) if isinstance(c, Row) else F.lit(c)).cast(kind) for c in cuts]
    if not fixed:
        return F.lit(0)
    if len(fixed) <= FLAT:
        return F.when(key.isNull(), F.lit(0)).otherwise(F.size(F.filter(F.array(*fixed), lambda c: c <= key)) + 1)
    # Two steps of about the root of their number each: first among every step-th cut, then among those after it.
    step = ceil(sqrt(len(fixed)))
    runs = [fixed[i : i + step] for i in range(0, len(fixed), step)]
    above = F.size(F.filter(F.array(*(r[0] for r in runs)), lambda c: c <= key))
    inside = F.size(F.filter(F.get(F.array(*(F.array(*r) for r in runs)), above - 1), lambda c: c <= key))
    return F.when(key.isNull(), F.lit(0)).when(above == 0, F.lit(1)).otherwise((above - 1) * step + inside + 1)


def running(rows: DataFrame, order: list[Column], amounts: dict[str, Column], bucket: Column, upto: int = -1) -> DataFrame:
    """rows with running sums of amounts in an order that rises with the bucket: sums by bucket first, then in each bucket.

    upto: -1 leaves the row itself out, 0 takes it in. No window holds more than a bucket, or one row a bucket.
    """
    placed = rows.withColumn("_bucket", bucket)
    sums = placed.groupBy("_bucket").agg(*(F.sum(x).alias(f"_sum_{name}") for name, x in amounts.items()))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_bucket", *(F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in amounts))
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    joined = placed.join(F.broadcast(sums), "_bucket")
    for name, x in amounts.items():
        joined = joined.withColumn(name, F.col(f"_before_{name}") + F.coalesce(F.sum(x).over(inside), F.lit(0)))
    return joined.drop("_bucket", *(f"_before_{name}" for name in amounts))


def numbered(rows: DataFrame, key: str, name: str, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Contiguous numbers from 0 in the order of a key without repeats; null first."""
    return running(rows, [F.col(key).asc_nulls_first()], {name: F.lit(1).cast("long")}, even_buckets(rows, F.col(key), per_bucket))


def dense_ids(rows: DataFrame, group: str, within: str, name: str, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Contiguous numbers from 0 over (group, within), groups in order, null first: sizes of groups, their running sums, then the place in the group."""
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    offsets = running(sizes, [F.col("_group").asc_nulls_first()], {"_offset": F.col("_size")}, even_buckets(sizes, F.col("_group"), per_bucket)).select("_group", "_offset")
    place = F.row_number().over(Window.partitionBy(group).orderBy(within)) - 1
    return rows.join(offsets, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col("_offset") + place).drop("_offset", "_group")


def completed(rows: DataFrame, key: str, n: int, fill: dict[str, object]) -> DataFrame:
    """A row for every key from 0 to n - 1; missing ones hold the fill values."""
    return rows.sparkSession.range(n).withColumnRenamed("id", key).join(rows, key, "left").na.fill(fill)


def joined_in_order(calls: DataFrame, other: DataFrame, on: str, row: str = "row_i") -> DataFrame:
    """Left join whose rows come in the calls' order."""
    return calls.join(other, on, "left").orderBy(row)


def without(requested: DataFrame, surviving: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and didn't survive."""
    return requested.select(key).distinct().join(surviving.select(key), key, "left_anti")


def with_others(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, null columns where one lacks them."""
    return left.unionByName(right, allowMissingColumns=True)


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by order."""
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_r"))
    return best.select(key, *(F.col(f"_r.{c}").alias(c) for c in others))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that come more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def histograms_joined(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """(key, p, q): two histograms as shares, 0 for a missing side."""

    def share(h: DataFrame, name: str) -> DataFrame:
        total = h.agg(F.sum(n).alias("_total"))  # one row
        return h.join(F.broadcast(total)).select(key, (F.col(n) / F.col("_total")).alias(name))

    return share(left, "p").join(share(right, "q"), key, "full_outer").na.fill(0.0)


def histogram_error(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """One row: sse of the shares, and 10,000 times its root."""
    both = histograms_joined(left, right, key, n)
    return both.agg(F.sum((F.col("p") - F.col("q")) * (F.col("p") - F.col("q"))).alias("sse")).withColumn("rmse", F.sqrt("sse") * 10_000)


def most_likely(counts: DataFrame) -> DataFrame:
    """(dyt_i, pep_i): the peptide with most reads of each track; the smaller number of equals. counts: (dyt_i, pep_i, n)."""
    return counts.groupBy("dyt_i").agg(F.max_by("pep_i", F.struct("n", -F.col("pep_i"))).alias("pep_i"))


def transitions(counts: DataFrame) -> DataFrame:
    """(dyt_i, pep_i, p): each track's share of its peptide's reads, sparse."""
    totals = counts.groupBy("pep_i").agg(F.sum("n").alias("_total"))
    return counts.join(totals, "pep_i").select("dyt_i", "pep_i", (F.col("n") / F.col("_total")).alias("p"))


#: Members of all shared patterns up to which their lists are broadcast, and numbers that a task writes into lists of others.
LISTED, WRITTEN = 2_000_000, 10_000_000


def unlike_proteins(calls: DataFrame, flus: DataFrame) -> DataFrame:
    """(pro_i, others): other proteins that share a labelled pattern, as an ordered comma list. flus: (pro_i, flustr).

    A shared pattern's proteins are listed once. A called protein with one such pattern takes its list without
    itself; only those with several are put together. So no pairs are made, and proteins are dealt over tasks
    by what they write, however few patterns there are. What is written grows with the square of a pattern's proteins.
    """
    called = calls.select("pro_i").distinct()
    distinct = written(flus.select("pro_i", "flustr").filter("pro_i is not null and flustr is not null").distinct(), "patterns")
    lists = distinct.groupBy("flustr").agg(F.array_sort(F.collect_list("pro_i")).alias("_all")).filter(F.size("_all") > 1)
    lists = written(lists.select("flustr", F.size("_all").cast("long").alias("_n"), F.transform("_all", lambda x: x.cast("string")).alias("_all")), "shared-patterns")
    sizes = lists.agg(F.sum("_n").alias("members"), F.sum(F.col("_n") * F.col("_n")).alias("pairs")).first()
    of = join_salted(distinct.join(called, "pro_i", "left_semi"), lists.select("flustr", "_n"), ["flustr"], "inner")
    of = written(called.join(of.groupBy("pro_i").agg(F.count("*").alias("_of"), F.first("flustr").alias("flustr")), "pro_i", "left"), "called")
    tasks = min(10_000, 1 + (sizes["pairs"] or 0) // WRITTEN)

    def with_lists(rows: DataFrame) -> DataFrame:
        rows = rows.repartition(tasks, "pro_i")
        if (sizes["members"] or 0) <= LISTED:
            return rows.join(F.broadcast(lists), "flustr")
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("pro_i"), F.lit(tasks)))
        return salted.join(lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))), ["flustr", "_salt"])

    own = F.col("pro_i").cast("string")
    one = with_lists(of.filter("_of = 1")).select("pro_i", F.array_join(F.array_remove("_all", own), ",").alias("others"))
    several = with_lists(of.filter("_of > 1").select("pro_i").join(distinct, "pro_i"))
    merged = several.groupBy("pro_i").agg(F.array_distinct(F.flatten(F.collect_list("_all"))).alias("_all"))
    kind = distinct.schema["pro_i"].dataType
    merged = merged.select("pro_i", F.array_join(F.transform(F.array_sort(F.transform(F.array_remove("_all", own), lambda x: x.cast(kind))), lambda x: x.cast("string")), ",").alias("others"))
    return of.filter("_of is null").select("pro_i", F.lit("").alias("others")).unionByName(one).unionByName(merged)


def strings(rows: DataFrame, key: str = "pep_i", at: str = "at", aa: str = "aa") -> DataFrame:
    """(key, seqstr): residues of each key put together in their order."""
    lists = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(at, aa))).alias("_r"))
    return lists.select(key, F.array_join(F.transform("_r", lambda r: r[aa]), "").alias("seqstr"))


def with_strings(pros: DataFrame, peps: DataFrame, seqs: DataFrame) -> DataFrame:
    """Peptides with their protein's name and their sequence: pros (pro_i, pro_id), peps (pep_i, pro_i, ...), seqs (pep_i, seqstr)."""
    return peps.join(pros.select("pro_i", "pro_id"), "pro_i", "left").join(seqs, "pep_i", "left")


def neighbours_of(rows: DataFrame, key: str, order: str, value: str, n: int = 1, fill: object = None) -> DataFrame:
    """Adds the value n rows before, later ones for negative n, in each key; the fill value where there is none."""
    over = Window.partitionBy(key).orderBy(order)
    return rows.withColumn(f"{value}_shifted", F.lag(value, n, fill).over(over) if n >= 0 else F.lead(value, -n, fill).over(over))


def with_group_statistics(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Adds the group's size, and the value's least, most and mean in it, to every row."""
    by = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("size"), *(f(value).alias(f"{name}_{value}") for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))))
    return rows.join(by, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def first_and_last(rows: DataFrame, key: str, order: str, true: Column) -> DataFrame:
    """(key, first, last): the least and the most of the order among a key's rows for which the condition holds; null if it never does."""
    return rows.groupBy(key).agg(F.min(F.when(true, F.col(order))).alias("first"), F.max(F.when(true, F.col(order))).alias("last"))


def intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, left_i, right_i): keys of both, with their numbers (row_i) on either side."""
    return left.select(key, F.col("row_i").alias("left_i")).join(right.select(key, F.col("row_i").alias("right_i")), key)


def with_flu_counts(flus: DataFrame) -> DataFrame:
    """flus (flustr, ...), which should be cheap to read twice, with how many share their pattern; the rows of a common one are dealt over tasks."""
    counts = written(flus.groupBy("flustr").agg(F.count("*").alias("flu_count")), "flu-counts")
    return join_salted(flus, counts, ["flustr"], "inner")


def with_flus(peps: DataFrame, flus: DataFrame) -> DataFrame:
    """Peptides with their labelled pattern, how many share it, and its dyes: flus (pep_i, flustr, n_dyes_max_any_ch)."""
    return peps.join(with_flu_counts(flus), "pep_i", "left")


def patterned(rows: DataFrame) -> DataFrame:
    """rows (pro_i, pep_in_pro, pep_start, flustr, ...) with flu_count: with_flus() of peptides that hold their own pattern, which are read once.

    Only proteins whose number repeats go through the join of every peptide with every pattern of its number; those without a number are counted and left out.
    """
    every = written(rows, "peptides")
    rows, counted = (x.filter("pro_i is not null") for x in (every, with_flu_counts(every)))
    again = rows.filter("pep_in_pro = 0").groupBy("pro_i").count().filter("count > 1").select("pro_i")
    if is_few(again, 0):
        return counted
    again = written(again, "repeated")
    peps = rows.join(again, "pro_i", "left_semi").select(F.struct("pro_i", "pep_in_pro").alias("pep_i"), "pep_start")
    known = counted.join(again, "pro_i", "left_semi").withColumn("pep_i", F.struct("pro_i", "pep_in_pro")).drop("pep_start")
    return counted.join(again, "pro_i", "left_anti").unionByName(peps.join(known, "pep_i").select(*counted.columns))
