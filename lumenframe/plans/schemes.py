"""Surveys of many schemes, sites in peptides, unmixing and reconciled peaks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import intervals, schemes, spatial, unmix
from .registry import query, table
from .sequences import PEPS, placed, proteins

#: Four enzymes and pairs of four labels: 24 schemes.
ENZYMES, LABELS, CYCLES = ["lysc", "aspn", "argc", "cnbr"], ["DE", "C", "Y", "K"], 8
DIGITS, RESIDUES = "0123456789", "ACDEGHKMRY"

_CUTS = {"lysc": "[^K]*K|[^K]+", "aspn": "D[^D]*|[^D]+", "argc": "[^R]*R|[^R]+", "cnbr": "[^M]*M|[^M]+"}
_SHOWN = {pair: "".join("0" if c in pair[0] else "1" if c in pair[1] else "." for c in schemes.LETTERS) for pair in combinations(LABELS, 2)}
_TRACK = " || ".join(f"list_transform(range(0, 9), lambda t: CAST(length(substring(head, t + 1)) - length(translate(substring(head, t + 1), {c}, '')) + least(99, length(tail) - length(translate(tail, {c}, ''))) AS DOUBLE))" for c in "ab")
SCHEMES = f"""enzymes(protease, cut) AS (VALUES {', '.join(f"('{e}', '{c}')" for e, c in _CUTS.items())}),
labels(a, b, shown) AS (VALUES {', '.join(f"('{a}', '{b}', '{s}')" for (a, b), s in _SHOWN.items())}),
pros AS (SELECT p_partkey AS pro_i, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') || translate(CAST(p_partkey * 7919 % 1000003 AS VARCHAR), '{DIGITS}', '{RESIDUES}') AS s FROM part),
cut_ AS (SELECT protease, pro_i, length(s) AS pro_len, regexp_extract_all(s, cut) AS f FROM pros, enzymes),
pieces AS (SELECT protease, pro_i, pro_len, unnest(f) AS pep, generate_subscripts(f, 1) - 1 AS pep_in_pro FROM cut_),
halves AS (SELECT protease || '-' || a || ',' || b AS scheme, *, pep[1:8] AS head, pep[9:] AS tail FROM pieces, labels),
labelled AS (SELECT scheme, pro_i, pro_len, pep_in_pro, length(pep) AS pep_len, greatest(length(pep) - length(translate(pep, a, '')), length(pep) - length(translate(pep, b, ''))) AS n_dyes,
  rpad(translate(head, '{schemes.LETTERS}', shown), 8, ' ') || ' ;' || least(99, length(tail) - length(translate(tail, a, ''))) || ',' || least(99, length(tail) - length(translate(tail, b, ''))) AS flustr, {_TRACK} AS track FROM halves),
patterns AS (SELECT scheme, flustr, count(*) AS flu_count, any_value(track) AS track FROM labelled GROUP BY ALL),
near AS (SELECT x.scheme, x.flustr, min(list_sum(list_transform(range(1, 19), lambda i: abs(x.track[i] - y.track[i])))) AS nn_dist FROM patterns x JOIN patterns y ON x.scheme = y.scheme AND x.flustr <> y.flustr GROUP BY ALL),
survey AS (SELECT l.scheme, pro_i, pro_len, pep_in_pro, pep_len, n_dyes, l.flustr, flu_count, nn_dist FROM labelled l JOIN patterns p ON p.scheme = l.scheme AND p.flustr = l.flustr LEFT JOIN near n ON n.scheme = l.scheme AND n.flustr = l.flustr)"""


def panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as proteins: their names' letters, and digits of a number as residues; with the rules of all schemes."""
    digits = F.translate((F.col("p_partkey") * 7919 % 1000003).cast("string"), DIGITS, RESIDUES)
    pros = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pro_i"), F.lit("all").alias("panel"), F.concat(F.regexp_replace(F.upper("p_name"), "[^A-Z]", ""), digits).alias("seq"))
    return pros, *schemes.rules(spark, {"all": (ENZYMES, LABELS, 2)})


@query(f"WITH {SCHEMES} SELECT scheme, pro_i, pep_in_pro, pep_len, n_dyes, flustr, flu_count, nn_dist FROM survey")
def scheme_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every peptide of every scheme, with how isolated its pattern is in the scheme."""
    return schemes.surveyed(*panel(spark, sf_dir), CYCLES).select("scheme", "pro_i", "pep_in_pro", "pep_len", "n_dyes", "flustr", "flu_count", "nn_dist")


@query(f"""WITH {SCHEMES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY scheme, pro_i ORDER BY nn_dist DESC, pep_in_pro) AS r FROM survey WHERE flu_count = 1 AND nn_dist IS NOT NULL),
best AS (SELECT scheme, pro_i, count(*) AS n_unique, sum(pep_len) AS held, avg(nn_dist) FILTER (r <= 2) AS m, min(nn_dist) FILTER (r <= 2) AS least_ FROM ranked GROUP BY ALL),
sums AS (SELECT scheme, count(*) AS n_found, sum(n_unique) AS n_unique, sum(held) AS held, sum(m) AS s, min(least_) AS least_ FROM best GROUP BY 1),
lengths AS (SELECT scheme, sum(n) AS residues FROM (SELECT scheme, pro_i, max(pro_len) AS n FROM survey GROUP BY ALL) GROUP BY 1),
scored AS (SELECT l.scheme, coalesce(n_found, 0) AS n_found, CAST(coalesce(n_unique, 0) AS BIGINT) AS n_unique, coalesce(held, 0) / residues AS coverage, coalesce(s, 0) / (SELECT count(*) FROM part) AS avg_dist, CASE WHEN n_found = (SELECT count(*) FROM part) THEN least_ ELSE 0.0 END AS min_dist FROM lengths l LEFT JOIN sums USING (scheme))
SELECT scheme, n_found, n_unique, round(coverage, 9) AS coverage, round(avg_dist, 9) AS avg_dist, min_dist, row_number() OVER (ORDER BY round(avg_dist, 9) DESC, scheme) AS place FROM scored""")
def schemes_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemes by the isolation of each protein's two best peptides; lost proteins count as 0."""
    rules = panel(spark, sf_dir)
    ranks = schemes.ranked_schemes(schemes.surveyed(*rules, CYCLES), table(spark, sf_dir, "part").count(), 2, schemes.lengths(*rules))
    return ranks.withColumns({"coverage": F.round("coverage", 9), "avg_dist": F.round("avg_dist", 9)})


@query(f"""WITH {PEPS}, letters AS (SELECT doc_id, unnest(range(1, length(s))) AS ptm, s FROM seq), sites AS (SELECT doc_id, ptm FROM letters WHERE s[ptm] IN ('S', 'T') AND s[ptm + 1] IN ('E', 'N')),
found AS (SELECT p.doc_id, p.pep_in_pro, pep_start, pep_stop, ptm FROM spans p JOIN sites s ON s.doc_id = p.doc_id AND ptm - 1 BETWEEN pep_start AND pep_stop - 1)
SELECT doc_id, pep_in_pro, ptm, count(*) OVER (PARTITION BY doc_id, pep_in_pro) AS n_ptms FROM found""")
def sites_in_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites are an S or T before an E or N, in whole texts."""
    marked = F.split(F.regexp_replace(F.col("seq"), "([ST])(?=[EN])", "$1|"), "[|]")
    ends = F.transform(marked, lambda x: F.char_length(x))
    # The last run has no site behind it. Nothing but the key lies beside the exploded column: it would be worked out again for every row.
    runs = proteins(spark, sf_dir).select("pro_i", ends.alias("ends")).select("pro_i", F.posexplode(F.slice("ends", 1, F.size("ends") - 1)).alias("i", "n"))
    order = Window.partitionBy("pro_i").orderBy("i")
    sites = runs.withColumn("ptm", F.sum("n").over(order)).select("pro_i", "ptm")
    found = intervals.peptides_with_sites(placed(spark, sf_dir, "lysc").drop("pep"), sites)
    return found.select(F.col("pro_i").alias("doc_id"), "pep_in_pro", "ptm", "n_ptms")


def _sql_rounds(n: int) -> str:
    """CTEs of the rounds of unmixing."""
    out = ["x0 AS (SELECT pep_i, 1.0 / (SELECT count(*) FROM top) AS x FROM top)"]
    for k in range(n):
        out.append(f"y{k} AS MATERIALIZED (SELECT dyt_i, sum(p * x) AS y FROM cells JOIN x{k} USING (pep_i) GROUP BY 1)")
        out.append(f"x{k + 1} AS MATERIALIZED (SELECT pep_i, x * top / bottom AS x FROM x{k} JOIN top USING (pep_i) JOIN (SELECT pep_i, sum(p * y) AS bottom FROM cells JOIN y{k} USING (dyt_i) GROUP BY 1) USING (pep_i))")
    return ", ".join(out)


@query(f"""WITH reads AS (SELECT l_partkey % 200 AS dyt_i, l_suppkey AS pep_i, CAST(sum(l_quantity) AS DOUBLE) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
cells AS MATERIALIZED (SELECT dyt_i, pep_i, n / sum(n) OVER (PARTITION BY pep_i) AS p FROM reads),
seen AS (SELECT l_partkey % 200 AS dyt_i, CAST(sum(l_quantity) AS DOUBLE) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT dyt_i, n / (SELECT sum(n) FROM seen) AS b FROM seen),
top AS MATERIALIZED (SELECT pep_i, sum(p * b) AS top FROM cells JOIN b USING (dyt_i) GROUP BY 1 HAVING sum(p * b) > 0), {_sql_rounds(6)}
SELECT pep_i, round(coalesce(x / (SELECT sum(x) FROM x6), 0), 9) AS share FROM (SELECT DISTINCT pep_i FROM cells) LEFT JOIN x6 USING (pep_i)""")
def unmixed_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as peptides: their shares among returned quantities of tracks, after six rounds."""
    lines = table(spark, sf_dir, "lineitem")
    track = (F.col("l_partkey") % 200).alias("dyt_i")
    reads = lines.filter("l_returnflag <> 'R'").groupBy(track, F.col("l_suppkey").alias("pep_i")).agg(F.sum("l_quantity").alias("n"))
    totals = reads.groupBy("pep_i").agg(F.sum("n").alias("total"))
    cells = reads.join(totals, "pep_i").select("dyt_i", "pep_i", (F.col("n") / F.col("total")).alias("p"))
    seen = lines.filter("l_returnflag = 'R'").groupBy(track).agg(F.sum("l_quantity").alias("n"))
    return unmix.unmixed(cells, seen, rounds=6, each=3, enough=0.0).withColumn("share", F.round("share", 9))


POINTS = "points AS (SELECT o_orderkey AS i, o_custkey % 40 AS field_i, o_orderkey % 3 AS channel_i, CAST(CAST(floor(o_totalprice * 100) AS BIGINT) % 499 AS DOUBLE) AS y, CAST((o_orderkey * 7919 + o_custkey) % 503 AS DOUBLE) AS x FROM orders)"


@query(f"""WITH RECURSIVE {POINTS}, near AS (SELECT a.i AS a, b.i AS b FROM points a JOIN points b ON a.field_i = b.field_i AND a.i <> b.i AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 36),
reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b), least_ AS (SELECT a AS i, min(b) AS m FROM reach GROUP BY 1),
named AS (SELECT p.*, least(p.i, coalesce(m, p.i)) AS peak_i FROM points p LEFT JOIN least_ USING (i)), by_channel AS (SELECT field_i, peak_i, channel_i, count(*) AS n, sum(y) AS y, sum(x) AS x FROM named GROUP BY ALL)
SELECT field_i, peak_i, round(sum(y) / sum(n), 6) AS y, round(sum(x) / sum(n), 6) AS x, count(*) AS n_channels, max(n) > 1 AS ambiguous FROM by_channel GROUP BY ALL""")
def reconciled_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as peaks: customers give fields, numbers give channels, prices and keys give places."""
    cents = F.floor(F.col("o_totalprice") * 100).cast("long")
    peaks = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("field_i"), (F.col("o_orderkey") % 3).alias("channel_i"), F.col("o_orderkey").alias("point_i"), (cents % 499).cast("double").alias("y"), ((F.col("o_orderkey") * 7919 + F.col("o_custkey")) % 503).cast("double").alias("x"))
    return spatial.reconciled(peaks, 6.0).select("field_i", "peak_i", F.round("y", 6).alias("y"), F.round("x", 6).alias("x"), "n_channels", "ambiguous")
