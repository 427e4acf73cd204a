"""Join, completion, frequency-table, survey, sampling and generator queries on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import generators, relational, sampling, survey
from .registry import query, table

COUNTS = "counts AS (SELECT l_partkey % 200 AS dyt_i, l_suppkey AS pep_i, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY ALL)"


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dyt_i, pep_i, n): parts as tracks, suppliers as peptides, quantities as reads."""
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 200).alias("dyt_i"), F.col("l_suppkey").alias("pep_i")).agg(F.sum("l_quantity").cast("long").alias("n"))


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def left_join_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "c_nationkey"})
    joined = relational.left_join(table(spark, sf_dir, "customer"), nation, "c_nationkey").withColumnRenamed("n_regionkey", "r_regionkey")
    return relational.left_join(joined, table(spark, sf_dir, "region"), "r_regionkey").select("c_custkey", "n_name", "r_name")


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey ORDER BY o_orderkey")
def order_preserving_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return relational.joined_in_order(table(spark, sf_dir, "orders"), customers, "o_custkey", "o_orderkey").select("o_orderkey", "c_name")


@query("SELECT s_name AS pro_id, coalesce(a.abundance, 0) AS abundance FROM supplier LEFT JOIN (SELECT 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS name, sum(l_quantity) AS abundance FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a ON s_name = name")
def protein_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    abundance = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").groupBy(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("name")).agg(F.sum("l_quantity").alias("abundance"))
    return relational.with_abundance(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("pro_id")), abundance)


@query("WITH c AS (SELECT l_suppkey AS pep_i, count(*) AS n FROM lineitem GROUP BY 1), g AS (SELECT unnest(range(0, 1 + (SELECT max(s_suppkey) FROM supplier) + 10)) AS pep_i) SELECT pep_i, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (pep_i)")
def completed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    most = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]
    found = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("pep_i")).agg(F.count("*").alias("n"))
    return relational.completed(found, "pep_i", (most or 0) + 11, {"n": 0})


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def domain_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.without(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.first_of_each(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey")


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.duplicates(table(spark, sf_dir, "part"), "p_name")


@query("""WITH a AS (SELECT l_quantity AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT l_quantity AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 5 GROUP BY 1),
j AS (SELECT coalesce(a.n / (SELECT sum(n) FROM a), 0) AS p, coalesce(b.n / (SELECT sum(n) FROM b), 0) AS q FROM a FULL JOIN b ON a.k = b.k)
SELECT round(sum((p - q) ** 2), 12) AS sse, round(sqrt(sum((p - q) ** 2)) * 10000, 6) AS rmse FROM j""")
def hist_full_outer_sse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    one = lines.filter("l_returnflag = 'A'").groupBy(F.col("l_quantity").alias("k")).agg(F.count("*").alias("n"))
    two = lines.filter("l_returnflag = 'R' and l_quantity > 5").groupBy(F.col("l_quantity").alias("k")).agg(F.count("*").alias("n"))
    return relational.histogram_error(one, two, "k", "n").select(F.round("sse", 12).alias("sse"), F.round("rmse", 6).alias("rmse"))


@query(f"WITH {COUNTS} SELECT dyt_i, pep_i, n FROM counts")
def dytpep_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


@query(f"WITH {COUNTS} SELECT dyt_i, pep_i FROM counts QUALIFY row_number() OVER (PARTITION BY dyt_i ORDER BY n DESC, pep_i) = 1")
def mlpep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.most_likely(counts(spark, sf_dir))


@query(f"WITH {COUNTS} SELECT dyt_i, pep_i, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY pep_i) AS p FROM counts")
def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.transitions(counts(spark, sf_dir))


@query(f"WITH {COUNTS} SELECT CAST(max(pep_i) + 1 AS BIGINT) AS n_peps, count(DISTINCT pep_i) AS n_peps_seen, count(DISTINCT dyt_i) AS n_tracks, CAST(sum(n) AS BIGINT) AS n_reads FROM counts")
def dytpep_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).agg((F.max("pep_i") + 1).alias("n_peps"), F.countDistinct("pep_i").alias("n_peps_seen"), F.countDistinct("dyt_i").alias("n_tracks"), F.sum("n").alias("n_reads"))


@query("WITH s AS (SELECT DISTINCT s_suppkey AS pro_i, s_nationkey AS flu FROM supplier), p AS (SELECT DISTINCT a.pro_i, b.pro_i AS other FROM s a JOIN s b ON a.flu = b.flu AND a.pro_i <> b.pro_i), l AS (SELECT pro_i, array_to_string(list(other ORDER BY other), ',') AS others FROM p GROUP BY 1) SELECT s.pro_i, coalesce(others, '') AS others FROM (SELECT DISTINCT pro_i FROM s) s LEFT JOIN l USING (pro_i)")
def proteins_sharing_flu(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pro_i"), F.col("s_nationkey").cast("string").alias("flustr"))
    return relational.unlike_proteins(rows, rows)


@query("""SELECT o_custkey, o_orderkey, l_linenumber, n_lines, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT l_orderkey, max(l_linenumber) + 1 AS n_lines FROM lineitem GROUP BY 1) n ON n.l_orderkey = o_orderkey JOIN lineitem l ON l.l_orderkey = o_orderkey""")
def fields_and_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table of fields, their number of peaks, and peaks."""
    lines = table(spark, sf_dir, "lineitem")
    n = lines.groupBy("l_orderkey").agg((F.max("l_linenumber") + 1).alias("n_lines"))
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("o_orderkey") == n["l_orderkey"]).drop("l_orderkey")
    return joined.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "o_orderkey", "l_linenumber", "n_lines", "c_mktsegment")


TRACKS = "tracks AS (SELECT vec_id AS dyt_i, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 8) AS DOUBLE)) AS vec FROM embeddings)"


@query(f"""WITH {TRACKS}, p AS (SELECT a.dyt_i, b.dyt_i AS other_i, list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: abs(a.vec[i] - b.vec[i]))) AS d FROM tracks a JOIN tracks b ON a.dyt_i <> b.dyt_i),
near AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY dyt_i ORDER BY d, other_i) <= 10),
c AS (SELECT dyt_i, dyt_i % 30 AS pep_i, 5 + dyt_i % 7 AS n FROM tracks UNION ALL SELECT dyt_i, (dyt_i + 1) % 30, 1 + dyt_i % 4 FROM tracks),
own AS (SELECT dyt_i, pep_i AS own FROM c QUALIFY row_number() OVER (PARTITION BY dyt_i ORDER BY n DESC, pep_i) = 1),
r AS (SELECT c.pep_i, c.dyt_i, c.n, o.own = c.pep_i AS mine, list(1 - exp(-0.8 * near.d)) FILTER ((o.own = c.pep_i) <> (q.own = c.pep_i)) AS ps FROM c JOIN own o ON o.dyt_i = c.dyt_i LEFT JOIN near ON near.dyt_i = c.dyt_i LEFT JOIN own q ON q.dyt_i = near.other_i GROUP BY ALL),
t AS (SELECT pep_i, n, coalesce(list_product(ps), 1) AS product, mine FROM r)
SELECT pep_i, round(sum(n * CASE WHEN mine THEN product ELSE 1 - product END) / sum(n), 9) AS score FROM t GROUP BY 1""")
def knn_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks are whole rounded vectors; peptides share them."""
    tracks = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("dyt_i"), F.transform("embedding", lambda x: F.round(x.cast("double") * 8)).alias("vec"))
    one = tracks.select("dyt_i", (F.col("dyt_i") % 30).alias("pep_i"), (5 + F.col("dyt_i") % 7).alias("n"))
    two = tracks.select("dyt_i", ((F.col("dyt_i") + 1) % 30).alias("pep_i"), (1 + F.col("dyt_i") % 4).alias("n"))
    reads = one.unionByName(two)
    return survey.isolation(reads, survey.nearest_tracks(tracks, 10), relational.most_likely(reads)).withColumn("score", F.round("score", 9))


SURVEY = "s AS (SELECT l_orderkey AS pro_i, l_orderkey * 10 + l_linenumber AS pep_i, l_discount AS nn_dist, CAST(l_quantity AS INT) AS pep_len, l_linenumber AS n_dyes, l_suppkey % 4 AS n_ptms, l_tax > 0.04 AS p2, l_returnflag = 'A' AS is_poi, l_partkey, l_suppkey FROM lineitem)"


def surveyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select(F.col("l_orderkey").alias("pro_i"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pep_i"), F.col("l_discount").alias("nn_dist"), F.col("l_quantity").cast("int").alias("pep_len"), F.col("l_linenumber").alias("n_dyes"), (F.col("l_suppkey") % 4).alias("n_ptms"), (F.col("l_tax") > 0.04).alias("p2"), (F.col("l_returnflag") == "A").alias("is_poi"))


@query(f"WITH {SURVEY} SELECT pro_i, rank, nn_dist, pep_len, n_dyes FROM (SELECT *, row_number() OVER (PARTITION BY pro_i ORDER BY nn_dist DESC, pep_len, n_dyes, pep_i) AS rank FROM s) WHERE rank <= 2")
def rank_in_protein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.ranked(surveyed(spark, sf_dir), 2).select("pro_i", "rank", "nn_dist", "pep_len", "n_dyes")


@query(f"WITH {SURVEY} SELECT pro_i, pep_i, pep_len, n_dyes FROM s WHERE is_poi AND pep_len <= 30 AND n_dyes <= 5 AND n_ptms <= 2 AND NOT p2")
def survey_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.filtered(surveyed(spark, sf_dir), poi_only=True, max_pep_len=30, max_dyes=5, max_ptms=2, no_proline_2=True).select("pro_i", "pep_i", "pep_len", "n_dyes")


@query("WITH b AS (SELECT l_returnflag || '-' || l_linestatus AS scheme, l_suppkey AS pro_i, max(l_discount) AS best FROM lineitem GROUP BY ALL), a AS (SELECT scheme, round(avg(best), 9) AS avg_dist, min(best) AS min_dist FROM b GROUP BY 1) SELECT *, row_number() OVER (ORDER BY avg_dist DESC, scheme) AS place FROM a")
def best_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_returnflag", "l_linestatus").alias("scheme"), F.col("l_suppkey").alias("pro_i"), F.col("l_discount").alias("nn_dist"))
    return survey.best_schemes(ranks).withColumn("avg_dist", F.round("avg_dist", 9))


DRAW = "CAST('0x' || substr(md5('{seed}|' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0"


@query(f"SELECT c_custkey, c_mktsegment FROM customer ORDER BY {DRAW.format(seed='pick', key='c_custkey')}, c_custkey LIMIT 40")
def sample_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.exactly(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), 40, "c_custkey", "pick")


@query(f"SELECT c_custkey, c_mktsegment FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY {DRAW.format(seed='strata', key='c_custkey')}, c_custkey) <= 7")
def sample_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", 7, "c_custkey", "strata")


def _text(dyt: str):
    return F.array_join(F.transform(dyt, lambda x: x.cast("string")), "")


@query("""WITH RECURSIVE t AS (SELECT p_partkey, [i] AS dyt FROM (SELECT p_partkey, unnest(range(0, p_size % 4 + 1)) AS i FROM part) UNION ALL SELECT p_partkey, list_append(dyt, n) FROM (SELECT p_partkey, dyt, unnest(range(greatest(0, dyt[-1] - 1), dyt[-1] + 1)) AS n FROM t WHERE len(dyt) < 6))
SELECT p_partkey, array_to_string(dyt, '') AS dyt FROM t WHERE len(dyt) = 6""")
def triangle_dyt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with the tracks of as many dyes as its size mod 4, which fall by one at most."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return generators.tracks_of(parts, F.col("p_size") % 4, 6, multi_drop=False).select("p_partkey", _text("dyt").alias("dyt"))


@query("""WITH RECURSIVE t AS (SELECT s_suppkey, c, [i] AS dyt FROM (SELECT s_suppkey, 0 AS c, unnest(range(0, s_nationkey % 3 + 1)) AS i FROM supplier UNION ALL SELECT s_suppkey, 1, unnest(range(0, s_nationkey % 2 + 1)) FROM supplier)
UNION ALL SELECT s_suppkey, c, list_append(dyt, n) FROM (SELECT s_suppkey, c, dyt, unnest(range(0, dyt[-1] + 1)) AS n FROM t WHERE len(dyt) < 4))
SELECT a.s_suppkey, array_to_string(a.dyt, '') || array_to_string(b.dyt, '') AS dyt FROM t a JOIN t b USING (s_suppkey) WHERE a.c = 0 AND b.c = 1 AND len(a.dyt) = 4 AND len(b.dyt) = 4""")
def span_dyt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier with all combinations of its two channels' tracks."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return generators.spans_of(rows, [F.col("s_nationkey") % 3, F.col("s_nationkey") % 2], 4).select("s_suppkey", _text("dyt").alias("dyt"))


@query("""WITH s AS (SELECT p || '-' || a || ',' || b AS scheme, a, b FROM (VALUES ('trypsin'), ('lysc'), ('aspn')) x(p), (VALUES ('C', 1), ('DE', 2), ('K', 3), ('Y', 4)) u(a, i), (VALUES ('C', 1), ('DE', 2), ('K', 3), ('Y', 4)) v(b, j) WHERE i < j)
SELECT n_name, scheme, length(n_name) - length(translate(n_name, a, '')) AS n_first, length(n_name) - length(translate(n_name, b, '')) AS n_second FROM nation, s""")
def scheme_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation's name under all schemes, with the residues that either label holds."""
    every = generators.schemes(spark, ["trypsin", "lysc", "aspn"], ["C", "DE", "K", "Y"], 2).withColumn("panel", F.lit(0))
    names = table(spark, sf_dir, "nation").select("n_name", F.lit(0).alias("panel")).join(F.broadcast(every), "panel")  # 18 schemes
    held = lambda i: F.char_length("n_name") - F.char_length(F.call_function("translate", F.col("n_name"), F.get(F.split("labels", ","), F.lit(i)), F.lit("")))
    return names.select("n_name", "scheme", held(0).alias("n_first"), held(1).alias("n_second"))


@query("WITH m AS (SELECT unnest(range(0, 256)) AS m) SELECT s_suppkey, array_to_string(list_transform(range(0, 8), lambda i: CASE WHEN (m >> i) & 1 = 1 THEN 'K' ELSE '.' END), '') AS pep FROM supplier JOIN m ON bit_count(m::INT) = s_nationkey % 4")
def spanning_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier with all places for its number of labels among eight residues."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return generators.placements_of(rows, F.col("s_nationkey") % 4, "K", 8).select("s_suppkey", "pep")


@query("SELECT p_name AS pep, CAST(k AS INT) AS k, repeat('.', k) || p_name AS clone FROM (SELECT DISTINCT p_name FROM part) CROSS JOIN (SELECT unnest(range(1, 4)) AS k)")
def clone_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.clones(table(spark, sf_dir, "part").select(F.col("p_name").alias("pep")).distinct(), 3)


@query("WITH t AS (SELECT o_custkey, list(l_quantity > 25 ORDER BY o_orderkey, l_linenumber, l_quantity) AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) SELECT o_custkey, array_to_string(list_transform(q, lambda b: CASE WHEN b THEN 'X' ELSE '.' END), '') AS pep FROM t")
def track_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    lists = joined.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "l_linenumber", "l_quantity"))).alias("q"))
    return lists.select("o_custkey", F.array_join(F.transform("q", lambda x: F.when(x["l_quantity"] > 25, F.lit("X")).otherwise(F.lit("."))), "").alias("pep"))
