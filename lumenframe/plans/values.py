"""Queries of array, text and path functions, of simulation helpers and of sources that are written and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, seq
from ..operators import generators, relational, sampling, simulate
from ..sources import tables
from .registry import query, table

QUANTITIES = "q AS (SELECT l_orderkey, list(CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS a FROM lineitem GROUP BY 1)"


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; in a local run without one, in a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='lumenframe-')}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, a): an order's quantities, every fourth one missing."""
    value = F.when(F.col("l_linenumber") % 4 != 3, F.col("l_quantity").cast("double"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", value.alias("v")))).alias("r"))
    return rows.select("l_orderkey", F.transform("r", lambda x: x["v"]).alias("a"))


@query(f"WITH {QUANTITIES} SELECT l_orderkey, coalesce(round(list_avg(a), 6), 'NaN'::DOUBLE) AS mean, coalesce(round(list_median(a), 6), 'NaN'::DOUBLE) AS median FROM q")
def nan_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantities(spark, sf_dir).select("l_orderkey", F.round(arrays.nan_mean(F.col("a")), 6).alias("mean"), F.round(arrays.nan_median(F.col("a")), 6).alias("median"))


@query(f"WITH {QUANTITIES}, z AS (SELECT l_orderkey, list_transform(a, lambda x: coalesce(x, 0)) AS a FROM q) SELECT l_orderkey, array_to_string(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN i > 1 THEN CAST(a[i - 1] AS INT) ELSE -1 END), ',') AS shifted, CAST(list_position(list_transform(a, lambda x: x > 25), true) - 1 AS INT) AS first_above, CAST(a[2:] || a[:1] AS INT[])::VARCHAR AS rotated FROM z")
def shifted_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.transform("a", lambda x: F.coalesce(x, F.lit(0.0)))
    text = lambda x: F.array_join(F.transform(x, lambda v: v.cast("int").cast("string")), ",")
    rows = quantities(spark, sf_dir).select("l_orderkey", a.alias("a"))
    turned = F.concat(F.lit("["), F.array_join(F.transform(arrays.rotated(F.col("a"), 1), lambda v: v.cast("int").cast("string")), ", "), F.lit("]"))
    return rows.select("l_orderkey", text(arrays.shifted(F.col("a"), 1, F.lit(-1.0))).alias("shifted"), arrays.index_where(F.col("a"), lambda x: x > 25).alias("first_above"), turned.alias("rotated"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS length, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * cos(-2 * pi() * 3 * (i - 1) / len(embedding)))), 6) AS re, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * sin(-2 * pi() * 3 * (i - 1) / len(embedding)))), 6) AS im FROM embeddings")
def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector's length and the third term of its Fourier transform."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    third = F.get(arrays.fourier(F.col("e")), F.lit(3))
    return rows.select("vec_id", F.round(arrays.magnitude(F.col("e")), 6).alias("length"), F.round(third["re"], 6).alias("re"), F.round(third["im"], 6).alias("im"))


@query("SELECT p_partkey, array_to_string(list_transform(range(0, 5), lambda i: p_size + (p_partkey % 100) * i // 4), ',') AS spread, CAST(floor(p_size * 4 / 51.0) AS INT) AS region, regexp_replace(p_name, '[^A-Za-z0-9_]', '_', 'g') AS symbol, regexp_matches(p_brand, '^[A-Za-z_][A-Za-z0-9_]*$') AS is_symbol FROM part")
def spreads_and_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    spread = arrays.int_linspace(size, size + F.col("p_partkey") % 100, 5)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(spread, lambda x: x.cast("string")), ",").alias("spread"), arrays.region_of(size, F.lit(51), 4).alias("region"), seq.as_symbol(F.col("p_name")).alias("symbol"), seq.is_symbol(F.col("p_brand")).alias("is_symbol"))


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderkey % 7 AS VARCHAR) AS second FROM orders")
def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    json = F.to_json(F.struct(F.struct(F.col("o_custkey").alias("id")).alias("customer"), F.array(F.struct(F.lit(0).alias("k")), F.struct((F.col("o_orderkey") % 7).alias("k"))).alias("items")))
    return table(spark, sf_dir, "orders").select("o_orderkey", arrays.at_path(json, "customer.id").alias("customer"), arrays.at_path(json, "items.1.k").alias("second"))


@query("WITH s AS (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents) SELECT doc_id, length(s) AS n_residues, CASE WHEN s = '' THEN '' ELSE s[1] || '[p]' END AS first, md5(CASE WHEN s = '' THEN '' ELSE s[1] || '[p]' || s[2:] END) AS digest FROM s")
def tokens_with_modifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a modified first residue, a comment and white space between."""
    marked = lambda text: F.when(text == "", F.lit(" ")).otherwise(F.concat(F.substring(text, 1, 1), F.lit("[p] (a (nested) note)\n"), F.substring(text, F.lit(2), F.char_length(text))))
    text = seq.once(seq.letter_text(F.coalesce("text", F.lit(""))), marked)
    rows = table(spark, sf_dir, "documents").select("doc_id", seq.tokenize(text).alias("t"))
    return rows.select("doc_id", F.size("t").cast("long").alias("n_residues"), F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("first"), F.md5(seq.join_tokens(F.col("t"))).alias("digest"))


@query(r"""WITH n AS (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS s FROM part), c AS (SELECT p_partkey, s, s[2:] AS after, s[:-2] AS before FROM n)
SELECT p_partkey, CASE WHEN s = '' THEN 0 ELSE 1 + length(regexp_replace(before, '[^W]', '', 'g')) END AS idosobenzoic, CASE WHEN s = '' THEN 0 ELSE 1 + length(regexp_replace(after, '[^K]', '', 'g')) END AS lysn,
  CASE WHEN s = '' THEN 0 ELSE 1 + len(list_filter(range(2, length(s) + 1), lambda i: s[i - 1] = 'E' AND s[i] NOT IN ('P', 'E'))) END AS gluc_ph4,
  CASE WHEN s = '' THEN 0 ELSE 1 + len(list_filter(range(2, length(s) + 1), lambda i: s[i - 1] IN ('D', 'E') AND s[i] NOT IN ('P', 'E'))) END AS gluc_ph8 FROM c""")
def more_enzymes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = seq.letter_text(F.coalesce("p_name", F.lit("")))
    return table(spark, sf_dir, "part").select("p_partkey", *(F.size(seq.cut_text(text, e)).alias(e) for e in ("idosobenzoic", "lysn", "gluc_ph4", "gluc_ph8")))


DRAW = "CAST('0x' || substr(md5('{seed}|' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0"


@query(f"SELECT c_custkey FROM customer WHERE c_custkey % 5 > 0 ORDER BY round(ln(greatest({DRAW.format(seed='heavy', key='c_custkey')}, 1e-300)) / (c_custkey % 5), 12) DESC, c_custkey LIMIT 60")
def sample_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.weighted(table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 5).alias("w")), "w", 60, "c_custkey", "heavy").select("c_custkey")


@query(f"WITH d AS (SELECT id AS draw_i, CAST(floor({DRAW.format(seed='again', key='id')} * (SELECT count(*) FROM nation)) AS BIGINT) AS row_i FROM (SELECT unnest(range(0, 70)) AS id)) SELECT draw_i, row_i, n_name FROM d JOIN (SELECT n_nationkey, n_name FROM nation) ON n_nationkey = row_i")
def sample_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("row_i"), "n_name")
    return sampling.with_replacement(rows, 70, rows.count(), "again").select("draw_i", "row_i", "n_name")


@query("WITH t AS (SELECT DISTINCT [l_linenumber, l_quantity % 3] AS dyt FROM (SELECT l_linenumber, CAST(l_quantity AS INT) AS l_quantity FROM lineitem)) SELECT dyt[1] AS first, dyt[2] AS second, row_number() OVER (ORDER BY dyt) AS dyt_i FROM t")
def numbered_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number 0 is the dark track, which no line has."""
    rows = table(spark, sf_dir, "lineitem").select(F.array(F.col("l_linenumber").cast("int"), F.col("l_quantity").cast("int") % 3).alias("dyt"))
    found = simulate.numbered_tracks(rows).filter("dyt_i > 0")
    return found.select(F.get("dyt", F.lit(0)).alias("first"), F.get("dyt", F.lit(1)).alias("second"), "dyt_i")


@query()
def redrawn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's lines by quantity, drawn anew."""
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("dyt_i"), F.col("l_suppkey").alias("pep_i")).agg(F.count("*").alias("n"))
    return simulate.redrawn(counts, 50)


@query()
def photobleach_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as peptides of as many dyes as their number and one: tracks that only bleach."""
    peps = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("pep_i"), F.array_repeat(F.lit(0), F.col("r_regionkey").cast("int") + 1).alias("channels"))
    return simulate.dye_tracks(peps, 200, simulate.photobleach(10, 0.1))


@query("""WITH most AS (SELECT max(r_regionkey % 3) AS m FROM region), t AS (SELECT [a, b] AS dyt FROM (SELECT unnest(range(0, m + 1)) AS a FROM most) x, (SELECT unnest(range(0, m + 1)) AS b FROM most) y WHERE b <= a), n AS (SELECT row_number() OVER (ORDER BY dyt) - 1 AS dyt_i, dyt FROM t)
SELECT dyt_i, array_to_string(dyt, '') AS dyt, CASE WHEN dyt_i = 0 THEN 0 ELSE 100 END AS n FROM n""")
def span_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct tracks of all regions' dyes, with 100 reads each but for the dark one."""
    regions = table(spark, sf_dir, "region").select("r_regionkey")
    tracks = simulate.numbered_tracks(generators.spans_of(regions, [F.col("r_regionkey") % 3], 2).select("dyt").distinct())
    return tracks.join(simulate.one_each(tracks, 100), "dyt_i").select("dyt_i", F.array_join(F.transform("dyt", lambda x: x.cast("string")), "").alias("dyt"), "n")


@query()
def random_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of ten residues from documents, as likely as they are long."""
    proteins = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pro_i"), seq.letter_text(F.coalesce("text", F.lit(""))).alias("seq"))
    return generators.random_windows(proteins, 500, 10, "windows")


@query(r"WITH s AS (SELECT doc_id, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS s FROM documents) SELECT 'doc ' || doc_id AS header, length(s) AS n, md5(s) AS digest FROM s")
def fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' letters, written as FASTA in lines of 60 and read back."""
    path = shared(spark, "fasta")
    text = seq.letter_text(F.coalesce("text", F.lit("")))
    lines = F.regexp_replace(text, "(.{60})(?=.)", "$1\n")
    table(spark, sf_dir, "documents").select(F.concat(F.lit(">doc "), F.col("doc_id").cast("string"), F.lit("\n"), lines)).write.text(path)
    found = tables.read_fasta(spark, path)
    return found.select("header", F.char_length("sequence").alias("n"), F.md5("sequence").alias("digest"))


@query("SELECT p_name AS name, p_brand AS sequence, CAST(p_size AS DOUBLE) AS abundance, p_size % 2 = 0 AS is_poi, p_size || ';' || (p_size + 3) AS ptm_locs FROM part")
def protein_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared(spark, "proteins")
    part = table(spark, sf_dir, "part")
    part.select(F.col("p_name").alias("Name"), F.col("p_brand").alias("Sequence"), F.col("p_size").alias("Abundance"), (F.col("p_size") % 2 == 0).cast("int").alias("POI"), F.concat_ws(";", F.col("p_size").cast("string"), (F.col("p_size") + 3).cast("string")).alias("PTM"), F.lit("x").alias("Other")).write.csv(path, header=True)
    return tables.read_proteins(spark, path).select("name", "sequence", "abundance", "is_poi", "ptm_locs")


@query("SELECT n_nationkey + 1 AS pred_i, CAST(n_nationkey AS BIGINT) AS row_i, n_regionkey / 10.0 AS score FROM nation")
def predictions_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared(spark, "predictions")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_nationkey", F.col("n_regionkey") / 10).toDF("row_i", "pred_i", "score").write.csv(path)
    return tables.read_predictions(spark, path)


@query("SELECT 'nation' || n_nationkey AS name, n_name AS value FROM nation")
def scope_metadata_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared(spark, "scope")
    table(spark, sf_dir, "nation").select(F.concat(F.lit("stage.nation"), F.col("n_nationkey").cast("string"), F.lit("\t"), F.col("n_name"))).write.text(path)
    return tables.read_scope_metadata(spark, path, "UTF-8").select(F.get("keys", F.lit(1)).alias("name"), "value")


@query("SELECT n_regionkey AS field_i, count(*) AS n, sum(n_nationkey) AS total FROM nation WHERE n_regionkey IN (1, 3) GROUP BY 1")
def fields_written_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder a field; two of them are read."""
    from ..operators import accessors

    path = shared(spark, "fields")
    accessors.write_fields(table(spark, sf_dir, "nation").withColumn("field_i", F.col("n_regionkey")), path)
    return accessors.of_fields(spark.read.parquet(path), [1, 3]).groupBy("field_i").agg(F.count("*").alias("n"), F.sum("n_nationkey").alias("total"))


@query("SELECT l_orderkey AS pep_i, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) AS seqstr FROM lineitem GROUP BY 1")
def residue_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.strings(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pep_i"), F.col("l_linenumber").alias("at"), F.col("l_returnflag").alias("aa")))


@query("SELECT s_suppkey AS pep_i, n_name AS pro_id, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS seqstr FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def peptides_with_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pros = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pro_i"), F.col("n_name").alias("pro_id"))
    peps = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pep_i"), F.col("s_nationkey").alias("pro_i"), "s_name")
    seqs = peps.filter("pep_i % 3 > 0").select("pep_i", F.col("s_name").alias("seqstr"))
    return relational.with_strings(pros, peps, seqs).select("pep_i", "pro_id", "seqstr")


@query("SELECT event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id), 'none') AS before FROM events")
def shifted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relational.neighbours_of(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type", 1, "none")
    return found.select("event_id", F.col("event_type_shifted").alias("before"))


@query("SELECT event_id, count(*) OVER w AS size, min(value) OVER w AS least, max(value) OVER w AS most, round(avg(value) OVER w, 6) AS mean FROM events WINDOW w AS (PARTITION BY event_type)")
def group_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relational.with_group_statistics(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_type", "value")
    return found.select("event_id", "size", F.col("min_value").alias("least"), F.col("max_value").alias("most"), F.round("mean_value", 6).alias("mean"))


@query("SELECT user_id, min(event_id) FILTER (event_type = 'purchase') AS first, max(event_id) FILTER (event_type = 'purchase') AS last FROM events GROUP BY 1")
def first_and_last_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.first_and_last(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("event_type") == "purchase")


@query("SELECT n_name AS name, n_nationkey AS left_i, c.row_i AS right_i FROM nation JOIN (SELECT n_name AS name, 100 + n_nationkey AS row_i FROM nation WHERE n_regionkey = 2) c ON c.name = n_name WHERE n_nationkey > 5")
def keys_of_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    left = nation.filter("n_nationkey > 5").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("row_i"))
    return relational.intersection(left, nation.filter("n_regionkey = 2").select(F.col("n_name").alias("name"), (100 + F.col("n_nationkey")).alias("row_i")), "name")


@query("SELECT p_brand AS dyeseq, count(*) AS n, min(p_partkey) AS pep_i FROM part GROUP BY 1")
def dye_sequences_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared(spark, "dyeseqs")
    tables.write_dye_sequences(table(spark, sf_dir, "part").select(F.col("p_brand").alias("dyeseq"), F.col("p_partkey").alias("pep_i")), path, 2)
    return tables.read_dye_sequences(spark, path)
