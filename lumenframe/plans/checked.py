"""Checks of rows, nested values by path, and stores that are written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import documents
from ..operators import checks
from ..operators.shared import shared_path
from ..sources import headed, register
from .registry import query, table

#: What orders with their lines are checked for.
ORDER_SPEC = {
    "o_orderkey": {"type": "bigint", "required": True, "min": 0},
    "o_totalprice": {"type": "double", "required": True, "min": 1000.0, "max": 490000.0},
    "o_orderstatus": {"type": "string", "choices": ["F", "O"]},
    "o_orderpriority": {"type": "string", "pattern": r"\d-[A-Z]+", "max_len": 10},
    "lines": {"type": "array", "required": True, "min_len": 2, "elems": {"type": "struct", "fields": {"quantity": {"type": "double", "required": True, "max": 49.0}, "flag": {"type": "string", "choices": ["A", "N"]}}}},
}
_BROKEN = {
    ("o_orderkey", "required"): "o_orderkey IS NULL", ("o_orderkey", "min"): "o_orderkey < 0", ("o_totalprice", "required"): "o_totalprice IS NULL", ("o_totalprice", "min"): "o_totalprice < 1000", ("o_totalprice", "max"): "o_totalprice > 490000",
    ("o_orderstatus", "choices"): "o_orderstatus NOT IN ('F', 'O')", ("o_orderpriority", "pattern"): r"NOT regexp_full_match(o_orderpriority, '\d-[A-Z]+')", ("o_orderpriority", "max_len"): "length(o_orderpriority) > 10",
    ("lines", "required"): "n IS NULL", ("lines", "min_len"): "n < 2", ("lines[].quantity", "required"): "no_quantity > 0", ("lines[].quantity", "max"): "most > 49", ("lines[].flag", "choices"): "others > 0",
}
_ORDERS = "o AS (SELECT orders.*, n, most, no_quantity, others FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_quantity) AS most, count(*) FILTER (l_quantity IS NULL) AS no_quantity, count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS others FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"


@query(f"WITH {_ORDERS} " + " UNION ALL ".join(f"SELECT '{path}' AS path, '{rule}' AS rule, count(*) FILTER ({broken}) AS n, min(CAST(o_orderkey AS VARCHAR)) FILTER ({broken}) AS first_key, max(CAST(o_orderkey AS VARCHAR)) FILTER ({broken}) AS last_key FROM o" for (path, rule), broken in _BROKEN.items()))
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over orders with nested lines, all counted in one pass."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"))).alias("lines"))
    rows = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    return checks.violations(rows, checks.required(rows, ORDER_SPEC), "o_orderkey")


_EVENTS = "e AS (SELECT event_id, json_object('user', json_object('id', user_id, 'type', event_type), 'tags', json_array(json_object('k', CAST(json_extract(props, '$.k') AS BIGINT)), json_object('k', event_id % 7))) AS doc FROM events)"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, doc): events as documents with a nested object and an array, as VARIANT."""
    k = F.get_json_object("props", "$.k").cast("long")
    tags = F.array(F.struct(k.alias("k")), F.struct((F.col("event_id") % 7).alias("k")))
    user = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("type"))
    return table(spark, sf_dir, "events").select("event_id", F.parse_json(F.to_json(F.struct(user.alias("user"), tags.alias("tags")))).alias("doc"))


@query(f"""WITH {_EVENTS}, k AS (SELECT event_id, unnest(json_extract(doc, '$.tags[*].k')) AS v, unnest(range(0, 2)) AS i FROM e), u AS (SELECT event_id, unnest(json_keys(doc, '$.user')) AS name, doc FROM e)
SELECT event_id, '$.tags[' || i || '].k' AS path, CAST(v AS VARCHAR) AS value FROM k UNION ALL SELECT event_id, '$.user.' || name, json_extract_string(doc, '$.user.' || name) FROM u""")
def event_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What matches `tags[*].k` and `user.*`."""
    rows = _events(spark, sf_dir)
    both = documents.found(rows, "doc", "tags[*].k").unionByName(documents.found(rows, "doc", "user.*"))
    return both.select("event_id", "path", F.col("value").cast("string").alias("value"))


@query(f"""WITH {_EVENTS} SELECT event_id, '{{"tags":[{{"k":' || 2 * CAST(json_extract(doc, '$.tags[0].k') AS BIGINT) || '}},{{"k":' || 2 * CAST(json_extract(doc, '$.tags[1].k') AS BIGINT) || '}}],"user":{{"id":' || json_extract(doc, '$.user.id') || ',"seen":true,"type":' || json_extract(doc, '$.user.type') || '}}}}' AS doc FROM e""")
def events_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tag's k is doubled and a user's seen is set; all else stays."""
    twice = documents.updated(F.col("doc"), "tags[*].k", lambda old: F.parse_json((F.variant_get(old, "$", "bigint") * 2).cast("string")))
    return _events(spark, sf_dir).withColumn("doc", twice).select("event_id", F.to_json(documents.updated(F.col("doc"), "user.seen", lambda old: F.parse_json(F.lit("true")))).alias("doc"))


@query("SELECT CAST(doc_id AS VARCHAR) AS key, md5(text) AS digest FROM documents")
def properties_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text is written as a property, and read from the store."""
    register(spark)
    path = shared_path(spark, "properties")
    table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("text").cast("binary").alias("value")).write.format("properties").option("path", path).mode("append").save()
    return spark.read.format("properties").option("path", path).load().select("key", F.md5("value").alias("digest"))


@query("WITH s AS (SELECT p_brand AS dyeseq, count(*) AS n, min(p_partkey) AS pep_i FROM part GROUP BY 1), r AS (SELECT dyeseq || chr(9) || n || chr(9) || pep_i AS line FROM s) SELECT '5' AS head, (SELECT CAST(count(*) AS VARCHAR) FROM r) AS rows_, line FROM r")
def classifier_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external classifier's dye sequences: parts by ranges under a head with the number of rows."""
    path = shared_path(spark, "dye-seqs")
    seqs = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dyeseq"), F.col("p_partkey").alias("pep_i"))
    headed.write_lines(headed.dye_sequence_lines(seqs), path, "5\n{rows}\n", "pep_i")
    head, lines = headed.read_lines(spark, path)
    channels, rows = head.split()
    return lines.select(F.lit(channels).alias("head"), F.lit(rows).alias("rows_"), "line")
