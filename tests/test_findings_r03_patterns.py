"""Finding 13 of round 3: peptides with their patterns, cut and labelled once."""

import duckdb
from lumenframe import plans
from lumenframe.operators import relational
from lumenframe.plans import sequences
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_texts_are_cut_once(spark):
    plan = sequences.placed(spark, SMALL, "lysc")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    found = plans.QUERIES["peptides_with_flus"](spark, SMALL)
    assert not [f for f in found.inputFiles() if "documents" in f]  # the pieces were written once, and the texts are not read again


def test_missing_numbers_have_no_patterns(spark, tmp_path):
    texts = [(1, "MADEK yy KED, dyk"), (2, "eek"), (3, ""), (4, None), (None, "dek yk"), (5, "K K k")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = plans.QUERIES["peptides_with_flus"](spark, str(tmp_path)).collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        wanted = db.execute(plans.SQL["peptides_with_flus"]).fetchall()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert {r.doc_id for r in found} == {1, 2, 5}


def test_repeated_numbers_meet_as_by_the_join(spark):
    rows = [(1, 0, 0, "a", 2), (1, 0, 0, "b", 1), (1, 1, 7, "a", 3), (2, 0, 0, "a", 2), (2, 1, 4, "c", 0), (None, 0, 0, "a", 9)]
    found = relational.patterned(spark.createDataFrame(rows, "pro_i long, pep_in_pro int, pep_start int, flustr string, n_max int"))
    shares = {f: sum(r[3] == f for r in rows) for f in "abc"}
    rows = [r for r in rows if r[0] is not None]
    wanted = [(*p[:3], *f[3:], shares[f[3]]) for p in rows for f in rows if p[:2] == f[:2]]
    assert sorted(tuple(r[c] for c in ("pro_i", "pep_in_pro", "pep_start", "flustr", "n_max", "flu_count")) for r in found.collect()) == sorted(wanted)
    assert len(wanted) == 7


def test_patterns_of_other_peptides_are_joined_by_key(spark):
    flus = spark.createDataFrame([(1, "a", 2), (2, "a", 3), (3, "b", 1)], "pep_i int, flustr string, n_dyes_max_any_ch int")
    peps = spark.range(1, 5).select(F.col("id").cast("int").alias("pep_i"))
    got = {r["pep_i"]: (r["flustr"], r["flu_count"]) for r in relational.with_flus(peps, flus).collect()}
    assert got == {1: ("a", 2), 2: ("a", 2), 3: ("b", 1), 4: (None, None)}
