"""Data sources that read ranges, sinks that commit, checks, and nested values by path."""

import json
import os
import struct

import numpy as np
import pytest
from lumenframe.functions import documents
from lumenframe.operators import checks
from lumenframe.sources import headed, nd2, register
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def sources(spark):
    register(spark)
    return spark


def nd2_file(stack):
    """A container of frames (frame, height, width, component)."""

    def chunk(name, data):
        nonlocal out
        places.append((name, len(out)))
        out += struct.pack("<IIQ", nd2.MARK, len(name), len(data)) + name.encode() + data

    def value(kind, name, data):
        text = (name + "\0").encode("utf-16-le")
        return bytes([kind, len(text) // 2]) + text + data

    out, places = b"", []
    fields = b"".join(value(3, n, struct.pack("<I", v)) for n, v in (("uiWidth", stack.shape[2]), ("uiHeight", stack.shape[1]), ("uiComp", stack.shape[3])))
    name = "SLxImageAttributes\0"
    head = 2 + 2 * len(name)
    chunk("ImageAttributesLV!", bytes([11, len(name)]) + name.encode("utf-16-le") + struct.pack("<IQ", 3, head + 12 + len(fields)) + fields + b"\0" * 24)
    for k, frame in enumerate(stack):
        chunk(f"ImageDataSeq|{k}!", struct.pack("<d", k) + frame.astype("<u2").tobytes())
    body = b"".join(n.encode() + struct.pack("<QQ", at, 0) for n, at in places) + nd2.SIGNATURE + b"\0" * 16
    return out + struct.pack("<IIQ", nd2.MARK, 0, len(body)) + body + nd2.SIGNATURE + struct.pack("<Q", len(out))


def tiff_file(pages, end="<"):
    out = (b"II" if end == "<" else b"MM") + struct.pack(end + "HI", 42, 8)
    for i, page in enumerate(pages):
        h, w = page.shape
        tags = [(256, 4, w), (257, 4, h), (258, 3, 16), (259, 3, 1), (273, 4, len(out) + 2 + 12 * 6 + 4), (279, 4, 2 * h * w)]
        after = len(out) + 2 + 12 * 6 + 4 + 2 * h * w
        out += struct.pack(end + "H", 6) + b"".join(struct.pack(end + "HHI", t, k, 1) + (struct.pack(end + "H", v) + b"\0\0" if k == 3 else struct.pack(end + "I", v)) for t, k, v in tags)
        out += struct.pack(end + "I", after if i + 1 < len(pages) else 0) + page.astype(end + "u2").tobytes()
    return out


@pytest.mark.parametrize("kind", ["npy", "nd2", "tiff"])
def test_planes_are_read_in_ranges(sources, tmp_path, kind):
    rng = np.random.default_rng(1)
    stack = rng.integers(0, 60_000, (20, 3 if kind != "tiff" else 1, 6, 5)).astype("<u2")
    if kind == "npy":
        np.save(tmp_path / "x.npy", stack)
    elif kind == "nd2":
        (tmp_path / "x.nd2").write_bytes(nd2_file(stack.transpose(0, 2, 3, 1)))
    else:
        (tmp_path / "x.tif").write_bytes(tiff_file(stack[:, 0], ">"))
    df = sources.read.format("planes").option("kind", kind).option("partitionBytes", "300").load(str(tmp_path))
    rows = df.withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == stack.shape[0] * stack.shape[1] and len({r.task for r in rows}) > 3
    assert all((r.height, r.width) == (6, 5) and r.pixels == stack[r.frame_i, r.channel_i].ravel().astype(float).tolist() for r in rows)
    few = df.filter("frame_i >= 3 and frame_i < 5 and channel_i = 0").collect()
    assert [r.frame_i for r in few] == [3, 4] and sum(r.bytes_read for r in few) <= 2 * 60 * (3 if kind == "nd2" else 1)
    bare = df.sparkSession.read.format("planes").option("kind", kind).option("pixels", "false").load(str(tmp_path)).agg(F.count("*"), F.count("pixels"), F.sum("bytes_read")).first()
    assert tuple(bare) == (len(rows), 0, 0)
    with pytest.raises(Exception, match="FileNotFound|not found|No such"):
        sources.read.format("planes").option("kind", kind).load(str(tmp_path / "none")).collect()


def test_properties(sources, tmp_path):
    path = str(tmp_path / "store")
    rows = sources.range(2000).selectExpr("concat('k', id) as key", "cast(if(id = 7, null, repeat(cast(id as string), 300)) as binary) as value").repartition(6)
    rows.write.format("properties").option("path", path).mode("append").save()
    store = sources.read.format("properties").option("path", path).load()
    assert {r.key: r.value for r in store.collect()} == {r.key: r.value for r in rows.collect()}
    asked = store.filter("key in ('k5', 'k7', 'k1999', 'nowhere')").collect()
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)
    assert {r.key: r.value and len(r.value) for r in asked} == {"k5": 300, "k7": None, "k1999": 1200} and 0 < sum(r.bytes_read for r in asked) < size / 20
    assert store.filter("key = 'nowhere'").collect() == []
    sources.createDataFrame([("k5", b"again")], "key string, value binary").write.format("properties").option("path", path).mode("append").save()
    assert sorted(len(r.value) for r in store.filter("key = 'k5'").collect()) == [5, 300]


@pytest.mark.parametrize("kind", ["properties", "headed"])
def test_a_failed_job_leaves_nothing_that_is_read(sources, tmp_path, kind):
    path = str(tmp_path / kind)
    name = F.when(F.col("id") == 790, F.raise_error("lost").cast("string")).otherwise(F.concat(F.lit("k"), F.col("id")))
    bad = sources.range(800, numPartitions=8).select(name.alias("key"), F.lit(b"v").alias("value")) if kind == "properties" else sources.range(800, numPartitions=8).select(name.alias("line"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format(kind).option("path", path).option("head", "{rows}\n").mode("append").save()
    assert os.listdir(path) == []
    if kind == "properties":
        assert sources.read.format("properties").option("path", path).load().collect() == []


def test_lines_under_a_head(sources, tmp_path):
    path = str(tmp_path / "lines")
    rng = np.random.default_rng(2)
    rows = sources.createDataFrame([(f"row {i}", int(i)) for i in rng.permutation(500)], "line string, i long").repartition(8)
    headed.write_lines(rows, path, "2\n{rows}\n", "i")
    parts = json.loads((tmp_path / "lines" / "manifest.json").read_text())
    whole = (tmp_path / "lines" / "head").read_text() + "".join((tmp_path / "lines" / p["name"]).read_text() for p in parts)
    assert len(parts) > 1 and whole == "2\n500\n" + "".join(f"row {i}\n" for i in range(500))
    head, lines = headed.read_lines(sources, path)
    assert head == "2\n500\n" and lines.count() == 500 and {r.part for r in lines.collect()} == set(range(len(parts)))
    headed.write_lines(rows.limit(0), str(tmp_path / "none"), "{rows}\n", "i")
    head, lines = headed.read_lines(sources, str(tmp_path / "none"))
    assert head == "0\n" and lines.collect() == []


def test_classifier_input_end_to_end(sources, tmp_path):
    seqs = sources.createDataFrame([("..0", 3), ("..0", 1), ("1", 2), ("", 9)], "dyeseq string, pep_i long")
    mats = sources.createDataFrame([(1, [1.0, 0.5]), (0, [2.0, 3.0])], "row_i long, radmat array<double>")
    headed.write_classifier_input(seqs, mats, str(tmp_path), 1, 2)
    assert headed.read_lines(sources, str(tmp_path / "dye-seqs.tsv"))[0] == "1\n2\n"
    head, lines = headed.read_lines(sources, str(tmp_path / "radiometries.tsv"))
    assert head == "2\n1\n2\n" and [r.line for r in lines.orderBy("part").collect()] == ["2.0\t3.0", "1.0\t0.5"]


SPEC = {"i": {"type": "bigint", "required": True, "max": 3}, "s": {"pattern": "[a-z]+", "choices": ["x", "yy"]}, "a": {"type": "array", "min_len": 1, "elems": {"type": "struct", "fields": {"k": {"required": True, "min": 0}, "t": {"type": "array", "elems": {"max_len": 1}}}}}}


def test_checks_find_all_violations_at_once(spark):
    rows = spark.createDataFrame([(1, "x", [(1, ["p"])]), (9, "Y", []), (None, None, [(None, ["pp", "q"]), (-1, None)]), (3, "yy", None)], "i long, s string, a array<struct<k int, t array<string>>>")
    faults, rules = checks.compiled(SPEC, rows.schema)
    assert faults == []
    expected = {("i", "required"): 1, ("i", "max"): 1, ("s", "choices"): 1, ("s", "pattern"): 1, ("a", "min_len"): 1, ("a[].k", "required"): 1, ("a[].k", "min"): 1, ("a[].t[]", "max_len"): 1}
    found = {(r.path, r.rule): r.n for r in checks.violations(rows, rules, "s").collect()}
    assert found == expected
    passed, watch = checks.observed(rows, rules, "i")
    assert passed.count() == 4 and {(p, r): n for p, r, n, *_ in checks.told(watch, rules)} == expected
    assert [len(r.broken) for r in checks.with_broken(rows, rules).collect()] == [0, 4, 4, 0]
    faults, _ = checks.compiled({**SPEC, "i": {"type": "int"}, "gone": {"required": True}, "a": {"elems": {"fields": {"z": {"required": True}}, "unknown": "refuse"}}}, rows.schema)
    assert faults == ["i: bigint in place of int", "a[].z: missing", "a[].k: unknown", "a[].t: unknown", "gone: missing"]
    with pytest.raises(ValueError, match="gone: missing"):
        checks.required(rows, {"gone": {"required": True}})


def test_checks_add_no_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id as i").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    passed, watch = checks.observed(rows, checks.required(rows, {"i": {"max": 989}}), "i")
    assert passed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    passed.write.format("noop").mode("overwrite").save()
    assert checks.told(watch, checks.required(rows, {"i": {"max": 989}})) == [("i", "max", 10, "990", "999")]


JSON = ['{"a":{"x":{"k":1},"y":{"k":2}},"l":[{"k":3},{"k":4,"m":[5]}],"odd name":7}', '{"a":5}', None]


@pytest.mark.parametrize(("path", "places"), [("a.*.k", {"$.a.x.k": "1", "$.a.y.k": "2"}), ("l[*].k", {"$.l[0].k": "3", "$.l[1].k": "4"}), ("l[1].m[0]", {"$.l[1].m[0]": "5"}), ("**.k", {"$.a.x.k": "1", "$.a.y.k": "2", "$.l[0].k": "3", "$.l[1].k": "4"}), ("odd name", {"$.odd name": "7"}), ("none.*", {})])
def test_nested_paths(spark, path, places):
    df = spark.createDataFrame([(i, j) for i, j in enumerate(JSON)], "i int, j string").select("i", F.parse_json("j").alias("v"))
    assert {r.path: r.value for r in documents.found(df, "v", path).filter("i = 0").select("path", F.col("value").cast("string").alias("value")).collect()} == places


@pytest.mark.parametrize(("path", "first"), [("a.x.k", {"a": {"x": {"k": 99}, "y": {"k": 2}}}), ("a.*.k", {"a": {"x": {"k": 99}, "y": {"k": 99}}}), ("l[*].k", {"l": [{"k": 99}, {"k": 99, "m": [5]}]}), ("l[0].k", {"l": [{"k": 99}, {"k": 4, "m": [5]}]}), ("new.z", {"new": {"z": 99}})])
def test_nested_updates_rewrite_one_path(spark, path, first):
    df = spark.createDataFrame([(i, j) for i, j in enumerate(JSON)], "i int, j string").select("i", F.parse_json("j").alias("v"))
    out = [r.s and json.loads(r.s) for r in df.select(F.to_json(documents.updated(F.col("v"), path, lambda old: F.parse_json(F.lit("99")))).alias("s"), "i").orderBy("i").collect()]
    assert out[0] == {**json.loads(JSON[0]), **first} and out[1] == ({"a": 5, "new": {"z": 99}} if path == "new.z" else {"a": 5})


def test_paths_that_are_none():
    with pytest.raises(ValueError, match="not a path"):
        documents.steps_of("a[")
    with pytest.raises(ValueError, match="names its levels"):
        documents.updated(F.lit(None), "**.k", lambda x: x)
