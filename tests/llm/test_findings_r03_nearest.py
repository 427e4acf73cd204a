"""F2 of round 3: op8 sent a copy of its queries for every shard through the driver, and searched and built many shards in one task."""

import numpy as np
from lumenframe.llm import ann
from pyspark.sql import functions as F


def test_queries_meet_shards_without_the_driver(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 40)
    monkeypatch.setattr(ann, "BLOCK", 6)
    plans, files = {}, {}
    write = ann.materialize

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        written = write(df, name)
        files[name] = written.select(F.input_file_name()).distinct().count()
        return written

    monkeypatch.setattr(ann, "materialize", watched)
    vectors = np.random.default_rng(5).standard_normal((600, 8))
    found = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    assert len(found) == 60
    assert "Broadcast" not in plans["answers"]
    assert files["graphs"] >= 8


def test_a_graph_holds_every_point():
    vectors = np.random.default_rng(6).standard_normal((3000, 16))
    unit = ann._unit(ann._scaled(vectors))
    graph = ann.Graph(unit)
    found = graph.search(unit, 40)
    assert found.shape == (3000, 40) and np.mean(found[:, 0] == np.arange(3000)) > 0.999
    best = np.argsort(-(unit[:300] @ unit.T), axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(found[:300].tolist(), best.tolist(), strict=True)]) > 0.95
    for links in graph.links:
        assert all(len(set(row[row >= 0].tolist())) == (row >= 0).sum() for row in links)
    for n in (1, 2, 3):
        few = ann.Graph(unit[:n]).search(unit[:n], 280)
        assert sorted(few[0].tolist()) == list(range(n))


def test_halves_only_what_keeps_its_value():
    assert ann._narrow(np.array([[0.5, 0.1]])).dtype == np.float64
    assert ann._narrow(np.array([[0.5, np.float32(0.1)]])).dtype == np.float32
