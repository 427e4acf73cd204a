"""Operators whose groups may be of any size: against plain versions, with bounds set low so that every way is taken."""

import random
from collections import Counter

import numpy as np
import pytest
from lumenframe.operators import intervals, quantiles, relational, schemes, shared, spatial, survey, unmix
from lumenframe.operators.fit import non_negative
from pyspark.sql import functions as F


@pytest.mark.parametrize(("distance", "by"), [("l1", None), ("l2", None), ("l1", "scheme")])
def test_nearest_tracks_by_cells(spark, distance, by):
    rng = np.random.default_rng(3)
    n = 180
    vecs = np.concatenate([rng.integers(0, 4, (n // 2, 5)), 50 + rng.integers(0, 3, (n // 2, 5))]).astype(float)
    groups = [("a", "b", None)[i % 3] for i in range(n)]
    rows = spark.createDataFrame([(i, v.tolist(), g) for i, (v, g) in enumerate(zip(vecs, groups, strict=True))] + [(900, [], "a"), (901, None, "a")], "dyt_i long, vec array<double>, scheme string")
    found = {}
    for r in survey.nearest_tracks(rows, 4, distance, block=30, by=by).collect():
        found.setdefault(r.dyt_i, []).append((r.d, r.other_i))
        assert by is None or r.scheme == groups[r.dyt_i]
    assert set(found) == set(range(n))
    for i in range(n):
        others = [j for j in range(n) if j != i and (by is None or groups[j] == groups[i])]
        d = np.abs(vecs[others] - vecs[i]).sum(axis=1) if distance == "l1" else np.sqrt(((vecs[others] - vecs[i]) ** 2).sum(axis=1))
        near, best = sorted(found[i]), sorted(zip(d.tolist(), others, strict=True))[:4]
        assert [x for _, x in near] == [x for _, x in best] and [x for x, _ in near] == pytest.approx([x for x, _ in best])


def test_few_tracks(spark):
    kind = "dyt_i long, vec array<double>"
    assert survey.nearest_tracks(spark.createDataFrame([], kind), 3).collect() == []
    assert survey.nearest_tracks(spark.createDataFrame([(1, [1.0])], kind), 3).collect() == []
    same = survey.nearest_tracks(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], kind), 2, block=8).collect()
    assert Counter(r.dyt_i for r in same) == dict.fromkeys(range(50), 2) and {r.d for r in same} == {0.0}


@pytest.mark.parametrize(("small", "bins"), [(300, 256), (100_000, 4096)])
def test_quantiles_are_exact(spark, small, bins):
    rng = np.random.default_rng(1)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    by = {"hot": rng.exponential(5, 5_000), "ties": rng.integers(0, 3, 900).astype(float), "one": np.ones(300), "few": rng.normal(size=7), "wide": np.concatenate([rng.normal(size=200) * 10.0**k for k in range(-9, 9, 6)]), None: np.array([2.0, 3.0]), "ends": np.array([-1.7e308, 1.7e308] * 30)}
    rows = [(g, float(v)) for g, vs in by.items() for v in vs] + [("few", float("nan")), ("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", shares, small, bins).collect()}
    assert set(found) == set(by)
    for g, vs in by.items():
        assert found[g].n == len(vs)
        if g != "ends":
            assert [found[g][f"q{j}"] for j in range(7)] == pytest.approx(np.quantile(vs, shares).tolist(), rel=1e-12)
    assert found["ends"].q0 == -1.7e308 and found["ends"].q6 == 1.7e308
    whole = quantiles.exact_quantiles(df.filter("g <> 'ends'"), [], "v", [0.5], small, bins).collect()
    assert whole[0].q0 == pytest.approx(np.median(np.concatenate([v for g, v in by.items() if g not in ("ends", None)])))


def test_ranks_of_one_group_with_all_rows(spark):
    df = spark.range(400_000).selectExpr("id % 1 as g", "cast((id * 7919) % 400000 as double) as v")
    ranks = spark.createDataFrame([(0, k) for k in (0, 1, 123_456, 399_999)], "g long, k long")
    assert sorted((r.k, r.v) for r in quantiles.selected(df, ["g"], "v", ranks, small=1000, bins=64).collect()) == [(k, float(k)) for k in (0, 1, 123_456, 399_999)]


@pytest.mark.parametrize("hot", [5, 50_000])
def test_positions_in_spans(spark, hot):
    rng = random.Random(2)
    spans = [(k % 3, i, s, s + rng.randint(0, 700), "x") for i, (k, s) in enumerate((rng.randrange(3), rng.randrange(2000)) for _ in range(150))]
    at = [(rng.randrange(4), rng.randrange(2600), j) for j in range(400)] + [(1, 300, 1000 + j) for j in range(40)] + [(None, 5, 0), (1, None, 0)]
    found = intervals.positions_in_spans(spark.createDataFrame(spans, "pro long, i long, start long, stop long, more string"), spark.createDataFrame(at, "pro long, at long, j long"), "pro", width=64, hot=hot)
    expected = Counter((i, j) for p, i, a, b, _ in spans for q, x, j in at if p == q and x is not None and a <= x < b)
    assert Counter((r.i, r.j) for r in found.collect()) == expected


def test_one_protein_with_a_million_positions(spark):
    sites = spark.range(1_000_000).selectExpr("cast(7 as long) as pro", "id as at")
    spans = spark.range(20_000).selectExpr("cast(7 as long) as pro", "id as i", "id * 50 as start", "id * 50 + 50 as stop")
    sums = intervals.positions_in_spans(spans, sites, "pro").groupBy("i").count().agg({"count": "min", "i": "count"}).first()
    assert sums["min(count)"] == 50 and sums["count(i)"] == 20_000


def test_unmixing_equals_dense_least_squares(spark):
    rng = np.random.default_rng(4)
    a = rng.dirichlet(np.full(30, 0.2), 6).T
    true = np.array([0.5, 0.0, 0.2, 0.3, 0.0, 0.0])
    b = a @ true + 0.003 * rng.random(30)
    cells = spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i in range(30) for j in range(6)] + [(99, 7, 1.0)], "dyt_i long, pep_i long, p double")
    counts = spark.createDataFrame([(i, float(1000 * b[i])) for i in range(30)], "dyt_i long, n double")
    dense, _ = non_negative(a, b / b.sum())
    found = {r.pep_i: r.share for r in unmix.unmixed(cells, counts, rounds=40, enough=1e-6).collect()}
    assert found[7] == 0.0 and [found[j] for j in range(6)] == pytest.approx((dense / dense.sum()).tolist(), abs=0.02)


def plain_components(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def test_connected_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(400, 401 + i) for i in range(200)] + [(700, 700)] + [(rng.randrange(800, 1000), rng.randrange(800, 1000)) for _ in range(90)]
    rng.shuffle(links)
    links = [x if rng.random() < 0.5 else x[::-1] for x in links]
    found = {r.node: r.component for r in spatial.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = plain_components(1000, links)
    assert found == {x: expected[x] for a, b in links if a != b for x in (a, b)}


def test_reconciled_peaks(spark):
    rng = random.Random(6)
    peaks = [(f, i % 3, 1000 * f + i, rng.random() * 90, rng.random() * 90) for f in range(2) for i in range(150)] + [(5, c, 6000 + c, 10.0 + c, 10.0) for c in range(3)] + [(6, 0, 7000 + i, 1.0 + i * 1e-4, 1.0) for i in range(300)]
    rows = spatial.reconciled(spark.createDataFrame(peaks, "field_i long, channel_i long, point_i long, y double, x double").repartition(3), 4.0).collect()
    links = [(i, j) for i, a in enumerate(peaks) for j, b in enumerate(peaks[:i]) if a[0] == b[0] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 16]
    groups = {}
    for p, r in zip(peaks, plain_components(len(peaks), links), strict=True):
        groups.setdefault(r, []).append(p)
    expected = {min(p[2] for p in g): (len({p[1] for p in g}), max(Counter(p[1] for p in g).values()) > 1, sum(p[3] for p in g) / len(g)) for g in groups.values()}
    assert {r.peak_i: (r.n_channels, r.ambiguous) for r in rows} == {k: v[:2] for k, v in expected.items()}
    assert all(r.y == pytest.approx(expected[r.peak_i][2]) for r in rows)


def test_schemes_of_two_panels(spark):
    """Panels of proteins may have different rules; a scheme's isolation looks at its own patterns only."""
    enzymes, labels = schemes.rules(spark, {"x": (["lysc"], ["DE", "C"], 1), "y": (["lysc", "aspn"], ["Y"], 1)})
    pros = spark.createDataFrame([(0, "x", "AKDCK"), (1, "y", "YKDY"), (2, "x", "")], "pro_i long, panel string, seq string")
    rows = schemes.surveyed(pros, enzymes, labels, 3).collect()
    assert Counter((r.scheme, r.pro_i) for r in rows) == {("lysc-DE", 0): 2, ("lysc-C", 0): 2, ("lysc-Y", 1): 2, ("aspn-Y", 1): 2}
    by = {(r.scheme, r.pep_in_pro): (r.flustr, r.nn_dist) for r in rows}
    assert by["lysc-DE", 0] == (".. ;0".replace(" ;", "  ;"), 1.0) and by["lysc-DE", 1] == ("0.. ;0", 1.0)
    assert by["lysc-Y", 1][0] == ".0  ;0" and by["aspn-Y", 0][0] == "0.  ;0"
    ranks = {r.scheme: r for r in schemes.ranked_schemes(spark.createDataFrame(rows), 2).collect()}
    assert ranks["lysc-DE"].n_found == 1 and ranks["lysc-DE"].min_dist == 0.0 and ranks["lysc-DE"].avg_dist == 0.5


def test_salted_join(spark, monkeypatch):
    left = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 1), (3, 1)], "k long, v long")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (4, "c")], "k long, w string")
    for most in (0, 100):
        assert Counter(r.w for r in shared.join_salted(left, right, ["k"], most=most).collect()) == {"a": 100, "b": 1, None: 1}


@pytest.mark.parametrize("flat", [4, 256])
def test_numbers_over_many_buckets(spark, monkeypatch, flat):
    monkeypatch.setattr(relational, "FLAT", flat)
    keys = random.Random(7).sample(range(10**6), 900) + [None]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    bucket = relational.even_buckets(rows, F.col("k"), 20)
    placed = sorted((r.k is not None, r.k or 0, r.b) for r in rows.select("k", bucket.alias("b")).collect())
    assert [b for *_, b in placed] == sorted(b for *_, b in placed) and len({b for *_, b in placed}) > 35
    order = sorted(keys, key=lambda k: (k is not None, k or 0))
    assert {r.k: r.i for r in relational.numbered(rows, "k", "i", 20).collect()} == {k: i for i, k in enumerate(order)}
