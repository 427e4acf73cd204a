"""What the third round's findings named: ties, work that is dealt by size, and bounds that don't grow with the input."""

from collections import defaultdict

from lumenframe import plans
from lumenframe.operators import generators, relational, shared, spatial, survey


def test_schemes_that_tie_in_nine_digits_go_by_name(spark):
    rows = [("b", 1, 0.1 + 0.2), ("a", 1, 0.3), ("c", 1, 0.5)]
    found = survey.best_schemes(spark.createDataFrame(rows, "scheme string, pro_i long, nn_dist double")).collect()
    assert {r.scheme: r.place for r in found} == {"c": 1, "a": 2, "b": 3}


def test_proteins_of_one_pattern_are_dealt_by_what_they_write(spark, monkeypatch):
    monkeypatch.setattr(relational, "WRITTEN", 1000)
    rows = [(i, f"flu{i % 3}") for i in range(120)] + [(5, "flu0"), (7, "own"), (300, None), (301, "alone")]
    flus = spark.createDataFrame(rows, "pro_i long, flustr string")
    calls = spark.createDataFrame([(i,) for i in (*range(60), 300, 301, 999)], "pro_i long")
    by = defaultdict(set)
    for p, f in rows:
        by[f].add(p)
    for listed in (2_000_000, 1):
        monkeypatch.setattr(relational, "LISTED", listed)
        out = relational.unlike_proteins(calls, flus)
        got = {r.pro_i: r.others for r in out.collect()}
        assert got == {p: ",".join(map(str, sorted({o for q, f in rows if q == p and f for o in by[f]} - {p}))) for p in (*range(60), 300, 301, 999)}
        assert out.rdd.getNumPartitions() > 4


def test_ranks_are_dealt_by_counted_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 50, i, (i * 7 % 11) / 10) for i in range(1000)], "pro_i long, pep_i long, nn_dist double").selectExpr("*", "1 as pep_len", "0 as n_dyes")
    monkeypatch.setattr(shared, "HELD", 100)
    ranked = survey.ranked(rows, 3)
    assert ranked.rdd.getNumPartitions() == 10
    assert {(r["rank"], r.n_proteins) for r in survey.neighbour_metrics(ranked).collect()} == {(1, 50), (2, 50), (3, 50)}


def test_sequences_do_not_travel_with_places_of_windows(spark, monkeypatch):
    seen = []
    placed = generators.running
    monkeypatch.setattr(generators, "running", lambda rows, *a: seen.extend(rows.columns) or placed(rows, *a))
    texts = {1: "ABCDEFGH" * 5, 2: "", 3: "XYZ"}
    rows = generators.random_windows(spark.createDataFrame(list(texts.items()), "pro_i long, seq string"), 60, 4, "seed").collect()
    assert sorted(r.draw_i for r in rows) == list(range(60)) and all(r.window == texts[r.pro_i][r.start : r.start + 4] for r in rows)
    assert seen == ["pro_i", "n"]


def test_texts_are_worked_out_once(spark, tmp_path):
    rows = [(1, "A (b) say: The key, STEN and SE"), (2, None), (3, ""), (4, "Kts en TN K")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name, pattern in (("tokens_with_modifications", "[^A-Za-z]"), ("sites_in_peptides", "([ST])")):
        found = plans.QUERIES[name](spark, str(tmp_path))
        assert found._jdf.queryExecution().optimizedPlan().toString().count(pattern) <= (1 if name.startswith("tokens") else 2)
        assert found.count() == {"tokens_with_modifications": 4, "sites_in_peptides": 4}[name]


def test_only_links_across_tiles_are_connected_row_by_row(spark, monkeypatch):
    sent = []
    connected = spatial.connected
    monkeypatch.setattr(spatial, "connected", lambda links: sent.append(links.distinct().count()) or connected(links))
    # A chain that runs through three tiles of one field, 20 points a place; and peaks without a place.
    peaks = [(0, i % 3, 20 * i + k, 1.0, 1.0 + i) for i in range(600) for k in range(20)] + [(1, 0, 20000, 5.0, None), (None, 0, 20001, 5.0, 5.0)]
    rows = spatial.reconciled(spark.createDataFrame(peaks, "field_i long, channel_i long, point_i long, y double, x double"), 5.0).collect()
    assert {(r.field_i, r.peak_i, r.n_channels, r.ambiguous) for r in rows} == {(0, 0, 3, True), (1, 20000, 1, False), (None, 20001, 1, False)}
    assert sent and sent[0] < 10


def test_only_tracks_near_a_block_go_to_it(spark, monkeypatch):
    """one track far off doesn't send its whole block to all others."""
    rows = [(i, [float(i), 0.0]) for i in range(400)] + [(1000, [5000.0, 0.0])]
    compared = []
    own = type(spark.range(0)).groupBy
    monkeypatch.setattr(type(spark.range(0)), "groupBy", lambda self, *c: own(compared.append(self.count()) or self if "mine" in self.columns else self, *c))
    found = {r.dyt_i: (r.other_i, r.d) for r in survey.nearest_tracks(spark.createDataFrame(rows, "dyt_i long, vec array<double>"), 1, block=50).collect()}
    assert found == {**{i: (max(0, i - 1) if i else 1, 1.0) for i in range(400)}, 1000: (399, 4601.0)}
    assert sum(compared) < 3 * len(rows)
