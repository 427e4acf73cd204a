"""Every query of the reference's own operators: equal to its SQL in another engine where it has one, else its contract."""

import math
from pathlib import Path

import duckdb
import numpy as np
import pytest
from lumenframe import plans

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, float, np.number)) or type(v).__name__ == "Decimal":
        return ("number", float(f"{float(v):.9g}"))
    return ("text", str(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    result = duck.execute(plans.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == expected


def test_simulation(spark):
    found = plans.QUERIES["dye_sim"](spark, SF)
    rows = found.collect()
    assert sorted(map(str, rows)) == sorted(map(str, found.collect()))
    by = {}
    for r in rows:
        by.setdefault(r.pep_i, []).append(r)
        dyt = np.array(r.dyt).reshape(2, -1)
        assert (np.diff(dyt, axis=1) <= 0).all() and (r.n > 0) == bool(dyt.any())
    for tracks in by.values():
        assert sum(t.n for t in tracks) in (0, 20) and 0 <= tracks[0].recall <= 1


def test_forest_beats_chance(spark):
    labels = {r.vec_id: r.label for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = plans.QUERIES["rf_classify"](spark, SF).collect()
    assert len(rows) == len(labels) and all(r.score >= r.runnerup_score for r in rows)
    assert np.mean([labels[r.row_i] == r.pred_i for r in rows]) > 0.4


def test_forest_calls_rows_that_it_has_not_seen(spark):
    true = {r.vec_id: 1 + (r.embedding[0] > 0) + 2 * (r.embedding[1] > 0) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = plans.QUERIES["rf_held_out"](spark, SF).collect()
    assert sorted(r.row_i for r in rows) == sorted(true) and np.mean([true[r.row_i] == r.pred_i for r in rows]) > 0.6


def test_redrawn_counts_have_their_sums(spark):
    first, again = (sorted(map(tuple, plans.QUERIES["redrawn_counts"](spark, SF).collect())) for _ in range(2))
    by = {}
    for _, pep, n in first:
        by[pep] = by.get(pep, 0) + n
    assert first == again and set(by.values()) == {50}


def test_photobleaching_only_loses_dyes(spark):
    rows = plans.QUERIES["photobleach_tracks"](spark, SF).collect()
    assert {r.pep_i for r in rows} == set(range(5)) and all(r.recall == 1 and r.dyt[0] == r.pep_i + 1 and list(r.dyt) == sorted(r.dyt, reverse=True) for r in rows)
    lost = sum(r.n * (r.dyt[0] - r.dyt[-1]) for r in rows) / sum(r.n * r.dyt[0] for r in rows)
    assert abs(lost - (1 - 0.9**10)) < 0.05


def test_random_windows_lie_in_their_proteins(spark):
    texts = {r.doc_id: "".join(c for c in (r.text or "") if c.isascii() and c.isalpha()).upper() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = plans.QUERIES["random_windows"](spark, SF).collect()
    assert len(rows) == 500 and all(r.window == texts[r.pro_i][r.start : r.start + 10] for r in rows)
    long = sorted(texts, key=lambda i: -len(texts[i]))[:20]
    share = sum(len(texts[i]) for i in long) / sum(map(len, texts.values()))
    assert abs(np.mean([r.pro_i in long for r in rows]) - share) < 0.1


def test_image_fields_find_what_was_drawn(spark):
    rows = plans.QUERIES["image_fields"](spark, SF).collect()
    first = [r for r in rows if r.cycle_i == 0 and r.signal is not None]
    bright = [r.signal for r in first if r.signal > 1500]
    assert len({r.field_i for r in rows}) == 5 and len(bright) > 100 and abs(np.median(bright) - 3000) < 500


def test_entry_runs(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 200 and any(r.coverage > 0 for r in rows)
