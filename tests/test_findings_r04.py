"""What the fourth round's findings named: peptides that are labelled alike, lengths of proteins, and nearest tracks that aren't sent about."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from lumenframe import plans
from lumenframe.operators import nearest, schemes, shared


def plain_survey(pros, panels, cycles):
    """(scheme, pro_i, pep_in_pro): (pep_len, flustr, n_dyes, flu_count, nn_dist), row by row; only the enzyme lysc."""
    rows, tracks = {}, defaultdict(lambda: defaultdict(list))
    for pro, panel, text in pros:
        peps = [p + "K" for p in text.split("K")[:-1]] + [p for p in text.split("K")[-1:] if p]
        for k, pep in enumerate(peps):
            for chosen in panels[panel]:
                head, tail = pep[:cycles], pep[cycles:]
                shown = "".join(next((str(i) for i, c in enumerate(chosen) if x in c), "." if x.isascii() and x.isupper() else x) for x in head).ljust(cycles)
                late = [min(99, sum(x in c for x in tail)) for c in chosen]
                flu = f"{shown} ;{','.join(map(str, late))}"
                scheme = f"lysc-{','.join(chosen)}"
                rows[scheme, pro, k] = (len(pep), flu, max(sum(x in c for x in pep) for c in chosen))
                tracks[scheme][flu].append([sum(x in c for x in head[t:]) + n for c, n in zip(chosen, late, strict=True) for t in range(cycles + 1)])
    out = {}
    for (scheme, pro, k), (n, flu, dyes) in rows.items():
        by = tracks[scheme]
        far = [sum(abs(a - b) for a, b in zip(by[flu][0], other[0], strict=True)) for f, other in by.items() if f != flu]
        out[scheme, pro, k] = (n, flu, dyes, len(by[flu]), min(far, default=None))
    return out


@pytest.mark.parametrize("few", [400_000, 10])
def test_peptides_of_a_kind_are_labelled_once(spark, monkeypatch, few):
    """every peptide was labelled for every scheme, twice, in as many tasks as the table has files."""
    monkeypatch.setattr(schemes, "KINDS", few)
    monkeypatch.setattr(schemes, "LABELLED", 20)
    monkeypatch.setattr(schemes, "DEALT", 500)
    monkeypatch.setattr(shared.join_salted, "__defaults__", ("left", min(few, shared.FEW)))
    rng = random.Random(4)
    # Unlike texts, labelled alike: G, H and I are in no label. Other characters than letters are shown as they are.
    pros = [(i, "x" if i % 3 else "y", "".join(rng.choices("GHIDKY", (6, 6, 6, 1, 1, 1), k=rng.randrange(1, 14)))) for i in range(400)]
    pros += [(900, "x", "GéDKgD"), (901, "x", "D" * 260), (902, "y", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (903, "x", "GHIHG1D-D"), (904, "x", "")]
    chosen = {"x": [("DE", "Y"), ("DE", "K"), ("Y", "K")], "y": [("Y",)]}
    enzymes, labels = schemes.rules(spark, {"x": (["lysc"], ["DE", "Y", "K"], 2), "y": (["lysc"], ["Y"], 1)})
    seen = []
    labelled = schemes.labelled
    monkeypatch.setattr(schemes, "labelled", lambda peps, *a: seen.append((peps.count(), peps.rdd.getNumPartitions())) or labelled(peps, *a))
    found = schemes.surveyed(spark.createDataFrame([*pros, (905, "x", None)], "pro_i long, panel string, seq string").coalesce(1), enzymes, labels, 4)
    rows = found.collect()
    assert {(r.scheme, r.pro_i, r.pep_in_pro): (r.pep_len, r.flustr, r.n_dyes, r.flu_count, r.nn_dist) for r in rows} == plain_survey(pros, chosen, 4)
    peptides = len({(r.pro_i, r.pep_in_pro) for r in rows})
    assert len(rows) == len(plain_survey(pros, chosen, 4)) and Counter(r.pro_i for r in rows)[901] == 3
    assert sum(n for n, _ in seen) < peptides / 2 and seen[0][1] > 3


def test_lengths_of_schemes_are_taken_from_proteins(spark, monkeypatch):
    """lengths were grouped by scheme and protein from all rows of the survey."""
    enzymes, labels = schemes.rules(spark, {"x": (["lysc", "aspn"], ["DE", "Y"], 1), "y": (["lysc"], ["Y"], 1), "z": (["cnbr"], ["Y"], 1)})
    rows = [(1, "x", "AKDE"), (1, "y", "AKDEYYKGG"), (2, "y", "KK"), (3, "x", ""), (4, "x", None), (5, "y", "DDYK"), (5, "y", "Y"), (None, "x", "KAKA"), (6, "z", "")]
    pros = spark.createDataFrame(rows, "pro_i long, panel string, seq string")
    survey = schemes.surveyed(pros, enzymes, labels, 3)
    found = {r.scheme: r.residues for r in schemes.lengths(pros, enzymes, labels).collect()}
    assert found == {"lysc-DE": 8, "aspn-DE": 8, "aspn-Y": 8, "lysc-Y": 19}
    known = schemes.lengths(pros, enzymes, labels)
    assert sorted(schemes.ranked_schemes(survey, 5, 2, known).collect()) == sorted(schemes.ranked_schemes(survey, 5, 2).collect())
    given = []
    ranked = schemes.ranked_schemes
    monkeypatch.setattr(schemes, "ranked_schemes", lambda *a: given.extend(a) or ranked(*a))
    out = plans.QUERIES["schemes_ranked"](spark, "/root/testdata/sf0.001")
    assert len(given) == 4 and given[3].columns == ["scheme", "residues"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("pro_len") < 4 and out.count() == 24


def plain_nearest(vecs, k):
    out = {}
    for i, v in enumerate(vecs):
        d = np.abs(vecs - v).sum(axis=1)
        d[i] = np.inf
        order = np.lexsort((np.arange(len(vecs)), d))[:k]
        out[i] = [(float(d[j]), int(j)) for j in order if np.isfinite(d[j])]
    return out


RNG = np.random.default_rng(8)
TRACKS = {
    "bytes": RNG.integers(-4, 5, (500, 40)).astype(float),
    "common": np.where(RNG.random((500, 1)) < 0.6, 1.0, RNG.integers(0, 3, (500, 3))),
    "words": RNG.integers(-30_000, 30_000, (300, 4)).astype(float),
    "parts": np.concatenate([RNG.normal(50 * i, 1, (100, 6)) for i in range(4)]),
    "apart": np.concatenate([RNG.integers(0, 3, (60, 20)) + 90.0 * i for i in range(8)]),
    "broken": np.where(RNG.random((200, 4)) < 0.02, np.nan, RNG.integers(0, 9, (200, 4))),
}


@pytest.mark.parametrize("name", TRACKS)
@pytest.mark.parametrize("sent", [3000, 64_000_000])
def test_nearest_of_any_tracks(spark, monkeypatch, name, sent):
    """whole numbers in packed blocks, in several rounds, with bounds by marks; others by whole distances."""
    for setting, value in (("ROUND", sent), ("FIRST", 64), ("SEGMENT", 128), ("TASK", 3), ("WORDS", 1 if sent == 3000 else 3)):
        monkeypatch.setattr(nearest, setting, value)
    vecs = TRACKS[name]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "dyt_i long, vec array<double>").repartition(3)
    found = defaultdict(list)
    for r in nearest.nearest_tracks(rows, 5, block=40).collect():
        found[r.dyt_i].append((r.d, r.other_i))
    for i, expected in plain_nearest(vecs, 5).items():
        got = sorted(found[i])
        assert [j for _, j in got] == [j for _, j in expected] and [d for d, _ in got] == pytest.approx([d for d, _ in expected])


def shuffled(spark):
    context = spark.sparkContext
    stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_tracks_are_not_sent_to_every_block(spark):
    """of vectors whose bounds exclude nothing, a copy was sent for every block."""
    vecs = RNG.integers(-4, 5, (4000, 48)).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "dyt_i long, vec array<double>")
    before = shuffled(spark)
    assert nearest.nearest_tracks(rows, 3, block=100).count() == 12_000
    # Once to its block, and packed once to the task that searches for the block.
    assert shuffled(spark) - before < 4 * vecs.size
