"""Worked examples of functions, sources and kernels."""

import gzip

import numpy as np
import pytest
from lumenframe.functions import arrays, seq
from lumenframe.operators import accessors, evaluate, fit, generators, images, pixels, radiometry, relational, sampling, simulate, steps, survey
from lumenframe.plans import workflow
from lumenframe.sources import frames, results, tables
from lumenframe.streaming import calls as streamed
from pyspark.sql import functions as F


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items())).select(column.alias("x")).first().x


def test_tokens(spark):
    tok = lambda s: one(spark, seq.tokenize(F.col("s")), s=s)
    assert tok("ab (note (inner)) C[ph]d.") == ["A", "B", "C[ph]", "D", "."]
    assert tok("") == [] and tok("A(((((((deep)))))))B(x)(y)C") == ["A", "B", "C"]
    for wrong in ("A(b", "A)b(", "A(b))"):
        with pytest.raises(Exception, match="not a residue sequence"):
            tok(wrong)
    with pytest.raises(Exception, match="not a residue sequence"):
        tok("A-B")
    with pytest.raises(Exception, match="not a residue sequence"):
        tok("A[b")


@pytest.mark.parametrize(
    ("enzyme", "text", "pieces"),
    [("lysc", "AKBKC", ["AK", "BK", "C"]), ("lysn", "AKBKC", ["A", "KB", "KC"]), ("trypsin", "AKPRAWKPA", ["AKPR", "AWK", "PA"]), ("trypsin", "CKDRRHA", ["CKDR", "RHA"]), ("gluc_ph4", "AEBEPEEC", ["AE", "BEPEE", "C"]), ("endopro", "BABPB", ["BA", "BP", "B"]), ("lysarg", "AKRB", ["A", "K", "RB"])],
)
def test_cleavage(spark, enzyme, text, pieces):
    spans = seq.fragments(F.col("t"), enzyme)
    got = one(spark, F.transform(spans, lambda x: seq.join_tokens(seq.piece(F.col("t"), x))), t=list(text))
    assert got == pieces


def test_letter_texts_cut_and_count_as_tokens_do(spark):
    import random

    rng = random.Random(2)
    texts = ["", "K", "KP", "RRHKD"] + ["".join(rng.choice("KRPWMCDHYEAK") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("t", seq.letters(F.col("s")))
    for enzymes in [(name,) for name in seq.ENZYMES] + [("trypsin", "aspn"), ()]:
        old = F.transform(seq.fragments(F.col("t"), *enzymes), lambda x: seq.join_tokens(seq.piece(F.col("t"), x)))
        assert rows.filter(~old.eqNullSafe(seq.cut_text(F.col("s"), *enzymes))).count() == 0, enzymes
    same = seq.flu(F.col("t"), ["DE", "Y"], 8) == seq.flu_text(F.col("s"), ["DE", "Y"], 8)
    for name, count in seq.flu_counts(F.col("t"), ["DE", "Y"], 8).items():
        same &= count == seq.flu_text_counts(F.col("s"), ["DE", "Y"], 8)[name]
    assert rows.filter(~same).count() == 0
    assert one(spark, seq.stops(F.col("t")), t=["ab", "c", "def"]) == [2, 3, 6] and one(spark, seq.dyeseq(F.lit("ADYKA"), ["D", "Y"])) == ".01"
    assert one(spark, F.array_sort(seq.shuffled(F.col("t"), F.lit(3))), t=["B", "A", "C"]) == ["A", "B", "C"]
    assert one(spark, seq.as_symbol(F.lit("9 a-b"))) == "_9_a_b" and one(spark, seq.is_symbol(F.lit("9a"))) is False


def test_labels_and_sites(spark):
    assert one(spark, seq.flu(F.col("t"), ["DE", "Y"], 4), t=list("ADYEED")) == ".010 ;2,0"
    assert one(spark, seq.flu(F.col("t"), ["DE"], 4), t=list("D")) == "0    ;0"
    assert one(spark, seq.mirrored_sites(F.lit("2;5"), F.lit(9))) == "5;8"
    assert one(spark, seq.sites_in(F.lit("1;4;9"), F.lit(3), F.lit(9))) == [1, 6]
    assert one(spark, seq.is_proline_second(F.col("t")), t=["A", "P[x]"]) is True


def test_arrays(spark):
    assert one(spark, arrays.lifespan(F.col("t")), t=[9.0, 10.0, 8.0, 0.1, 0.0]) == 3
    assert one(spark, arrays.safe_divide(F.lit(1.0), F.lit(0.0))) == 0.0
    assert one(spark, arrays.run_of_true(F.col("t")), t=[True, True, False, True]) == 2
    assert one(spark, arrays.nearest_index(F.col("t"), F.lit(2.5)), t=[1.0, 2.0, 3.0]) == 2
    assert one(spark, arrays.next_power_of_two(F.lit(5))) == 8 and one(spark, arrays.is_power_of_two(F.lit(6))) is False
    assert one(spark, arrays.max_rise(F.col("t"), F.lit(2)), t=[5.0, 7.0, 1.0]) == 2.0


def test_generators(spark):
    tracks = [tuple(r.dyt) for r in generators.triangle_tracks(spark, 2, 3).collect()]
    assert len(tracks) == len(set(tracks)) and all(0 <= a - b <= 1 for t in tracks for a, b in zip(t, t[1:], strict=False)) and (2, 1, 0) in tracks
    assert {r.pep for r in generators.placements(spark, "D", 2, 3).collect()} == {"DD.", "D.D", ".DD"}
    assert one(spark, generators.pseudo_sequence(F.col("t")), t=[2, 2, 1]) == ".XX"
    assert generators.schemes(spark, ["lysc"], ["C", "K", "Y"], 2, [("aspn", "W")]).count() == 4


def test_samples_rerun(spark):
    rows = spark.range(500).withColumn("w", F.col("id") % 5)
    for draw in (lambda: sampling.exactly(rows, 20, "id", "a"), lambda: sampling.stratified(rows, "w", 3, "id", "b"), lambda: sampling.weighted(rows, "w", 20, "id", "c"), lambda: sampling.with_replacement(rows.withColumnRenamed("id", "row_i"), 30, 500, "d")):
        assert sorted(map(str, draw().collect())) == sorted(map(str, draw().collect()))
    assert sampling.weighted(rows, "w", 500, "id", "c").count() == 400


def test_dense_ids_and_completion(spark):
    rows = spark.createDataFrame([(5, 2), (1, 9), (5, 1)], "g long, i long")
    assert sorted((r.g, r.i, r.n) for r in relational.dense_ids(rows, "g", "i", "n").collect()) == [(1, 9, 0), (5, 1, 1), (5, 2, 2)]
    assert [r.v for r in relational.completed(spark.createDataFrame([(1, 7)], "k long, v long"), "k", 3, {"v": 0}).orderBy("k").collect()] == [0, 7, 0]


def test_peak_filter_returns_whole_peaks(spark):
    rows = [(p, c, k, 100.0 if k <= p else 0.0, p) for p in range(3) for c in range(2) for k in range(3)]
    df = spark.createDataFrame(rows, "peak_i long, channel_i int, cycle_i int, signal double, field_i long")
    got = radiometry.filter_peaks(df, 0, 50.0, on_through=1, off_at=2).collect()
    assert {r.peak_i for r in got} == {1} and len(got) == 6


def test_steps():
    trace = np.r_[np.full(10, 9000.0), np.full(10, 4000.0)] + np.tile([30.0, -30.0, 10.0, 0.0], 5)
    cut = steps.borders(trace)
    assert len(cut) == 3 and abs(cut[1] - 10) <= 2 and cut[0] == 0 and cut[-1] == 20
    assert steps.borders(np.zeros(3)) == [0, 3] and steps.borders(np.full(20, 5.0)) == [0, 20]


def test_steps_of_several_regions():
    rng = np.random.default_rng(1)
    trace = np.concatenate([np.full(12, 9000.0), np.full(9, 2000.0), np.full(15, 6000.0), np.full(8, 500.0)]) + rng.normal(0, 60, 44)
    cut = steps.borders(trace)
    assert len(cut) == 5 and all(abs(a - b) <= 1 for a, b in zip(cut, [0, 12, 21, 36, 44], strict=True))
    assert steps.borders(np.arange(5.0) * 5000) == [0, 5]


def test_region_tables(spark):
    traces = spark.createDataFrame([(1, 0, [9000.0, 9010.0, 8990.0, 9020.0, 1000.0, 1010.0, 990.0, 1005.0]), (2, 0, [5.0] * 8)], "peak_i long, channel_i int, trace array<double>")
    regions = steps.step_regions(traces)
    assert [(r.cycle_i, r.region_i) for r in steps.region_of_cycle(regions).filter("peak_i = 1").orderBy("cycle_i").collect()] == [(i, int(i >= 4)) for i in range(8)]
    assert {r.peak_i: len(r["values"]) for r in steps.region_matrix(regions).collect()} == {1: 2, 2: 1}
    r = steps.region_report(regions).first()
    assert (r.n_traces, r.n_regions, r.n_rises) == (2, 3, 0)


def test_numbers_over_many_buckets(spark):
    rows = spark.createDataFrame([(f"k{i * 37 % 1000:04d}",) for i in range(1000)] + [(None,)], "k string").repartition(5)
    found = {r.k: r.n for r in relational.numbered(rows, "k", "n", per_bucket=60).collect()}
    assert found == {None: 0} | {f"k{i:04d}": i + 1 for i in range(1000)}
    pairs = spark.createDataFrame([(None if g == 0 else g, i) for g in range(40) for i in range(g % 5 + 1)], "g long, i long")
    found = sorted((r.n, r.g or 0, r.i) for r in relational.dense_ids(pairs, "g", "i", "n", per_bucket=3).collect())
    assert [(g, i) for _, g, i in found] == [(g, i) for g in range(40) for i in range(g % 5 + 1)] and [n for n, *_ in found] == list(range(len(found)))
    arrays_ = spark.createDataFrame([([i // 10, i % 10],) for i in range(100)], "v array<int>")
    assert all(r.n == r.v[0] * 10 + r.v[1] for r in relational.numbered(arrays_, "v", "n", per_bucket=9).collect())


@pytest.mark.parametrize("distance", ["l1", "l2"])
def test_nearest_tracks_equal_brute_force(spark, distance):
    rng = np.random.default_rng(3)
    vecs = np.concatenate([rng.integers(0, 3, (150, 6)), np.zeros((5, 6)), rng.integers(20, 60, (45, 6))]).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "dyt_i long, vec array<double>")
    found = {}
    for r in survey.nearest_tracks(rows, 4, distance, block=20).collect():
        found.setdefault(r.dyt_i, []).append((r.d, r.other_i))
    for i, v in enumerate(vecs):
        d = np.abs(vecs - v).sum(axis=1) if distance == "l1" else np.sqrt(((vecs - v) ** 2).sum(axis=1))
        expected = sorted((float(d[j]), j) for j in range(len(vecs)) if j != i)[:4]
        assert [j for _, j in sorted(found[i])] == [j for _, j in expected] and np.allclose([x for x, _ in sorted(found[i])], [x for x, _ in expected])


def test_running_fdr_with_one_score(spark):
    rows = spark.createDataFrame([(i, 1, 1 + i % 3 % 2, 1.0, i % 4 == 0) for i in range(200)], "row_i long, true_i int, pred_i int, score double, is_decoy boolean")
    found = sorted((r.row_i, r.n_above, r.fdr) for r in evaluate.running_fdr(rows, per_bucket=11).collect())
    assert all(n == i + 1 and abs(f - (i // 4 + 1) / (i + 1)) < 1e-12 for i, n, f in found)


def test_simulation_without_failures():
    chem = simulate.Chemistry(cycles=(0, 2, 2, 2), p_bright=(1.0, 1.0), p_bleach=(0.0, 0.0), p_cyclic_block=0, p_initial_block=0, p_detach=0, p_edman_failure=0)
    out = simulate.simulate_peptide(np.array([0, -1, 1, 0]), 3, chem, np.random.default_rng(0))
    assert (out == np.array([[2, 1, 1, 1], [1, 1, 1, 0]])).all()


def test_image_kernels():
    frames_ = images.synthesize(3, 12, 96, 1, 2, seed=4)
    shifts, at, radmat = images.analyse_field(frames_)
    assert 10 <= len(at) <= 16 and np.nanmedian(radmat[0, 0][:, 0]) > 2000
    a = images.synthesize(1, 20, 64, 1, 1, seed=2)[0, 0]
    assert images.shift_between(a, np.roll(a, (3, -2), (0, 1))) == (3, -2)
    assert np.allclose(images.sub_pixel_shift(a, images.moved(a, -1.25, 2.5)), (1.25, -2.5), atol=0.2)
    assert np.allclose(images.moved(np.roll(a, 2, 0), 2, 0), a)
    spot = 500 * images.gaussian(15, 2.0, 0.4, -0.3) + 10
    p = images.fit_gaussian(spot)
    assert np.allclose(p[1:5], [7.4, 6.7, 2.0, 2.0], atol=0.05)
    assert images.crop_power_of_two(np.zeros((100, 90))).shape == (128, 128) and images.crop_power_of_two(np.zeros((80, 80))).shape == (64, 64)


def test_fits(spark):
    a = np.array([[1.0, 0.2], [0.0, 0.8], [0.5, 0.5]])
    x, rest = fit.non_negative(a, a @ [0.3, 0.7])
    assert np.allclose(x, [0.3, 0.7]) and rest < 1e-9
    assert np.allclose(fit.non_negative(a, np.array([-1.0, 1.0, 0.0]))[0][0], 0)
    goal = lambda p: float((p[0] - 0.3) ** 2 + 2 * (p[1] - 0.6) ** 2 + (p[0] - 0.3) * (p[1] - 0.6))
    low, high = np.zeros(2), np.ones(2)
    start, _ = fit.grid_search(spark, goal, low, high, n_start=16, generations=2)
    best, value = fit.local_search(goal, start, low, high)
    assert np.allclose(best, [0.3, 0.6], atol=1e-3) and value < 1e-6


def test_fasta_and_tables(spark, tmp_path):
    text = ">sp|P1 first\nMKV\nLA\n\n>P2\nGG>H\n"
    (tmp_path / "a.fasta").write_text(text)
    with gzip.open(tmp_path / "b.fasta.gz", "wt") as f:
        f.write(text)
    for name in ("a.fasta", "b.fasta.gz"):
        assert sorted(map(tuple, tables.read_fasta(spark, str(tmp_path / name)).collect())) == [("P2", "GG>H"), ("sp|P1 first", "MKVLA")]
    (tmp_path / "bad.fasta").write_text("MK\n>x\nA\n")
    with pytest.raises(Exception, match="before the first header"):
        tables.read_fasta(spark, str(tmp_path / "bad.fasta")).collect()
    (tmp_path / "p.csv").write_text("Name,Sequence,Extra,POI\nA,MK,1,0\n,GG,2,1\nC,LL,3,0\n")
    got = tables.read_proteins(spark, str(tmp_path / "p.csv"), ["C"]).orderBy("order").collect()
    assert [(r.name, r.is_poi, r.abundance) for r in got] == [("C", True, 1.0), ("A", False, 1.0), ("Protein_0001", False, 1.0)]
    (tmp_path / "m.txt").write_bytes("a.b\t1\r\na.c\t x y\r\n".encode("utf-16"))
    assert [(r["keys"], r.value) for r in tables.read_scope_metadata(spark, str(tmp_path / "m.txt")).collect()] == [(["a", "b"], "1"), (["a", "c"], "x y")]
    assert spark.range(1).select(tables.fit_value(F.lit("p_bleach = 0.25, n: 3"), "p_bleach")).first()[0] == 0.25


def test_image_files(spark, tmp_path):
    for f in (9, 100):
        for c in range(2):
            np.save(tmp_path / f"f{f}_ch{c}_cy0.npy", np.full((4, 5), f + c))
    got = frames.scan(spark, str(tmp_path), r"f(\d+)_ch(\d+)_cy(\d+)\.npy").collect()
    assert sorted((r.field_i, r.channel_i, r.cycle_i) for r in got) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0)]
    assert all(("f100" in r.path) == (r.field_i == 1) for r in got)
    pixels = frames.read_arrays(spark, str(tmp_path)).collect()
    assert len(pixels) == 4 and all(r.height == 4 and len(r.pixels) == 20 for r in pixels)
    (tmp_path / "odd.npy").write_bytes(b"x")
    with pytest.raises(Exception, match="unexpected file name"):
        frames.scan(spark, str(tmp_path), r"f(\d+)_ch(\d+)_cy(\d+)\.npy").collect()


def test_results(spark, tmp_path):
    path = f"file://{tmp_path}/run"
    results.Results.write(spark, path, {"peaks": spark.range(6).withColumn("field_i", F.col("id") % 2)}, {"peaks": "field_i"}, n=3)
    back = results.Results(spark, path)
    assert back.manifest["params"] == {"n": 3} and frames.chosen(slice(1, 2), back.peaks).count() == 3
    with pytest.raises(AttributeError):
        back.other


def test_workflow(spark):
    job = workflow.parse_job({"enzymes": ["lysc"], "labels": ["D", "E"], "n_cycles": 4, "n_samples": 30})
    with pytest.raises(ValueError, match="no"):
        workflow.parse_job({"cycles": 3})
    with pytest.raises(ValueError, match="not int"):
        workflow.parse_job({"n_cycles": "3"})
    priors = workflow.Priors({"gain": 2, "gain.ch1": 3}, {"bleach": 0.1})
    assert (priors.get("gain.ch1"), priors.get("gain.ch0.x"), priors.get("bleach.ch0")) == (3, 2, 0.1)
    with pytest.raises(KeyError):
        priors.get("other")
    pros = spark.createDataFrame([(1, list("ADAAEK")), (2, list("EADEK"))], "pro_i long, tokens array<string>")
    peps = workflow.digested(pros, job)
    workflow.assert_schema(peps.select("pep_i"), peps.select("pep_i").schema)
    with pytest.raises(TypeError):
        workflow.assert_schema(peps, peps.select("pep_i").schema)
    assert all(0 <= r.score <= 1 for r in workflow.surveyed(peps, job).collect())
    called, table = workflow.trained_and_tested(peps, job, 5, 4)
    assert called.count() == 60 and all(r.recall > 0.5 for r in table.collect())


def test_streaming(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    query = streamed.windowed_counts(streamed.without_repeats(stream), late=None).writeStream.format("memory").queryName("counts").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.w, r.event_type): r.n for r in spark.sql("select window.start as w, event_type, n from counts").collect()}
    want = {(r.w, r.event_type): r.n for r in events.groupBy(F.window("ts", "10 minutes").start.alias("w"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert len(got) > 0 and all(want[k] == n for k, n in got.items())


def test_channels_are_reconciled():
    one, two = np.array([[10.0, 10.0], [30.0, 30.0], [50.0, 50.0], [52.0, 50.0]]), np.array([[11.0, 10.0], [51.0, 51.0], [70.0, 20.0]])
    centres, by = images.reconciled([one, two], (96, 96))
    assert sorted(map(tuple, centres)) == [(10.5, 10.0), (30.0, 30.0), (70.0, 20.0)]
    assert np.isnan(by).any(axis=2).sum() == 2


def test_illumination_and_calibration():
    rng = np.random.default_rng(0)
    at = rng.uniform(0, 100, (200, 2))
    light = 5 * np.exp(-1.5 * (((at - [40, 60]) / 100) ** 2).sum(axis=1))
    assert np.allclose(images.illumination(at, light, (100, 100)), [5, 40, 60, 1.5])
    found = images.calibrated(images.synthesize(2, 15, 96, 2, 1, seed=3))
    assert np.allclose(found["shifts"], 0, atol=0.6) and abs(found["psf"].sum() - 1) < 1e-6


def test_density_sweep(spark):
    rows = images.density_sweep(spark.createDataFrame([(0, 0), (1, 10)], "field_i long, n_peaks long")).orderBy("field_i").collect()
    assert rows[0].n_drawn == 0 and 8 <= rows[1].n_found <= 14


def container(frames_: np.ndarray) -> bytes:
    """A microscope file of frames (frame, y, x, component)."""
    import struct

    from lumenframe.sources import nd2

    def value(name, number):
        raw = (name + "\0").encode("utf-16-le")
        return bytes([3, len(raw) // 2]) + raw + struct.pack("<I", number)

    inner = value("uiWidth", frames_.shape[2]) + value("uiHeight", frames_.shape[1]) + value("uiComp", frames_.shape[3])
    raw = ("SLxImageAttributes\0").encode("utf-16-le")
    head = bytes([11, len(raw) // 2]) + raw
    tree = head + struct.pack("<IQ", 3, len(head) + 12 + len(inner)) + inner + b"\0" * 24
    out, places = b"", []
    for name, data in [("ImageAttributesLV!", tree), *((f"ImageDataSeq|{i}!", b"\0" * 8 + f.astype("<u2").tobytes()) for i, f in enumerate(frames_))]:
        places.append((name, len(out), len(data)))
        out += struct.pack("<IIQ", nd2.MARK, len(name), len(data)) + name.encode() + data
    body = b"".join(n.encode() + struct.pack("<QQ", at, size) for n, at, size in places) + nd2.SIGNATURE + b"\0" * 16
    return out + struct.pack("<IIQ", nd2.MARK, 0, len(body)) + body + nd2.SIGNATURE + struct.pack("<Q", len(out))


def test_microscope_files(spark, tmp_path):
    from lumenframe.sources import nd2

    stack = np.arange(2 * 3 * 4 * 2).reshape(2, 3, 4, 2)
    (tmp_path / "a.nd2").write_bytes(container(stack))
    rows = nd2.read_nd2(spark, str(tmp_path)).collect()
    assert len(rows) == 4
    for r in rows:
        assert r.height == 3 and r.pixels == stack[r.frame_i, :, :, r.channel_i].ravel().tolist()
    with pytest.raises(ValueError, match="no chunk map"):
        nd2.chunk_map(b"x" * 50)


def test_more_arrays(spark):
    nan = float("nan")
    assert one(spark, arrays.nan_mean(F.col("t")), t=[1.0, nan, 3.0]) == 2.0 and one(spark, arrays.nan_median(F.col("t")), t=[5.0, nan, 1.0, 2.0, 10.0]) == 3.5
    assert np.isnan(one(spark, arrays.nan_mean(F.col("t")), t=[nan]))
    assert one(spark, arrays.int_linspace(F.lit(2), F.lit(12), 3)) == [2, 7, 12] and one(spark, arrays.repeated(F.col("t"), 2), t=[1, 2]) == [1, 1, 2, 2]
    rows = F.array(F.array(F.lit(1), F.lit(2), F.lit(3)), F.array(F.lit(4), F.lit(5), F.lit(6)))
    assert one(spark, arrays.times_rows(rows, F.array(F.lit(2), F.lit(1)))) == [[2, 4, 6], [4, 5, 6]] and one(spark, arrays.times_columns(rows, F.array(F.lit(1), F.lit(0), F.lit(2)))) == [[1, 0, 6], [4, 0, 12]]
    assert one(spark, arrays.padded_rows(F.array(F.array(F.lit(1)), F.array(F.lit(2), F.lit(3))), F.lit(0))) == [[1, 0], [2, 3]]
    assert one(spark, arrays.same(F.array(F.lit(nan), F.lit(None)), F.array(F.lit(nan), F.lit(None)))) is True
    assert one(spark, arrays.entry_where(F.col("t"), lambda x: x > 1, last=True), t=[1, 2, 3]) == 3 and one(spark, arrays.index_where(F.col("t"), lambda x: x > 9), t=[1]) is None
    assert one(spark, arrays.scaled_to_one(F.col("t")), t=[1.0, 4.0]) == [0.25, 1.0] and one(spark, arrays.sorted_rows(F.array(F.array(F.lit(2), F.lit(1))))) == [[1, 2]]
    with pytest.raises(Exception, match="outside"):
        one(spark, arrays.region_of(F.lit(9), F.lit(9), 3))
    found = one(spark, arrays.fourier(F.col("t")), t=[1.0, 2.0, 0.5, -1.0])
    assert np.allclose([x.re + 1j * x.im for x in found], np.fft.fft([1.0, 2.0, 0.5, -1.0]))


def test_jobs_and_priors(spark, tmp_path):
    job = workflow.Job(labels=["DE"], n_cycles=4)
    peps = spark.createDataFrame([(1, "AK")], "pep_i long, pep string")
    workflow.write_job(spark, f"file://{tmp_path}/job", job, {"peps": peps})
    read, found = workflow.read_job(spark, f"file://{tmp_path}/job")
    assert read == job and found.peps.count() == 1
    priors = {"gain.ch_0": 1, "gain.ch_1": 2, "gain.ch_2": 3, "shift_y.ch_0": 0.0, "shift_y.ch_1": 2.0, "shift_y.ch_2": 5.0, "p": 9}
    assert workflow.remapped(priors, [1, 2]) == {"p": 9, "gain.ch_0": 2, "gain.ch_1": 3, "shift_y.ch_0": 0.0, "shift_y.ch_1": 3.0}
    assert ("n_cycles", "int", 8) in workflow.described() and workflow.filled("{a.b.1} of {c}", {"a": {"b": [1, 2]}, "c": "x"}) == "2 of x"
    with pytest.raises(ValueError, match="unknown workflow"):
        workflow.run("none", peps, job)


def test_train_and_test_sets_are_drawn_apart(spark):
    proteins = spark.createDataFrame([(0, list("ADAAK")), (1, list("AAYDAAYK")), (2, list("YAAAADDK"))], "pro_i long, tokens array<string>")
    job = workflow.Job(labels=["D", "Y"], n_cycles=5, n_samples=60, n_samples_test=25)
    tables_ = workflow.run("classify", proteins, job)
    calls = tables_["calls"].collect()
    assert len(calls) == 75 and len({r.row_i for r in calls}) == 75 and np.mean([r.true_i == r.pred_i for r in calls]) > 0.5
    sets = workflow.run("simulate", proteins, job)
    assert {n: sum(r.n for r in t.collect()) for n, t in sets.items()} == {"tracks": 180, "test_tracks": 75}


def test_frame_sources(spark, tmp_path):
    import struct

    for k, cells in ((2, [[1, 2], [3, 4]]), (10, [[5, 6], [7, 8]])):
        data = np.array(cells, "<u2").tobytes()
        tags = [(256, 3, 1, 2), (257, 3, 1, 2), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 1, 8), (279, 4, 1, len(data))]
        head = b"II" + struct.pack("<HI", 42, 8 + len(data)) + data + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0)
        (tmp_path / f"f_{k}.tif").write_bytes(head)
    movie = frames.as_movie(frames.read_tifs(spark, f"file://{tmp_path}/*.tif"))
    assert sorted((r.field_i, r.cycle_i, list(r.pixels)) for r in movie.collect()) == [(0, 0, [1, 2, 3, 4]), (1, 0, [5, 6, 7, 8])]
    for k in range(2):
        np.save(tmp_path / f"s_{k}.npy", np.full((4, 2, 2), k, np.float32))
    stacks = frames.as_z_stack(frames.read_arrays(spark, f"file://{tmp_path}/*.npy"), 2)
    assert sorted((r.field_i, r.slice_i, r.pixels[0]) for r in stacks.collect()) == [(f, s, float(f // 2)) for f in range(4) for s in range(2)]
    with pytest.raises(ValueError, match="divide"):
        frames.as_z_stack(frames.read_arrays(spark, f"file://{tmp_path}/*.npy"), 3)
    rows = spark.createDataFrame([(f, c, y) for y in range(2) for f in range(3) for c in range(2)], "field_i int, channel_i int, cycle_i int")
    assert {(r.channel_i, r.field_i) for r in frames.by_field(rows, {1: 0}).collect()} == {(0, f) for f in range(3)}


def test_noisy_fret_has_its_mean(spark):
    rows = spark.range(4000).select(simulate.noisy_fret(F.lit(100.0), F.lit(2), 0.3, 0.05, True, 3, "id").alias("v"))
    assert abs(rows.agg(F.avg("v")).first()[0] - 100 * (0.49 + 0.0025)) < 1


def test_pixel_kernels():
    image = np.arange(20.0).reshape(4, 5)
    assert (pixels.cut_out(image, pixels.Box(-1, 3, 3, 3), -1) == [[-1, -1, -1], [3, 4, -1], [8, 9, -1]]).all()
    copy = image.copy()
    pixels.paste(copy, np.ones((3, 3)), 3, 4)
    assert copy.sum() == image.sum() + 1
    assert pixels.disc((5, 5), 2, 2, 1).sum() == 5 and pixels.disc((5, 5), 2, 2, 1, 0).sum() == 4
    kernel = np.array([[0, 1, 0], [1, 2, 1], [0, 0, 3.0]])
    padded = np.pad(image, 1)
    plain = np.array([[(padded[y : y + 3, x : x + 3] * kernel[::-1, ::-1]).sum() for x in range(5)] for y in range(4)])
    assert np.allclose(pixels.convolved(image, kernel), plain)
    assert np.allclose(pixels.between_pixels(image, np.array([0.5, 3.0, 9.0]), np.array([1.5, 4.0, 0.0])), [4.0, 19.0, 15.0])
    spot = images.gaussian(21, 2.0, 1.0, -2.0)
    total, y, x, spread = pixels.moments(spot)
    assert np.allclose([total, y, x], [1, 11, 8], atol=0.02) and abs(spread[0, 0] - 4) < 0.1 and pixels.aspect(spot)[0] > 0.98
    line = np.zeros((9, 9))
    line[4, 1:8] = 1
    assert pixels.aspect(line)[0] == 0 and pixels.moments(np.zeros((3, 3)))[:3] == (0.0, 1.0, 1.0)
    assert pixels.regions(image, 2).shape == (2, 2) and pixels.rolling(image, 2).shape == (3, 4) and pixels.rolling(image, 2)[0, 0] == 3.0
    assert abs(pixels.commonest(np.r_[np.full(90, 5.0), np.linspace(0, 100, 10)].reshape(10, 10)) - 5) < 2
    assert abs(pixels.with_camera(np.full((50, 50), 400.0), np.random.default_rng(0)).mean() - 500) < 3 and pixels.vignetted(np.ones((5, 5)), 2.0)[2, 2] == 1.0


def test_scans_trials_and_starts(spark):
    f = lambda x: float((x[0] - 0.3) ** 2 + (x[1] + 0.2) ** 2)
    low, high = np.array([-1.0, -1.0]), np.array([1.0, 1.0])
    rows = fit.scan(spark, f, np.zeros(2), low, high, [(0,), (1,), (0, 1)], n=5).collect()
    assert len(rows) == 5 + 5 + 25 and all(abs(r.value - f(r.x)) < 1e-12 for r in rows)
    found = fit.trials(spark, lambda rng: [rng.random()], lambda p: p[0], 200)
    assert sorted(map(str, found.collect())) == sorted(map(str, found.collect())) and abs(fit.share_below(found, 0.5) - 0.5) < 0.12
    best = min(fit.many_starts(spark, f, low, high, 4).collect(), key=lambda r: r.value)
    assert np.allclose(best.x, [0.3, -0.2], atol=1e-3)


def test_accessors(spark):
    rows = spark.createDataFrame([(0, 0, 0, 0, 5.0, 2.0), (0, 1, 0, 0, float("nan"), 0.0), (1, 0, 0, 0, 3.0, None)], "field_i long, field_peak_i long, channel_i int, cycle_i int, signal double, noise double")
    assert [(r.snr, r.signal is None) for r in accessors.signal_to_noise(rows).orderBy("field_i", "field_peak_i").collect()] == [(2.5, False), (None, False), (None, False)]
    assert sorted(r.signal for r in accessors.measure(rows, "signal").collect()) == [0.0, 3.0, 5.0]
    with pytest.raises(ValueError, match="no rows"):
        accessors.of_fields(rows, [7])
    drawn = accessors.sampled_fits(rows.select("field_i", "field_peak_i", "signal")).collect()
    assert sorted((r.field_i, r.draw_i) for r in drawn) == [(0, 0), (0, 1), (1, 0)]
    assert accessors.first_fields(rows, 1).count() == 2 and accessors.images_of(rows, 1, 0).count() == 1
    meta, quality = accessors.import_tables(spark.createDataFrame([(0, 0, 0, 64, 1.0), (0, 1, 0, 64, 2.0)], "field_i long, channel_i int, cycle_i int, height int, quality double"))
    assert tuple(meta.first()) == (0, 2, 1, 64) and quality.count() == 2


def test_results_by_columns_and_grids(spark, tmp_path):
    found = results.Results.write(spark, f"file://{tmp_path}/r", {"t": spark.createDataFrame([(1, 2)], "a int, b int")})
    assert found.columns("t", ["b"]).columns == ["b"] and tuple(found.columns("t", ["a", "z"], missing_ok=True).first()) == (1, None)
    with pytest.raises(KeyError):
        found.columns("t", ["z"])
    tables.write_grid(spark.createDataFrame([(1, [2, 3])], "a int, v array<int>"), f"file://{tmp_path}/grid")
    assert [tuple(r) for r in spark.read.csv(f"file://{tmp_path}/grid", header=True).collect()] == [("1", "2;3")]
    assert dict(tables.read_bootstrap(spark, f"file://{tmp_path}/grid").dtypes)["a"] == "int"


def test_masks_priors_and_nearest_classes(spark):
    assert one(spark, arrays.masked(F.col("t"), F.array(F.lit(True), F.lit(None), F.lit(True))), t=[1, 2, 3]) == [1, 3]
    values = workflow.drawn({"p_x": {"mean": 5.0, "sd": 0.1}, "gain": {"low": 2.0, "high": 3.0}, "n": 4})
    assert values["p_x"] == 1.0 and 2 <= values["gain"] <= 3 and values["n"] == 4.0 and values == workflow.drawn({"p_x": {"mean": 5.0, "sd": 0.1}, "gain": {"low": 2.0, "high": 3.0}, "n": 4})
    tracks = spark.createDataFrame([(1, [2.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 3.0])], "dyt_i long, vec array<double>")
    likely = spark.createDataFrame([(1, 10, 1.0), (2, 10, 0.4), (2, 20, 0.6), (3, 30, 1.0)], "dyt_i long, pep_i long, p double")
    reads = spark.createDataFrame([(0, [1.9, 1.1]), (1, [0.1, 2.8]), (2, [1.0, 1.0])], "row_i long, radmat array<double>")
    found = {r.row_i: r for r in evaluate.nearest_classes(reads, tracks, likely, 2, 0.3).collect()}
    assert {i: r.pred_i for i, r in found.items()} == {0: 10, 1: 30, 2: 20} and all(0 < r.score <= 1 for r in found.values())
    flus = spark.createDataFrame([(1, "a", 2), (2, "a", 2), (3, "b", 1)], "pep_i long, flustr string, n_dyes_max_any_ch int")
    assert {(r.pep_i, r.flu_count) for r in relational.with_flus(spark.range(1, 5).withColumnRenamed("id", "pep_i"), flus).collect()} == {(1, 2), (2, 2), (3, 1), (4, None)}
