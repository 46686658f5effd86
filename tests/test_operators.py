import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from axisforge.config import ConfigError, MixConfig, StitchConfig
from axisforge.functions import kinematics as K
from axisforge.functions import names
from axisforge.operators import hemisphere, histogram, jobs, match, stitch, thrust, weights
from axisforge.plans import pipeline
from axisforge.sources import catalog, layout, sinks

JET = "array<struct<pt:double,eta:double,phi:double,m:double>>"


def events(spark, *lists):
    return spark.createDataFrame([(i, [tuple(map(float, j)) for j in js]) for i, js in enumerate(lists)], f"ev bigint, jets {JET}")


def mixed(spark, *lists, **how):
    e = thrust.with_thrust(events(spark, *lists))
    return hemisphere.with_hemispheres(e, **how)


def test_thrust_of_known_events(spark):
    back_to_back = [(50, 0, 0, 0), (50, 0, math.pi, 0)]
    three = [(10, 0, 2 * math.pi * k / 3, 0) for k in range(3)]
    e = events(spark, back_to_back, [], [(0, 1, 1, 1)] * 2, three)
    for f in (thrust.with_thrust, thrust.with_thrust_expressions):
        r = {x.ev: x for x in f(e).collect()}
        assert abs(math.sin(r[0].thrust_axis_phi)) < 1e-6 and r[0].thrust == pytest.approx(1)
        assert (r[1].thrust_axis_phi, r[1].thrust) == (0, 0) == (r[2].thrust_axis_phi, r[2].thrust)
        assert r[3].thrust == pytest.approx(2 / 3, abs=1e-3)


def test_thrust_kernel_equals_expressions_on_random_events(spark):
    g = np.random.default_rng(1)
    e = events(spark, *[[(g.uniform(1, 99), g.normal(), g.uniform(-3.1, 3.1), 1) for _ in range(g.integers(0, 8))] for _ in range(200)])
    a, b = ({r.ev: (r.thrust_axis_phi, r.thrust) for r in f(e).collect()} for f in (thrust.with_thrust, thrust.with_thrust_expressions))
    assert a == pytest.approx(b, abs=1e-6) if not isinstance(a, dict) else all(np.allclose(a[k], b[k], atol=1e-6) for k in a)
    assert all(0 <= t <= 1 + 1e-6 for _, t in a.values())


def test_rotation_moves_the_axis_only(spark):
    js = [(50, 0.3, 0.2, 3), (40, -0.5, 2.9, 2), (30, 1, -1.5, 1), (20, 0, 1.1, 1), (10, 0.2, -2, 1)]
    turn = 7 * math.pi / 180
    a, b = thrust.with_thrust(events(spark, js, [(p, e, f + turn, m) for p, e, f, m in js])).orderBy("ev").collect()
    assert abs(math.sin(b.thrust_axis_phi - a.thrust_axis_phi - turn)) < 1e-5 and a.thrust == pytest.approx(b.thrust, abs=1e-6)


def test_hemispheres_keep_what_jets_have_and_both_exist(spark):
    one_sided = [(10 + k, 0.1 * k, 0.1 + 0.04 * k, 1) for k in range(5)]
    r = mixed(spark, one_sided).first()
    sizes = sorted(h.n_jets for h in r.Hemisphere)
    assert sizes == [0, 5]
    empty, full = sorted(r.Hemisphere, key=lambda h: h.n_jets)
    assert empty.pt == empty.eta == empty.energy == empty.mass == 0 and full.partner_eta == 0 and empty.partner_eta == full.eta
    assert sum(h.px for h in r.Hemisphere) == pytest.approx(sum(p * math.cos(f) for p, _, f, _ in one_sided), rel=1e-5)
    assert [h.side for h in r.Hemisphere] == [1, -1]


def test_pt_zero_has_eta_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, -1e8)], "pt double, pz double")
    a, b = (r[0] for r in df.select(K.pseudorapidity(F.col("pt"), F.col("pz"))).collect())
    assert a == 0 and b == pytest.approx(math.asinh(-5e7))


def test_directions_wrap(spark):
    df = spark.createDataFrame([(0.25, 1), (0.25, -1), (3.0, 0), (-1e-17, 1)], "phi double, side int")
    r = df.select(K.directed_phi(F.col("phi"), F.col("side")), K.query_direction(F.col("phi"), F.col("side"))).collect()
    assert r[0] == pytest.approx((0.25, 0.25 + math.pi)) and r[1] == pytest.approx((0.25 + math.pi, 0.25)) and r[2][0] == 3.0
    assert spark.range(1).select(K.delta_phi(F.lit(0.1), F.lit(2 * math.pi - 0.1))).first()[0] == pytest.approx(0.2)


def test_a_stored_axis_above_pi_is_reduced_again(spark):
    e = events(spark, [(10, 0, 0, 1), (9, 0, 0.1, 1), (8, 0, -0.1, 1), (20, 0, 3.1, 1), (7, 0.0, 3.0, 1)]).withColumn("thrust_axis_phi", F.lit(math.pi).cast("float"))
    lib = hemisphere.library(hemisphere.with_hemispheres(e), ["ev"])
    assert all(r.thrust_phi < 1e-6 and len(r.jets) == 3 for r in lib.collect())


def random_library(g, n):
    return pd.DataFrame({"job": 1, "id": range(n), "ev": np.arange(n) // 2, "pt": np.where(g.random(n) < 0.05, 0, g.integers(10, 30, n)).astype(float), "direction": np.round(g.uniform(0, 2 * np.pi, n), 2), "query": np.round(g.uniform(0, 2 * np.pi, n), 2), "eta": np.round(g.normal(0, 1, n), 1), "partner_eta": np.round(g.normal(0, 1, n), 1), "weight": g.choice([0.3, 1.0, 2.5], n)})


def close(lib, distance, tolerance):
    def d2(s, c):
        d = abs(lib.direction[c] - lib["query"][s]) % (2 * np.pi)
        d = min(d, 2 * np.pi - d)
        return d * d + (lib.eta[c] - lib.partner_eta[s]) ** 2

    def allowed(s, c):
        return lib.ev[s] != lib.ev[c] and (tolerance is None or abs(lib.pt[c] - lib.pt[s]) <= tolerance * lib.pt[s]) and (distance is None or math.sqrt(d2(s, c)) <= distance)

    return d2, allowed


@pytest.mark.parametrize("distance,tolerance", [(0.5, 0.1), (2.5, 0.5), (7.0, None), (0.2, 1.5)])
def test_edges_equal_the_cross_join(spark, distance, tolerance):
    lib = random_library(np.random.default_rng(2), 80)
    d2, allowed = close(lib, distance, tolerance)
    df = spark.createDataFrame(lib)
    got = {(r.seed, r.match) for r in match.candidate_edges(df, df, ["job"], distance, tolerance).collect()}
    assert got == {(s, c) for s in range(80) for c in range(80) if allowed(s, c)}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_draws_equal_a_scan_of_the_library(spark, seed):
    lib = random_library(np.random.default_rng(seed), 60)
    d2, allowed = close(lib, 1.0, 0.3)
    df = spark.createDataFrame(lib)
    draws = stitch.stitch(df, match.candidate_edges(df, df, ["job"], 1.0, 0.3), "job", 42).orderBy("draw").toPandas()
    g = np.random.default_rng(42)
    want = stitch.brute_force_draws(stitch.drawn_budgets(lib.weight.to_numpy(), g), g, allowed, d2)
    assert [(a, None if pd.isna(b) else int(b)) for a, b in zip(draws.seed, draws.match)] == [(a, b) for a, b, _ in want]
    # Budgets bound the uses, no pair repeats, no event meets itself.
    budgets = stitch.with_drawn_budgets(df, "job", 42).toPandas().set_index("id").budget
    made = draws[draws.match.notna()]
    uses = pd.concat([draws.seed, made.match]).astype(int).value_counts()
    assert all(uses[i] <= budgets[i] for i in uses.index)
    assert len({frozenset(p) for p in zip(made.seed, made.match)}) == len(made)
    assert budgets.sum() >= 2 * len(made) + (len(draws) - len(made))


def test_stitched_events(spark):
    g = np.random.default_rng(5)
    e = events(spark, *[[(g.uniform(20, 60), g.normal(), g.uniform(-3.1, 3.1), 1) for _ in range(5)] for _ in range(300)]).withColumn("job", F.lit("a"))
    s = pipeline.stitched(pipeline.mix(e), "job", ["ev"], StitchConfig(max_distance=1.5, pt_tolerance=0.3))
    rows, lib = s.events.collect(), {r.id: r for r in s.library.collect()}
    assert rows
    for r in rows:
        assert [j.pt for j in r.jets] == sorted((j.pt for j in r.jets), reverse=True) and sum(j.hemisphere for j in r.jets) == 3
        assert {tuple(j)[:4] for j in r.jets} == {tuple(j) for i in (r.seed, r.match) for j in lib[i].jets}
        assert [h.n_jets for h in r.Hemisphere] == [3, 3] and r.distance <= 1.5
    flow = {r.step: r.n for r in s.cutflow.collect()}
    assert flow["draws"] == flow["pseudo-events"] + flow["failed matches"] and flow["pseudo-events"] == len(rows)
    assert s.distances.agg(F.sum("n")).first()[0] == len(rows)


def test_weights(spark):
    files = spark.createDataFrame([("a/x_QCD_HT100_1.root", 10), ("b/QCD_HT1000_2.root", 4), ("QCD_HT100/other.root", 5), (None, 1)], "path string, n_original bigint")
    keys = spark.createDataFrame([("QCD_HT100", 2.0), ("QCD_HT1000", None), ("HT100", 9.0)], "dataset string, xs_pb double")
    r = {x.path: (x.dataset, x.xs_weight) for x in weights.with_weight(weights.infer_dataset(files, keys), keys, 5.0).collect()}
    assert r == {"a/x_QCD_HT100_1.root": ("QCD_HT100", 1.0), "b/QCD_HT1000_2.root": ("QCD_HT1000", 1.0), "QCD_HT100/other.root": (None, 1.0), None: (None, 1.0)}
    with pytest.raises(Exception, match="no cross-section weight"):
        weights.with_weight(weights.infer_dataset(files, keys), keys, 5.0, strict=True).collect()


def test_budgets_round_stochastically(spark):
    df = spark.range(20000).select(F.col("id").alias("ev"), F.lit(1).alias("side"))
    r = df.select(weights.hash_budget(F.lit(2.3), F.col("ev"), F.col("side")).alias("b"), weights.hash_budget(F.lit(3.0), F.col("ev"), F.col("side")).alias("c")).agg(F.avg("b"), F.min("b"), F.max("b"), F.min("c"), F.max("c")).first()
    assert r[0] == pytest.approx(2.3, abs=0.02) and tuple(r)[1:] == (2, 3, 3, 3)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.5,), (-1.0,), (None,), (float("nan"),)], "d double")
    n = {r.bin: r.n for r in histogram.histogram(df, "d", 5, 0.0, 0.5, "h").collect()}
    assert n == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_jobs(spark):
    files = spark.createDataFrame([(s, f"{s}{i}", "t") for s, n in (("a", 7), ("b", 5), ("c", 9)) for i in range(n)], "slice string, path string, tree string")
    r = jobs.slice_balanced_jobs(files, 2)
    assert {(x.job, x["count"]) for x in jobs.job_files(r).groupBy("job").count().collect()} == {("job_1", 6), ("job_2", 6)}
    assert jobs.leftovers(r).count() == 21 - 12
    assert jobs.job_files(jobs.slice_balanced_jobs(files, 6)).count() == 0
    cut = jobs.sub_jobs(jobs.job_files(r), 4)
    assert {(x.job, x.sub_jobs) for x in jobs.split_jobs(cut).collect()} == {("job_1", 2), ("job_2", 2)}
    assert jobs.slice_files(files, only=["a"]).count() == 7
    with pytest.raises(ValueError):
        jobs.slice_balanced_jobs(files, 0)


def test_layouts(spark):
    nested = spark.createDataFrame([(1, [(1.0, 2.0, 3.0, 4.0)], "x")], f"run int, ScoutingPFJet {JET}, other string")
    flat = layout.to_flat(nested)
    assert layout.jet_format(nested) == "nested" and layout.jet_format(flat) == "flat" and layout.jet_format(nested.select("run")) is None
    again = layout.to_nested(flat)
    assert set(again.columns) == {"run", "other", "ScoutingPFJet"} and again.first().ScoutingPFJet == nested.first().ScoutingPFJet
    for df in (nested, flat):
        assert layout.with_jets(df).first().jets[0].phi == 3.0
    with pytest.raises(ValueError):
        layout.with_jets(nested.select("run"))


def test_catalog(spark, tmp_path):
    (tmp_path / "qcd_filelist.txt").write_text("# c\n\n/store/a.root\nroot://h//store/b.root\nbad\n")
    r = {(x.dataset, x.path) for x in catalog.read_filelists(spark, str(tmp_path / "qcd_filelist.txt")).collect()}
    assert r == {("qcd", "root://xcache//store/a.root"), ("qcd", "root://h//store/b.root")}
    out = tmp_path / "sets"
    out.mkdir()
    catalog.write_fileset(spark.createDataFrame([("a", "p1", "t"), ("a", "p2", "t"), ("b", "p3", "u")], "dataset string, path string, tree string"), str(out / "x.json"))
    assert json.loads((out / "x.json").read_text()) == {"a": {"files": {"p1": "t", "p2": "t"}}, "b": {"files": {"p3": "u"}}}
    assert catalog.read_filesets(spark, str(out)).count() == 3
    catalog.write_fileset(spark.createDataFrame([], "dataset string, path string, tree string"), str(out / "y.json"))
    assert json.loads((out / "y.json").read_text()) == {}
    for p in ("base/TT_Tune5/0/f1.root", "base/TT_Tune5/f2.root", "base/WW/f3.root", "base/top.root", "base/WW/skip.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    listed = catalog.list_folder(spark, str(tmp_path / "base"), strip_at="_Tune").collect()
    assert sorted((x.dataset, x.path.rsplit("/", 1)[1]) for x in listed) == [("TT", "f1.root"), ("TT", "f2.root"), ("WW", "f3.root")]
    (tmp_path / "xs.json").write_text('{"QCD": {"xs_pb": 2.5}, "WW": {}}')
    assert {(x.dataset, x.xs_pb) for x in catalog.read_cross_sections(spark, str(tmp_path / "xs.json")).collect()} == {("QCD", 2.5), ("WW", None)}
    assert catalog.locate_cross_sections(str(tmp_path / "xs.json")) == str(tmp_path / "xs.json")


def test_events_tables_and_sinks(spark, tmp_path):
    e = events(spark, [(1, 0, 0, 0)])
    sinks.write_events(e, str(tmp_path / "in/Events"))
    assert catalog.read_events(spark, str(tmp_path / "in")).count() == 1
    assert catalog.read_events(spark, str(tmp_path / "none"), schema=e.schema).count() == 0
    assert tuple(sinks.mix_meta(spark, MixConfig(), lumi=2.0).first()) == (180, 90, 5, 2.0, 0.0, 0.0, 0.0)
    assert {r.name for r in sinks.labels(spark, MixConfig(), "QCD", {"version": "s1"}).collect()} == {"version", "dataset", "slimmer_version"}
    totals = spark.createDataFrame([(3, 4)], "n_hemispheres bigint, total_budget bigint")
    assert tuple(sinks.stitch_meta(totals, StitchConfig()).first()) == (42, 0.5, 0.1, 3, 4)


def test_names(spark):
    def value(c):
        return spark.range(1).select(c).first()[0]

    assert value(names.stem(F.lit("a/b.c.txt"))) == "b.c" and value(names.stem(F.lit("a/.hidden"))) == ".hidden"
    assert value(names.list_label(F.lit("x/QCD_files.txt"))) == "QCD" and value(names.list_label(F.lit("x/QCD_file_list.txt"))) == "QCD"
    assert value(names.label_before(F.lit("/a/TT_TuneX/"), "_Tune")) == "TT" and value(names.label_before(F.lit("/a/TT/"), "")) == "TT"
    assert value(names.strip_redirector(F.lit("root://h///store/x"))) == "/store/x"
    assert value(names.mixed_name(F.lit("root://h//store/x.root"), "tag")) == "mixed_tag_x.root"


@pytest.mark.parametrize("bad", [{}, {"metadata": {"version": "v"}, "mixer": {"thrust_scan_points": True, "hist_bins": 1, "n_jets": 1}}, {"metadata": {"version": "v"}, "mixer": {"thrust_scan_points": 1, "hist_bins": 1, "n_jets": 1}}, {"metadata": {"version": 3}, "mixer": {"thrust_scan_points": 2, "hist_bins": 1, "n_jets": 1}}, {"metadata": {"version": "v"}, "mixer": {"thrust_scan_points": 2, "hist_bins": 1}}])
def test_bad_configs(bad):
    with pytest.raises(ConfigError):
        MixConfig.from_dict(bad)


def test_empty_tables(spark):
    e = events(spark).withColumn("job", F.lit(1))
    mixed_ = pipeline.mix(e)
    assert mixed_.count() == 0 and pipeline.mix_histograms(mixed_).agg(F.sum("n")).first()[0] == 0
    s = pipeline.stitched(mixed_, "job", ["ev"])
    assert s.draws.count() == s.events.count() == 0
