import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from axisforge import cli
from axisforge.library import HemisphereLibrary
from axisforge.operators import match, stitch
from axisforge.plans import pipeline
from axisforge.streaming import mixing

JET = "array<struct<pt:double,eta:double,phi:double,m:double>>"


def random_events(spark, n=60, jets=5):
    g = np.random.default_rng(3)
    return spark.createDataFrame([(i, [tuple(map(float, (g.uniform(20, 60), g.normal(), g.uniform(-3.1, 3.1), 1))) for _ in range(jets)]) for i in range(n)], f"entry bigint, jets {JET}")


def test_library_gives_the_draws_of_the_distributed_plan(spark):
    s = pipeline.stitched(pipeline.mix(random_events(spark, 120), weight=F.lit(1.4)).withColumn("job", F.lit(1)), "job", ["entry"], pipeline.StitchConfig(max_distance=1.5, pt_tolerance=0.3))
    lib = HemisphereLibrary(42)
    ids = {}
    for r in s.library.orderBy("id").collect():
        h = lib.add(*([j[k] for j in r.jets] for k in range(4)), thrust_phi=r.thrust_phi, partner_eta=r.partner_eta, pt=r.pt, eta=r.eta, side=r.side, weight=r.weight, event_id=r.ev)
        ids[id(h)] = r.id
    for d in s.draws.orderBy("draw").collect():
        seed = lib.draw()
        found, distance = lib.find_partner(seed, seed.event, 1.5, 0.3)
        assert (ids[id(seed)], found and ids[id(found)]) == (d.seed, d.match)
        assert found is None or distance == pytest.approx(d.distance)
    assert lib.draw() is None and lib.total_budget == lib.n_available == 0


def test_library_rules():
    lib = HemisphereLibrary()
    with pytest.raises(ValueError):
        lib.find_partner(None)
    jets = ([10, 11, 12], [0, 0.1, 0], [0.1, 0, -0.1], [1, 1, 1])
    a = lib.add(*jets, thrust_phi=0.0, partner_eta=0.0, side=1, event_id="a")
    b = lib.add(*jets, thrust_phi=0.0, partner_eta=0.0, side=-1, event_id="b")
    assert a.n_jets == 3 and a.pt == b.pt == lib.pt_max and len(lib) == 2 and lib.total_budget == 2
    assert b.direction == pytest.approx(math.pi) and a.wanted_direction == pytest.approx(math.pi) and a.eta == b.eta
    assert a.eta == pytest.approx(math.asinh(11 * math.sinh(0.1) / a.pt))
    assert lib.find_partner(a, "a", record=False)[0] is b and lib.total_budget == 2
    assert lib.find_partner(a, "a")[0] is b and lib.total_budget == 1
    assert lib.find_partner(b, "b", max_distance=9.0, record=False) == (None, math.inf)
    assert lib.total_budget == 1 and lib.find_partner(b, "b", max_distance=9.0)[0] is None and lib.total_budget == 1
    lib.forget_matches()
    assert lib.find_partner(b, "b", max_distance=9.0, record=False)[0] is a
    with pytest.raises(ValueError):
        lib.find_partner(a, "a")


def test_nearest_and_pairs(spark):
    edges = spark.createDataFrame([(1, 1, 2, 0.25), (1, 1, 3, 0.25), (1, 2, 1, 0.04), (1, 3, 1, 0.01)], "job int, seed bigint, match bigint, d2 double")
    best = match.nearest(edges, ["job"])
    assert {(r.seed, r.match, r.distance) for r in best.collect()} == {(1, 2, 0.5), (2, 1, 0.2), (3, 1, 0.1)}
    assert {(r.a, r.b, r.distance, r.mutual) for r in match.unordered_pairs(best, ["job"]).collect()} == {(1, 2, 0.5, True), (1, 3, 0.1, False)}


def test_resolve_retires_seeds():
    none = np.zeros(0, dtype=np.int64)
    assert stitch.resolve(np.array([3]), np.random.default_rng(1), none, none, none.astype(float)) == [(0, None, None)]


def test_stream_equals_batch(spark, tmp_path):
    e = random_events(spark)
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    mixing.start_mixing(mixing.read_events(spark, str(tmp_path / "in"), e.schema, 1), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    key = lambda df: {(r.entry, r.thrust_axis_phi, r.Hemisphere[0].pt) for r in df.collect()}
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(pipeline.mix(e))


def test_windowed_cutflow(spark):
    e = random_events(spark).withColumn("t", F.timestamp_seconds(F.col("entry") * 10))
    rows = mixing.windowed_cutflow(e, "t", "1 minute", "10 seconds").collect()
    assert sum(r.n_read for r in rows) == sum(r.n_pass for r in rows) == 60 and len(rows) == 10


def slimmed(spark, path, n=100, cutflow=None):
    e = random_events(spark, n).withColumnRenamed("jets", "ScoutingPFJet")
    e.write.parquet(f"{path}/events")
    if cutflow is not None:
        spark.createDataFrame([(0, float(cutflow)), (1, float(n))], "bin int, n double").write.parquet(f"{path}/cutflow")
        spark.createDataFrame([("s7",)], "label string").write.parquet(f"{path}/version")


@pytest.fixture
def config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"metadata": {"version": "v1"}, "mixer": {"thrust_scan_points": 180, "hist_bins": 90, "n_jets": 5}}))
    (tmp_path / "xs.json").write_text('{"QCD": {"xs_pb": 3.0}}')
    return str(path)


def test_weights_are_divided_by_the_events_of_the_cutflow(spark, tmp_path, config):
    slimmed(spark, str(tmp_path / "slim_QCD"), cutflow=12)
    cli.main(["mix", str(tmp_path / "slim_QCD"), config, "-o", str(tmp_path), "--xs-json", str(tmp_path / "xs.json")])
    read = lambda name: spark.read.parquet(str(tmp_path / "mixed_slim_QCD" / name))
    assert read("events").select("xs_weight").distinct().collect() == [(0.25,)] and read("meta").first().n_original == 12
    assert {(r.bin, r.n) for r in read("cutflow").collect()} == {(0, 12.0), (1, 100.0)}
    assert {(r.name, r.label) for r in read("labels").collect()} == {("version", "v1"), ("dataset", "QCD"), ("slimmer_version", "s7")}
    cli.main(["mix", str(tmp_path / "slim_QCD"), config, "-o", str(tmp_path / "own"), "--xs-json", str(tmp_path / "xs.json"), "--n-original", "6"])
    assert spark.read.parquet(str(tmp_path / "own/mixed_slim_QCD/events")).select("xs_weight").distinct().collect() == [(0.5,)]


def test_stitching_skips_counts_and_guards(spark, tmp_path, config, capsys):
    pipeline.mix(random_events(spark, 100)).drop("entry").write.parquet(str(tmp_path / "a/events"))
    pipeline.mix(random_events(spark, 0)).write.parquet(str(tmp_path / "b/events"))
    wide = ["--max-distance", "1.5", "--pt-tolerance", "0.4"]
    cli.main(["stitch", str(tmp_path / "b"), str(tmp_path / "none"), str(tmp_path / "a"), "-o", str(tmp_path / "out"), *wide])
    said = capsys.readouterr()
    assert said.err.count("skipped") == 2 and "100 events in 1 inputs" in said.out
    events = spark.read.parquet(str(tmp_path / "out/events"))
    assert events.count() > 0
    meta, flow = spark.read.parquet(str(tmp_path / "out/meta")).first(), {r.step: r.n for r in spark.read.parquet(str(tmp_path / "out/stitch_cutflow")).collect()}
    assert (meta.rng_seed, meta.max_distance, meta.n_hemispheres, meta.budget0) == (42, 1.5, flow["hemispheres"], flow["total budget"]) and flow["pseudo-events"] == events.count()
    for inputs, how, why in (("b", wide, "nothing to stitch"), ("a", ["--max-distance", "0.0000001"], "no pseudo-event")):
        with pytest.raises(SystemExit, match=why):
            cli.main(["stitch", str(tmp_path / inputs), "-o", str(tmp_path / f"fails_{inputs}"), *how])
    pipeline.mix(random_events(spark, 5, jets=2), pipeline.MixConfig(n_jets=2)).write.parquet(str(tmp_path / "c/events"))
    with pytest.raises(SystemExit, match="none of 5 events"):
        cli.main(["stitch", str(tmp_path / "c"), "-o", str(tmp_path / "d")])


def test_a_campaign_mixes_and_stitches_each_job(spark, tmp_path, config, capsys):
    for name in ("x1", "x2"):
        slimmed(spark, str(tmp_path / name))
    jobs = {"job_1": {"files": {str(tmp_path / n): "events" for n in ("x1", "x2")}}, "job_2": {"files": {str(tmp_path / "x1"): "events"}}, "unused": {"files": {str(tmp_path / "x9"): "events"}}}
    (tmp_path / "jobs.json").write_text(json.dumps(jobs))
    how = [str(tmp_path / "jobs.json"), config, "--no-xs-weight", "--max-distance", "1.5", "--pt-tolerance", "0.4"]
    cli.main(["campaign", *how, "-o", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/job_1/stitched_job_1/events")).select("job").distinct().collect() == [("job_1",)]
    assert (tmp_path / "out/job_2/stitched_job_2/meta").is_dir() and (tmp_path / "out/job_1/mixed_job_1_x2/events").is_dir() and not (tmp_path / "out/unused").exists()
    # A failed stitching leaves the mixed tables, and other jobs go on.
    with pytest.raises(SystemExit, match="1 of 1 jobs failed"):
        (tmp_path / "jobs.json").write_text(json.dumps({"job_3": jobs["job_2"]}))
        cli.main(["campaign", *how[:3], "--max-distance", "0.0000001", "-o", str(tmp_path / "out")])
    assert (tmp_path / "out/job_3/mixed_job_3_x1/events").is_dir() and not (tmp_path / "out/job_3/stitched_job_3").exists()


def test_later_arguments_win_when_filesets_are_merged(spark, tmp_path):
    for name, tree in (("z", "first"), ("a", "second")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"s": {"files": {f"p{i}": tree for i in range(2)}}}))
    cli.main(["jobs", str(tmp_path / "z.json"), str(tmp_path / "a.json"), "-o", str(tmp_path / "jobs.json"), "--per-slice", "1"])
    assert json.loads((tmp_path / "jobs.json").read_text())["job_1"]["files"] == {"p0": "second"}


def test_event_numbers_are_checked(spark):
    number = lambda rows: [r[0] for r in spark.createDataFrame(rows, "file bigint, entry bigint").select(pipeline.event_number(["file", "entry"])).collect()]
    assert number([(0, 5), (1, 0), (2**31 - 1, 2**31 - 1)]) == [5, 2**31, 2**62 - 1]
    for row in ((2**31, 0), (0, 2**31), (0, -1), (None, 1)):
        with pytest.raises(Exception, match="must be from 0 to"):
            number([row])


def test_commands(spark, tmp_path):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"metadata": {"version": "v1"}, "mixer": {"thrust_scan_points": 180, "hist_bins": 90, "n_jets": 5}}))
    (tmp_path / "xs.json").write_text('{"QCD": {"xs_pb": 3.0}}')
    random_events(spark, 100).withColumnRenamed("jets", "ScoutingPFJet").write.parquet(str(tmp_path / "slim_QCD/events"))
    cli.main(["mix", str(tmp_path / "slim_QCD"), str(config), "-o", str(tmp_path), "--xs-json", str(tmp_path / "xs.json"), "--n-original", "3"])
    mixed = tmp_path / "mixed_slim_QCD"
    assert spark.read.parquet(str(mixed / "events")).select("xs_weight").distinct().collect() == [(1.0,)]
    assert tuple(spark.read.parquet(str(mixed / "mixer_cutflow")).first()) == (100, 100)
    cli.main(["mix", str(tmp_path / "none"), str(config), "-o", str(tmp_path), "--no-xs-weight"])
    assert tuple(spark.read.parquet(str(tmp_path / "mixed_none/mixer_cutflow")).first()) == (0, 0)
    cli.main(["stitch", str(mixed), "-o", str(tmp_path / "stitched"), "--max-distance", "1.5", "--pt-tolerance", "0.4"])
    assert spark.read.parquet(str(tmp_path / "stitched/events")).count() > 0
    lists = tmp_path / "lists"
    lists.mkdir()
    for s in ("a", "b"):
        (lists / f"{s}_files.txt").write_text("".join(f"/store/{s}{i}.root\n" for i in range(3)))
    cli.main(["fileset", str(lists), "-o", str(tmp_path / "fileset.json")])
    cli.main(["jobs", str(tmp_path / "fileset.json"), "-o", str(tmp_path / "jobs.json"), "--per-slice", "2"])
    assert len(json.loads((tmp_path / "jobs.json").read_text())["job_1"]["files"]) == 4
    assert len(json.loads((tmp_path / "jobs_unused.json").read_text())["unused"]["files"]) == 2
