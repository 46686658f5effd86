"""Commands: mix, stitch, jobs, fileset, folder and campaign."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from axisforge.config import MixConfig, StitchConfig
from axisforge.functions import names
from axisforge.operators import histogram, jobs, weights
from axisforge.plans import pipeline
from axisforge.sources import catalog, layout, sinks


def mixed_folder(spark: SparkSession, a) -> str:
    return f"{a.output}/" + spark.range(1).select(names.mixed_name(F.lit(a.input.rstrip("/")), a.output_tag)).first()[0]


def mix(spark: SparkSession, a) -> None:
    """The mixed events of an input folder, with what describes them. Weights are divided by the events that the input's cutflow began with."""
    config = MixConfig.load(a.config)
    events = catalog.read_events(spark, a.input, a.tree)
    if not events.columns:  # an empty slice: what describes the run is still written
        events = spark.createDataFrame([], "jets array<struct<pt:double,eta:double,phi:double,m:double>>")
    else:
        events = layout.with_jets(layout.to_nested(events))
    records = catalog.read_records(spark, a.input)
    n_original = records.n_original if a.n_original is None else a.n_original
    weight, xs_pb, dataset = 1.0, None, a.dataset
    if not a.no_xs_weight:
        found = catalog.locate_cross_sections(a.xs_json)
        xs = catalog.read_cross_sections(spark, found) if found else spark.createDataFrame([], "dataset string, xs_pb double")
        file = spark.createDataFrame([(a.input, a.dataset, n_original)], "path string, dataset string, n_original double")
        file = file if a.dataset else weights.infer_dataset(file, xs)
        row = weights.with_weight(file, xs, a.lumi, strict=a.require_xs).first()
        weight, xs_pb, dataset = row.xs_weight, row.xs_pb, row.dataset
    out = mixed_folder(spark, a)
    sinks.write_events(pipeline.mix(events, config, F.lit(weight)), f"{out}/events")
    sinks.write_events(pipeline.mix_histograms(spark.read.parquet(f"{out}/events"), config), f"{out}/histograms")
    sinks.write_events(histogram.mixer_cutflow(events, config.n_jets), f"{out}/mixer_cutflow")
    sinks.write_events(sinks.mix_meta(spark, config, a.lumi, xs_pb, n_original, weight), f"{out}/meta")
    sinks.write_events(sinks.labels(spark, config, dataset, {"version": records.version} if records.version else None), f"{out}/labels")
    if records.cutflow is not None:
        sinks.write_events(records.cutflow, f"{out}/cutflow")


def stitch(spark: SparkSession, a) -> None:
    """The pseudo-events of all inputs as one library. Inputs without events are skipped; an empty library, or no pseudo-event, ends with an error."""
    config = StitchConfig(a.max_distance, a.pt_tolerance, a.seed)
    parts = []
    for i, path in enumerate(a.inputs):
        events = catalog.read_events(spark, path, a.tree)
        if not events.columns or events.isEmpty():
            print(f"skipped {path}: no {a.tree}", file=sys.stderr)
            continue
        if a.entry not in events.columns:
            events = catalog.with_entries(events, a.entry)
        parts.append(events.withColumn("file", F.lit(i).cast("long")).withColumn("job", F.lit(a.job)))
    if not parts:
        sys.exit("no input has events: there is nothing to stitch")
    events = parts[0]
    for p in parts[1:]:
        events = events.unionByName(p, allowMissingColumns=True)
    s = pipeline.stitched(events, "job", ["file", a.entry], config, a.random)
    flow = {r.step: r.n for r in s.cutflow.collect()}  # five rows
    if not flow:
        sys.exit(f"none of {events.count()} events in {len(parts)} inputs has a hemisphere of {config.jets_per_hemisphere} jets: there is nothing to stitch")
    print(f"{events.count()} events in {len(parts)} inputs; " + ", ".join(f"{k}: {v}" for k, v in flow.items()))
    if not flow[histogram.STEPS[3]]:
        sys.exit("no pseudo-event was made: is max-distance too small?")
    totals = spark.createDataFrame([(flow[histogram.STEPS[0]], flow[histogram.STEPS[1]])], "n_hemispheres bigint, total_budget bigint")
    sinks.write_events(s.draws, f"{a.output}/draws")
    sinks.write_events(s.events, f"{a.output}/events")
    sinks.write_events(s.distances, f"{a.output}/match_distance")
    sinks.write_events(s.cutflow, f"{a.output}/stitch_cutflow")
    sinks.write_events(sinks.stitch_meta(totals, config), f"{a.output}/meta")
    sinks.write_events(sinks.labels(spark), f"{a.output}/labels")


def campaign(spark: SparkSession, a) -> None:
    """All jobs of a jobs file: the mixed tables of a job's inputs, and then their pseudo-events.

    A failed mixing ends its job before anything is stitched; a failed stitching leaves the
    mixed tables. Other jobs go on, and the command ends with an error if any job failed.
    """
    files = catalog.read_filesets(spark, [a.jobs]).where("dataset <> 'unused'").orderBy("dataset", "path")
    jobs_, failed = {}, []
    for r in files.toLocalIterator():
        jobs_.setdefault(r.dataset, []).append((r.path, r.tree))
    for job, inputs in jobs_.items():
        made = []
        try:
            for path, tree in inputs:
                own = argparse.Namespace(**{**vars(a), "input": path, "tree": tree or "events", "output": f"{a.output}/{job}", "output_tag": job, "n_original": None, "dataset": None})
                mix(spark, own)
                made.append(mixed_folder(spark, own))
            if not a.no_stitch:
                stitch(spark, argparse.Namespace(**{**vars(a), "inputs": sorted(made), "tree": "events", "job": job, "output": f"{a.output}/{job}/stitched_{job}"}))
        except (Exception, SystemExit) as e:  # noqa: BLE001
            print(f"{job} failed: {e}", file=sys.stderr)
            failed.append(job)
    if failed:
        sys.exit(f"{len(failed)} of {len(jobs_)} jobs failed: {', '.join(failed)}")


def make_jobs(spark: SparkSession, a) -> None:
    files = catalog.read_filesets(spark, a.inputs).withColumnRenamed("dataset", "slice")
    assigned = jobs.slice_balanced_jobs(jobs.slice_files(files, a.only), a.per_slice, a.job_prefix)
    catalog.write_fileset(jobs.job_files(assigned), a.output, "job")
    left = jobs.leftovers(assigned)
    if not left.isEmpty():
        stem, dot, ending = a.output.rpartition(".")
        catalog.write_fileset(left.withColumn("job", F.lit("unused")), f"{stem}_unused.{ending}" if dot else f"{a.output}_unused.json", "job")


def fileset(spark: SparkSession, a) -> None:
    catalog.write_fileset(catalog.read_filelists(spark, a.inputs, a.redirector, a.tree), a.output)


def folder(spark: SparkSession, a) -> None:
    found = catalog.list_folder(spark, a.base, only=a.only, strip_at=a.strip_at, tree=a.tree, redirector=a.redirector)
    for (name,) in found.select("dataset").distinct().toLocalIterator():
        catalog.write_fileset(found.where(F.col("dataset") == name), f"{a.outdir}/{name}.json")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="axisforge", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(f, *options):
        c = sub.add_parser(f.__name__.removeprefix("make_"))
        for name, how in options:
            c.add_argument(*name.split(), **how)
        c.set_defaults(run=f)

    only = ("--only", {"action": "append", "default": []})
    tree = ("--tree", {"default": "events"})
    config, out = ("config", {}), lambda default: ("-o --output", {"default": default})
    weight = ("--xs-json", {}), ("--lumi", {"type": float, "default": 1.0}), ("--no-xs-weight", {"action": "store_true"}), ("--require-xs", {"action": "store_true"})
    match = ("--entry", {"default": "entry"}), ("--random", {"default": "pcg64", "choices": ["pcg64", "hash"]}), ("--max-distance", {"type": float, "default": 0.5}), ("--pt-tolerance", {"type": float, "default": 0.10}), ("--seed", {"type": int, "default": 42})
    command(mix, ("input", {}), config, tree, out("."), ("--output-tag", {"default": ""}), ("--dataset", {}), ("--n-original", {"type": float}), *weight)
    command(stitch, ("inputs", {"nargs": "+"}), out("stitched"), tree, ("--job", {"default": "job_1"}), *match)
    command(campaign, ("jobs", {}), config, out("campaign"), ("--no-stitch", {"action": "store_true"}), *weight, *match)
    command(make_jobs, ("inputs", {"nargs": "+"}), ("-o --output", {"default": "mixing_jobs.json"}), ("--per-slice", {"type": int, "default": 5}), only, ("--job-prefix", {"default": "job"}))
    command(fileset, ("inputs", {"nargs": "+"}), ("-o --output", {"default": "fileset.json"}), ("--redirector", {"default": "root://xcache/"}), tree)
    command(folder, ("--base", {"required": True}), ("-o --outdir", {"default": "."}), only, tree, ("--strip-at", {"default": ""}), ("--redirector", {"default": ""}))
    a = p.parse_args(argv)
    a.run(SparkSession.builder.appName("axisforge").getOrCreate(), a)


if __name__ == "__main__":
    main()
