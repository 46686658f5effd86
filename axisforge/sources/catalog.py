"""Catalogs of files: lists as text, filesets as JSON, folders, cross sections, and event tables."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from axisforge.functions import names
from axisforge.sources.scratch import written

FILES = T.StructType([T.StructField(c, T.StringType()) for c in ("dataset", "path", "tree")])
_FILESET = T.MapType(T.StringType(), T.StructType([T.StructField("files", T.MapType(T.StringType(), T.StringType()))]))


def filelist_lines(lines: DataFrame, redirector: str = "root://xcache/", tree: str = "events") -> DataFrame:
    """(path of the list, path, tree, skipped) from rows (source, value): blanks and comments go, local store paths get the redirector.

    skipped marks lines of another form: they have no path.
    """
    line = F.trim("value", F.lit(" \t\r\n\f\v"))
    path = F.when(line.startswith("root://"), line).when(line.startswith("/store/"), names.with_redirector(line, redirector))
    out = lines.where((line != "") & ~line.startswith("#"))
    return out.select("source", path.alias("path"), F.lit(tree).alias("tree"), path.isNull().alias("skipped"))


def read_filelists(spark: SparkSession, paths: str | list[str], redirector: str = "root://xcache/", tree: str = "events") -> DataFrame:
    """(dataset, path, tree) of text lists, a dataset for each list; lists without a valid path give none."""
    lines = spark.read.text(paths).select(F.input_file_name().alias("source"), "value")
    found = filelist_lines(lines, redirector, tree).where(~F.col("skipped"))
    return found.select(names.list_label(F.col("source")).alias("dataset"), "path", "tree").distinct()


def read_filesets(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(dataset, path, tree, at) of fileset JSONs {name: {"files": {path: tree}}}, files or folders of them; at orders them by argument, within a folder by name."""
    out = None
    for i, path in enumerate([paths] if isinstance(paths, str) else paths):
        raw = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "false").text(path, wholetext=True)
        one = raw.select(F.struct(F.lit(i).alias("argument"), F.input_file_name().alias("file")).alias("at"), F.from_json("value", _FILESET, {"mode": "FAILFAST"}).alias("m"))
        out = one if out is None else out.unionByName(one)
    out = out.select("at", F.explode("m").alias("dataset", "f"))
    return out.select("dataset", F.explode("f.files").alias("path", "tree"), "at").select("dataset", "path", "tree", "at")


def list_folder(spark: SparkSession, base: str, ending: str = ".root", only: list[str] | None = None, strip_at: str = "", tree: str = "events", redirector: str = "") -> DataFrame:
    """(dataset, path, tree) of the files below each subfolder of base, named after the subfolder up to the marker; files without content are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{ending}").load(base).select("path")
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/*", "/")
    root = "/" + base.split("://", 1)[-1].strip("/")
    below = F.substring(plain, F.lit(len(root) + 2), F.length(plain))
    folder = F.substring_index(below, "/", 1)
    rows = found.where(F.instr(below, "/") > 0)
    if only:
        rows = rows.where(F.exists(F.array(*map(F.lit, only)), lambda s: folder.contains(s)))
    path = names.with_redirector(plain, redirector) if redirector else plain
    return rows.select(names.label_before(folder, strip_at).alias("dataset"), path.alias("path"), F.lit(tree).alias("tree"))


def write_fileset(files: DataFrame, path: str, group: str = "dataset") -> None:
    """A fileset JSON of a catalog, which is small: one record for each file of a campaign, streamed group by group."""
    with open(path, "w") as f:
        f.write("{")
        last, first_path = None, True
        for r in files.select(group, "path", "tree").orderBy(group, "path").toLocalIterator():
            if r[0] != last:
                f.write(("" if last is None else "}}, ") + f'{json.dumps(r[0])}: {{"files": {{')
                last, first_path = r[0], True
            f.write(("" if first_path else ", ") + f"{json.dumps(r[1])}: {json.dumps(r[2])}")
            first_path = False
        f.write("}" if last is None else "}}}")


#: Fixed value: the usual name of the table of cross sections.
CROSS_SECTIONS = "mj_samples_xs.json"


def locate_cross_sections(explicit: str | None = None, variable: str = "AXISFORGE_XS_JSON", name: str = CROSS_SECTIONS, sibling: str | None = None) -> str | None:
    """The first that exists of: the given path, that of the environment variable, the file here, and one in a sibling folder of any folder above."""
    here = Path.cwd()
    options = [explicit, os.environ.get(variable), here / name, *((p / sibling / name) for p in here.parents if sibling)]
    return next((str(o) for o in options if o and Path(o).is_file()), None)


def read_cross_sections(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, xs_pb) of a JSON {dataset: {"xs_pb": number}}; null where the number is missing."""
    schema = T.MapType(T.StringType(), T.StructType([T.StructField("xs_pb", T.DoubleType())]))
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("m"))
    return raw.select(F.explode("m").alias("dataset", "x")).select("dataset", F.col("x.xs_pb").alias("xs_pb"))


def find_table(spark: SparkSession, base: str, names: list[str]) -> str | None:
    """The first Parquet table of that name that is in the folder base."""
    for name in names:
        for place in (f"{base}/{name}", f"{base}/{name}.parquet"):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
            if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
                return place
    return None


def read_events(spark: SparkSession, base: str, tree: str = "events", schema: T.StructType | None = None) -> DataFrame:
    """The Parquet table `tree` in the folder base; for `events`, `Events` will do. Without one, an empty table of the schema."""
    place = find_table(spark, base, [tree, "Events"] if tree == "events" else [tree])
    return spark.read.parquet(place) if place else spark.createDataFrame([], schema or T.StructType([]))


def with_entries(events: DataFrame, name: str = "entry") -> DataFrame:
    """events with their place in the table, from 0 and without gaps, in the order of its files. Only the counts of partitions meet."""
    at, part = F.col("_at"), F.call_function("shiftright", F.col("_at"), F.lit(33))
    rows = written(events.withColumn("_at", F.monotonically_increasing_id()), "entries").withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return rows.join(counts, "_part").withColumn(name, at.bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_off")).drop("_at", "_part", "_off")


@dataclass
class InputRecords:
    """What an input folder says of itself beside its events."""

    cutflow: DataFrame | None  # (bin int, n double), bin 0 the events that there were to begin with
    version: str | None

    @property
    def n_original(self) -> float | None:
        """The events of bin 0, which weights are divided by; None without a cutflow."""
        first = self.cutflow.where("bin = 0").first() if self.cutflow is not None else None
        return float(first.n) if first else None


def read_records(spark: SparkSession, base: str) -> InputRecords:
    """From the tables `cutflow` (bin, n) and `version` (label) of an input folder, each of which may be missing."""
    cutflow, version = (find_table(spark, base, [name]) for name in ("cutflow", "version"))
    label = spark.read.parquet(version).select("label").first() if version else None
    return InputRecords(spark.read.parquet(cutflow).select("bin", "n") if cutflow else None, label[0] if label else None)
