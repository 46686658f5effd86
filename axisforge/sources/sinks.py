"""Where results go: events and pseudo-events as Parquet, and the rows that describe them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axisforge import __version__
from axisforge.config import MixConfig, StitchConfig


def write_events(events: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists") -> None:
    writer = events.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def mix_meta(spark: SparkSession, config: MixConfig, lumi: float | None = None, xs_pb: float | None = None, n_original: float | None = None, xs_weight: float | None = None) -> DataFrame:
    """One row of numbers that describe a mixing run; what isn't known is 0."""
    known = [0.0 if v is None else float(v) for v in (lumi, xs_pb, n_original, xs_weight)]
    return spark.createDataFrame([(config.thrust_scan_points, config.hist_bins, config.n_jets, *known)], "thrust_scan_points int, hist_bins int, n_jets int, lumi double, xs_pb double, n_original double, xs_weight double")


def stitch_meta(totals: DataFrame, config: StitchConfig) -> DataFrame:
    """The numbers that describe a stitching run, from the totals of its library (n_hemispheres, total_budget)."""
    return totals.select(F.lit(config.seed).cast("long").alias("rng_seed"), F.lit(config.max_distance).cast("double").alias("max_distance"), F.lit(config.pt_tolerance).cast("double").alias("pt_tolerance"), F.col("n_hemispheres").cast("long"), F.col("total_budget").cast("long").alias("budget0"))


def labels(spark: SparkSession, config: MixConfig | None = None, dataset: str | None = None, passed: dict[str, str] | None = None) -> DataFrame:
    """(name, label, n): versions and the dataset as categories that were counted once; `passed` carries those of the input on."""
    rows = [("version", config.version if config else __version__, 1.0)]
    rows += [("dataset", dataset, 1.0)] if dataset else []
    rows += [("slimmer_version" if k == "version" else k, v, 1.0) for k, v in (passed or {}).items()]
    return spark.createDataFrame(rows, "name string, label string, n double")
