"""Histograms with regular bins, cutflows and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The steps of the stitching cutflow.
STEPS = ("hemispheres", "total budget", "draws", "pseudo-events", "failed matches")


def histogram(rows: DataFrame, value: str, bins: int, low: float, high: float, name: str) -> DataFrame:
    """(hist, bin, low, high, n): bins 1 to `bins`, each with its lower edge inside, 0 below and bins + 1 above.

    All bins are there, also those without rows. Nulls and NaN aren't counted.
    """
    x = F.col(value).cast("double")
    at = F.when(x < low, 0).when(x >= high, bins + 1).otherwise(F.least(F.floor((x - low) * bins / (high - low)), F.lit(bins - 1)) + 1)
    counts = rows.where(x.isNotNull() & ~F.isnan(x)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = rows.sparkSession.range(bins + 2).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    edge = lambda k: F.lit(low) + k * F.lit(width)
    out = spine.join(F.broadcast(counts), "bin", "left")
    return out.select(
        F.lit(name).alias("hist"), "bin",
        F.when(F.col("bin") > 0, edge(F.col("bin") - 1)).alias("low"), F.when(F.col("bin") <= bins, edge(F.col("bin"))).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def mixer_cutflow(events: DataFrame, n_jets: int, jets: str = "jets") -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n_read"), F.count_if(F.size(jets) == n_jets).alias("n_pass"))


def library_totals(lib: DataFrame, keys: list[str]) -> DataFrame:
    """What a library holds (needs pt and budget), for each of keys."""
    grouped = lib.groupBy(*keys) if keys else lib.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_hemispheres"), F.count_if(F.col("budget") > 0).alias("n_available"), F.sum("budget").alias("total_budget"), F.max("pt").alias("pt_max"))


def stitch_cutflow(lib: DataFrame, draws: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, step, n) for each of STEPS."""
    totals = lib.groupBy(*keys).agg(F.count(F.lit(1)).alias(STEPS[0]), F.sum("budget").cast("long").alias(STEPS[1]))
    counts = draws.groupBy(*keys).agg(*[c.alias(n) for c, n in zip((F.count(F.lit(1)), F.count_if(F.col("match").isNotNull()), F.count_if(F.col("match").isNull())), STEPS[2:], strict=True)])
    return totals.join(counts, keys, "left").na.fill(0, list(STEPS[2:])).unpivot(keys, list(STEPS), "step", "n")
