"""From events to pseudo-events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.config import MixConfig, StitchConfig
from axisforge.operators import hemisphere, histogram, match, stitch, thrust
from axisforge.operators.weights import hash_budget
from axisforge.sources.scratch import written


def mix(events: DataFrame, config: MixConfig | None = None, weight: Column | None = None, jets: str = "jets") -> DataFrame:
    """Events of exactly n_jets jets with thrust_axis_phi, thrust, xs_weight and Hemisphere; a narrow plan.

    The cut comes first: it isn't pushed through the kernel.
    """
    config = config or MixConfig()
    kept = events.where(F.size(jets) == config.n_jets)
    kept = kept.withColumn("xs_weight", (F.lit(1.0) if weight is None else weight).cast("float"))
    return hemisphere.with_hemispheres(thrust.with_thrust(kept, config.thrust_scan_points, jets), jets, F.col("xs_weight"))


def mix_histograms(mixed: DataFrame, config: MixConfig | None = None) -> DataFrame:
    """The histograms of a mixed table, which is read twice: persist or write it first."""
    config = config or MixConfig()
    halves = mixed.select(F.explode("Hemisphere").alias("h")).select(F.col("h.n_jets").alias("n_jets"))
    return histogram.histogram(mixed, "thrust_axis_phi", config.hist_bins, 0.0, 3.141592653589793, "thrust_axis_phi").unionByName(histogram.histogram(halves, "n_jets", 20, 0.0, 20.0, "hemisphere_njets"))


@dataclass
class Stitched:
    library: DataFrame
    draws: DataFrame
    events: DataFrame
    distances: DataFrame
    cutflow: DataFrame


def event_number(keys: list[str]) -> Column:
    """One non-negative long in the order of the keys, from which two ids are made; an error where a key is null, negative or too large for it."""
    room = 1 << 62 if len(keys) == 1 else 1 << (62 // len(keys))
    out = F.lit(0).cast("long")
    for k in keys:
        key = F.col(k).cast("long")
        fits = key.isNotNull() & (key >= 0) & (key < F.lit(room))
        wrong = F.raise_error(F.concat(F.lit(f"{k} must be from 0 to {room - 1}, not "), F.coalesce(key.cast("string"), F.lit("null")))).cast("long")
        out = out * F.lit(room if len(keys) > 1 else 1) + F.when(fits, key).otherwise(wrong)
    return out


def stitched(mixed: DataFrame, scope: str, keys: list[str], config: StitchConfig | None = None, random: str = "pcg64", jets: str = "jets") -> Stitched:
    """The pseudo-events of each library (equal `scope`) of mixed events.

    keys identify an event within a library, in its order. random: `pcg64` draws budgets and
    seeds one after another; with `hash` budgets depend on the event and side, and draws on
    their turn. The library and the draws are written once, so that all results agree. A
    library is one task, which holds a few hundred bytes for each hemisphere; jobs bound it.
    """
    config = config or StitchConfig()
    lib = hemisphere.library(mixed, [scope, *keys], config.jets_per_hemisphere, jets)
    lib = lib.withColumn("ev", event_number(keys)).withColumn("id", F.col("ev") * 2 + F.col("slot"))
    if random == "hash":
        lib = lib.withColumn("budget", hash_budget(F.col("weight"), F.col("ev"), F.col("side"), config.seed))
    lib = written(lib, "library")
    near = match.nearest_candidates(lib, lib, [scope], stitch.NEAR, config.max_distance, config.pt_tolerance)
    draws = written(stitch.stitch_nearest(lib, near, scope, config.seed, random, config.max_distance, config.pt_tolerance), "library-draws")
    events = stitch.pseudo_events(draws, lib, [scope], config.scan_points)
    found = draws.where(F.col("match").isNotNull()).select(F.col("distance").cast("float").alias("match_distance"))
    high = config.max_distance if config.max_distance is not None else 10.0
    distances = histogram.histogram(found, "match_distance", config.distance_bins, 0.0, high, "match_distance")
    counted = lib if "budget" in lib.columns else stitch.with_drawn_budgets(lib, scope, config.seed)
    return Stitched(lib, draws, events, distances, histogram.stitch_cutflow(counted, draws, [scope]))
