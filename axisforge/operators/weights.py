"""Cross-section weights: which dataset a file belongs to, and what its events weigh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.functions import names

#: Dimension tables up to this many rows are broadcast; larger ones are left to the planner.
BROADCAST_ROWS = 100_000


def small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def infer_dataset(files: DataFrame, keys: DataFrame, path: str = "path") -> DataFrame:
    """files with dataset: the longest of keys (dataset) that the basename contains, the first by code point of equals; null for none.

    The names in a basename are its substrings, so files meet keys by equality: each basename
    is cut at the lengths that keys have.
    """
    base = names.basename(F.col(path))
    own = keys.select(F.col("dataset").alias("_key")).where("_key is not null").distinct()
    lengths = own.agg(F.collect_set(F.length("_key")).alias("_lengths"))  # one row: the distinct lengths of names
    n = [int(x) for x in (lengths.first()[0] or [])]
    places = lambda k: F.sequence(F.lit(1), F.greatest(F.length(base) - k + 1, F.lit(1)))
    of_length = lambda k: F.transform(places(k), lambda i: F.substring(base, i, F.lit(k)))
    cuts = F.flatten(F.array(*map(of_length, sorted(n)))) if n else F.array().cast("array<string>")
    one = files.select(path).distinct()
    met = one.select(path, F.explode(F.array_distinct(cuts)).alias("_cut")).join(small(own), F.col("_cut") == F.col("_key"))
    best = met.groupBy(path).agg(F.min_by("_key", F.struct(-F.length("_key"), "_key")).alias("dataset"))
    return files.drop("dataset").join(best, path, "left")


def event_weight(lumi: Column, xs_pb: Column, n_original: Column) -> Column:
    """lumi * xs_pb / n_original; null where it can't be had."""
    known = xs_pb.isNotNull() & (n_original > 0)
    return F.when(known, lumi * xs_pb / F.when(known, n_original))


def with_weight(files: DataFrame, cross_sections: DataFrame, lumi: float | Column = 1.0, strict: bool = False) -> DataFrame:
    """files (dataset, n_original) with xs_pb and xs_weight; 1.0 where no cross section is known, or an error if strict."""
    lumi = F.lit(lumi) if isinstance(lumi, int | float) else lumi
    out = files.join(small(cross_sections.select("dataset", "xs_pb")), "dataset", "left")
    weight = event_weight(lumi, F.col("xs_pb"), F.col("n_original"))
    missing = F.raise_error(F.concat(F.lit("no cross-section weight for "), F.coalesce("dataset", F.lit("an unknown dataset")))).cast("double") if strict else F.lit(1.0)
    return out.withColumn("xs_weight", F.coalesce(weight, missing))


def hash_uniform(event: Column, side: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the hemisphere and the seed alone, by integer arithmetic."""
    return F.pmod(F.pmod(event, F.lit(1_000_003)) * 69_621 + (side + 2) * 40_503 + seed * 9_973, F.lit(1_000_003)).cast("double") / 1_000_003.0


def hash_budget(weight: Column, event: Column, side: Column, seed: int = 42) -> Column:
    """Stochastic rounding of a weight: its floor, and one more with the chance of its fraction."""
    floor = F.floor(weight)
    return (floor + (hash_uniform(event, side, seed) < weight - floor).cast("long")).cast("long")
