"""Events cut in two: the four-vectors of both hemispheres, and the library of those to recombine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.functions import kinematics as K

#: The names of what is stored as float; the others are n_jets, side, partner_eta and weight.
SUMS = ("px", "py", "pz", "energy", "pt", "eta", "phi", "mass", "pt_par", "pt_perp")


def _half(jets: Column, inside, axis: Column, side: Column) -> Column:
    """A struct of SUMS, n_jets and side for the jets that are inside; all zero for none."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("x", "y", "z", "e")], F.lit(0).alias("n"))
    add = lambda a, j: F.when(
        inside(j),
        F.struct((a.x + K.px(j.pt, j.phi)).alias("x"), (a.y + K.py(j.pt, j.phi)).alias("y"), (a.z + K.pz(j.pt, j.eta)).alias("z"), (a.e + K.energy(j.pt, j.eta, j.m)).alias("e"), (a.n + 1).alias("n")),
    ).otherwise(a)

    def finish(a: Column) -> Column:
        pt, c, s = K.hypot(a.x, a.y), F.cos(axis), F.sin(axis)
        values = (a.x, a.y, a.z, a.e, pt, K.pseudorapidity(pt, a.z), F.atan2(a.y, a.x), K.mass(a.e, a.x, a.y, a.z), a.x * c + a.y * s, -a.x * s + a.y * c)
        return F.struct(*[v.cast("float").alias(n) for v, n in zip(values, SUMS, strict=True)], a.n.alias("n_jets"), side.cast("int").alias("side"))

    return F.aggregate(jets, zero, add, finish)


def _pair(a: Column, b: Column, weight: Column, side=lambda h: h.side) -> Column:
    full = lambda own, other: F.struct(*[own[c].alias(c) for c in (*SUMS, "n_jets")], side(own).alias("side"), other.eta.alias("partner_eta"), weight.cast("float").alias("weight"))
    return F.array(full(a, b), full(b, a))


def with_hemispheres(events: DataFrame, jets: str = "jets", weight: Column | None = None) -> DataFrame:
    """events with Hemisphere, an array of two: the jets with a positive projection on the axis, and the others.

    The axis is thrust_axis_phi as stored (float). Both exist even if one has no jets.
    """
    axis = F.col("thrust_axis_phi").cast("double")
    forward = lambda j: K.px(j.pt, j.phi) * F.cos(axis) + K.py(j.pt, j.phi) * F.sin(axis) > 0
    out = events.withColumn("_plus", _half(F.col(jets), forward, axis, F.lit(1))).withColumn("_minus", _half(F.col(jets), lambda j: ~forward(j), axis, F.lit(-1)))
    out = out.withColumn("Hemisphere", _pair(F.col("_plus"), F.col("_minus"), F.lit(1.0) if weight is None else weight))
    return out.drop("_plus", "_minus")


def with_parent_hemispheres(events: DataFrame, jets: str = "jets", flag: str = "hemisphere") -> DataFrame:
    """As with_hemispheres, by the jets' flag (0 first, else second); a side is the sign of its projection."""
    axis = F.col("thrust_axis_phi").cast("double")
    halves = [_half(F.col(jets), inside, axis, F.lit(0)) for inside in (lambda j: j[flag] == 0, lambda j: j[flag] != 0)]
    out = events.withColumn("_seed", halves[0]).withColumn("_match", halves[1])
    side = lambda h: F.when(h.pt_par >= 0, 1).otherwise(-1).cast("int")
    return out.withColumn("Hemisphere", _pair(F.col("_seed"), F.col("_match"), F.lit(1.0), side)).drop("_seed", "_match")


def hemisphere_rows(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each hemisphere: keys, slot (0, 1) and its fields."""
    return events.select(*keys, F.posexplode("Hemisphere").alias("slot", "h")).select(*keys, "slot", "h.*")


def library(events: DataFrame, keys: list[str], n_jets: int = 3, jets: str = "jets") -> DataFrame:
    """The hemispheres of n_jets jets with those jets, and what matching needs as doubles.

    keys, slot, jets, pt, eta, partner_eta, side, weight, thrust_phi (again modulo pi, as a
    stored axis may exceed it), direction and query.
    """
    axis = F.col("thrust_axis_phi").cast("double")
    rows = events.select(*keys, F.col("thrust_axis_phi"), F.col(jets).alias("_jets"), F.posexplode("Hemisphere").alias("slot", "h")).where(F.col("h.n_jets") == n_jets)
    forward = lambda j: K.px(j.pt, j.phi) * F.cos(axis) + K.py(j.pt, j.phi) * F.sin(axis) > 0
    own = F.filter("_jets", lambda j: forward(j) == (F.col("h.side") > 0))
    phi = K.floored_mod(axis, K.PI)
    numbers = [F.col(f"h.{c}").cast("double").alias(c) for c in ("pt", "eta", "partner_eta", "weight")]
    return rows.select(*keys, "slot", own.alias("jets"), *numbers, F.col("h.side").alias("side"), phi.alias("thrust_phi"), K.directed_phi(phi, F.col("h.side")).alias("direction"), K.query_direction(phi, F.col("h.side")).alias("query"))
