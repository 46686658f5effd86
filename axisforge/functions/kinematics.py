"""Kinematics of jets and hemispheres as column expressions, all in double precision."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI, TWO_PI = math.pi, 2 * math.pi


def px(pt: Column, phi: Column) -> Column:
    return pt * F.cos(phi)


def py(pt: Column, phi: Column) -> Column:
    return pt * F.sin(phi)


def pz(pt: Column, eta: Column) -> Column:
    return pt * F.sinh(eta)


def energy(pt: Column, eta: Column, m: Column) -> Column:
    p = pt * F.cosh(eta)
    return F.sqrt(p * p + m * m)


def asinh(x: Column) -> Column:
    """Odd by construction: Spark's own loses digits for negative arguments."""
    return F.signum(x) * F.asinh(F.abs(x))


def hypot(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def pseudorapidity(pt: Column, pz: Column) -> Column:
    """0 where pt is 0, whatever pz."""
    return F.when(pt > 0, asinh(pz / F.when(pt > 0, pt))).otherwise(F.lit(0.0))


def mass(e: Column, px: Column, py: Column, pz: Column) -> Column:
    return F.sqrt(F.greatest(e * e - (px * px + py * py + pz * pz), F.lit(0.0)))


def floored_mod(x: Column, y: float) -> Column:
    """x modulo y > 0 with the sign of y."""
    return F.pmod(x, F.lit(y))


def directed_phi(thrust_phi: Column, side: Column) -> Column:
    """Where a hemisphere points, in [0, 2 pi): along the axis, or against it for a negative side."""
    along = floored_mod(thrust_phi, TWO_PI)
    return F.when(side >= 0, along).otherwise(floored_mod(along + PI, TWO_PI))


def query_direction(thrust_phi: Column, side: Column) -> Column:
    """Opposite to where the hemisphere points."""
    return floored_mod(directed_phi(thrust_phi, side) + PI, TWO_PI)


def delta_phi(a: Column, b: Column) -> Column:
    """The angle between directions, folded to [0, pi]."""
    d = floored_mod(F.abs(a - b), TWO_PI)
    return F.least(d, TWO_PI - d)


def distance_squared(direction: Column, query: Column, eta: Column, partner_eta: Column) -> Column:
    d, e = delta_phi(direction, query), eta - partner_eta
    return d * d + e * e
