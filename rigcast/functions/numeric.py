"""Numeric column functions: text-to-number coercion and the power formulas."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's number parser accepts a trailing float/double suffix ("5f", "5d"), the
# pandas coercion does not. Such strings are turned into null before the cast.
_JAVA_SUFFIX = r"^\s*[+-]?[0-9.].*[fFdD]\s*$"


def coerce_double(c: Column | str) -> Column:
    """Text -> double with the lenient rule of a "coerce" conversion.

    Unparsable text becomes null (never an error, ANSI mode or not); "NaN"
    becomes NaN, "inf" stays infinite, surrounding blanks are ignored.
    """
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(s.rlike(_JAVA_SUFFIX), F.lit(None).cast("double")).otherwise(
        s.try_cast("double"))


def mech_power(speed: Column, torque: Column) -> Column:
    """Mechanical power in kW from rpm and Nm, evaluated left to right."""
    return speed * torque * F.lit(math.pi) / F.lit(30.0) / F.lit(1e3)


def abs_mech_power(speed: Column, torque: Column) -> Column:
    return F.abs(mech_power(speed, torque))


def hyd_power(pressure: Column, flow: Column) -> Column:
    """Hydraulic power in kW from bar and l/min, evaluated left to right."""
    return pressure * F.lit(1e5) * flow * F.lit(1e-3) / F.lit(60.0) / F.lit(1e3)


_KINDS = {"mech": mech_power, "abs_mech": abs_mech_power, "hyd": hyd_power}


def power_expr(kind: str, a: Column, b: Column) -> Column:
    try:
        return _KINDS[kind](a, b)
    except KeyError:
        raise ValueError(f"unknown power kind {kind!r}") from None
