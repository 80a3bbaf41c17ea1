"""Robust statistics over small arrays, as SQL expressions.

Intermediate values are bound once with a one-element ``transform``: Catalyst
inlines projected columns into filters pushed below them, so a median referenced
several times would otherwise be recomputed per reference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dampen(z: Column, noise_floor: float = 1.2, factor: float = 0.1) -> Column:
    """abs(z) when it exceeds the noise floor, else a tenth of it."""
    a = F.abs(z)
    return F.when(a > noise_floor, a).otherwise(a * factor)


def _dbl(x: float) -> str:
    return f"{float(x)!r}D"


def _median_sql(b: str) -> str:
    return (f"((get({b}, CAST(floor((size({b}) - 1) / 2) AS INT)) "
            f"+ get({b}, CAST(floor(size({b}) / 2) AS INT))) / 2)")


def robust_z_sql(value: str, history: str, floor: float, mad_constant: float = 1.4826,
                 cap: float = 20.0, min_history: int = 3, tag: str = "") -> str:
    """(value - median) / max(c * MAD, floor), capped to +-cap; 0 when the
    history holds fewer than ``min_history`` values. One SQL expression, parsed
    once on the JVM side; ``value`` and ``history`` are SQL expressions, ``tag`` keeps
    lambda names unique."""
    b, m, d, ds, y = (f"{v}_{tag}" for v in ("b", "m", "d", "ds", "y"))
    mad = (f"get(transform(array(array_sort(transform({b}, {y} -> abs({y} - {m})))), "
           f"{ds} -> {_median_sql(ds)}), 0)")
    z = (f"greatest({_dbl(-cap)}, least({_dbl(cap)}, "
         f"(CAST({value} AS DOUBLE) - {m}) / greatest({d} * {_dbl(mad_constant)}, {_dbl(floor)})))")
    with_median = f"get(transform(array({mad}), {d} -> {z}), 0)"
    body = (f"CASE WHEN size({b}) < {int(min_history)} THEN CAST(0 AS DOUBLE) "
            f"ELSE get(transform(array({_median_sql(b)}), {m} -> {with_median}), 0) END")
    return (f"get(transform(array(array_sort(transform({history}, x_{tag} -> CAST(x_{tag} AS DOUBLE)))), "
            f"{b} -> {body}), 0)")


def robust_z(value: str, history: str, floor: float, params=None) -> Column:
    """Robust z of the SQL expression ``value`` against an array of earlier values,
    with the detector's MAD constant, cap and minimum history (``Params``); ``floor``
    is the signal's MAD floor. No warm-up gate."""
    from burstwatch.params import DEFAULT

    p = params or DEFAULT
    return F.expr(robust_z_sql(value, history, floor, p.mad_constant, p.z_cap, p.min_history))


def array_median(array: str) -> Column:
    """Median of an array (SQL expression): the middle value, or the mean of the two
    middle values for an even count; null for an empty array."""
    return F.expr(f"get(transform(array(array_sort({array})), b -> {_median_sql('b')}), 0)")
