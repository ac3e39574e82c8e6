"""Percent-of-schedule keys, in exact integer arithmetic.

The planner maps day ``i`` of a ``d``-day schedule to ``round(i / d, 2)``
(Python's ``round`` on the binary double) and the curve maps its completion
time ``p`` to ``numpy.round(p, 2)`` (``rint(p * 100) / 100``). Both produce
the double nearest to ``k / 100`` for an integer ``k``, so curve points and
schedule days are matched on the integer ``k`` ("percent key") instead of
on doubles.

Away from ties ``k = floor(100 * i / d + 1/2)``. At an exact half-percent
(``200 * i / d = t`` with ``t`` odd) the result depends on which side of
``t / 200`` the binary double falls; those 100 cases are a fixed table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tie_percent(t: int) -> int:
    """Percent key of the exact half-percent ``t / 200`` (t odd), per Python rounding."""
    return int(round(round(t / 200, 2) * 100))


# The percent key of each half-percent tie t = 1, 3, ..., 199
# (in that order), derived from the rule above when the module loads.
TIE_PERCENT: list[int] = [_tie_percent(t) for t in range(1, 200, 2)]

MAX_PERCENT_KEY = 100


def _tie_lookup(t: Column) -> Column:
    """TIE_PERCENT[t] for odd t in 1..199 (element_at is 1-based)."""
    table = F.array(*[F.lit(v) for v in TIE_PERCENT])
    return F.try_element_at(table, (_idiv(t - 1, F.lit(2)) + 1).cast("int"))


def _idiv(a: Column, b: Column) -> Column:
    """Integer floor division of non-negative longs."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def schedule_percent_key(day: Column, duration: Column) -> Column:
    """Integer percent key of ``round(day / duration, 2)`` (0 <= day < duration)."""
    i = day.cast("long")
    d = duration.cast("long")
    scaled = i * 200
    exact = F.pmod(scaled, d) == 0
    t = _idiv(scaled, d)
    is_tie = exact & (F.pmod(t, F.lit(2)) == 1)
    return F.when(is_tie, _tie_lookup(t)).otherwise(_idiv(scaled + d, d * 2)).cast("long")


def _tie_rounds_down(k: int) -> bool:
    """Whether the exact half-percent just below key ``k`` rounds down to ``k - 1``."""
    return 1 <= k <= MAX_PERCENT_KEY and TIE_PERCENT[k - 1] != k


def _first_day(k: Column, tie_down: Column, d: Column) -> Column:
    """First day ``i >= 0`` whose percent key is at least ``k``.

    For k >= 1 that is ``ceil((2k - 1) * d / 200)``, one later when that day
    is an exact tie that rounds down; for k = 0 it is day 0.
    """
    n = (k * 2 - 1) * d
    first = _idiv(n + 199, F.lit(200).cast("long")) + F.when(
        (F.pmod(n, F.lit(200)) == 0) & tie_down, 1).otherwise(0)
    return F.when(k == 0, F.lit(0).cast("long")).otherwise(first)


def percent_first_days(duration: Column) -> Column:
    """array<(PCT_KEY, DAY)>: each percent key that occurs in a ``duration``-day schedule
    with the first day that carries it.

    Keys are non-decreasing in the day, so with ``i_k`` the first day whose key
    is at least ``k``, day ``i_k`` carries key ``k`` exactly when ``i_k < d``
    and ``i_k < i_(k+1)`` (or k = 100). Both days come from the closed form
    above, with the tie flags of k and k + 1 attached to the key as literals:
    at most 101 entries and no per-day rows.
    """
    d = duration.cast("long")
    keys = F.array(*[
        F.struct(F.lit(k).cast("long").alias("PCT_KEY"),
                 F.lit(_tie_rounds_down(k)).alias("TIE_K"),
                 F.lit(_tie_rounds_down(k + 1)).alias("TIE_NEXT"))
        for k in range(MAX_PERCENT_KEY + 1)])
    days = F.transform(keys, lambda x: F.struct(
        x["PCT_KEY"].alias("PCT_KEY"), _first_day(x["PCT_KEY"], x["TIE_K"], d).alias("DAY"),
        _first_day(x["PCT_KEY"] + 1, x["TIE_NEXT"], d).alias("NEXT_DAY")))
    kept = F.filter(days, lambda x: (x["DAY"] < d) & ((x["PCT_KEY"] == MAX_PERCENT_KEY) | (x["DAY"] < x["NEXT_DAY"])))
    return F.transform(kept, lambda x: F.struct(x["PCT_KEY"].alias("PCT_KEY"), x["DAY"].alias("DAY")))


def curve_percent_key(percent: Column) -> Column:
    """Integer key of ``numpy.round(p, 2)``: half-to-even on ``p * 100``."""
    return F.rint(percent.cast("double") * 100).try_cast("long")


def leading_code(text: Column) -> Column:
    """Leading code of a label (``^[A-Z0-9]+``); null when the label has none."""
    return F.nullif(F.regexp_extract(text, r"^([A-Z0-9]+)", 1), F.lit(""))
