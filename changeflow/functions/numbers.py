"""Integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def floor_div(value: Column, by: int) -> Column:
    """Floor of ``value / by``, in integers: a division in doubles is off beyond 2^53."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def span_of(value: Column, width: int) -> Column:
    """Number of the span of ``width`` that ``value`` lies in. Never null, so that joins on it need no null
    filter of their own and both sides can share one shuffle."""
    return F.coalesce(floor_div(value.cast("bigint"), width), F.lit(0).cast("bigint"))
