"""Rounding, percentages and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.functions.clock import MICROS_PER_SECOND


def round2(value: Column) -> Column:
    """Two decimals, rounding the binary value scaled by 100 rather than its decimal text."""
    return F.round(value.cast("double") * 100.0, 0) / 100.0


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole in doubles; NULL over an empty whole."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def delay_totals(micros: Column, times: Column | None = None) -> list[Column]:
    """Aggregates that add up exactly in any order, so they may be combined in steps.

    `times` counts a row that often.

    Seconds and the remainder are summed apart: a bigint of microseconds would
    overflow after about 10^10 events a quarter of an hour late.
    """
    weight = F.lit(1) if times is None else times
    counted = F.sum(F.when(micros.isNotNull(), weight).otherwise(0))
    return [
        F.sum(F.call_function("div", micros, F.lit(MICROS_PER_SECOND)) * weight).alias("sum_sec"),
        F.sum(micros % MICROS_PER_SECOND * weight).alias("sum_us"),
        (F.count(micros) if times is None else F.coalesce(counted, F.lit(0))).alias("n_delay"),
    ]


def combine_totals(weight: Column | None = None) -> list[Column]:
    """Second step over `delay_totals`, each row counted `weight` times.

    Weighted sums are products of two counts' size and need more than a bigint.
    """

    def total(column: str) -> Column:
        if weight is None:
            return F.sum(column).alias(column)
        return F.sum(F.col(column).cast("decimal(38,0)") * weight).alias(column)

    return [total(c) for c in ("sum_sec", "sum_us", "n_delay")]


def mean_minutes() -> Column:
    """Mean delay in minutes from `delay_totals`; NULL when no delay was counted."""
    seconds = F.col("sum_sec").cast("double") + F.col("sum_us").cast("double") / MICROS_PER_SECOND
    return F.try_divide(seconds, F.col("n_delay").cast("double")) / 60.0
