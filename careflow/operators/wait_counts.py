"""Mergeable exact wait statistics: visits counted per wait, with additive sums beside them.

``visit_cells`` is the one fact-sized aggregation of a build: a row per (date, hour, segment,
department, wait minute) with the number of visits and the sums that the measures need. A median
cannot be merged from medians, but it can from counts per value, so the cells of any days, hours
or segments add up to the state of their union: ``merged`` sums the counts, ``quantiles`` reads
exact order statistics off them. Everything behind the fact (hourly, daily and segment marts, calendar
bounds, roll-up measures, quantiles of any mixture of dimensions) reads cells or ``wait_counts``, the
cells without the hour, and a refresh of a few dates replaces those dates' cells only.

A cell's rows number at most the distinct whole-minute waits of its group, however many visits it
holds, and partial aggregation leaves a map task one row per cell: a date or segment with a third
of all visits is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions.stats import ratio

CELL_KEYS = ("visit_date", "visit_hour", "segment_key", "department_referral", "wait_minutes",
             "wait_implausible_flag", "within_target_flag")
COUNT_KEYS = tuple(k for k in CELL_KEYS if k != "visit_hour")
HOUR_KEYS = tuple(k for k in CELL_KEYS if k not in ("segment_key", "department_referral"))
SUMS = ("visits", "admissions", "responses", "score_sum")


def visit_cells(fct: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per cell: visits, admissions, satisfaction responses and the sum of the scores.
    The two flags follow from the wait and add no rows."""
    return _counted(fct, list(dict.fromkeys([*CELL_KEYS, *extra_keys])))


def _counted(fct: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fct.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_if(F.col("admitted_flag")).alias("admissions"),
        F.count("satisfaction_score").alias("responses"),
        F.sum("satisfaction_score").alias("score_sum"),
    )


def as_cells(rows: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Cells as they are; visits as cells."""
    return rows if set(SUMS) <= set(rows.columns) else visit_cells(rows, extra_keys)


def wait_counts(cells: DataFrame) -> DataFrame:
    """The cells without the hour."""
    return cells.groupBy(*COUNT_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def merged_cells(parts: DataFrame) -> DataFrame:
    """One row per cell from the cells of parts of the visits."""
    return parts.groupBy(*CELL_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def hour_counts(rows: DataFrame) -> DataFrame:
    """The cells without segment and department, from cells or straight from visits: bounded by the
    calendar's hours and the waits, where the cells of a long series are nearly as many as its
    visits. All that the hourly and the daily mart and the calendar need."""
    if set(SUMS) <= set(rows.columns):
        return rows.groupBy(*HOUR_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return _counted(rows, HOUR_KEYS)


def plausible_wait() -> Column:
    """The wait where it is plausible, else NULL (a NULL wait has a NULL flag)."""
    return F.when(~F.col("wait_implausible_flag"), F.col("wait_minutes"))


def merged(states: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """(keys, wait_minutes, visits) over the plausible waits: the state of coarser groups."""
    rows = states.where(~F.col("wait_implausible_flag") & F.col("wait_minutes").isNotNull())
    return rows.groupBy(*keys, "wait_minutes").agg(F.sum("visits").alias("visits"))


def quantiles(counts: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact, interpolated order statistics per group of a merged state."""
    return counts.groupBy(*keys).agg(*[
        F.percentile("wait_minutes", p, F.col("visits")).cast("double").alias(name) for name, p in probs.items()])


def total(column: str, where: Column | None = None) -> Column:
    """The sum of an additive column, 0 over no rows."""
    x = F.col(column) if where is None else F.when(where, F.col(column))
    return F.coalesce(F.sum(x), F.lit(0)).cast("bigint")


def mean_wait(where: Column | None = None) -> Column:
    """The mean of the plausible waits, every visit counting once."""
    w = plausible_wait()
    n = F.when(w.isNotNull(), F.col("visits"))
    return ratio(F.sum(w.cast("double") * n), F.sum(n))


def sd_wait() -> Column:
    """The sample standard deviation of the plausible waits; NULL below two."""
    w = plausible_wait().cast("double")
    n = F.when(w.isNotNull(), F.col("visits"))
    count, s, q = F.sum(n).cast("double"), F.sum(w * n), F.sum(w * w * n)
    return F.when(count >= 2, F.sqrt(F.greatest(F.try_divide(q - s * s / count, count - 1), F.lit(0.0))))


def pct_within_target() -> Column:
    eligible = F.col("wait_minutes").isNotNull() & ~F.col("wait_implausible_flag")
    return ratio(F.sum(F.when(F.col("within_target_flag"), F.col("visits")).otherwise(0)),
                 F.sum(F.when(eligible, F.col("visits")).otherwise(0)))


def rates() -> dict[str, Column]:
    """The shares and means of the additive sums, per group."""
    return {
        "admission_rate": ratio(F.sum("admissions"), F.sum("visits")),
        "pct_within_target": pct_within_target(),
        "satisfaction_response_rate": ratio(F.sum("responses"), F.sum("visits")),
        "mean_satisfaction": ratio(F.sum("score_sum"), F.sum("responses")),
    }
