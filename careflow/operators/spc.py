"""M8: statistical process control over a daily series.

* XmR chart on the daily plausible median wait: centre = mean of the daily values,
  sigma = mean moving range / d2, UCL = centre + k*sigma, LCL = max(centre - k*sigma, 0).
  Rules, first hit wins: point beyond a limit; the ``run_length``-th (and later)
  consecutive observed day on the same side of the centre; at least 2 of the last 3
  rows (shorter at the start) beyond 2 sigma on the same side.
* p-chart on the daily admission rate: pooled centre, per-day limits from that day's
  volume, capped to [0, 1], with a flag when a cap was applied.

``series_keys`` names the columns that identify independent series (none = one series
for the whole input). The run rules need each day's predecessors, so the series is
scanned in calendar-year segments: windows are ``partitionBy(series_keys, year)`` with
two halo rows per segment, and what crosses a year boundary (positions, a run's start)
goes through per-year tables of one row per series and year. No window partition holds
more than 368 rows, and no task a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.functions.stats import ratio
from careflow.operators import wait_counts as wc
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.session import checkpoint_dir

POINT_BEYOND_LIMIT = "point_beyond_limit"
TWO_OF_THREE = "two_of_three_beyond_2sigma"
NO_DATE_BUCKET = 1_000_000

DAILY_OPS_COLUMNS = [
    "visit_date", "visits", "admissions", "median_wait_minutes", "p90_wait_minutes",
    "wait_centre_line", "wait_ucl", "wait_lcl", "spc_signal", "admission_rate",
    "admit_centre_line", "admit_ucl", "admit_lcl", "admit_limits_clipped", "admit_signal",
]


def daily_series(rows: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Visits, admissions, plausible median and P90 wait per observed day, from the cells
    (or from visits)."""
    w = wc.plausible_wait()
    return wc.as_cells(rows, series_keys).groupBy(*series_keys, "visit_date").agg(
        F.sum("visits").alias("visits"),
        F.sum("admissions").alias("admissions"),
        F.percentile(w, 0.5, F.col("visits")).cast("double").alias("median_wait_minutes"),
        F.percentile(w, 0.9, F.col("visits")).cast("double").alias("p90_wait_minutes"),
    )


def _join_ns(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Inner equi-join on ``cols`` where NULL matches NULL (a NULL series key or the
    NULL-date bucket of leniently parsed input must not drop rows); planned as a hash
    join like any equi-join."""
    renamed = right.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(cols)],
                           *[c for c in right.columns if c not in cols])
    cond = [left[c].eqNullSafe(renamed[f"_r{i}"]) for i, c in enumerate(cols)]
    return left.join(renamed, cond).drop(*[f"_r{i}" for i in range(len(cols))])


def _attach(df: DataFrame, stats: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Add per-series statistics: an equi-join on the series keys, or, for a single
    series, scalar subqueries (a join on no keys would be a nested-loop join)."""
    if keys:
        return _join_ns(df, stats.select(*keys, *cols), keys)
    return df.select("*", *[stats.select(c).scalar().alias(c) for c in cols])


def _bucketed(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each series split into calendar-year buckets, with their 1-based global
    position in the series and the two rows that precede each bucket copied into it as
    ``_halo`` rows, so that windows partitioned by (series, year) see each row's two
    predecessors.

    Positions come from per-year row counts (one row per series and year). The halo
    copies are emitted by the rows themselves: the last two rows of a year copy
    themselves into the next year, and the last row also into the year after that when
    the next year holds a single row. No join back onto the rows is needed.
    """
    # rows without a date come last in their series, as a bucket of their own
    d = daily.withColumn("_b", F.coalesce(F.year("visit_date"), F.lit(NO_DATE_BUCKET)))
    d = d.withColumn("_li", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("visit_date")))
    sizes = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_year = Window.partitionBy(*keys).orderBy("_b")
    years = sizes.select(
        *keys, "_b", "_n",
        F.coalesce(F.sum("_n").over(by_year.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lead("_b", 1).over(by_year).alias("_b1"),
        F.lead("_n", 1).over(by_year).alias("_n1"),
        F.lead("_b", 2).over(by_year).alias("_b2"),
    )
    d = _join_ns(d, years, [*keys, "_b"])
    last_two = F.col("_li") >= F.col("_n") - 1
    last = F.col("_li") == F.col("_n")
    copies = F.array(
        F.struct(F.col("_b").alias("b"), F.lit(False).alias("h")),
        F.when(last_two & F.col("_b1").isNotNull(), F.struct(F.col("_b1").alias("b"), F.lit(True).alias("h"))),
        F.when(last & (F.col("_n1") == 1) & F.col("_b2").isNotNull(),
               F.struct(F.col("_b2").alias("b"), F.lit(True).alias("h"))),
    )
    out = d.withColumn("_pos", F.col("_off") + F.col("_li")).withColumn(
        "_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    return out.withColumns({"_b": F.col("_copy.b"), "_halo": F.col("_copy.h")}).drop(
        "_li", "_n", "_off", "_b1", "_n1", "_b2", "_copy")


def xmr_chart(daily: DataFrame, value: str = "median_wait_minutes", series_keys: Sequence[str] = (),
              params: MeasureParams = DEFAULT_PARAMS, prefix: str = "wait",
              signal_col: str = "spc_signal") -> DataFrame:
    """M8b + M8c: XmR limits and rule signals for ``value`` of a daily series.

    A segmented scan: lag, the 3-row rule and run starts are windows over
    (series, year) buckets with two halo rows each; the series centre and mean moving
    range are ordinary aggregates; the start of a run that began in an earlier year is
    carried by a running maximum over the per-year table. No task holds a whole series.
    """
    keys = list(series_keys)
    x = F.col(value)
    k = F.lit(float(params.spc_sigma))
    centre, sigma = f"{prefix}_centre_line", f"_{prefix}_sigma"
    ucl, lcl = f"{prefix}_ucl", f"{prefix}_lcl"
    cols = daily.columns
    w = Window.partitionBy(*keys, "_b").orderBy("_pos")

    rows = _bucketed(daily, keys).withColumn("_mr", F.abs(x - F.lag(x).over(w)))
    own = rows.filter(~F.col("_halo"))
    stats = own.groupBy(*keys).agg(
        F.avg(x).alias(centre), (F.avg("_mr") / F.lit(params.mr_d2)).alias(sigma))
    rows = _attach(rows, stats, keys, [centre, sigma])

    cl, sg = F.col(centre), F.col(sigma)
    side = F.when(x > cl, 1).when(x < cl, -1).otherwise(0)
    beyond2 = F.when(x > cl + 2 * sg, 1).when(x < cl - 2 * sg, -1).otherwise(0)
    rows = rows.withColumns({
        ucl: cl + k * sg,
        lcl: F.greatest(cl - k * sg, F.lit(0.0)),
        "_side": side,
        "_b2": beyond2,
    })
    prev_side = F.lag("_side").over(w)
    rows = rows.withColumn(
        "_chg", F.when(~F.col("_halo") & (prev_side.isNull() | (prev_side != F.col("_side"))), F.col("_pos")))
    rows = rows.withColumns({
        "_run_from": F.max("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_pos3": F.sum(F.when(F.col("_b2") == 1, 1).otherwise(0)).over(w.rowsBetween(-2, Window.currentRow)),
        "_neg3": F.sum(F.when(F.col("_b2") == -1, 1).otherwise(0)).over(w.rowsBetween(-2, Window.currentRow)),
    }).filter(~F.col("_halo"))
    # A run that started in an earlier year: the last change before this year.
    last = rows.groupBy(*keys, "_b").agg(F.max("_chg").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "_b", F.max("_last").over(earlier).alias("_carry"))
    rows = _join_ns(rows, carry, [*keys, "_b"])
    run_len = F.col("_pos") - F.greatest(F.col("_run_from"), F.col("_carry")) + 1

    xu, xl = F.col(ucl), F.col(lcl)
    signal = (
        F.when((x > xu) | (x < xl), F.lit(POINT_BEYOND_LIMIT))
        .when((F.col("_side") != 0) & (run_len >= params.run_length), F.lit(params.run_signal_label))
        .when((F.col("_pos3") >= 2) | (F.col("_neg3") >= 2), F.lit(TWO_OF_THREE))
    )
    return rows.withColumn(signal_col, signal).select(*cols, centre, ucl, lcl, signal_col)


def p_chart(daily: DataFrame, series_keys: Sequence[str] = (),
            params: MeasureParams = DEFAULT_PARAMS) -> DataFrame:
    """M8d: admission-rate p-chart with a pooled centre line per series (an aggregate
    attached to the daily rows; no window)."""
    keys = list(series_keys)
    k = F.lit(float(params.spc_sigma))
    pooled = daily.groupBy(*keys).agg(
        ratio(F.sum("admissions"), F.sum("visits")).alias("admit_centre_line"))
    with_p = _attach(daily, pooled, keys, ["admit_centre_line"]).withColumn(
        "admission_rate", ratio(F.col("admissions"), F.col("visits")))
    p = F.col("admit_centre_line")
    sig = F.sqrt(p * (1 - p) / F.col("visits"))
    upper, lower = p + k * sig, p - k * sig
    out = with_p.withColumns({
        "admit_ucl": F.least(upper, F.lit(1.0)),
        "admit_lcl": F.greatest(lower, F.lit(0.0)),
        "admit_limits_clipped": (upper > 1) | (lower < 0),
    })
    rate = F.col("admission_rate")
    return out.withColumn(
        "admit_signal",
        F.when((rate > F.col("admit_ucl")) | (rate < F.col("admit_lcl")), F.lit(POINT_BEYOND_LIMIT)),
    )


def chart_daily(daily: DataFrame, params: MeasureParams = DEFAULT_PARAMS,
                series_keys: Sequence[str] = ()) -> DataFrame:
    """Both control charts over a daily series, in one chain of projections: no self-join of two
    chart branches. The charted rows are checkpointed: their readers, some of them several times in
    one plan, scan a small table instead of carrying the whole chart chain."""
    checkpoint_dir(daily.sparkSession)
    charted = p_chart(xmr_chart(daily, series_keys=series_keys, params=params),
                      series_keys=series_keys, params=params)
    return charted.select(
        *series_keys,
        "visit_date",
        F.col("visits").cast("bigint").alias("visits"),
        F.col("admissions").cast("bigint").alias("admissions"),
        *DAILY_OPS_COLUMNS[3:],
    ).checkpoint(eager=True)


def agg_daily_ops(rows: DataFrame, params: MeasureParams = DEFAULT_PARAMS,
                  series_keys: Sequence[str] = ()) -> DataFrame:
    """M8: one row per observed day (per series) with both control charts. Building it runs two
    checkpoints: the daily aggregation and the charted rows."""
    # The daily table (one row per series and day) is read by several branches of the
    # scan; it is computed once and its lineage cut with a reliable checkpoint in the
    # shared checkpoint folder, so the cells are scanned once and a lost executor
    # re-reads the checkpoint instead of aggregating them again.
    checkpoint_dir(rows.sparkSession)
    daily = daily_series(rows, series_keys).checkpoint(eager=True)
    return chart_daily(daily, params, series_keys)
