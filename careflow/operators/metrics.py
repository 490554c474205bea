"""Q1-Q31: the metric queries of the warehouse.

Each function takes a :class:`~careflow.plans.warehouse.Warehouse` and returns a
DataFrame (scalar bundles are one-row DataFrames); nothing is collected here. Metrics
read the pre-aggregated marts where the definition allows it (daily, hourly, segment
tables are bounded by the calendar or the segment count); medians of any grouping read the
counted waits; the rest aggregates the fact with map-side partial aggregation before any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions.stats import (
    guarded_corr,
    indicator,
    kurtosis_of_moments,
    ratio,
    skewness_of_moments,
)
from careflow.operators import wait_counts as wc
from careflow.operators.ranking import ntile

EQUITY_DIMENSIONS = ("gender", "age_band", "race")
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}


def _n() -> Column:
    return F.count(F.lit(1))


def _eligible() -> Column:
    """A wait that counts for the target: present and plausible."""
    return F.col("wait_minutes").isNotNull() & ~F.col("wait_implausible_flag")


def _not_implausible(df: DataFrame) -> DataFrame:
    # NOT flag is NULL for a NULL wait, so this also drops visits without a wait.
    return df.filter(~F.col("wait_implausible_flag"))


def _daily_counts(wh) -> DataFrame:
    """Visits per observed day, read from the daily mart (one row per day)."""
    return wh.agg_daily_ops.select("visit_date", F.col("visits").alias("n"))


# ---------------------------------------------------------------- headline KPIs


def kpi_summary(wh) -> DataFrame:
    """Q1: 12 headline KPIs over the counted waits plus signal counts of the daily mart."""
    c, daily, r = wh.agg_wait_counts, wh.agg_daily_ops, wc.rates()
    q = wc.quantiles(wc.merged(c), (), {"median": 0.5, "p90": 0.9})
    row = c.agg(
        wc.total("visits").alias("visits"),
        F.min("visit_date").alias("date_min"),
        F.max("visit_date").alias("date_max"),
        wc.mean_wait().alias("mean_wait_minutes"),
        *[r[k].alias(k) for k in ("pct_within_target", "admission_rate", "satisfaction_response_rate",
                                  "mean_satisfaction")],
        wc.total("visits", F.col("wait_implausible_flag")).alias("n_implausible_waits"),
    )
    # Scalar subqueries over the small daily mart (merged into one by the optimizer);
    # the daily mart has one row per distinct visit date (plus a NULL-date row only when
    # lenient date parsing let unparseable dates through, which n_days leaves out).
    return row.select(
        "visits", "date_min", "date_max",
        daily.agg(F.count("visit_date")).scalar().alias("n_days"),
        q.select("median").scalar().alias("median_wait_minutes"),
        q.select("p90").scalar().alias("p90_wait_minutes"),
        "mean_wait_minutes", "pct_within_target",
        "admission_rate", "satisfaction_response_rate", "mean_satisfaction", "n_implausible_waits",
        daily.agg(F.count("spc_signal")).scalar().alias("wait_signal_days"),
        daily.agg(F.count("admit_signal")).scalar().alias("admit_signal_days"),
        daily.agg(_n()).scalar().alias("total_days"),
    )


def monthly_trend(wh) -> DataFrame:
    """Q2: per calendar month (first day of month, a DATE), from the counted waits: counts per
    month and wait first, which every figure of the month can be read from."""
    keys = ["month", "wait_minutes", "wait_implausible_flag", "within_target_flag"]
    c = wh.agg_wait_counts.withColumn("month", F.trunc("visit_date", "month")).groupBy(*keys).agg(
        *[F.sum(x).alias(x) for x in wc.SUMS])
    r = wc.rates()
    return c.groupBy("month").agg(
        wc.total("visits").alias("visits"),
        wc.total("admissions").alias("admissions"),
        r["admission_rate"].alias("admission_rate"),
        F.percentile(wc.plausible_wait(), 0.5, F.col("visits")).cast("double").alias("median_wait_minutes"),
        *[r[k].alias(k) for k in ("pct_within_target", "satisfaction_response_rate", "mean_satisfaction")],
    ).orderBy("month")


# ---------------------------------------------------------------- demand


def demand_by_weekday(wh) -> DataFrame:
    """Q3: arrivals and average arrivals per observed day, by weekday."""
    d = wh.dim_date
    days = _daily_counts(wh).join(d, F.col("visit_date") == d.date_day)
    return days.groupBy("day_of_week_num", "day_name").agg(
        F.sum("n").cast("bigint").alias("arrivals"),
        ratio(F.sum("n"), _n()).alias("avg_per_day"),
    ).orderBy("day_of_week_num")


def demand_by_hour(wh) -> DataFrame:
    """Q4: 24 hours with shift, peak flag and arrivals (0 for hours without visits)."""
    per_hour = wh.fct_er_visit.groupBy(F.col("visit_hour").alias("hour_of_day")).agg(
        F.count("visit_id").alias("arrivals")
    )
    return wh.dim_time_of_day.join(per_hour, "hour_of_day", "left").select(
        "hour_of_day", "shift", "is_peak",
        F.coalesce(F.col("arrivals"), F.lit(0)).cast("bigint").alias("arrivals"),
    ).orderBy("hour_of_day")


def demand_heatmap(wh) -> DataFrame:
    """Q5: weekday x hour arrivals, long form (from the date-hour mart)."""
    d = wh.dim_date
    h = wh.agg_hourly_arrivals
    return h.join(d, h.visit_date == d.date_day).groupBy(
        "day_of_week_num", "day_name", "hour_of_day"
    ).agg(F.sum("arrivals").cast("bigint").alias("arrivals")).orderBy("day_of_week_num", "hour_of_day")


def heatmap_row_order(wh) -> DataFrame:
    """Weekday row order of the heatmap (one row per weekday number). The name
    depends on the number only, so keeping any duplicate is deterministic."""
    return demand_heatmap(wh).dropDuplicates(["day_of_week_num"]).select(
        "day_of_week_num", "day_name").orderBy("day_of_week_num")


def demand_heatmap_matrix(wh) -> DataFrame:
    """Q5p: 7 x 24 matrix, one column per hour ('0' .. '23'); NULL where no arrivals."""
    d = wh.dim_date
    h = wh.agg_hourly_arrivals
    # Pivot values are listed, so Spark needs no extra job to find them.
    return h.join(d, h.visit_date == d.date_day).groupBy("day_of_week_num", "day_name").pivot(
        "hour_of_day", list(range(24))
    ).agg(F.sum("arrivals")).orderBy("day_of_week_num")


def demand_volume_stats(wh) -> DataFrame:
    """Q6: mean/sd/CV of daily arrivals, weekday and weekend averages, weekend uplift.

    Conditional averages give NULL (not an error) when the window has no weekend day.
    """
    d = wh.dim_date
    days = _daily_counts(wh).join(d, F.col("visit_date") == d.date_day, "left")
    n = F.col("n").cast("double")
    stats = days.agg(
        F.avg(n).alias("mean_daily"),
        F.stddev_samp(n).alias("sd_daily"),
        F.avg(F.when(~F.col("is_weekend"), n)).alias("weekday_avg"),
        F.avg(F.when(F.col("is_weekend"), n)).alias("weekend_avg"),
    )
    return stats.select(
        "mean_daily", "sd_daily",
        F.try_divide(F.col("sd_daily"), F.col("mean_daily")).alias("cv_daily"),
        "weekday_avg", "weekend_avg",
        (F.try_divide(F.col("weekend_avg"), F.col("weekday_avg")) - 1).alias("weekend_uplift"),
    )


# ---------------------------------------------------------------- waits


def wait_summary_stats(wh) -> DataFrame:
    """Q7: distribution of plausible waits (sample sd, skewness and excess kurtosis), from the
    visits per wait minute: one small table, its moments taken about its mean."""
    counts = wc.merged(wh.agg_wait_counts)
    q = wc.quantiles(counts, (), {"median": 0.5, "p90": 0.9, "p99": 0.99})
    n, w = F.col("visits"), F.col("wait_minutes").cast("double")
    mean = counts.agg(ratio(F.sum(w * n), F.sum(n))).scalar()
    off = F.col("_off")
    row = counts.withColumn("_off", w - mean).agg(
        wc.total("visits").alias("n_plausible"),
        F.min("wait_minutes").alias("min_wait"),
        F.max("wait_minutes").alias("max_wait"),
        *[F.sum(n * F.pow(off, k)).alias(f"_m{k}") for k in (2, 3, 4)],
    )
    implausible = wh.agg_wait_counts.agg(wc.total("visits", F.col("wait_implausible_flag"))).scalar()
    count, m2, m3, m4 = F.col("n_plausible").cast("double"), F.col("_m2"), F.col("_m3"), F.col("_m4")
    return row.select(
        "n_plausible", implausible.alias("n_implausible"), "min_wait",
        q.select("median").scalar().alias("median_wait"),
        mean.alias("mean_wait"),
        q.select("p90").scalar().alias("p90_wait"),
        q.select("p99").scalar().alias("p99_wait"),
        "max_wait",
        F.sqrt(F.try_divide(m2, count - 1)).alias("sd_wait"),
        skewness_of_moments(count, m2, m3).alias("skew_wait"),
        kurtosis_of_moments(count, m2, m4).alias("kurt_wait"),
    )


def wait_quantiles_by(wh, by: list[str], probs: dict[str, float] | None = None) -> DataFrame:
    """Exact wait quantiles and visits for any mixture of calendar, segment and department
    columns, from the counted waits: the states of the members' cells, merged."""
    from careflow.operators.measures import CALENDAR, DEPARTMENT, SEGMENT, with_dimensions

    unknown = [k for k in by if k not in CALENDAR + SEGMENT + DEPARTMENT]
    if unknown:
        raise ValueError(f"not a dimension of the counted waits: {unknown}")
    # merged by the keys of the dimensions before they are joined
    grain = [k for k, columns in (("visit_date", CALENDAR), ("segment_key", SEGMENT),
                                  ("department_referral", DEPARTMENT)) if set(by) & set(columns)]
    counts = with_dimensions(wc.merged(wh.agg_wait_counts, grain), wh, by)
    out = counts.groupBy(*by, "wait_minutes").agg(F.sum("visits").alias("visits"))
    quantiles = [F.percentile("wait_minutes", p, F.col("visits")).cast("double").alias(name)
                 for name, p in (probs or QUARTILES).items()]
    return out.groupBy(*by).agg(wc.total("visits").alias("n_plausible"), *quantiles)


def wait_histogram(wh, bin_width: int = 5, source_bins: bool = False) -> DataFrame:
    """Q8: counts of plausible waits per ``bin_width``-minute bin (bin start, INT).

    ``source_bins=True`` reproduces the source system's result exactly: its
    ``(wait / width) * width`` is true division there, so every minute is its own
    "bin" and ``bucket_start`` is the wait as a DOUBLE.
    """
    if bin_width <= 0:
        raise ValueError("bin_width must be positive")
    if source_bins:
        start = (F.col("wait_minutes").cast("double") / bin_width) * bin_width
    else:
        start = (F.floor(F.col("wait_minutes") / bin_width) * bin_width).cast("int")
    return _not_implausible(wh.fct_er_visit).groupBy(start.alias("bucket_start")).agg(
        _n().alias("n")).orderBy("bucket_start")


def wait_within_target(wh) -> DataFrame:
    """Q9: visits within target, eligible visits, share, and eligible visits over target."""
    f = wh.fct_er_visit
    within, eligible = F.count_if(F.col("within_target_flag")), F.count_if(_eligible())
    return f.agg(within.alias("within"), eligible.alias("eligible"),
                 ratio(within, eligible).alias("pct")).withColumn(
        "over", F.col("eligible") - F.col("within")
    )


def wait_daily_trend(wh) -> DataFrame:
    """Q10."""
    return wh.agg_daily_ops.select("visit_date", "median_wait_minutes", "p90_wait_minutes").orderBy("visit_date")


# ---------------------------------------------------------------- load vs wait


def load_vs_wait_hourly(wh) -> DataFrame:
    """Q11: date-hours that have a plausible median wait."""
    return wh.agg_hourly_arrivals.filter(F.col("median_wait_minutes").isNotNull()).select(
        "visit_date", "hour_of_day", "arrivals", "median_wait_minutes"
    )


def load_vs_wait_correlation(wh) -> DataFrame:
    """Q12: Pearson r of arrivals and median wait over date-hours."""
    h = load_vs_wait_hourly(wh)
    return h.agg(guarded_corr(F.col("arrivals"), F.col("median_wait_minutes")).alias("corr_arrivals_wait"))


def load_vs_wait_fit(wh) -> DataFrame:
    """Q12f: least-squares line of median wait on arrivals, and the arrivals range."""
    h = load_vs_wait_hourly(wh)
    x, y = F.col("arrivals").cast("double"), F.col("median_wait_minutes")
    return h.agg(
        _n().alias("n_hours"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min("arrivals").alias("min_arrivals"),
        F.max("arrivals").alias("max_arrivals"),
        F.avg(x).alias("mean_arrivals"),
    )


def load_vs_wait_quintiles(wh) -> DataFrame:
    """Q13: quintiles of date-hours by arrivals (ties broken by date, hour)."""
    ranked = ntile(load_vs_wait_hourly(wh), 5, ["arrivals", "visit_date", "hour_of_day"],
                   "arrivals_quintile")
    return ranked.groupBy("arrivals_quintile").agg(
        F.min("arrivals").alias("min_arrivals"),
        F.max("arrivals").alias("max_arrivals"),
        F.avg("arrivals").alias("avg_arrivals"),
        F.avg("median_wait_minutes").alias("avg_median_wait"),
        _n().alias("n_hours"),
    ).orderBy("arrivals_quintile")


# ---------------------------------------------------------------- SPC


def spc_wait_chart(wh) -> DataFrame:
    """Q14."""
    return wh.agg_daily_ops.select(
        "visit_date", "median_wait_minutes", "wait_centre_line", "wait_ucl", "wait_lcl", "spc_signal"
    ).orderBy("visit_date")


def spc_admit_chart(wh) -> DataFrame:
    """Q15."""
    return wh.agg_daily_ops.select(
        "visit_date", "admission_rate", "admit_centre_line", "admit_ucl", "admit_lcl",
        "admit_signal", "admit_limits_clipped",
    ).orderBy("visit_date")


def spc_signal_days(wh) -> DataFrame:
    """Q16: days with a wait or an admission signal."""
    d = wh.agg_daily_ops
    return d.filter(F.col("spc_signal").isNotNull() | F.col("admit_signal").isNotNull()).select(
        "visit_date", "median_wait_minutes", "wait_ucl", "wait_lcl", "spc_signal",
        "admission_rate", "admit_ucl", "admit_lcl", "admit_signal",
    ).orderBy("visit_date")


def spc_summary(wh) -> DataFrame:
    """Signal-day counts of both charts by rule, clipped-limit days and total days (the
    one-row summary above the control charts)."""
    from careflow.operators.spc import POINT_BEYOND_LIMIT, TWO_OF_THREE

    d = wh.agg_daily_ops
    sig = F.col("spc_signal")
    return d.agg(
        F.count("spc_signal").alias("wait_signal_days"),
        F.count_if(sig == POINT_BEYOND_LIMIT).alias("point_beyond_limit_days"),
        F.count_if(sig == wh.params.run_signal_label).alias("run_days"),
        F.count_if(sig == TWO_OF_THREE).alias("two_of_three_days"),
        F.count("admit_signal").alias("admit_signal_days"),
        F.count_if(F.col("admit_limits_clipped")).alias("clipped_limit_days"),
        _n().alias("total_days"),
    )


# ---------------------------------------------------------------- satisfaction


def _satisfaction_aggs() -> list[Column]:
    return [
        ratio(F.count("satisfaction_score"), _n()).alias("response_rate"),
        F.avg("satisfaction_score").alias("mean_score"),
        _n().alias("n"),
    ]


def satisfaction_overview(wh) -> DataFrame:
    """Q17."""
    return wh.fct_er_visit.agg(
        F.count("satisfaction_score").alias("responders"),
        _n().alias("total"),
        ratio(F.count("satisfaction_score"), _n()).alias("response_rate"),
        F.avg("satisfaction_score").alias("mean_score"),
        F.stddev_samp("satisfaction_score").alias("sd_score"),
    )


def satisfaction_by_wait_bucket(wh) -> DataFrame:
    """Q18: response and score for plausible waits within / over the target."""
    t = wh.params.wait_target_minutes
    bucket = F.when(F.col("wait_minutes") <= t, F.lit(f"<={t} min")).otherwise(F.lit(f">{t} min"))
    return _not_implausible(wh.fct_er_visit).groupBy(bucket.alias("wait_bucket")).agg(
        *_satisfaction_aggs()).orderBy("wait_bucket")


def satisfaction_by_admitted(wh) -> DataFrame:
    """Q19."""
    return wh.fct_er_visit.groupBy("admitted_flag").agg(*_satisfaction_aggs()).orderBy("admitted_flag")


def satisfaction_nonresponse_bias(wh) -> DataFrame:
    """Point-biserial correlations of responding with wait and with admission."""
    responded = indicator(F.col("satisfaction_score").isNotNull())
    admitted = indicator(F.col("admitted_flag"))
    return _not_implausible(wh.fct_er_visit).agg(
        guarded_corr(F.col("wait_minutes"), responded).alias("corr_wait_responded"),
        guarded_corr(admitted, responded).alias("corr_admitted_responded"),
    )


def satisfaction_by_response_group(wh) -> DataFrame:
    """Plausible waits of responders and non-responders, from the counted waits: a cell's
    visits are its responses and the rest."""
    rows = wh.agg_wait_counts.where(~F.col("wait_implausible_flag")).groupBy("wait_minutes").agg(
        F.sum("responses").alias("yes"), F.sum(F.col("visits") - F.col("responses")).alias("no"))
    groups = F.explode(F.array(*[F.struct(F.lit(x).alias("responded"), F.col(c).alias("visits"))
                                 for x, c in ((True, "yes"), (False, "no"))])).alias("g")
    counts = rows.select("wait_minutes", groups).select("wait_minutes", "g.*").where("visits > 0")
    w = F.col("wait_minutes").cast("double")
    return counts.groupBy("responded").agg(
        ratio(F.sum(w * F.col("visits")), F.sum("visits")).alias("mean_wait"),
        F.percentile("wait_minutes", 0.5, F.col("visits")).cast("double").alias("median_wait"),
        F.sum("visits").alias("n"),
    )


def satisfaction_nonresponse_report(wh) -> dict[str, DataFrame]:
    """Q20 in the source's shape: the two correlations and the response-group table."""
    return {"correlations": satisfaction_nonresponse_bias(wh),
            "by_response_group": satisfaction_by_response_group(wh)}


# ---------------------------------------------------------------- equity


def segment_equity_by(wh, dimension: str) -> DataFrame:
    """Q21: median and mean plausible wait and visits by one demographic dimension.

    Exact: the weighted percentile over (wait, count) pairs equals the median over the
    visits, and the counted waits of a segment are few, so the dimension join is cheap.
    """
    if dimension not in EQUITY_DIMENSIONS:
        raise ValueError(f"unsupported dimension: {dimension}")
    counts = wc.merged(wh.agg_wait_counts, ["segment_key"]).withColumnRenamed("visits", "cnt")
    counts = counts.join(wh.dim_patient_segment, "segment_key")
    return counts.groupBy(F.col(dimension).alias("segment_value")).agg(
        F.percentile("wait_minutes", 0.5, F.col("cnt")).cast("double").alias("median_wait"),
        ratio(F.sum(F.col("wait_minutes") * F.col("cnt")), F.sum("cnt")).alias("mean_wait"),
        F.sum("cnt").cast("bigint").alias("n"),
    ).orderBy(F.col("median_wait").desc_nulls_last(), F.col("segment_value").asc_nulls_first())


def segment_equity_by_age_band_ordered(wh) -> DataFrame:
    """Equity by age band in band order, bands without plausible waits shown with
    n = 0 (left join from the 5-row band spine; the NULL band is not listed)."""
    from careflow.functions.parsing import AGE_BAND_ORDER

    spine = wh.spark.createDataFrame(
        [(i, b) for i, b in enumerate(AGE_BAND_ORDER)], "band_order int, segment_value string")
    eq = segment_equity_by(wh, "age_band")
    return spine.join(eq, "segment_value", "left").select(
        "band_order", "segment_value", "median_wait", "mean_wait",
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
    ).orderBy("band_order")


EXTREME_COLUMNS = ["age_band", "gender", "race", "n_plausible", "median_wait_minutes", "ci_lower", "ci_upper"]


def segment_equity_extremes(wh, n: int = 10) -> DataFrame:
    """Q22: the n highest and n lowest median waits among reportable segments, tagged
    ``extreme`` = 'top' / 'bottom'. Ties are broken by the segment attributes."""
    seg = wh.agg_segment_waits.filter(~F.col("low_n_flag"))
    tie = [F.col(c).asc_nulls_first() for c in ("age_band", "gender", "race")]
    top = seg.orderBy(F.col("median_wait_minutes").desc_nulls_last(), *tie).limit(n)
    bottom = seg.orderBy(F.col("median_wait_minutes").asc_nulls_last(), *tie).limit(n)
    return top.select(*EXTREME_COLUMNS, F.lit("top").alias("extreme")).unionByName(
        bottom.select(*EXTREME_COLUMNS, F.lit("bottom").alias("extreme"))
    )


def segment_equity_extremes_split(wh, n: int = 10) -> dict[str, DataFrame]:
    """Q22 in the source's shape: ``{"top": ..., "bottom": ...}``."""
    ext = segment_equity_extremes(wh, n)
    return {
        "top": ext.filter(F.col("extreme") == "top").drop("extreme")
        .orderBy(F.col("median_wait_minutes").desc_nulls_last()),
        "bottom": ext.filter(F.col("extreme") == "bottom").drop("extreme")
        .orderBy(F.col("median_wait_minutes").asc_nulls_last()),
    }


def segment_low_n_summary(wh) -> DataFrame:
    """Q23."""
    low = F.count_if(F.col("low_n_flag"))
    return wh.agg_segment_waits.agg(
        low.alias("low_n_segments"), _n().alias("total_segments"), ratio(low, _n()).alias("pct_low_n")
    )


def extremes_chart_frame(wh, n: int = 5) -> DataFrame:
    """Q31: top n and bottom n segments with a label and CI error bars."""
    ext = segment_equity_extremes(wh, n)
    label = F.concat(F.col("age_band"), F.lit(" / "), F.col("gender"), F.lit(" / "), F.col("race"))
    return ext.select(
        *EXTREME_COLUMNS,
        F.when(F.col("extreme") == "top", F.lit(f"Top {n}")).otherwise(F.lit(f"Bottom {n}")).alias("group"),
        label.alias("label"),
        (F.col("ci_upper") - F.col("median_wait_minutes")).alias("err_plus"),
        (F.col("median_wait_minutes") - F.col("ci_lower")).alias("err_minus"),
    )


# ---------------------------------------------------------------- data quality


def row_counts(wh) -> DataFrame:
    """Q24: rows per mart (one aggregate per mart, unioned)."""
    from careflow.schema import MART_TABLES

    wh.with_cells()
    parts = [wh.table(t).agg(_n().alias("row_count")).select(F.lit(t).alias("table"), "row_count")
             for t in MART_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


NULL_REPORT_COLUMNS = [
    "visit_id", "visit_ts", "visit_date", "visit_hour", "segment_key", "department_referral",
    "wait_minutes", "admitted_flag", "satisfaction_score", "case_management_flag",
]


def null_report(wh, columns: list[str] | None = None) -> DataFrame:
    """Q25: NULL count, share and total for each fact column, in one scan."""
    cols = columns or NULL_REPORT_COLUMNS
    f = wh.fct_er_visit
    agg = f.agg(_n().alias("_total"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n_{i}").alias("n_null")) for i, c in enumerate(cols)
    ])).alias("s")
    return agg.select("_total", stacked).select(
        F.col("s.column").alias("column"),
        F.col("s.n_null").alias("n_null"),
        F.coalesce(ratio(F.col("s.n_null"), F.col("_total")), F.lit(0.0)).alias("pct_null"),
        F.col("_total").alias("n_total"),
    )


def date_coverage_check(wh) -> DataFrame:
    """Q26: first and last visit date, span, observed days, gap-free flag (daily mart)."""
    d = wh.agg_daily_ops.filter(F.col("visit_date").isNotNull())
    row = d.agg(F.min("visit_date").alias("min_date"), F.max("visit_date").alias("max_date"),
                _n().alias("distinct_days"))
    span = (F.datediff("max_date", "min_date") + 1).cast("bigint")
    return row.select("min_date", "max_date", span.alias("span_days"), "distinct_days",
                      (span == F.col("distinct_days")).alias("gap_free"))


def duplicate_check(wh) -> DataFrame:
    """Q27: rows, distinct visit ids, duplicates (= rows - distinct)."""
    row = wh.fct_er_visit.agg(_n().alias("n_rows"), F.count_distinct("visit_id").alias("n_distinct_ids"))
    return row.withColumn("n_duplicate_ids", F.col("n_rows") - F.col("n_distinct_ids"))


def invalid_value_check(wh) -> DataFrame:
    """Q28."""
    score = F.col("satisfaction_score")
    return wh.fct_er_visit.agg(
        F.count_if(F.col("wait_implausible_flag")).alias("implausible_waits"),
        F.count_if(F.col("wait_minutes").isNotNull() & (F.col("wait_minutes") < 0)).alias("negative_waits"),
        F.count_if(score.isNotNull() & ((score < 0) | (score > 10))).alias("out_of_range_satisfaction"),
        F.count_if(F.col("admitted_flag").isNull()).alias("null_admitted_flag"),
    )


def data_quality_report(wh) -> dict[str, DataFrame]:
    """Q29: the five quality frames, lazily."""
    return {
        "row_counts": row_counts(wh),
        "nulls": null_report(wh),
        "date_coverage": date_coverage_check(wh),
        "duplicates": duplicate_check(wh),
        "invalid_values": invalid_value_check(wh),
    }


def data_quality_summary(wh) -> DataFrame:
    """Q29 flattened: every number of the quality bundle as ``(section, item, value)``."""
    def long(df: DataFrame, section: str, items: list[str]) -> DataFrame:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("item"), F.col(i).cast("bigint").alias("value")) for i in items
        ])).alias("p")
        return df.select(pairs).select(F.lit(section).alias("section"), "p.item", "p.value")

    parts = [
        row_counts(wh).select(F.lit("row_counts").alias("section"), F.col("table").alias("item"),
                              F.col("row_count").cast("bigint").alias("value")),
        null_report(wh).select(F.lit("nulls").alias("section"), F.col("column").alias("item"),
                               F.col("n_null").cast("bigint").alias("value")),
        long(date_coverage_check(wh), "date_coverage", ["span_days", "distinct_days", "gap_free"]),
        long(duplicate_check(wh), "duplicates", ["n_rows", "n_distinct_ids", "n_duplicate_ids"]),
        long(invalid_value_check(wh), "invalid_values",
             ["implausible_waits", "negative_waits", "out_of_range_satisfaction", "null_admitted_flag"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- distributions


DISTRIBUTION_COLUMNS = ("gender", "race", "department_referral", "admitted_flag")


def category_distribution(wh, column: str) -> DataFrame:
    """Q30: ``value, n`` for one category; gender and race come from the segment
    dimension (fact counts per segment first, then the small join)."""
    if column in ("gender", "race"):
        per_seg = wh.fct_er_visit.groupBy("segment_key").agg(_n().alias("cnt"))
        joined = per_seg.join(wh.dim_patient_segment, "segment_key")
        out = joined.groupBy(F.col(column).alias("value")).agg(F.sum("cnt").cast("bigint").alias("n"))
    elif column in ("department_referral", "admitted_flag"):
        out = wh.fct_er_visit.groupBy(F.col(column).alias("value")).agg(_n().alias("n"))
    else:
        raise ValueError(f"unsupported column: {column}")
    return out.orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
