"""BI roll-up and time-intelligence measures, evaluated for a grouping context.

A BI measure is evaluated in whatever filter context a report sets; here the context
is a list of dimension columns ``by``: calendar (``month_start``, ``year``,
``day_of_week_num``, ...), segment (``gender``, ``age_band``, ``race``),
``department_referral``, hour (``hour_of_day``, ``shift``, ``is_peak``), any mixture of
them, or none for the grand total. The visits' cells are first rolled up to additive sums
by the keys of the dimensions asked for (map-side partial aggregation), so the dimensions
join aggregated rows, never visits. :func:`context_measures` evaluates any number of
contexts in one pass over that roll-up (grouping sets).

Measures of the daily mart (daily medians, control limits, signal days) have calendar
contexts only, and arrivals per hour calendar and hour contexts: other dimensions do not
filter those marts, so their columns are left out there.

Prior-month measures (``*_pm``) sum the dates that a bridge table names for every month, under
whatever other dimensions the context has; a month outside the calendar gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions.stats import ratio
from careflow.operators import wait_counts as wc

_ALL = "_context"

CALENDAR = ("date_day", "year", "month", "month_name", "month_start", "day_of_week_num", "day_name", "is_weekend")
SEGMENT = ("gender", "age_band", "race")
HOUR = ("hour_of_day", "shift", "is_peak")
DEPARTMENT = ("department_referral",)
_DAILY = ("median_wait_daily_avg", "p90_wait_daily_avg", "wait_centre_line", "wait_ucl", "wait_lcl")
_HOURLY = ("arrivals_per_hour", "peak_hour_arrivals")
_SUMS = ("visits", "within_target_visits", "admissions", "satisfaction_responses", "_score_sum", "_wait_sum",
         "_wait_n")


def calendar(wh) -> DataFrame:
    d = wh.with_cells().dim_date
    return d.withColumns({"month_start": F.trunc("date_day", "month"), _ALL: F.lit(1)})


def rollup(wh, *keys: str) -> DataFrame:
    """Additive sums of the visits per key combination, from their cells."""
    n, w = F.col("visits"), F.col("wait_minutes").cast("bigint")
    return wh.agg_visit_cells.groupBy(*keys).agg(
        F.sum(n).alias("visits"),
        wc.total("visits", F.col("within_target_flag")).alias("within_target_visits"),
        F.sum("admissions").alias("admissions"),
        F.sum("responses").alias("satisfaction_responses"),
        F.sum("score_sum").alias("_score_sum"),
        F.sum(w.cast("double") * n).alias("_wait_sum"),
        wc.total("visits", w.isNotNull()).alias("_wait_n"),
    )


def daily_rollup(wh) -> DataFrame:
    return rollup(wh, "visit_date")


def _fact_measures() -> list[Column]:
    """X1, X3-X6 from the additive sums."""
    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    return [
        count("visits"),
        count("within_target_visits"),
        ratio(F.col("within_target_visits"), F.col("visits")).alias("pct_within_target"),
        count("admissions"),
        ratio(F.col("admissions"), F.col("visits")).alias("admission_rate"),
        count("satisfaction_responses"),
        ratio(F.col("satisfaction_responses"), F.col("visits")).alias("satisfaction_response_rate"),
        ratio(F.col("_score_sum"), F.col("satisfaction_responses")).alias("mean_satisfaction"),
        ratio(F.col("_wait_sum"), F.col("_wait_n")).alias("mean_wait"),
    ]


def _hour_measures(hourly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Arrivals per observed hour, and of the busiest hour of day on average."""
    per_hour = hourly.groupBy(*keys, F.col("hour_of_day").alias("_hour")).agg(
        F.avg("arrivals").alias("_mean_arrivals"), F.sum("arrivals").alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    return per_hour.groupBy(*keys).agg(
        ratio(F.sum("_sum"), F.sum("_n")).alias("arrivals_per_hour"),
        F.max("_mean_arrivals").alias("peak_hour_arrivals"),
    )


def with_dimensions(df: DataFrame, wh, keys: Sequence[str]) -> DataFrame:
    """Dimension columns joined to rows keyed by visit_date, segment_key or hour_of_day; rows
    without a member in a dimension keep NULL there."""
    if set(keys) & set(CALENDAR):
        df = df.join(calendar(wh).drop(_ALL), F.col("visit_date") == F.col("date_day"), "left")
    if set(keys) & set(SEGMENT):
        df = df.join(wh.dim_patient_segment, "segment_key", "left")
    if set(keys) & set(HOUR[1:]):
        df = df.join(wh.dim_time_of_day, "hour_of_day", "left")
    return df


def dimension_measures(wh, by: Sequence[str]) -> DataFrame:
    """The measures for every combination of ``by`` that has visits, any dimension."""
    keys = list(by)
    unknown = [k for k in keys if k not in CALENDAR + SEGMENT + HOUR + DEPARTMENT]
    if unknown or not keys:
        raise ValueError(f"not a dimension column: {unknown}")
    grain = [key for key, columns in (("visit_date", CALENDAR), ("segment_key", SEGMENT),
                                      ("visit_hour", HOUR), ("department_referral", DEPARTMENT))
             if set(keys) & set(columns)]
    rolled = rollup(wh, *grain)
    if "visit_hour" in grain:
        rolled = rolled.withColumnRenamed("visit_hour", "hour_of_day")
    out = with_dimensions(rolled, wh, keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    if not set(keys) <= set(CALENDAR + HOUR):
        return out.select(*keys, *_fact_measures())
    hours = _hour_measures(with_dimensions(wh.agg_hourly_arrivals, wh, keys), keys)
    hours = hours.withColumnsRenamed({k: f"_h_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return out.join(hours, same, "left").select(
        *keys, *_fact_measures(), "arrivals_per_hour", "peak_hour_arrivals")


def measures(wh, by: Sequence[str] = ("month_start",)) -> DataFrame:
    """X1-X9 for every value combination of ``by`` present in the calendar; contexts with
    another dimension: see :func:`dimension_measures`."""
    if not set(by) <= set(CALENDAR):
        return dimension_measures(wh, by)
    keys = list(by) or [_ALL]
    cal = calendar(wh)
    spine = cal.select(*keys).distinct()
    on_day = cal.select("date_day", *keys)

    fact = daily_rollup(wh).join(on_day, F.col("visit_date") == F.col("date_day")).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS]
    )
    daily = wh.agg_daily_ops.join(on_day, F.col("visit_date") == F.col("date_day")).groupBy(*keys).agg(
        F.avg("median_wait_minutes").alias("median_wait_daily_avg"),
        F.avg("p90_wait_minutes").alias("p90_wait_daily_avg"),
        F.avg("wait_centre_line").alias("wait_centre_line"),
        F.avg("wait_ucl").alias("wait_ucl"),
        F.avg("wait_lcl").alias("wait_lcl"),
        F.count("spc_signal").alias("out_of_control_days"),
    )
    hourly = wh.agg_hourly_arrivals.join(on_day, F.col("visit_date") == F.col("date_day"))
    hours = _hour_measures(hourly, keys)
    if by:
        out = spine.join(fact, keys, "left").join(daily, keys, "left").join(hours, keys, "left")
    else:
        # Grand total: three one-row aggregates combined as scalar subqueries (a join on
        # a constant key would be planned as a nested-loop join).
        d_row = daily.drop(_ALL)
        h_row = hours.drop(_ALL)
        out = fact.select(
            "*",
            *[d_row.select(c).scalar().alias(c) for c in d_row.columns],
            *[h_row.select(c).scalar().alias(c) for c in h_row.columns],
        )
    res = out.select(
        *keys,
        *_fact_measures(),
        "median_wait_daily_avg", "p90_wait_daily_avg", "wait_centre_line", "wait_ucl", "wait_lcl",
        F.coalesce(F.col("out_of_control_days"), F.lit(0)).cast("bigint").alias("out_of_control_days"),
        "arrivals_per_hour", "peak_hour_arrivals",
    )
    return res.drop(_ALL) if not by else res


def prior_month_dates(wh) -> DataFrame:
    """(month_start, pm_date): the dates a one-month-back date shift selects for each
    calendar month, as the BI date table does it: each date of the month's (contiguous)
    range moves back one month, end-of-month days clamp, and a range that ends on the
    last day of its month extends to the last day of the target month (so a whole month
    maps to the whole previous month). Only dates present in the calendar count.

    The shifted ranges are exploded to dates (calendar-bounded rows), so the lookup is
    an equi-join on the date, not a range join.
    """
    cal = calendar(wh)
    ctx = cal.groupBy("month_start").agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))
    s_lo = F.add_months("lo", -1)
    s_hi = F.when(F.col("hi") == F.last_day("hi"), F.last_day(F.add_months("hi", -1))).otherwise(
        F.add_months("hi", -1))
    dates = ctx.select("month_start", F.explode(F.sequence(s_lo, s_hi)).alias("pm_date"))
    return dates.join(cal.select(F.col("date_day").alias("pm_date")), "pm_date")


def monthly_measures(wh, by: Sequence[str] = ()) -> DataFrame:
    """X1/X4 time intelligence: measures per month and ``by`` with prior month, MoM % and delta.

    ``by`` names segment, department or hour columns; the shift moves the month alone, so the
    prior month is read under the same values of ``by``. A value with visits in the prior month
    and none in this one has a row of its own (0 visits). A prior-month measure over a set of
    dates without visits is blank (NULL). Calendar columns would be shifted with the dates and are
    refused.

    The roll-up by date and the keys of ``by`` meets the bridge (month, date of its prior month) on
    the date: calendar-bounded rows times the members of ``by``, never visits.
    """
    by = list(by)
    if set(by) & set(CALENDAR):
        raise ValueError(f"a calendar column moves with the month: {sorted(set(by) & set(CALENDAR))}")
    keys = ["month_start", *by]
    m = measures(wh, keys)
    grain = [k for k, columns in (("segment_key", SEGMENT), ("visit_hour", HOUR),
                                  ("department_referral", DEPARTMENT)) if set(by) & set(columns)]
    per_day = rollup(wh, "visit_date", *grain).withColumnsRenamed({"visit_hour": "hour_of_day"})
    per_day = with_dimensions(per_day, wh, by).groupBy("visit_date", *by).agg(
        *[F.sum(c).alias(c) for c in ("visits", "within_target_visits")])
    pm = prior_month_dates(wh).join(per_day, F.col("pm_date") == F.col("visit_date")).groupBy(*keys).agg(
        F.sum("visits").alias("_v"), F.sum("within_target_visits").alias("_w"))
    prior = pm.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys],
        F.when(F.col("_v") > 0, F.col("_v")).cast("bigint").alias("visits_pm"),
        ratio(F.col("_w"), F.col("_v")).alias("pct_within_target_pm"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys]
    joined = m.join(prior, same, "full" if by else "left")
    # A full join's row without visits this month has the keys of the prior one.
    here = F.col("visits").isNotNull()
    counts = ("visits", "within_target_visits", "admissions", "satisfaction_responses")
    joined = joined.select(
        *[F.when(here, F.col(k)).otherwise(F.col(f"_p_{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in counts else F.col(c)
          for c in m.columns if c not in keys],
        "visits_pm", "pct_within_target_pm")
    return joined.withColumns({
        "visits_mom_pct": ratio(F.col("visits") - F.col("visits_pm"), F.col("visits_pm")),
        "pct_within_target_delta": F.col("pct_within_target") - F.col("pct_within_target_pm"),
    })


# The contexts of the standard report: name of each and its columns.
CONTEXTS = {"total": (), "month": ("month_start",), "weekday": ("day_of_week_num",), "gender": ("gender",),
            "age_band": ("age_band",), "race": ("race",), "department": DEPARTMENT, "shift": ("shift",)}


def _sets(df: DataFrame, contexts: dict[str, Sequence[str]], aggs: list[Column],
          inner: Sequence[str] = ()) -> DataFrame:
    """One aggregation over all contexts: (context, their columns, ``inner`` columns, aggregates).

    ``_dated`` (the row's date is in the calendar) is a column of the contexts made of calendar
    columns alone: those leave rows without a date out, the others count them."""
    columns = sorted({k for by in contexts.values() for k in by})
    every = ["_dated", *columns, *inner]
    in_calendar = {name: set(by) <= set(CALENDAR) for name, by in contexts.items()}
    sets = {name: [*(["_dated"] if in_calendar[name] else []), *by, *inner] for name, by in contexts.items()}
    # grouping_id has a bit per column, the first column's the highest, set where it is left out.
    ids = {name: sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in cols)
           for name, cols in sets.items()}
    out = df.groupingSets([[F.col(c) for c in cols] for cols in sets.values()], *[F.col(c) for c in every]).agg(
        F.grouping_id().alias("_set"), *aggs)
    name = F.coalesce(*[F.when(F.col("_set") == i, F.lit(n)) for n, i in ids.items()])
    # A context of calendar columns keeps its dated groups; for the others _dated is left out.
    return (out.withColumn("context", name).where(F.coalesce(F.col("_dated"), F.lit(True)))
            .drop("_dated", "_set"))


def context_measures(wh, contexts: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """X1-X9 for several contexts in one pass: ``context``, one column for every dimension column
    of any context (NULL where it is not of that context), and the measures of :func:`measures`.

    The cells are rolled up once to date, hour, segment and department; the dimensions join that
    roll-up; one aggregation with grouping sets serves all contexts, and one each over the daily
    and the hourly mart for the measures read from there (NULL where a context has none).
    """
    contexts = {n: tuple(by) for n, by in (contexts or CONTEXTS).items()}
    columns = sorted({k for by in contexts.values() for k in by})
    unknown = [k for k in columns if k not in CALENDAR + SEGMENT + HOUR + DEPARTMENT]
    if unknown or not contexts or len(set(map(frozenset, contexts.values()))) < len(contexts):
        raise ValueError(f"not different contexts of dimension columns: {unknown or contexts}")
    calendar_only = {n: by for n, by in contexts.items() if set(by) <= set(CALENDAR)}
    timed = {n: by for n, by in contexts.items() if set(by) <= set(CALENDAR + HOUR)}
    days = [c for c in columns if c in CALENDAR]

    def dated(df: DataFrame) -> DataFrame:
        cal = calendar(wh).select(F.col("date_day").alias("_day"), *days)
        return df.join(cal, F.col("visit_date") == F.col("_day"), "left").withColumn(
            "_dated", F.col("_day").isNotNull())

    base = rollup(wh, "visit_date", "visit_hour", "segment_key", "department_referral")
    base = base.withColumnRenamed("visit_hour", "hour_of_day")
    rest = [c for c in columns if c not in CALENDAR]
    rows = with_dimensions(dated(base), wh, rest)
    # Every member of a calendar context has a row: the calendar joins in with sums of nothing.
    spine = calendar(wh).select(*days, F.lit(True).alias("_dated"))
    rows = rows.select("_dated", *columns, *_SUMS).unionByName(spine, allowMissingColumns=True)
    fact = _sets(rows, contexts, [F.sum(c).alias(c) for c in _SUMS])
    # In the other contexts the calendar's rows form a group of NULLs, with visits or without.
    fact = fact.where((F.coalesce(F.col("visits"), F.lit(0)) > 0) | F.col("context").isin(*calendar_only))

    parts = [(fact, contexts)]
    if calendar_only:
        parts.append((_sets(dated(wh.agg_daily_ops), calendar_only, [
            F.avg("median_wait_minutes").alias("median_wait_daily_avg"),
            F.avg("p90_wait_minutes").alias("p90_wait_daily_avg"),
            F.avg("wait_centre_line").alias("wait_centre_line"),
            F.avg("wait_ucl").alias("wait_ucl"),
            F.avg("wait_lcl").alias("wait_lcl"),
            F.count("spc_signal").alias("out_of_control_days"),
        ]), calendar_only))
    if timed:
        hourly = wh.agg_hourly_arrivals.withColumn("_clock", F.col("hour_of_day"))
        hourly = with_dimensions(dated(hourly), wh, [c for c in rest if c in HOUR])
        per_hour = _sets(hourly, timed, [F.avg("arrivals").alias("_mean"), F.sum("arrivals").alias("_sum"),
                                         F.count(F.lit(1)).alias("_n")], ["_clock"])
        own = sorted({k for by in timed.values() for k in by})
        hours = per_hour.groupBy("context", *own).agg(
            ratio(F.sum("_sum"), F.sum("_n")).alias("arrivals_per_hour"), F.max("_mean").alias("peak_hour_arrivals"))
        parts.append((hours, timed))
    out = parts[0][0]
    for n, (part, own) in enumerate(parts[1:]):
        keys = ["context", *sorted({k for by in own.values() for k in by})]
        renamed = part.withColumnsRenamed({k: f"_{n}_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{n}_{k}")) for k in keys]
        out = out.join(renamed, same, "left").drop(*[f"_{n}_{k}" for k in keys])
    for c in _DAILY + _HOURLY:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    signal_days = (F.when(F.col("context").isin(*calendar_only), F.coalesce("out_of_control_days", F.lit(0)))
                   if calendar_only else F.lit(None))
    return out.select("context", *columns, *_fact_measures(), *_DAILY,
                      signal_days.cast("bigint").alias("out_of_control_days"), *_HOURLY)


def _measures_sql(by: str | None) -> str:
    key = f"{by} as ctx" if by else "1 as ctx"
    return f"""
with cal as (select *, date_trunc('month', date_day)::date as month_start from dim_date),
ctx as (select distinct {key} from cal),
f as (
    select {key}, count(*) as visits,
           count(*) filter (where x.within_target_flag) as within_target_visits,
           count(*) filter (where x.admitted_flag) as admissions,
           count(x.satisfaction_score) as satisfaction_responses,
           avg(x.satisfaction_score) as mean_satisfaction,
           avg(x.wait_minutes) as mean_wait
    from fct_er_visit x join cal on x.visit_date = cal.date_day group by 1
),
d as (
    select {key}, avg(median_wait_minutes) as median_wait_daily_avg, avg(p90_wait_minutes) as p90_wait_daily_avg,
           avg(wait_centre_line) as wait_centre_line, avg(wait_ucl) as wait_ucl, avg(wait_lcl) as wait_lcl,
           count(spc_signal) as out_of_control_days
    from agg_daily_ops o join cal on o.visit_date = cal.date_day group by 1
),
h as (
    select ctx, sum(s)::double / sum(n) as arrivals_per_hour, max(m) as peak_hour_arrivals
    from (select {key}, hour_of_day, avg(arrivals) as m, sum(arrivals) as s, count(*) as n
          from agg_hourly_arrivals a join cal on a.visit_date = cal.date_day group by 1, 2)
    group by 1
)
select ctx.ctx,
       coalesce(f.visits, 0) as visits,
       coalesce(f.within_target_visits, 0) as within_target_visits,
       f.within_target_visits::double / nullif(f.visits, 0) as pct_within_target,
       coalesce(f.admissions, 0) as admissions,
       f.admissions::double / nullif(f.visits, 0) as admission_rate,
       coalesce(f.satisfaction_responses, 0) as satisfaction_responses,
       f.satisfaction_responses::double / nullif(f.visits, 0) as satisfaction_response_rate,
       f.mean_satisfaction, f.mean_wait,
       d.median_wait_daily_avg, d.p90_wait_daily_avg, d.wait_centre_line, d.wait_ucl, d.wait_lcl,
       coalesce(d.out_of_control_days, 0) as out_of_control_days,
       h.arrivals_per_hour, h.peak_hour_arrivals
from ctx left join f using (ctx) left join d using (ctx) left join h using (ctx)
"""


_DOUBLES = ("pct_within_target", "admission_rate", "satisfaction_response_rate", "mean_satisfaction",
            "mean_wait", "median_wait_daily_avg", "p90_wait_daily_avg", "wait_centre_line", "wait_ucl",
            "wait_lcl", "arrivals_per_hour", "peak_hour_arrivals")

_MONTHLY_SQL = f"""
select m.* exclude (ctx), m.ctx as month_start,
       p.visits_pm, p.pct_within_target_pm,
       (m.visits - p.visits_pm)::double / nullif(p.visits_pm, 0) as visits_mom_pct,
       m.pct_within_target - p.pct_within_target_pm as pct_within_target_delta
from ({_measures_sql("month_start")}) m
left join (
    select r.month_start,
           nullif(count(f.visit_date), 0) as visits_pm,
           (count(*) filter (where f.within_target_flag))::double
               / nullif(count(*) filter (where f.visit_date is not null), 0) as pct_within_target_pm
    from (
        select month_start,
               unnest(generate_series(
                   (lo - interval 1 month)::date,
                   case when hi = last_day(hi) then last_day((hi - interval 1 month)::date)
                        else (hi - interval 1 month)::date end,
                   interval 1 day))::date as pm_date
        from (select date_trunc('month', date_day)::date as month_start, min(date_day) as lo, max(date_day) as hi
              from dim_date group by 1)
    ) r
    join dim_date c on c.date_day = r.pm_date
    left join fct_er_visit f on f.visit_date = r.pm_date
    group by 1
) p on p.month_start = m.ctx
"""

_TOTAL_SQL = f"select * exclude (ctx) from ({_measures_sql(None)})"
_WEEKDAY_SQL = f"select * exclude (ctx), ctx as day_of_week_num from ({_measures_sql('day_of_week_num')})"

QUERIES = {
    "x1_x9_monthly_measures": ("lineitem", _MONTHLY_SQL,
                               _DOUBLES + ("pct_within_target_pm", "visits_mom_pct", "pct_within_target_delta"),
                               monthly_measures),
    "x1_x9_total_measures": ("lineitem", _TOTAL_SQL, _DOUBLES, lambda wh: measures(wh, ())),
    "x1_x9_total_measures_ev": ("events", _TOTAL_SQL, _DOUBLES, lambda wh: measures(wh, ())),
    "x1_x9_weekday_measures": ("lineitem", _WEEKDAY_SQL, _DOUBLES, lambda wh: measures(wh, ("day_of_week_num",))),
    "x1_x9_monthly_measures_ev": ("events", _MONTHLY_SQL,
                                  _DOUBLES + ("pct_within_target_pm", "visits_mom_pct", "pct_within_target_delta"),
                                  monthly_measures),
    "x1_x9_monthly_measures_dirty": ("orders", _MONTHLY_SQL,
                                     _DOUBLES + ("pct_within_target_pm", "visits_mom_pct", "pct_within_target_delta"),
                                     monthly_measures),
    "x1_x9_weekday_measures_ev": ("events", _WEEKDAY_SQL, _DOUBLES,
                                  lambda wh: measures(wh, ("day_of_week_num",))),
}


def _dimension_sql(by: Sequence[str]) -> str:
    """The measures straight from the visits, each joined with its dimension rows."""
    keys = ", ".join(by)
    visits = f"""
select {keys}, count(*) as visits,
       count(*) filter (where within_target_flag) as within_target_visits,
       avg(within_target_flag::int) as pct_within_target,
       count(*) filter (where admitted_flag) as admissions,
       avg(coalesce(admitted_flag, false)::int) as admission_rate,
       count(satisfaction_score) as satisfaction_responses,
       avg((satisfaction_score is not null)::int) as satisfaction_response_rate,
       avg(satisfaction_score) as mean_satisfaction,
       avg(wait_minutes) as mean_wait
from (select *, date_trunc('month', visit_date)::date as month_start from fct_er_visit) f
left join dim_patient_segment s on s.segment_key = f.segment_key
left join dim_time_of_day t on t.hour_of_day = f.visit_hour
group by all"""
    if not set(by) <= set(CALENDAR + HOUR):
        return visits
    same = " and ".join(f"v.{k} is not distinct from h.{k}" for k in by)
    return f"""
select v.*, h.arrivals_per_hour, h.peak_hour_arrivals
from ({visits}) v
left join (
    select {keys}, sum(total)::double / sum(n) as arrivals_per_hour, max(mean) as peak_hour_arrivals
    from (select {", ".join("t." + k if k in HOUR else k for k in by)}, a.hour_of_day as clock_hour,
                 sum(arrivals) as total, count(*) as n, avg(arrivals) as mean
          from (select *, date_trunc('month', visit_date)::date as month_start from agg_hourly_arrivals) a
          left join dim_time_of_day t on t.hour_of_day = a.hour_of_day
          group by all)
    group by all
) h on {same}"""


_FACT_DOUBLES = ("pct_within_target", "admission_rate", "satisfaction_response_rate", "mean_satisfaction", "mean_wait")
for _name, _by in {"gender": ("gender",), "department": DEPARTMENT, "shift": ("shift",),
                   "month_gender": ("month_start", "gender"), "month_shift": ("month_start", "shift")}.items():
    _hours = ("arrivals_per_hour", "peak_hour_arrivals") if set(_by) <= set(CALENDAR + HOUR) else ()
    for _src, _sfx in (("lineitem", ""), ("orders", "_dirty")):
        QUERIES[f"x_measures_by_{_name}{_sfx}"] = (
            _src, _dimension_sql(_by), _FACT_DOUBLES + _hours, lambda wh, _b=_by: measures(wh, _b))


_PM = ("visits_pm", "pct_within_target_pm", "visits_mom_pct", "pct_within_target_delta")


def _prior_month_sql(by: Sequence[str]) -> str:
    """Per month and ``by``: this month's measures, and the visits of the dates that lie one month
    before the month's, straight from the visits."""
    keys = ", ".join(by)
    same = " and ".join(f"m.{k} is not distinct from p.{k}" for k in ("month_start", *by))
    hours = ", m.arrivals_per_hour, m.peak_hour_arrivals" if set(by) <= set(CALENDAR + HOUR) else ""
    return f"""
select * from (with bridge as (
    select month_start, unnest(generate_series(
               (lo - interval 1 month)::date,
               case when hi = last_day(hi) then last_day((hi - interval 1 month)::date)
                    else (hi - interval 1 month)::date end, interval 1 day))::date as pm_date
    from (select date_trunc('month', date_day)::date as month_start, min(date_day) as lo, max(date_day) as hi
          from dim_date group by 1)),
p as (
    select b.month_start, {keys}, count(*) as visits_pm,
           avg(within_target_flag::int) as pct_within_target_pm
    from bridge b join fct_er_visit f on f.visit_date = b.pm_date
    left join dim_patient_segment s on s.segment_key = f.segment_key
    left join dim_time_of_day t on t.hour_of_day = f.visit_hour
    group by all)
select {", ".join(f"coalesce(m.{k}, p.{k}) as {k}" for k in ("month_start", *by))},
       coalesce(m.visits, 0) as visits, coalesce(m.within_target_visits, 0) as within_target_visits,
       m.pct_within_target, coalesce(m.admissions, 0) as admissions, m.admission_rate,
       coalesce(m.satisfaction_responses, 0) as satisfaction_responses, m.satisfaction_response_rate,
       m.mean_satisfaction, m.mean_wait{hours},
       p.visits_pm, p.pct_within_target_pm,
       (coalesce(m.visits, 0) - p.visits_pm)::double / p.visits_pm as visits_mom_pct,
       m.pct_within_target - p.pct_within_target_pm as pct_within_target_delta
from ({_dimension_sql(("month_start", *by))}) m full join p on {same})"""


for _name, _by in {"gender": ("gender",), "department": DEPARTMENT, "shift": ("shift",),
                   "race_department": ("race", "department_referral")}.items():
    _hours = _HOURLY if set(_by) <= set(HOUR) else ()
    for _src, _sfx in (("lineitem", ""), ("events", "_ev"), ("orders", "_dirty")):
        if _src == "events" and _name == "race_department":
            continue
        QUERIES[f"x1_x4_prior_month_by_{_name}{_sfx}"] = (
            _src, _prior_month_sql(_by), _FACT_DOUBLES + _hours + tuple(c for c in _PM if c != "visits_pm"),
            lambda wh, _b=_by: monthly_measures(wh, _b))


def _contexts_sql() -> str:
    """The contexts one by one, each from its own query."""
    columns = sorted({k for by in CONTEXTS.values() for k in by})
    kinds = {"month_start": "date", "day_of_week_num": "int"}
    parts = []
    for name, by in CONTEXTS.items():
        if set(by) <= set(CALENDAR):
            body, keys = _measures_sql(by[0] if by else None), {k: "ctx" for k in by}
            daily, hourly = True, True
        else:
            body, keys = _dimension_sql(by), {k: k for k in by}
            daily, hourly = False, set(by) <= set(HOUR)
        shown = [f"{keys[k] if k in keys else 'null'}::{kinds.get(k, 'varchar')} as {k}" for k in columns]
        names = ["visits", "within_target_visits", "pct_within_target", "admissions", "admission_rate",
                 "satisfaction_responses", "satisfaction_response_rate", "mean_satisfaction", "mean_wait"]
        names += [c if daily else f"null::double as {c}" for c in _DAILY]
        names += ["out_of_control_days" if daily else "null::bigint as out_of_control_days"]
        names += [c if hourly else f"null::double as {c}" for c in _HOURLY]
        parts.append(f"select '{name}' as context, {', '.join(shown + names)} from ({body})")
    return " union all ".join(parts)


for _src, _sfx in (("lineitem", ""), ("events", "_ev"), ("orders", "_dirty")):
    QUERIES[f"x1_x9_all_contexts{_sfx}"] = (_src, _contexts_sql(), _DOUBLES, context_measures)
