"""Declarative data tests as Spark operators.

Each test returns the failing rows (``*_failures``) and, through :func:`run_checks`,
one summary row per test: ``check_id, test, table_name, column_name, failures, status``.
The count semantics follow the usual warehouse test runners: ``unique`` counts
duplicated key values, ``not_null`` counts NULL rows, ``accepted_values`` counts
distinct values outside the list, ``relationships`` counts child rows (non-null key)
without a parent.

Scale: all NULL and accepted-value checks of one table run in one aggregate; unique
and relationship checks pre-aggregate the key (map-side) before their shuffle or
anti join, so a hot key costs one row per task, not a hot partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    check_id: str
    test: str  # unique | not_null | accepted_values | relationships
    table: str
    column: str
    values: tuple = ()
    parent: tuple[str, str] | None = None  # (table, column)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# The 34 tests of the warehouse (6 on staging, 28 on the marts).
CHECKS: list[Check] = [
    Check("stg_visit_id_unique", "unique", "stg_er_visits", "visit_id"),
    Check("stg_visit_id_not_null", "not_null", "stg_er_visits", "visit_id"),
    Check("stg_visit_date_not_null", "not_null", "stg_er_visits", "visit_date"),
    Check("stg_wait_minutes_not_null", "not_null", "stg_er_visits", "wait_minutes"),
    Check("stg_gender_accepted", "accepted_values", "stg_er_visits", "gender", ("M", "F", "NC")),
    Check("stg_segment_key_not_null", "not_null", "stg_er_visits", "segment_key"),
    Check("dim_date_unique", "unique", "dim_date", "date_day"),
    Check("dim_date_not_null", "not_null", "dim_date", "date_day"),
    Check("dim_time_of_day_unique", "unique", "dim_time_of_day", "hour_of_day"),
    Check("dim_time_of_day_not_null", "not_null", "dim_time_of_day", "hour_of_day"),
    Check("dim_patient_segment_unique", "unique", "dim_patient_segment", "segment_key"),
    Check("dim_patient_segment_not_null", "not_null", "dim_patient_segment", "segment_key"),
    Check("dim_department_unique", "unique", "dim_department", "department_referral"),
    Check("dim_department_not_null", "not_null", "dim_department", "department_referral"),
    Check("fct_visit_id_unique", "unique", "fct_er_visit", "visit_id"),
    Check("fct_visit_id_not_null", "not_null", "fct_er_visit", "visit_id"),
    Check("fct_visit_date_not_null", "not_null", "fct_er_visit", "visit_date"),
    Check("fct_visit_date_rel", "relationships", "fct_er_visit", "visit_date", parent=("dim_date", "date_day")),
    Check("fct_visit_hour_not_null", "not_null", "fct_er_visit", "visit_hour"),
    Check("fct_visit_hour_rel", "relationships", "fct_er_visit", "visit_hour",
          parent=("dim_time_of_day", "hour_of_day")),
    Check("fct_segment_key_not_null", "not_null", "fct_er_visit", "segment_key"),
    Check("fct_segment_key_rel", "relationships", "fct_er_visit", "segment_key",
          parent=("dim_patient_segment", "segment_key")),
    Check("fct_department_not_null", "not_null", "fct_er_visit", "department_referral"),
    Check("fct_department_rel", "relationships", "fct_er_visit", "department_referral",
          parent=("dim_department", "department_referral")),
    Check("fct_admitted_not_null", "not_null", "fct_er_visit", "admitted_flag"),
    Check("fct_admitted_accepted", "accepted_values", "fct_er_visit", "admitted_flag", (True, False)),
    Check("hourly_visit_date_not_null", "not_null", "agg_hourly_arrivals", "visit_date"),
    Check("hourly_hour_not_null", "not_null", "agg_hourly_arrivals", "hour_of_day"),
    Check("daily_visit_date_unique", "unique", "agg_daily_ops", "visit_date"),
    Check("daily_visit_date_not_null", "not_null", "agg_daily_ops", "visit_date"),
    Check("daily_visit_date_rel", "relationships", "agg_daily_ops", "visit_date", parent=("dim_date", "date_day")),
    Check("segment_waits_unique", "unique", "agg_segment_waits", "segment_key"),
    Check("segment_waits_not_null", "not_null", "agg_segment_waits", "segment_key"),
    Check("segment_waits_rel", "relationships", "agg_segment_waits", "segment_key",
          parent=("dim_patient_segment", "segment_key")),
]


# ---------------------------------------------------------------- failing rows


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once (NULL keys are not tested)."""
    return (df.filter(_c(column).isNotNull()).groupBy(_c(column).alias(column))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_c(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values) -> DataFrame:
    """Distinct non-null values outside ``values``, with their row counts."""
    return (df.filter(_c(column).isNotNull() & ~_c(column).isin(list(values)))
            .groupBy(_c(column).alias(column)).agg(F.count(F.lit(1)).alias("n_records")))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(_c(parent_column).alias("_pk")).filter(F.col("_pk").isNotNull())
    return child.filter(_c(column).isNotNull()).join(keys, _c(column) == F.col("_pk"), "left_anti")


# ---------------------------------------------------------------- summary


def _tables(wh) -> dict[str, DataFrame]:
    tables = dict(wh.marts())
    if wh.stg_er_visits is not None:
        tables["stg_er_visits"] = wh.stg_er_visits
    return tables


def _row(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.check_id).alias("check_id"), F.lit(check.test).alias("test"),
            F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
            failures.cast("bigint").alias("failures")]


def run_checks(wh, checks: list[Check] | None = None) -> DataFrame:
    """All tests, one row each, as one lazy DataFrame (a union of small aggregates)."""
    checks = checks or CHECKS
    tables = _tables(wh)
    absent = sorted({c.table for c in checks} - set(tables))
    if absent:
        raise ValueError(f"tables needed by the checks are not in the warehouse: {absent} "
                         "(load it with_staging=True for the staging checks)")
    parts: list[DataFrame] = []
    # NULL and accepted-value tests: one scan per table.
    by_table: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.test in ("not_null", "accepted_values"):
            by_table.setdefault(ch.table, []).append(ch)
    for table, group in by_table.items():
        aggs = []
        for i, ch in enumerate(group):
            if ch.test == "not_null":
                aggs.append(F.count_if(_c(ch.column).isNull()).alias(f"_f{i}"))
            else:
                bad = F.when(_c(ch.column).isNotNull() & ~_c(ch.column).isin(list(ch.values)), _c(ch.column))
                aggs.append(F.count_distinct(bad).alias(f"_f{i}"))
        one = tables[table].agg(*aggs)
        structs = [F.struct(*_row(ch, F.col(f"_f{i}"))) for i, ch in enumerate(group)]
        parts.append(one.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for ch in checks:
        if ch.test == "unique":
            fails = unique_failures(tables[ch.table], ch.column).agg(F.count(F.lit(1)).alias("n"))
            parts.append(fails.select(*_row(ch, F.col("n"))))
    # Relationship tests: the child's distinct keys with their row counts (map-side, one column
    # read, keys in their own type) against the parent's keys.
    for ch in checks:
        if ch.test == "relationships":
            keys = (tables[ch.table].filter(_c(ch.column).isNotNull()).groupBy(_c(ch.column).alias(ch.column))
                    .agg(F.count(F.lit(1)).alias("_rows")))
            missing = relationship_failures(keys, ch.column, tables[ch.parent[0]], ch.parent[1])
            parts.append(missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).select(*_row(ch, F.col("n"))))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def reconciliation(wh, raw: DataFrame | None = None) -> DataFrame:
    """Raw rows = staging rows = fact rows (flags are carried, never filtered)."""
    raw = raw if raw is not None else wh.raw_visits
    raw_n = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    stg = wh.stg_er_visits.agg(F.count(F.lit(1))).scalar()
    fct = wh.fct_er_visit.agg(F.count(F.lit(1))).scalar()
    return raw_n.select(
        "raw_rows", stg.alias("staging_rows"), fct.alias("fact_rows"),
        ((F.col("raw_rows") == stg) & (stg == fct)).alias("reconciled"),
    )


def export_reconciliation(marts: dict[str, DataFrame], exported: dict[str, DataFrame]) -> DataFrame:
    """D5 for the export: rows and columns of every exported table against its mart."""
    parts = []
    for name, df in marts.items():
        ex = exported[name]
        parts.append(df.agg(F.count(F.lit(1)).alias("mart_rows")).select(
            F.lit(name).alias("table_name"), "mart_rows",
            ex.agg(F.count(F.lit(1))).scalar().alias("export_rows"),
            F.lit(len(df.columns)).alias("mart_columns"), F.lit(len(ex.columns)).alias("export_columns"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("reconciled", (F.col("mart_rows") == F.col("export_rows"))
                          & (F.col("mart_columns") == F.col("export_columns")))


# ---------------------------------------------------------------- registered queries

# Damage done to the tables of a sound build, so that each test has something to find:
# table -> (key column, rows lost, rows doubled, rows repeated without their key).
DAMAGE = {
    "stg_er_visits": ("segment_key", "false", "wait_minutes = 7", "wait_minutes = 300"),
    "fct_er_visit": ("segment_key", "false", "wait_minutes = 7", "wait_minutes = 300"),
    "dim_date": ("date_day", "day_of_week_num = 0", "day_of_week_num = 1", "day_of_week_num = 2"),
    "dim_time_of_day": ("hour_of_day", "hour_of_day in (8, 9)", "hour_of_day = 10", "hour_of_day = 11"),
    "dim_patient_segment": ("segment_key", "race = 'Asian'", "gender = 'F'", "age_band = '65+'"),
    "dim_department": ("department_referral", "department_referral = 'None'", "department_referral like '1%'",
                       "department_referral like '2%'"),
    "agg_hourly_arrivals": ("hour_of_day", "false", "false", "arrivals > 2"),
    "agg_daily_ops": ("visit_date", "false", "visits > 40", "visits > 42"),
    "agg_segment_waits": ("segment_key", "false", "low_n_flag", "not low_n_flag"),
}


def damaged(wh):
    """A warehouse with DAMAGE done to it."""
    def spoil(name: str, df: DataFrame) -> DataFrame:
        key, lost, doubled, keyless = DAMAGE[name]
        without = df.where(keyless).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
        return df.where(f"not coalesce({lost}, false)").unionByName(df.where(doubled)).unionByName(without)

    tables = {name: spoil(name, df) for name, df in wh.marts().items()}
    return type(wh)(wh.spark, tables, stg_er_visits=spoil("stg_er_visits", wh.stg_er_visits), params=wh.params)


def _damaged_sql() -> str:
    parts = []
    for name, (key, lost, doubled, keyless) in DAMAGE.items():
        src = "stg" if name == "stg_er_visits" else name
        parts.append(f"""damaged_{src} as (
    select * from {src} where not coalesce({lost}, false)
    union all select * from {src} where {doubled}
    union all select * replace (null as {key}) from {src} where {keyless})""")
    return ", " + ", ".join(parts)


def _checks_sql(prefix: str = "") -> str:
    rows = []
    for ch in CHECKS:
        t, c = prefix + (ch.table if ch.table != "stg_er_visits" else "stg"), ch.column
        if ch.test == "unique":
            q = f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"
        elif ch.test == "not_null":
            q = f"select count(*) from {t} where {c} is null"
        elif ch.test == "accepted_values":
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in ch.values)
            q = f"select count(distinct {c}) from {t} where {c} is not null and {c} not in ({vals})"
        else:
            pt, pc = prefix + ch.parent[0], ch.parent[1]
            q = (f"select count(*) from {t} x where x.{c} is not null "
                 f"and not exists (select 1 from {pt} p where p.{pc} = x.{c})")
        rows.append(f"select '{ch.check_id}' as check_id, '{ch.test}' as test, '{ch.table}' as table_name, "
                    f"'{c}' as column_name, ({q})::bigint as failures")
    body = " union all ".join(rows)
    return (f"select *, case when failures = 0 then 'pass' else 'fail' end as status from ({body})")


QUERIES = {
    "d1_d4_data_tests": ("lineitem", _checks_sql(), (), run_checks),
    "d1_d4_data_tests_ev": ("events", _checks_sql(), (), run_checks),
    "d1_d4_data_tests_damaged": ("orders", _checks_sql("damaged_"), (), lambda wh: run_checks(damaged(wh)),
                                 _damaged_sql()),
    "d1_d4_data_tests_dirty": ("orders", _checks_sql(), (), run_checks),
}

_RECONCILIATION_SQL = (
    "select (select count(*) from raw) as raw_rows, (select count(*) from stg) as staging_rows, "
    "(select count(*) from fct_er_visit) as fact_rows, "
    "(select count(*) from raw) = (select count(*) from stg) "
    "and (select count(*) from stg) = (select count(*) from fct_er_visit) as reconciled"
)
QUERIES["d5_reconciliation"] = ("lineitem", _RECONCILIATION_SQL, (), reconciliation)
QUERIES["d5_reconciliation_dirty"] = ("orders", _RECONCILIATION_SQL, (), reconciliation)
QUERIES["d5_reconciliation_ev"] = ("events", _RECONCILIATION_SQL, (), reconciliation)
