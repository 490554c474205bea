"""Driver tables mapped onto the raw visit schema (12 strings).

Three mappings give the operators realistic input at any scale factor:

* ``visits_from_lineitem`` - a long daily series (order lines as visits), no NULL
  or implausible waits; used for SPC, calendar gaps, suppression and month measures.
* ``visits_from_events`` - a 30-day hourly series with NULL and implausible waits,
  NULL ages and lower-case admission text; used for NULL logic and hours.
* ``visits_from_orders`` - untidy text: repeated and missing ids, days and hours without
  visits, timestamps padded, unpadded, between blanks or missing, numbers with blanks,
  decimals or a letter behind them, waits and scores out of range, unknown categories;
  every data-quality measure has something to count.

All are pure projections/joins of the input tables, so they scale with them. The
same mappings exist as DuckDB SQL in ``careflow.oracle`` for the result check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.schema import RAW_COLUMNS

# Race names of the source data, in the order used by the events mapping.
RACES = [
    "White",
    "African American",
    "Two or More Races",
    "Asian",
    "Declined to Identify",
    "Pacific Islander",
    "Native American/Alaska Native",
]
LOW_N_RACE = "Native American/Alaska Native"
RAW_TS_FORMAT = "dd-MM-yyyy HH:mm"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: Column) -> Column:
    return col.cast("string")


def visits_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation (25 rows) and region (5 rows) have a fixed size by definition of the
    # schema, so broadcasting them is bounded whatever the scale factor.
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "r_name"
    )
    # Both remaining joins are big-big equi joins, left to Catalyst/AQE (sort-merge by
    # key at scale, broadcast only when a side is measured small). Order matters without
    # cost-based reordering: orders (1/4 of lineitem) meets customer first, so lineitem is
    # shuffled once, on l_orderkey, instead of twice.
    order_info = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "r_name")
    df = li.join(order_info, li.l_orderkey == order_info.o_orderkey)
    # The visit id is the whole natural line tuple (order, line, part, supplier, price
    # in cents, ship day): unique at every scale factor and needs no window.
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    patient_id = F.concat_ws(
        "-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber")), _s(F.col("l_partkey")),
        _s(F.col("l_suppkey")), _s(cents), F.date_format("l_shipdate", "yyyyMMdd"),
    )
    hour_shift = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24
    admitted_at = F.timestamp_add("HOUR", hour_shift, F.col("l_shipdate").cast("timestamp_ntz"))
    return df.select(
        patient_id.alias("patient_id"),
        F.date_format(admitted_at, RAW_TS_FORMAT).alias("admission_date_raw"),
        F.lit("X").alias("first_initial"),
        F.lit("X").alias("last_name"),
        F.when(F.col("l_returnflag") == "R", "M")
        .when(F.col("l_returnflag") == "A", "F")
        .when(F.col("l_returnflag") == "N", "NC")
        .alias("gender_raw"),
        _s(1 + F.col("o_custkey") % 79).alias("age_raw"),
        F.when(F.col("o_custkey") == 1, F.lit(LOW_N_RACE)).otherwise(F.col("r_name"))
        .alias("race_raw"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("None"))
        .otherwise(F.col("o_orderpriority"))
        .alias("department_referral_raw"),
        F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("FALSE").alias("admitted_flag_raw"),
        F.when(F.col("l_discount") >= 0.075, _s(F.round(F.col("l_discount") * 100).cast("int")))
        .alias("satisfaction_score_raw"),
        _s(F.col("l_quantity").cast("int")).alias("wait_minutes_raw"),
        F.when(F.col("l_tax") == 0, "1").otherwise("0").alias("case_management_flag_raw"),
    ).select(*RAW_COLUMNS)


def visits_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    race = F.element_at(F.array(*[F.lit(r) for r in RACES]), (uid % 7 + 1).cast("int"))
    return ev.select(
        _s(F.col("event_id")).alias("patient_id"),
        F.date_format(F.col("ts").cast("timestamp_ntz"), RAW_TS_FORMAT).alias("admission_date_raw"),
        F.lit("X").alias("first_initial"),
        F.lit("X").alias("last_name"),
        F.when(uid % 3 == 0, "M")
        .when(uid % 3 == 1, "F")
        .when(uid % 12 == 2, "NC")
        .otherwise("M")
        .alias("gender_raw"),
        F.when(uid % 41 == 0, F.lit(None).cast("string"))
        .otherwise(_s(1 + (uid * 7) % 79))
        .alias("age_raw"),
        race.alias("race_raw"),
        F.when(F.col("event_type") == "view", F.lit("None")).otherwise(F.col("event_type"))
        .alias("department_referral_raw"),
        F.when(k % 2 == 0, "TRUE").otherwise("false").alias("admitted_flag_raw"),
        F.when(k % 4 == 0, _s(k % 11)).alias("satisfaction_score_raw"),
        F.when(k % 50 == 7, F.lit(None).cast("string"))
        .otherwise(_s(F.floor("value").cast("bigint")))
        .alias("wait_minutes_raw"),
        F.when(k % 19 == 0, "1").otherwise("0").alias("case_management_flag_raw"),
    ).select(*RAW_COLUMNS)


def visits_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    none = F.lit(None).cast("string")

    # 400 days, every ninth of them without visits; hours 4 to 20
    n = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) % 400
    n = n - F.when(n % 9 == 4, 1).otherwise(0)
    day = F.date_add(F.lit("2021-01-04").cast("date"), n)
    minutes = ((k * 7 + c) % 17 + 4) * 60 + k % 60
    at = F.timestamp_add("MINUTE", minutes, day.cast("timestamp_ntz"))
    padded = F.date_format(at, RAW_TS_FORMAT)
    admission = (F.when(k % 211 == 7, none)
                 .when(k % 4 == 1, F.date_format(at, "d-M-yyyy H:m"))
                 .when(k % 4 == 2, F.concat(F.lit("  "), padded, F.lit(" ")))
                 .otherwise(padded))
    race = F.element_at(F.array(*[F.lit(r) for r in RACES], none), (c % 8 + 1).cast("int"))
    # waits rise for a month, so that the charts have signals
    usual = (c * 13 + k) % 70 + F.when(n.between(200, 230), 45).otherwise(0)
    return o.select(
        F.when(k % 499 == 3, none).when(k % 50 == 0, _s(k + 1)).otherwise(_s(k)).alias("patient_id"),
        admission.alias("admission_date_raw"),
        F.lit("X").alias("first_initial"),
        F.lit("X").alias("last_name"),
        F.when(c % 6 == 0, "M").when(c % 6 == 1, " F ").when(c % 6 == 2, "NC").when(c % 6 == 3, "F")
        .when(c % 6 == 4, none).when(k % 10 == 0, "Unknown").otherwise("M").alias("gender_raw"),
        F.when(k % 12 == 0, "45F").when(k % 12 == 1, " 7 ").when(k % 12 == 2, "12.6")
        .when(k % 12 == 3, none).when(k % 12 == 4, "").when(k % 12 == 5, "-1").when(k % 12 == 6, "abc")
        .otherwise(_s(1 + c % 95)).alias("age_raw"),
        race.alias("race_raw"),
        F.when(k % 13 == 0, none).when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "None")
        .otherwise(F.col("o_orderpriority")).alias("department_referral_raw"),
        F.when(k % 5 == 0, "TRUE").when(k % 5 == 1, " true ").when(k % 5 == 2, "FALSE")
        .when(k % 5 == 3, "yes").when(k % 20 == 4, none).otherwise("False").alias("admitted_flag_raw"),
        F.when(k % 7 == 0, "11").when(k % 7 == 1, "7.5").when(k % 7 == 2, "-2").when(k % 7 == 3, "9")
        .when(k % 7 == 4, "5d").alias("satisfaction_score_raw"),
        F.when(k % 16 == 0, "-5").when(k % 16 == 1, "300").when(k % 16 == 2, "30D")
        .when(k % 16 == 3, " 30 ").when(k % 16 == 4, none).when(k % 16 == 5, "31.5")
        .otherwise(_s(usual)).alias("wait_minutes_raw"),
        F.when(k % 19 == 0, "1").when(k % 19 == 1, none).otherwise("0").alias("case_management_flag_raw"),
    ).select(*RAW_COLUMNS)
