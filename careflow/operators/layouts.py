"""Timestamp layouts of text columns, inferred by a vote of the values.

A text fits if it is three numbers between equal separators, one of them a four-digit year, with an
optional time. Where the year stands and the separator show in the text; whether the day or the
month comes first does not, but a component above 12 tells. So one aggregation counts, per column,
separator and place of the year, the values that are dates with the day first and those that are with
the month first; the larger count is the column's order there, and a tie (no value tells) goes to
the habit of the layout: year-month-day, month/day/year, day-month-year and day.month.year. A
column may mix layouts: each of its separators is decided on its own.

Votes are taken over (column, value, n) tables, so a value that fills a third of a column is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: numbers, separators and the time of a layout.
TEXT = (r"^([0-9]{1,4})([-/.])([0-9]{1,2})([-/.])([0-9]{1,4})"
        r"(?:[T ]+([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\.([0-9]{1,6}))?)?)?$")


def _part(text: Column, k: int) -> Column:
    return F.regexp_extract(text, TEXT, k)


def _dates(vc: DataFrame) -> DataFrame:
    """``vc`` (column, value, n) with sep, year_first and the timestamps that the value stands for
    with the day first and with the month first; all NULL where it fits no layout."""
    v = F.trim("value")
    split = vc.select("*", *[_part(v, k).alias(f"_g{k}") for k in range(1, 10)])
    a, b, c = F.col("_g1"), F.col("_g3"), F.col("_g5")
    year_first = (F.length(a) == 4) & (F.length(c) <= 2)
    year_last = (F.length(c) == 4) & (F.length(a) <= 2)
    fits = (F.col("_g2") == F.col("_g4")) & (F.length(b) > 0) & (year_first | year_last)

    def number(text: Column) -> Column:
        return F.when(F.length(text) > 0, text).otherwise("0").cast("int")

    clock = (number(F.col("_g6")) <= 23) & (number(F.col("_g7")) <= 59) & (number(F.col("_g8")) <= 59)
    seconds = F.concat(number(F.col("_g8")).cast("string"), F.lit("."), F.rpad("_g9", 6, "0")).cast("decimal(8,6)")

    def moment(day: Column, month: Column) -> Column:
        year = number(F.when(year_first, a).otherwise(c))
        return F.when(fits & clock, F.try_make_timestamp_ntz(
            year, number(month), number(day), number(F.col("_g6")), number(F.col("_g7")), seconds))

    first, second = F.when(year_first, b).otherwise(a), F.when(year_first, c).otherwise(b)
    return split.select(
        *vc.columns, F.when(fits, F.col("_g2")).alias("sep"), F.when(fits, year_first).alias("year_first"),
        moment(first, second).alias("_day_first"), moment(second, first).alias("_month_first"))


def layout_votes(vc: DataFrame) -> DataFrame:
    """(column, sep, year_first, day_first_votes, month_first_votes, day_first) from the counted
    values of columns: six rows a column at most."""
    def votes(ts: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(ts).isNotNull(), F.col("n"))), F.lit(0)).cast("bigint")

    counted = _dates(vc).where(F.col("sep").isNotNull()).groupBy("column", "sep", "year_first").agg(
        votes("_day_first").alias("day_first_votes"), votes("_month_first").alias("month_first_votes"))
    day, month = F.col("day_first_votes"), F.col("month_first_votes")
    habit = ~F.col("year_first") & (F.col("sep") != "/")
    return counted.where((day > 0) | (month > 0)).withColumn(
        "day_first", F.when(day != month, day > month).otherwise(habit))


def parsed(vc: DataFrame) -> DataFrame:
    """``vc`` with ``ts``, the value read in its column's layout; NULL where it does not fit."""
    # six rows a column: a bounded broadcast
    votes = F.broadcast(layout_votes(vc).select("column", "sep", "year_first", "day_first"))
    return _dates(vc).join(votes, ["column", "sep", "year_first"], "left").select(
        *vc.columns, F.when(F.col("day_first"), F.col("_day_first")).otherwise(
            F.when(~F.col("day_first"), F.col("_month_first"))).alias("ts"))
