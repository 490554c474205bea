"""Mergeable column sketches: distinct values (HyperLogLog) and quantiles (KLL) of text tables.

The exact profile shuffles a row per distinct value and column; the sketches shuffle a few
kilobytes per column and map task, whatever the distinct values. They are kept per source (a file, a
day, a batch), written as a table, and merged to any set of sources without reading the data again.

Bounds: the distinct count of ``2 ** LG_K`` registers has a relative standard error of
1.04 / sqrt(2 ** LG_K) (1.6 %), the rank of a quantile an error below about 1.7 / KLL_K (0.4 %)
in 99 of 100 sketches. ``distinct_bounds`` and ``RANK_ERROR`` state three such errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions.parsing import cast_double

LG_K = 12
KLL_K = 400
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.015
PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def column_sketches(df: DataFrame, source: Column) -> DataFrame:
    """(source, column, rows, nulls, distinct_sketch, quantile_sketch): one pass over ``df``, every
    column as text; quantiles are of the values that are numbers (NULL if there are none)."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in df.columns])).alias("cell")
    read = df.select(source.alias("source"), cells).select(
        "source", "cell.*", cast_double(F.col("cell.value")).alias("x"))
    numbers = F.when(~F.isnan("x"), F.col("x"))
    return read.groupBy("source", "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.count(numbers).alias("numbers"),
        F.hll_sketch_agg("value", F.lit(LG_K)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(numbers, F.lit(KLL_K)).alias("quantile_sketch"),
    )


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """The sketches of the union of sources, per ``keys``."""
    return sketches.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "numbers")],
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        # a sketch without numbers adds none
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimates(sketches: DataFrame, probs: dict[str, float] | None = None) -> DataFrame:
    """Row counts, the estimated distinct values and the estimated quantiles of every sketch row."""
    has = F.col("numbers") > 0
    quantiles = [F.when(has, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p))).alias(name)
                 for name, p in (probs or PROBS).items()]
    rest = [c for c in sketches.columns if not c.endswith("_sketch")]
    return sketches.select(*rest, F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *quantiles)


def distinct_bounds(estimate: Column) -> tuple[Column, Column]:
    """The exact counts that an estimate is compatible with (three standard errors)."""
    return F.floor(estimate / (1 + DISTINCT_ERROR)), F.ceil(estimate / (1 - DISTINCT_ERROR))
