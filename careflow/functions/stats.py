"""Statistics with the semantics of the measure definitions.

Skewness and kurtosis are the sample-corrected G1 / G2 (Spark's own are population moments), from
sums over counted values, NULL when n is too small or the spread is zero.
Ratios are NULL (never an error, never inf) on a zero denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def skewness_of_moments(n: Column, m2: Column, m3: Column) -> Column:
    """Adjusted Fisher-Pearson G1 = g1 * sqrt(n(n-1)) / (n-2) from the count and the sums of squared
    and cubed distances to the mean; NULL for n < 3 or no spread."""
    g1 = F.try_divide(m3 / n, F.pow(m2 / n, 1.5))
    return F.when((n >= 3) & (m2 > 0), g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_of_moments(n: Column, m2: Column, m4: Column) -> Column:
    """Sample excess kurtosis G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6) from the count and the sums of
    second and fourth powers of distances to the mean; NULL for n < 4 or no spread."""
    g2 = F.try_divide(m4 / n, F.pow(m2 / n, 2)) - 3
    return F.when((n >= 4) & (m2 > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson r over pairs with both sides non-null; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x.cast("double"))
    ys = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


def indicator(cond: Column) -> Column:
    """1.0 / 0.0 indicator (FALSE and NULL conditions give 0.0)."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (result comparison across engines)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(field.name), digits).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
