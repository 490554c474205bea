"""Column-expression helpers: typed parsing, banding, and statistics with exact
semantics. All return JVM-side ``Column`` expressions (no Python UDFs)."""

from careflow.functions.parsing import (
    age_band,
    parse_bool_text,
    parse_int_rounding,
    parse_visit_ts,
    segment_key,
    shift_band,
)
from careflow.functions.stats import (
    guarded_corr,
    kurtosis_of_moments,
    ratio,
    round_doubles,
    skewness_of_moments,
)

__all__ = [
    "age_band", "parse_bool_text", "parse_int_rounding", "parse_visit_ts", "segment_key",
    "shift_band", "guarded_corr", "kurtosis_of_moments", "ratio", "round_doubles",
    "skewness_of_moments",
]
