"""Profile of a raw text table (any columns), before any model is written.

Input: a DataFrame of text columns with missing-value tokens already NULL
(``sources.raw_csv.read_csv_for_profile`` / ``apply_na_values``). Column types are
inferred from the values the way a dataframe library would (integers, floats,
booleans, else text) inside the profile's own aggregation, without a separate
schema-inference pass over the file.

Plan shape, independent of the column count:

* one pre-aggregated long table ``(column, value, n)`` (explode + partial
  aggregation; a hot value costs one row per task), counted once and kept as Parquet,
  feeds R2-R5 and R7;
* R6 groups 128-bit row digests and compares whole rows only where digests meet;
* R4 exact quantiles use a range-partitioned sort of the distinct numbers and a rank
  lookup (no aggregation buffer holds all distinct values of a column); ``exact=False``
  uses ``percentile_approx`` instead, and ``operators.sketches`` keeps mergeable sketches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.functions.parsing import CAST_TEXT, cast_double, parse_double
from careflow.functions.stats import ratio
from careflow.operators import layouts, sketches
from careflow.operators.ranking import global_cumsum
from careflow.schema import RAW_COLUMNS
from careflow.session import checkpoint_dir, kept

# Text spellings read as booleans, and the describe() percentiles.
TRUE_TEXT = ["True", "TRUE", "true"]
FALSE_TEXT = ["False", "FALSE", "false"]
DESCRIBE_PERCENTILES = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
MAX_LOW_CARDINALITY = 15
TOP_VALUES = 15
DATE_SHARE = 0.9
_INT_RE = r"^\s*[+-]?[0-9]+\s*$"


def long_values(df: DataFrame) -> DataFrame:
    """(column, value) for every cell, as text."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in df.columns
    ])).alias("cell")
    return df.select(cells).select("cell.column", "cell.value")


def value_counts(df: DataFrame) -> DataFrame:
    """(column, value, n): one row per distinct raw text (NULL included) per column."""
    return long_values(df).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def counted_values(df: DataFrame) -> DataFrame:
    """:func:`value_counts` of a raw table, computed once: every part of the profile reads it."""
    return kept(read_values(value_counts(df)), "values")


def read_values(vc: DataFrame) -> DataFrame:
    """``vc`` (column, value, n) with what its readers ask of a text: x, the number that it casts
    to, and whether it is an integer, a number, or shaped like a date. A text is looked at once."""
    if "x" in vc.columns:
        return vc
    v = F.col("value")
    like = v.rlike(CAST_TEXT)  # holds of every integer and number, and of no date
    return vc.select(
        "column", "value", "n", cast_double(v).alias("x"), (like & v.rlike(_INT_RE)).alias("is_int"),
        (like & parse_double(v).isNotNull()).alias("is_number"),
        (~like & F.trim(v).rlike(layouts.TEXT)).alias("is_dated"))


def _counted(df: DataFrame, vc: DataFrame | None) -> DataFrame:
    return counted_values(df) if vc is None else read_values(vc)


def column_types(vc: DataFrame) -> DataFrame:
    """Per column: rows, NULLs and the inferred dtype, from the distinct-text table."""
    v = F.col("value")
    per_col = read_values(vc).groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("_texts"),
        F.bool_and(v.isNull() | F.col("is_int")).alias("_all_int"),
        F.bool_and(v.isNull() | F.col("is_number")).alias("_all_float"),
        F.bool_and(v.isNull() | v.isin(TRUE_TEXT + FALSE_TEXT)).alias("_all_bool"),
    )
    has_null = F.col("nulls") > 0
    dtype = (
        F.when(F.col("_texts") == 0, F.lit("float64"))
        .when(F.col("_all_int"), F.when(has_null, F.lit("float64")).otherwise(F.lit("int64")))
        .when(F.col("_all_float"), F.lit("float64"))
        .when(F.col("_all_bool"), F.when(has_null, F.lit("object")).otherwise(F.lit("bool")))
        .otherwise(F.lit("object"))
    )
    return per_col.select("column", "rows", "nulls", dtype.alias("dtype"))


def typed_value_counts(vc: DataFrame) -> DataFrame:
    """(column, value, n) over *typed* values: texts that are the same number or the
    same boolean are one value (e.g. '1' and ' 1' in an integer column), written as
    the canonical text of the type. Derived from the distinct-text table, so this
    second pass costs one row per distinct text, not per cell; the texts of object columns
    are their own canonical form, distinct already, and are not moved again."""
    types = column_types(vc).select("column", "dtype")
    v, dt = F.col("value"), F.col("dtype")
    canonical = (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(dt == "int64", F.trim(v).try_cast("bigint").cast("string"))
        .when(dt == "float64", v.try_cast("double").cast("string"))
        .otherwise(F.when(v.isin(TRUE_TEXT), F.lit("True")).otherwise(F.lit("False")))
    )
    # one row per column: broadcasting the type table is bounded by the column count
    texts = vc.join(F.broadcast(types), "column")
    typed = texts.where(dt != "object").groupBy("column", canonical.alias("value")).agg(F.sum("n").alias("n"))
    return typed.unionByName(texts.where(dt == "object").select("column", "value", "n"))


def column_summary(df: DataFrame, vc: DataFrame | None = None) -> DataFrame:
    """R2 + R7: per column dtype, NULLs, NULL %, distinct (non-null, typed) values, and
    for columns whose name contains 'id' the duplicated values (NULL counted as a value).
    ``vc``: the table's :func:`counted_values`, if they are at hand."""
    vc = _counted(df, vc)
    types = column_types(vc)
    typed = typed_value_counts(vc).groupBy("column").agg(
        F.count("value").alias("distinct"), F.count(F.lit(1)).alias("_distinct_with_null"))
    order = F.array_position(F.array(*[F.lit(c) for c in df.columns]), F.col("column"))
    return types.join(typed, "column").select(
        order.cast("int").alias("position"),
        "column",
        "dtype",
        F.col("nulls").cast("bigint").alias("nulls"),
        F.round(ratio(F.col("nulls"), F.col("rows")) * 100, 1).alias("null_pct"),
        F.col("distinct").cast("bigint").alias("distinct"),
        F.when(F.lower(F.col("column")).contains("id"),
               (F.col("rows") - F.col("_distinct_with_null")).cast("bigint")).alias("duplicate_values"),
    )


def low_cardinality_values(df: DataFrame, max_distinct: int = MAX_LOW_CARDINALITY,
                           top: int = TOP_VALUES, vc: DataFrame | None = None) -> DataFrame:
    """Value counts (NULL included) of columns with 1..max_distinct non-null typed
    values, the ``top`` most frequent per column (ties: value order, NULL first)."""
    vc = typed_value_counts(_counted(df, vc))
    # Distinct counts per column by a plain aggregate (partial, fixed-size buffers); the
    # result has one row per column, so broadcasting it to pick the low-cardinality
    # columns is bounded. Only their <= max_distinct + 1 rows reach the ranking window,
    # never the values of an id-like column.
    low = vc.groupBy("column").agg(F.count("value").alias("_distinct")).filter(
        (F.col("_distinct") >= 1) & (F.col("_distinct") <= max_distinct)
    ).select("column")
    ranked = vc.join(F.broadcast(low), "column").withColumn("rank", F.row_number().over(
        Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())))
    return ranked.filter(F.col("rank") <= top).select(
        "column", "value", F.col("n").cast("bigint").alias("n"), F.col("rank").cast("int").alias("rank"))


def numeric_describe(df: DataFrame, exact: bool = True, vc: DataFrame | None = None) -> DataFrame:
    """Count, mean, std, min, percentiles, max of every numeric column.

    Everything is read from the *distinct* (column, number, count) table; the raw table is
    scanned once. Exact percentiles interpolate linearly between order statistics: a weighted
    running count along (column, value) gives every distinct value its rank range, and each
    wanted rank is found by an equi-join on the column plus a range filter. Only distinct values
    are sorted, never all cells, and no aggregation buffer holds a column's values.
    """
    vc = _counted(df, vc)
    numeric = column_types(vc).filter(F.col("dtype").isin("int64", "float64")).select("column")
    counts = kept(vc.select("column", "x", "n").filter(F.col("x").isNotNull()).join(
        F.broadcast(numeric), "column").groupBy("column", "x").agg(F.sum("n").alias("n")), "numbers")
    n, x = F.col("n"), F.col("x")
    level = counts.groupBy("column").agg(
        F.sum("n").alias("count"), ratio(F.sum(x * n), F.sum(n)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"))
    # The spread about the mean: a second look at the distinct numbers, one mean per column.
    spread = counts.join(F.broadcast(level.select("column", "mean")), "column").groupBy("column").agg(
        F.sum(n * F.pow(x - F.col("mean"), 2)).alias("_m2"))
    moments = level.join(spread, "column").select(
        "column", "count", "mean", F.sqrt(F.try_divide(F.col("_m2"), F.col("count") - 1)).alias("std"), "min", "max")
    names = [f"p{int(p * 100)}" for p in DESCRIBE_PERCENTILES]
    if not exact:
        cells = long_values(df).select("column", cast_double(F.col("value")).alias("x")).filter(
            F.col("x").isNotNull()).join(F.broadcast(numeric), "column")
        q = cells.groupBy("column").agg(F.percentile_approx("x", DESCRIBE_PERCENTILES, 100000).alias("_q"))
        q = q.select("column", *[F.col("_q")[i].alias(name) for i, name in enumerate(names)])
        return moments.join(q, "column")
    ranked = global_cumsum(counts, ["column", "x"], "n", "_before")
    starts = ranked.groupBy("column").agg(F.min("_before").alias("_start"), F.sum("n").alias("_total"))
    wanted = starts.select(
        "column",
        F.explode(F.array(*[F.struct(F.lit(n).alias("q"), F.lit(p).alias("p"))
                            for n, p in zip(names, DESCRIBE_PERCENTILES)])).alias("w"),
        "_start", "_total",
    ).select("column", F.col("w.q").alias("q"), ((F.col("_total") - 1) * F.col("w.p")).alias("h"), "_start")
    lookups = wanted.select(
        "column", "q", (F.col("h") - F.floor("h")).alias("frac"),
        F.explode(F.array(
            F.struct(F.lit("lo").alias("end"), (F.col("_start") + F.floor("h")).cast("bigint").alias("k")),
            F.struct(F.lit("hi").alias("end"), (F.col("_start") + F.ceil("h")).cast("bigint").alias("k")),
        )).alias("e"),
    ).select("column", "q", "frac", "e.end", "e.k")
    # lookups: columns x percentiles x 2 rows, a fixed bound; the range filter runs
    # after a hash join on the column name.
    hits = ranked.join(F.broadcast(lookups), "column").filter(
        (F.col("k") >= F.col("_before")) & (F.col("k") < F.col("_before") + F.col("n")))
    ends = hits.groupBy("column", "q").agg(
        F.first("frac").alias("frac"),
        F.max(F.when(F.col("end") == "lo", F.col("x"))).alias("x_lo"),
        F.max(F.when(F.col("end") == "hi", F.col("x"))).alias("x_hi"),
    )
    qv = ends.select("column", "q", (F.col("x_lo") + F.col("frac") * (F.col("x_hi") - F.col("x_lo"))).alias("v"))
    wide = qv.groupBy("column").pivot("q", names).agg(F.first("v"))
    return moments.join(wide, "column").select("column", "count", "mean", "std", "min", *names, "max")


def _text_columns(vc: DataFrame) -> DataFrame:
    """The counted values of the columns that are neither numbers nor booleans."""
    text = column_types(vc).filter(F.col("dtype") == "object").select("column")
    return read_values(vc).join(F.broadcast(text), "column")  # one row per column: bounded


def datetime_layouts(df: DataFrame, vc: DataFrame | None = None) -> DataFrame:
    """The votes that decide how a text column's dates are read (``operators.layouts``)."""
    return layouts.layout_votes(_text_columns(_counted(df, vc)).where("is_dated").select("column", "value", "n"))


def datetime_columns(df: DataFrame, share: float = DATE_SHARE, vc: DataFrame | None = None) -> DataFrame:
    """Text columns where more than ``share`` of all rows are timestamps in the column's own
    layouts, with the first and the last of them."""
    texts = _text_columns(_counted(df, vc))
    rows = texts.groupBy("column").agg(F.sum("n").alias("_rows"))
    # only texts shaped like a date are read; the others count as rows
    read = layouts.parsed(texts.where("is_dated").select("column", "value", "n")).groupBy("column").agg(
        F.sum(F.when(F.col("ts").isNotNull(), F.col("n"))).alias("_read"),
        F.min("ts").alias("min"), F.max("ts").alias("max"),
    )
    # one row per column
    agg = read.join(F.broadcast(rows), "column").select(
        "column", ratio(F.col("_read"), F.col("_rows")).alias("parsed_share"), "min", "max")
    return agg.filter(F.col("parsed_share") > share)


DIGEST_WORDS = 1 << 18  # of 64 bits: 2 MB, whatever the table's size


def _row_digest(df: DataFrame) -> DataFrame:
    """``df`` with a digest of 128 bits. NULL and empty text, and a NULL's place, differ in it."""
    known = [p for c in df.columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return df.select("*", F.xxhash64(F.lit(1), *known).alias("_d1"), F.xxhash64(F.lit(2), *known).alias("_d2"))


def overview(df: DataFrame) -> DataFrame:
    """R1 + R6: rows, columns and fully duplicated rows (occurrences after the first).

    Phase 1 counts rows per digest: 24 bytes of a distinct row are shuffled, not its columns.
    The digests that occur more than once mark bits of a filter of fixed size. Phase 2 compares
    whole rows, but only those that meet a marked bit: the copies themselves, rows whose digests
    agree by chance, and, as the filter fills, a share of the others. Single rows add nothing to
    the count, so it is exact whatever the digests do.
    """
    checkpoint_dir(df.sparkSession)
    digests = _row_digest(df).groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_d2").bitwiseAND(F.lit(63)).cast("int"))
    word = F.pmod("_d1", F.lit(DIGEST_WORDS))
    # At most DIGEST_WORDS rows.
    words = digests.groupBy(word.alias("w")).agg(
        F.sum("_n").alias("rows"), F.bit_or(F.when(F.col("_n") > 1, bit)).alias("b")).checkpoint(eager=True)
    marks = words.where("b IS NOT NULL").select(F.col("w").alias("_w"), F.col("b").alias("_b"))
    # a bounded broadcast; a lookup by hash, where an array of all words was copied for every row
    met = _row_digest(df).join(F.broadcast(marks), word == F.col("_w")).where(F.col("_b").bitwiseAND(bit) != 0)
    copies = met.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg((F.count(F.lit(1)) - 1).alias("_more"))
    more = copies.agg(F.coalesce(F.sum("_more"), F.lit(0)))
    return words.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), more.scalar().cast("bigint").alias("fully_duplicated_rows"))


# ---------------------------------------------------------------- registered queries

def _raw(wh) -> DataFrame:
    from careflow.sources.raw_csv import apply_na_values

    return apply_na_values(wh.raw_visits)


def _layouts_sql(columns: list[str], table: str) -> dict[str, str]:
    """R5 by text functions: both readings of every value as ISO text, cast if possible."""
    cells = " union all ".join(f"""select '{c}' as "column", trim({c}) as v from {table}""" for c in columns)
    groups = "['a', 's', 'b', 's2', 'c', 'h', 'm', 'sec', 'f']"
    clock = ("lpad(g.h, 2, '0') || ':' || lpad(g.m, 2, '0') || ':' || lpad(g.sec, 2, '0') "
             "|| '.' || rpad(g.f, 6, '0')")

    def iso(day: str, month: str) -> str:
        return f"try_cast(y || '-' || lpad({month}, 2, '0') || '-' || lpad({day}, 2, '0') || ' ' || {clock} as timestamp)"

    read = f"""
cells as ({cells}),
textual as (select "column" from (
    select "column", count(v) as n, bool_and(v is null or try_cast(v as double) is not null) as numbers,
           bool_and(v is null or lower(v) in ('true', 'false')) as bools from cells group by 1)
    where n > 0 and not numbers and not bools),
split as (
    select "column", v, regexp_extract(v, '{layouts.TEXT}', {groups}) as g,
           regexp_full_match(v, '{layouts.TEXT}') as shaped
    from cells join textual using ("column")),
placed as (
    select *, case when shaped and g.s = g.s2 and length(g.a) = 4 and length(g.c) <= 2 then true
                   when shaped and g.s = g.s2 and length(g.c) = 4 and length(g.a) <= 2 then false end as year_first
    from split),
ordered as (
    select *, g.s as sep, case when year_first then g.a else g.c end as y,
           case when year_first then g.b else g.a end as p, case when year_first then g.c else g.b end as q
    from placed),
readings as (
    select "column", v, sep, year_first,
           case when year_first is not null and coalesce(try_cast(g.sec as int), 0) < 60 then {iso("p", "q")} end as dm,
           case when year_first is not null and coalesce(try_cast(g.sec as int), 0) < 60 then {iso("q", "p")} end as md
    from ordered),
tally as (
    select "column", sep, year_first, count(dm) as day_first_votes, count(md) as month_first_votes
    from readings where year_first is not null group by all having count(dm) + count(md) > 0),
decided as (
    select *, case when day_first_votes > month_first_votes then true
                   when day_first_votes < month_first_votes then false
                   else not year_first and sep <> '/' end as day_first from tally)"""
    found = f"""select * from (with {read}
select "column", count(ts)::double / count(*) as parsed_share, min(ts) as "min", max(ts) as "max"
from (select r."column", case when d.day_first then r.dm when not d.day_first then r.md end as ts
      from readings r left join decided d
        on d."column" = r."column" and d.sep = r.sep and d.year_first = r.year_first)
group by 1 having count(ts)::double / count(*) > {DATE_SHARE})"""
    return {"r5": found, "r5v": f"select * from (with {read} select * from decided)"}


def _oracle_sql() -> dict[str, str]:
    from careflow.sources.raw_csv import PANDAS_NA_VALUES

    na = ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_NA_VALUES)
    cleaned = ",\n".join(f"case when {c} in ({na}) then null else {c} end as {c}" for c in RAW_COLUMNS)
    base = f"clean as (select {cleaned} from raw)"
    bools = ", ".join(f"'{b}'" for b in TRUE_TEXT + FALSE_TEXT)
    per_col = " union all ".join(
        f"""select {i + 1} as position, '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls,
            count(distinct {c}) as texts,
            bool_and({c} is null or regexp_full_match({c}, '\\s*[+-]?[0-9]+\\s*')) as all_int,
            bool_and({c} is null or try_cast({c} as double) is not null) as all_float,
            bool_and({c} is null or {c} in ({bools})) as all_bool
            from clean"""
        for i, c in enumerate(RAW_COLUMNS))
    trues = ", ".join(f"'{b}'" for b in TRUE_TEXT)
    types = f"""types as (
        select position, "column", rows, nulls,
            case when texts = 0 then 'float64'
                 when all_int then case when nulls > 0 then 'float64' else 'int64' end
                 when all_float then 'float64'
                 when all_bool then case when nulls > 0 then 'object' else 'bool' end
                 else 'object' end as dtype
        from ({per_col}))"""
    tvc = " union all ".join(
        f"""select '{c}' as "column",
               case when {c} is null then null
                    when t.dtype = 'int64' then try_cast(trim({c}) as bigint)::varchar
                    when t.dtype = 'float64' then try_cast({c} as double)::varchar
                    when t.dtype = 'bool' then case when {c} in ({trues}) then 'True' else 'False' end
                    else {c} end as value,
               count(*) as n
            from clean, (select dtype from types where "column" = '{c}') t group by 2"""
        for c in RAW_COLUMNS)
    colsum = f"""tvc as ({tvc}),
    colsum as (
        select t.position, t."column", t.dtype, t.nulls,
               round(t.nulls * 100.0 / nullif(t.rows, 0), 1) as null_pct, d."distinct",
               case when lower(t."column") like '%id%' then t.rows - d.dwn end as duplicate_values
        from types t join (select "column", count(value) as "distinct", count(*) as dwn from tvc group by 1) d
          on t."column" = d."column")"""
    pre = f", {base}, {types}, {colsum} "
    r3 = f"""select "column", value, n, rank from (
        select *, count(value) over (partition by "column") as d,
               row_number() over (partition by "column" order by n desc, value asc nulls first)::int as rank
        from tvc) where d between 1 and {MAX_LOW_CARDINALITY} and rank <= {TOP_VALUES}"""
    pct = ", ".join(f"quantile_cont(x, {p}) as p{int(p * 100)}" for p in DESCRIBE_PERCENTILES)
    r4 = " union all ".join(
        f"""select '{c}' as "column", count(x) as "count", avg(x) as mean, stddev_samp(x) as std,
                   min(x) as "min", {pct}, max(x) as "max"
            from (select try_cast({c} as double) as x from clean where try_cast({c} as double) is not null)
            where (select dtype from types where "column" = '{c}') in ('int64', 'float64')
            having count(x) > 0"""
        for c in RAW_COLUMNS)
    r5 = _layouts_sql(RAW_COLUMNS, "clean")
    cols = ", ".join(RAW_COLUMNS)
    r1 = f"""select sum(k)::bigint as rows, {len(RAW_COLUMNS)} as columns, sum(k - 1)::bigint as fully_duplicated_rows
             from (select count(*) as k from clean group by {cols})"""
    return {"pre": pre, "r1": r1, "r2": "select * from colsum", "r3": r3, "r4": r4, **r5}


SQL = _oracle_sql()
QUERIES = {}
for _src, _sfx in (("lineitem", ""), ("events", "_ev"), ("orders", "_dirty")):
    QUERIES[f"r1_r6_profile_overview{_sfx}"] = (_src, SQL["r1"], (), lambda wh: overview(_raw(wh)), SQL["pre"])
    QUERIES[f"r2_r7_profile_columns{_sfx}"] = (_src, SQL["r2"], ("null_pct",),
                                              lambda wh: column_summary(_raw(wh)), SQL["pre"])
    QUERIES[f"r3_value_counts{_sfx}"] = (_src, SQL["r3"], (), lambda wh: low_cardinality_values(_raw(wh)),
                                        SQL["pre"])
    QUERIES[f"r4_numeric_describe{_sfx}"] = (
        _src, SQL["r4"], ("mean", "std", "min", "p25", "p50", "p75", "p90", "p95", "p99", "max"),
        lambda wh: numeric_describe(_raw(wh), exact=True), SQL["pre"])
    QUERIES[f"r5_datetime_columns{_sfx}"] = (_src, SQL["r5"], ("parsed_share",),
                                            lambda wh: datetime_columns(_raw(wh)), SQL["pre"])
    QUERIES[f"r5_layout_votes{_sfx}"] = (_src, SQL["r5v"], (), lambda wh: datetime_layouts(_raw(wh)), SQL["pre"])

# Columns that write the visits' times in one layout each, in two, or mostly: (Spark, DuckDB).
_MIXED = {
    "us_slash": ("date_format(visit_ts, 'M/d/yyyy')", "strftime(visit_ts, '%-m/%-d/%Y')"),
    "eu_slash": ("date_format(visit_ts, 'd/M/yyyy H:m')", "strftime(visit_ts, '%-d/%-m/%Y %-H:%-M')"),
    "eu_dot": ("date_format(visit_ts, 'd.M.yyyy H:m')", "strftime(visit_ts, '%-d.%-m.%Y %-H:%-M')"),
    "iso": ("date_format(visit_ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "strftime(visit_ts, '%Y-%m-%dT%H:%M:%S')"),
    "year_day": ("date_format(visit_ts, 'yyyy-dd-MM')", "strftime(visit_ts, '%Y-%d-%m')"),
    "two_layouts": ("CASE WHEN minute(visit_ts) % 2 = 0 THEN date_format(visit_ts, 'dd/MM/yyyy') "
                    "ELSE date_format(visit_ts, 'yyyy-MM-dd HH:mm') END",
                    "case when minute(visit_ts) % 2 = 0 then strftime(visit_ts, '%d/%m/%Y') "
                    "else strftime(visit_ts, '%Y-%m-%d %H:%M') end"),
    "no_telling": ("concat('0', 1 + month(visit_ts) % 9, '-0', 1 + month(visit_ts) % 7, '-', year(visit_ts))",
                   "concat('0', 1 + month(visit_ts) % 9, '-0', 1 + month(visit_ts) % 7, '-', year(visit_ts))"),
    "mostly": ("CASE WHEN hour(visit_ts) = 9 THEN 'unknown' ELSE date_format(visit_ts, 'd-M-yyyy') END",
               "case when hour(visit_ts) = 9 then 'unknown' else strftime(visit_ts, '%-d-%-m-%Y') end"),
    "seldom": ("CASE WHEN hour(visit_ts) > 9 THEN 'unknown' ELSE date_format(visit_ts, 'd-M-yyyy') END",
               "case when hour(visit_ts) > 9 then 'unknown' else strftime(visit_ts, '%-d-%-m-%Y') end"),
}


def _mixed(wh) -> DataFrame:
    return wh.stg_er_visits.where("visit_ts IS NOT NULL").selectExpr(*[f"{x} AS {c}" for c, (x, _) in _MIXED.items()])


_MIXED_CTE = (", mixed as (select " + ", ".join(f"{x} as {c}" for c, (_, x) in _MIXED.items())
              + " from stg where visit_ts is not null)")
for _src, _sfx in (("lineitem", ""), ("orders", "_dirty")):
    _sql = _layouts_sql(list(_MIXED), "mixed")
    QUERIES[f"r5_mixed_layouts{_sfx}"] = (_src, _sql["r5"], ("parsed_share",),
                                         lambda wh: datetime_columns(_mixed(wh)), _MIXED_CTE)
    QUERIES[f"r5_mixed_layout_votes{_sfx}"] = (_src, _sql["r5v"], (), lambda wh: datetime_layouts(_mixed(wh)), _MIXED_CTE)


def sketch_errors(df: DataFrame, source: Column) -> DataFrame:
    """The merged sketches of ``df``'s sources against the exact counts: per column the distinct
    texts, and whether the estimates keep their bounds."""
    checkpoint_dir(df.sparkSession)
    parts = sketches.column_sketches(df, source).checkpoint(eager=True)
    estimated = sketches.estimates(sketches.merged_sketches(parts))
    vc = counted_values(df)
    low, high = sketches.distinct_bounds(F.col("distinct"))
    # the share of a column's numbers below and up to each estimate: its rank range
    names = list(sketches.PROBS)
    exact = vc.select("column", "value", "n", "x")
    exact = exact.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    ranks = exact.join(F.broadcast(estimated.select("column", *names)), "column").groupBy("column").agg(
        F.count("value").alias("exact"), F.sum("n").alias("exact_rows"),
        F.sum(F.when(F.col("x").isNotNull(), F.col("n"))).alias("_numbers"),
        *[F.sum(F.when(F.col("x") < F.col(q), F.col("n")).otherwise(0)).alias(f"_below_{q}") for q in names],
        *[F.sum(F.when(F.col("x") <= F.col(q), F.col("n")).otherwise(0)).alias(f"_upto_{q}") for q in names])
    within = [(ratio(F.col(f"_below_{q}"), F.col("_numbers")) <= p + sketches.RANK_ERROR)
              & (ratio(F.col(f"_upto_{q}"), F.col("_numbers")) >= p - sketches.RANK_ERROR)
              for q, p in sketches.PROBS.items()]
    return estimated.join(ranks, "column").select(
        "column", "rows", "nulls", F.col("exact").alias("distinct_texts"),
        ((F.col("exact") >= low) & (F.col("exact") <= high) & (F.col("rows") == F.col("exact_rows"))).alias("distinct_within"),
        reduce(Column.__and__, within).alias("quantiles_within"))


_SKETCH_SQL = " union all ".join(
    f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls,
        count(distinct {c}) as distinct_texts, true as distinct_within,
        case when count(try_cast({c} as double)) > 0 then true end as quantiles_within from clean"""
    for c in RAW_COLUMNS)
for _src, _sfx in (("lineitem", ""), ("orders", "_dirty")):
    QUERIES[f"r2_r4_sketches{_sfx}"] = (
        _src, _SKETCH_SQL, (),
        lambda wh: sketch_errors(_raw(wh), F.pmod(F.xxhash64("patient_id"), F.lit(5))), SQL["pre"])
