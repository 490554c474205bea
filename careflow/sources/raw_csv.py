"""Raw visit CSV readers.

The raw file is read with an explicit all-string schema, renamed by position, so that
text such as ``None`` stays text and blank fields become NULL. A path may be a file, a
folder (every CSV in it is read, in parallel, one split per block) or a glob.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from careflow.schema import RAW_COLUMNS, RAW_HEADER, RAW_SCHEMA

# The tokens pandas' CSV reader treats as missing by default; the
# profile reads the raw file with these so its null counts match a pandas profile.
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class RawHeaderError(ValueError):
    pass


def check_header(spark: SparkSession, path: str) -> None:
    """Compare every file's header with the expected source header (names only: the data
    is mapped by position, so a renamed column would silently shift otherwise). Reads the
    first line of each file."""
    expected = [h.lower() for h in RAW_HEADER]

    def first_line(file: str) -> tuple[str, list[str]]:
        return file, spark.read.option("header", True).csv(unquote(file)).columns

    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(max_workers=8) as pool:
        for file, found in pool.map(first_line, files):
            names = [c.lstrip("\ufeff").strip().lower() for c in found]  # tolerate a UTF-8 BOM
            if names != expected:
                raise RawHeaderError(f"unexpected raw header in {file}: {found}")


def malformed_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows): per file the rows with too few or too many fields, which the typed read
    fills up or cuts."""
    schema = StructType([*RAW_SCHEMA.fields, StructField("_malformed", StringType())])
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_malformed").csv(path)
            .select("*", F.col("_metadata.file_path").alias("file")))
    # every field is read: a reader that skips columns cannot tell how many a row has
    whole = F.length(F.concat_ws("", *[F.col(c) for c in RAW_COLUMNS])) >= 0
    found = F.count_if(whole & F.col("_malformed").isNotNull())
    return rows.groupBy("file").agg(found.alias("rows")).where("rows > 0")


def read_raw_visits(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The raw visit file(s) as 12 string columns with positional names."""
    if check:
        check_header(spark, path)
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .select(*RAW_COLUMNS)
    )


def apply_na_values(df: DataFrame, na_values: list[str] | None = None) -> DataFrame:
    """Every column as text, values in ``na_values`` (default: pandas' list) as NULL."""
    na = PANDAS_NA_VALUES if na_values is None else na_values
    return df.select(*[
        F.when(F.col(f"`{c}`").cast("string").isin(na), F.lit(None).cast("string"))
        .otherwise(F.col(f"`{c}`").cast("string")).alias(c)
        for c in df.columns
    ])


def read_csv_for_profile(spark: SparkSession, path: str,
                         na_values: list[str] | None = None) -> DataFrame:
    """S3: any CSV with a header, every column as text, ``na_values`` tokens as NULL.

    Types are not inferred by a separate read pass; the profile decides numeric
    columns itself in its single aggregation pass (see ``operators.profile``).
    """
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return apply_na_values(df, na_values)
