"""CSV, Parquet and JSON readers, file listings and header-derived names."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.text import blank_to_null, strip
from carelake.operators.corpus import SECTIONS

# Markers that a CSV cell uses for "missing".
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The tables of the data lake.
LAKE_TABLES = [
    "allergies", "careplans", "conditions", "devices", "encounters", "imaging_studies", "immunizations", "medications",
    "observations", "organizations", "patients", "payer_transitions", "payers", "procedures", "providers", "supplies",
]


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_reader(spark: SparkSession, columns: Sequence[str] | None = None, multi_line: bool = False):
    """Reader for header CSV with every column as text; quotes inside quotes are doubled.

    ``multi_line`` allows line breaks in cells, at the price that a file is no longer split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.schema(string_schema(columns)) if columns else reader


def read_csv_strings(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    na_values: Sequence[str] = NA_VALUES,
    multi_line: bool = False,
) -> DataFrame:
    """CSV as text columns; cells that hold a missing marker are null."""
    return missing_to_null(csv_reader(spark, columns, multi_line).csv(path), na_values)


def missing_to_null(df: DataFrame, na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """Cells of text columns that hold a missing marker become null."""
    cell = lambda c: F.when(~F.col(f"`{c}`").isin(list(na_values)), F.col(f"`{c}`")).alias(c)
    return df.select(*[cell(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def read_csv_trimmed(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV as text columns, names and cells trimmed, a byte-order mark dropped."""
    df = csv_reader(spark, columns, multi_line).csv(path)
    return df.select(*[strip(F.col(f"`{c}`")).alias(c.lstrip("\ufeff").strip()) for c in df.columns])


def column_name(text: str) -> str:
    """Catalog column name of a CSV header cell: lower case, anything but letters, digits and underscores replaced."""
    return re.sub("[^a-z0-9_]", "_", text.strip().lower()) or "col"


def csv_schema_from_header(df: DataFrame) -> DataFrame:
    """The table under catalog column names; repeated names get a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        name = column_name(c)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def table_name_from_file(file_name: Column) -> Column:
    """Lower-case stem, other characters than letters and digits as underscores, outer ones dropped."""
    stem = F.lower(F.regexp_replace(F.substring_index(file_name, "/", -1), r"\.[^.]*$", ""))
    return F.trim(F.regexp_replace(stem, r"[^\p{L}\p{N}]", "_"), F.lit("_"))


def load_views(
    spark: SparkSession, directory: str, tables: Sequence[str] = LAKE_TABLES, columns: Mapping[str, Sequence[str]] | None = None, prefix: str = ""
) -> DataFrame:
    """Register ``directory/<table>`` CSVs as views and return the row count of each.

    Nulls become empty text, as in the lake. Tables without rows keep their columns. ``prefix`` keeps
    the views apart from others of the session.
    """
    counts = []
    for name in tables:
        df = csv_reader(spark, (columns or {}).get(name)).csv(f"{directory}/{name}").na.fill("")
        df.createOrReplaceTempView(prefix + name)
        counts.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, counts)


def read_parquet_prefix(spark: SparkSession, directory: str) -> DataFrame:
    """All Parquet files under a prefix."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(directory)


def read_nested_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Whole-file JSON documents."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def list_files(spark: SparkSession, directory: str, suffix: str = "") -> DataFrame:
    """Files below a directory with key, name, size and time; their content is never read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(directory)
    )
    return files.select(
        F.col("path").alias("key"),
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def newest_files(files: DataFrame) -> DataFrame:
    return files.orderBy(F.col("last_modified").desc(), "key")


def total_bytes(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def latest_file(files: DataFrame) -> DataFrame:
    """Key of the newest file; the last in name order among equals."""
    return files.agg(F.max_by("key", F.struct("last_modified", "key")).alias("key"))


def file_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows of a file-based table that come from one file."""
    return df.filter(F.col("_metadata.file_name") == name)


LABEL_SCHEMA = T.StructType(
    [
        T.StructField("drug_name", T.StringType()),
        T.StructField(
            "openfda",
            T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("brand_name", "generic_name", "rxcui")]),
        ),
        *[T.StructField(s, T.ArrayType(T.StringType())) for s in SECTIONS],
    ]
)


def read_label_documents(spark: SparkSession, path: str) -> DataFrame:
    """Drug labels, one JSON document per line."""
    return spark.read.schema(LABEL_SCHEMA).json(path)


def read_code_table(spark: SparkSession, path: str) -> DataFrame:
    """Code table CSV: code and name, both required, the last row of a code in file order wins."""
    df = csv_reader(spark).csv(path)
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    rows = df.select(blank_to_null(F.col("LOINC_NUM")).alias("code"), blank_to_null(F.col("LONG_COMMON_NAME")).alias("name"), at.alias("at"))
    return rows.dropna("any", subset=["code", "name"]).groupBy("code").agg(F.max_by("name", "at").alias("name"))
