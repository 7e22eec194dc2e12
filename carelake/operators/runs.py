"""Claims runs: many files with a report per file, and the whole clean-write-forecast run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import cleaning, forecast
from carelake.session import materialise
from carelake.sources.readers import missing_to_null, read_parquet_prefix
from carelake.sources.writers import write_claims_parquet, write_forecast, write_manifest


def read_claim_files(spark: SparkSession, directory: str) -> DataFrame:
    """Raw claims of every CSV under a directory, with the file they come from; missing markers are null."""
    df = spark.read.option("header", True).option("escape", '"').option("recursiveFileLookup", True)
    rows = df.schema(read_claims_schema()).csv(directory).select("*", F.col("_metadata.file_path").alias("file"))
    return missing_to_null(rows)


def read_claims_schema() -> str:
    return ", ".join(f"`{name}` string" for name in cleaning.CLAIM_COLUMNS)


def process_all(raw: DataFrame, by: str = "file") -> DataFrame:
    """Quality report per input file; claim ids count within their file. All files are read once, rows of one id that differ twice."""
    return cleaning.stored_quality_report(raw, [by])


def claims_run(
    spark: SparkSession, raw: DataFrame, out: str, session_id: str, day: str, end_month: str, within: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Clean, write, manifest and forecast in one go; returns what was written.

    The input is read and shuffled once: the per-claim verdicts go to the shared folder, and both
    the clean table and the report come from there. ``within``: see ``cleaning.clean_claims``.
    """
    verdicts = materialise(cleaning.claim_verdicts(raw, within), "verdicts")
    if within:
        verdicts = cleaning.merge_unidentified(verdicts)
    write_claims_parquet(cleaning.clean_from_verdicts(verdicts), f"{out}/claims")
    write_manifest(spark, f"{out}/claims", f"{out}/manifest", session_id, f"{day}T00:00:00Z")
    claims = read_parquet_prefix(spark, f"{out}/claims")
    write_forecast(forecast.provider_documents(claims, end_month), f"{out}/forecast", session_id, day, end_month)
    return {
        "report": cleaning.report_from_verdicts(verdicts),
        "claims": claims,
        "manifest": spark.read.json(f"{out}/manifest"),
        "forecast": spark.read.json(f"{out}/forecast"),
    }
