"""Grouping, joining and reporting queries over claims, patients and events."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.rows import null_safe_equal
from carelake.functions.text import blank_to_null
from carelake.operators.nesting import PART_ROWS, nested_parts
from carelake.session import materialise


def top_counts(df: DataFrame, col: str, n: int | None = None, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first, ties by value; ``n`` makes it a top-k."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), F.col(col).asc())
    return out.limit(n) if n else out


def billed(claims: DataFrame) -> DataFrame:
    """Clean claims with the billed amount and the encounter they belong to."""
    return claims.withColumns({"total_amount": F.col("net_amount"), "encounter": F.substring_index("claim_id", "-", 1)})


def billing_by_encounter(claims: DataFrame, encounters: DataFrame, col: str) -> DataFrame:
    """Claims, priced claims and billed total per value of an encounter column.

    Claims are summed per encounter before the join, and an encounter id that occurs several times
    counts once (its smallest row), so neither side multiplies the other.
    """
    sums = billed(claims).groupBy("encounter").agg(
        F.count(F.lit(1)).alias("claims"), F.count("total_amount").alias("priced"), F.sum("total_amount").alias("total")
    )
    side = encounters.groupBy(F.col("id").alias("encounter")).agg(F.min(F.struct(col)).alias("first"))
    joined = sums.join(side, "encounter", "left").groupBy(F.col(f"first.{col}").alias(col))
    return joined.agg(F.sum("claims").alias("claims"), F.sum("priced").alias("priced"), F.sum("total").alias("total"))


def amount_by(claims: DataFrame, col: str, total: str) -> DataFrame:
    """Claims and rounded billed total per value of a claim column."""
    return billed(claims).groupBy(col).agg(F.count(F.lit(1)).alias("claims"), F.round(F.sum("total_amount"), 2).alias(total))


def claims_by_status(claims: DataFrame) -> DataFrame:
    return amount_by(claims, "status", "total_billed").orderBy(F.col("claims").desc(), "status")


def claims_by_date(claims: DataFrame, newest: int = 30) -> DataFrame:
    return amount_by(claims, "service_date", "total_billed").orderBy(F.col("service_date").desc()).limit(newest)


def payer_distribution(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    sums = billing_by_encounter(claims, encounters, "payer")
    out = sums.select(F.col("payer").alias("payer_name"), "claims", F.round(F.col("total") / F.col("priced"), 2).alias("avg_amount"))
    return out.orderBy(F.col("claims").desc(), "payer_name")


def encounter_classes(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Claims per encounter class."""
    sums = billing_by_encounter(claims, encounters, "encounter_class").select("encounter_class", "claims")
    return sums.orderBy(F.col("claims").desc(), "encounter_class")


def top_patients_by_spend(claims: DataFrame, n: int = 10) -> DataFrame:
    return amount_by(claims, "patient_id", "total_spend").orderBy(F.col("total_spend").desc(), "patient_id").limit(n)


def patient_activity(
    patients: DataFrame, encounters: DataFrame, medications: DataFrame, conditions: DataFrame, n: int | None = 20
) -> DataFrame:
    """Distinct encounters, drug codes and condition codes per (first, last, gender, race).

    Joining the three sides directly would multiply them per patient. Here they become one set of
    distinct (kind, patient, value), which meets the patients once in an inner join (either side
    may be split when skewed), is made distinct again per name group, since patients of one name
    count together, and is counted. Name groups are numbered in a stored table, so these rows hold
    three short cells and tasks less of them. Groups without activity come back with zeros.
    """
    group = ["first", "last", "gender", "race"]
    sides = [("encounters", encounters, "id"), ("medications", medications, "code"), ("conditions", conditions, "code")]
    parts = [
        df.select(F.lit(kind).alias("kind"), F.col("patient").alias("patient_id"), F.col(value).cast("string").alias("value"))
        .filter(F.col("patient_id").isNotNull() & F.col("value").isNotNull())
        for kind, (_, df, value) in enumerate(sides)
    ]
    activity = reduce(DataFrame.unionByName, parts).distinct()
    groups = materialise(patients.select(*group).distinct().withColumn("group_id", F.monotonically_increasing_id()), "patient-groups")
    people = patients.select(F.col("id").alias("patient_id"), *group).alias("patient")
    numbered = people.join(groups.alias("numbered"), null_safe_equal("patient", "numbered", group)).select("patient_id", "group_id")
    members = numbered.join(activity, "patient_id").select("group_id", "kind", "value").distinct()
    counts = [F.count_if(F.col("kind") == kind).alias(name) for kind, (name, _, _) in enumerate(sides)]
    out = groups.join(members.groupBy("group_id").agg(*counts), "group_id", "left")
    out = out.select(*group, *[F.coalesce(name, F.lit(0)).alias(name) for name, _, _ in sides])
    return out.orderBy(F.col("encounters").desc(), *group).limit(n) if n else out


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def outcome_summary(df: DataFrame, col: str, outcomes: Sequence[str]) -> DataFrame:
    """Total and the count of each named outcome."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(col) == o).alias(o) for o in outcomes])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-empty values, for choice lists."""
    return df.select(blank_to_null(F.col(col)).alias(col)).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def distinct_codes(df: DataFrame, code: str = "code", description: str = "description") -> DataFrame:
    """One description per code, the largest where several occur; the code is required."""
    return (
        df.select(blank_to_null(F.col(code)).alias("code"), F.coalesce(F.trim(description), F.lit("")).alias("description"))
        .filter(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.max("description").alias("description"))
    )


# Workflow steps and how event types change their state.
STEPS = ["generate_synthetic_claims", "clean_claims", "store_claims_manifest", "forecast_claims"]
ENTERED = ["TaskStateEntered", "PassStateEntered"]
EXITED = ["TaskStateExited", "PassStateExited"]
FAILED = ["TaskFailed", "ExecutionFailed", "LambdaFunctionFailed", "TaskSubmitFailed", "TaskTimedOut", "ExecutionAborted"]


def step_status(events: DataFrame) -> DataFrame:
    """Last state of each known step per execution; steps without events are PENDING."""
    state = (
        F.when(F.col("type").isin(ENTERED), "RUNNING")
        .when(F.col("type").isin(EXITED), "SUCCEEDED")
        .when(F.col("type").isin(FAILED), "FAILED")
    )
    folded = events.withColumn("state", state)
    last = [
        F.max_by("state", F.when((F.col("step") == s) & F.col("state").isNotNull(), F.col("event_id"))).alias(s)
        for s in STEPS
    ]
    wide = folded.groupBy("execution_id").agg(*last)
    long = wide.unpivot("execution_id", STEPS, "step", "status")
    return long.withColumn("status", F.coalesce("status", F.lit("PENDING")))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def limited_result(df: DataFrame, order_by: Sequence[str], limit: int) -> tuple[DataFrame, bool]:
    """At most ``limit`` rows and whether the result was cut there.

    Like the hosted query client, a result that reaches the limit counts as truncated. The rows are
    stored, so that counting and reading them runs the query once.
    """
    rows = materialise(df.orderBy(*order_by).limit(limit), "limited")
    return rows, rows.count() >= limit


def newest(df: DataFrame, by: Sequence[str], n: int | None = 100) -> DataFrame:
    """Newest entries first, at most ``n`` of them unless that is None."""
    ordered = df.orderBy(*[F.col(c).desc() for c in by])
    return ordered if n is None else ordered.limit(n)


def display_names(entries: str) -> F.Column:
    """Sorted names of a list of entries, comma separated."""
    return F.array_join(F.array_sort(F.filter(entries, lambda e: F.coalesce(e, F.lit("")) != "")), ", ")


def display_name_parts(entries: DataFrame, group: str, name: str, size: int = PART_ROWS) -> DataFrame:
    """``display_names`` of any number of entries per group: numbered parts (from 0) of at most ``size`` sorted names.

    Null and empty names are left out, so a group without any other has no part.
    """
    named = entries.select(group, name).filter(F.coalesce(name, F.lit("")) != "")
    parts = nested_parts(named, [group], [name], F.col(f"`{name}`"), "names", size)
    return parts.withColumn("names", F.array_join("names", ", "))


def column_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows under the union of all columns, first seen first."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """The table with extra columns for names people use by mistake."""
    return df.select("*", *[F.col(real).alias(alias) for alias, real in aliases.items()])


# Mistaken column names and the real ones, per table.
COLUMN_ALIASES = {
    "medications": {
        "medication_name": "description",
        "drug_name": "description",
        "med_name": "description",
        "patient_id": "patient",
    },
}


def sql_over(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """SQL over named frames, with their alias columns, without registering session-wide views.

    Names after FROM and JOIN are bound to the frames; a frame that is used as a qualifier needs an
    alias in the text.
    """
    used = {n: df for n, df in tables.items() if re.search(rf"(FROM|JOIN)\s+{n}\b", text)}
    text = text.replace("{", "{{").replace("}", "}}")
    for name in used:
        text = re.sub(rf"(FROM|JOIN)\s+{name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **{n: with_aliases(df, COLUMN_ALIASES.get(n, {})) for n, df in used.items()})
