"""Medication store: typed rows, identifiers, filters, lookups, pages and the several-drugs report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import iso8601
from carelake.functions.numbers import INTEGER, NUMBER, nullable_number
from carelake.functions.text import blank_to_null, first_present, strip
from carelake.operators import nesting
from carelake.operators.ordinals import row_ordinal

# Accepted spellings, best first.
PATIENT_ID_NAMES = ["id", "Id", "ID", "patient", "patientId", "PATIENT"]
FULL_NAME_NAMES = ["name", "NAME", "fullName", "full_name", "fullname"]
FIRST_NAME_NAMES = ["first", "FIRST", "firstName", "first_name"]
LAST_NAME_NAMES = ["last", "LAST", "lastName", "last_name"]
MEDICATION_MARKS = ["PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST"]


def present(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-blank of the aliases the table has; column names match without regard to case."""
    known = {c.lower(): c for c in df.columns}
    found = list(dict.fromkeys(known[n.lower()] for n in names if n.lower() in known))
    return first_present([F.col(f"`{c}`") for c in found]) if found else F.lit(None).cast("string")


def patient_id(df: DataFrame) -> Column:
    return present(df, PATIENT_ID_NAMES)


def patient_name(df: DataFrame) -> Column:
    """Full name, else first and last, else whichever of the two exists."""
    first, last = present(df, FIRST_NAME_NAMES), present(df, LAST_NAME_NAMES)
    return F.coalesce(present(df, FULL_NAME_NAMES), F.nullif(F.concat_ws(" ", first, last), F.lit("")))


def resolved_patients(df: DataFrame) -> DataFrame:
    """Patient id and display name from whatever spellings the table uses."""
    return df.select(patient_id(df).alias("patient_id"), patient_name(df).alias("patient_name"))


def with_patient_names(df: DataFrame, patients: DataFrame, id_col: str) -> DataFrame:
    """Left join the display name; the smallest non-empty name stands for an id with several."""
    names = (
        resolved_patients(patients)
        .filter(F.col("patient_id").isNotNull() & F.col("patient_name").isNotNull())
        .groupBy(F.col("patient_id").alias(id_col))
        .agg(F.min("patient_name").alias("patient_name"))
    )
    return df.join(names, id_col, "left")


def is_medication_row(df: DataFrame) -> Column:
    """A row with any of the medication columns filled."""
    known = {c.upper(): c for c in df.columns}
    hit = F.lit(False)
    for name in MEDICATION_MARKS:
        if name in known:
            hit = hit | (F.coalesce(F.col(known[name]), F.lit("")) != "")
    return hit


def route_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Medication-shaped rows and all others."""
    mark = is_medication_row(df)
    return df.filter(mark), df.filter(~mark)


def column_types(df: DataFrame) -> dict[str, str]:
    """Type per text column from one pass: bigint or double only where every filled cell fits."""
    checks = []
    for i, name in enumerate(df.columns):
        text = blank_to_null(F.col(f"`{name}`"))
        whole = F.when(text.isNotNull(), text.rlike(INTEGER) & text.try_cast("bigint").isNotNull())
        dotted = text.rlike(NUMBER) & F.contains(text, F.lit("."))
        checks += [
            F.count(text).alias(f"n{i}"),
            F.bool_and(whole).alias(f"whole{i}"),
            F.bool_and(whole | dotted).alias(f"number{i}"),
        ]
    profile = df.agg(*checks).first()
    types = {}
    for i, name in enumerate(df.columns):
        if profile[f"n{i}"] and profile[f"whole{i}"]:
            types[name] = "bigint"
        elif profile[f"n{i}"] and profile[f"number{i}"]:
            types[name] = "double"
        else:
            types[name] = "string"
    return types


def type_generic_rows(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Text rows to typed items: lower-case names, blanks as null, one type per column, an ``id``.

    Rows without an id get the first three values joined by dashes plus the row's input position.
    """
    types = column_types(df)
    source = row_ordinal(df, order_by or df.columns, "__row")
    out = []
    for name in df.columns:
        key = name.strip().lower()
        if key:
            out.append(blank_to_null(F.col(f"`{name}`")).try_cast(types[name]).alias(key))
    typed = source.select(*out, "__row")
    names = [c for c in typed.columns if c != "__row"]
    seed = F.coalesce(F.nullif(F.concat_ws("-", *[F.col(f"`{c}`").cast("string") for c in names[:3]]), F.lit("")), F.lit("row"))
    made = F.concat(seed, F.lit("-"), F.col("__row").cast("string"))
    own = F.col("id").cast("string") if "id" in names else F.lit(None).cast("string")
    others = [F.col(f"`{c}`") for c in names if c != "id"]
    return typed.select(F.coalesce(own, made).alias("id"), *others)


def medication_rows(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Medication CSV rows to typed items; the id holds the row's 0-based input position."""
    rows = row_ordinal(df, order_by or df.columns, "__row")
    filled = lambda name, default: F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))
    # casting an empty text raises an exception inside, which costs more than all else about a cell
    number = lambda name: nullable_number(F.nullif(F.col(name), F.lit("")))
    item_id = F.concat_ws(
        "-",
        filled("PATIENT", "patient"),
        filled("ENCOUNTER", "encounter"),
        filled("CODE", "code"),
        filled("START", "nostart"),
        filled("STOP", "nostop"),
        F.col("__row").cast("string"),
    )
    return rows.select(
        item_id.alias("id"),
        iso8601(F.col("START")).alias("start"),
        iso8601(F.col("STOP")).alias("stop"),
        F.col("PATIENT").alias("patient"),
        F.col("PAYER").alias("payer"),
        F.col("ENCOUNTER").alias("encounter"),
        F.col("CODE").alias("code"),
        F.col("DESCRIPTION").alias("description"),
        number("BASE_COST").alias("baseCost"),
        number("PAYER_COVERAGE").alias("payerCoverage"),
        number("DISPENSES").alias("dispenses"),
        number("TOTALCOST").alias("totalCost"),
        F.col("REASONCODE").alias("reasonCode"),
        F.col("REASONDESCRIPTION").alias("reasonDescription"),
    )


def default_medication_id(df: DataFrame) -> Column:
    """``id``, else ``medicationId``, else patient, encounter and code with literal stand-ins."""
    have = set(df.columns)
    text = lambda name: F.nullif(F.col(name).cast("string"), F.lit("")) if name in have else F.lit(None).cast("string")
    made = F.concat_ws("-", *[F.coalesce(text(n), F.lit(n)) for n in ("patient", "encounter", "code")])
    return F.coalesce(text("id"), text("medicationId"), made)


def medication_items(df: DataFrame) -> DataFrame:
    """Request bodies to stored items: default id, canonical timestamps, numbers."""
    have = set(df.columns)
    col = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    numbers = ["baseCost", "payerCoverage", "dispenses", "totalCost"]
    plain = ["patient", "payer", "encounter", "code", "description", "reasonCode", "reasonDescription"]
    return df.select(
        default_medication_id(df).alias("id"),
        iso8601(col("start")).alias("start"),
        iso8601(col("stop")).alias("stop"),
        *[col(n).alias(n) for n in plain],
        *[nullable_number(col(n)).alias(n) for n in numbers],
    )


def find_medications(
    df: DataFrame, id: str | None = None, patient_id: str | None = None, medication_id: str | None = None
) -> DataFrame:
    """Equality on the given arguments, all of which must hold; plain predicates reach the scan."""
    for name, value in {"id": id, "patient": patient_id, "code": medication_id}.items():
        if value:
            df = df.filter(F.col(name) == value)
    return df


def active_medications(df: DataFrame, stop: str = "stop") -> DataFrame:
    """Rows whose stop is null or blank."""
    return df.filter(blank_to_null(F.col(stop)).isNull())


def sort_by_description(df: DataFrame, descending: bool = False, top_n: int = 0, key: str = "id") -> DataFrame:
    """Case-insensitive by description, missing as empty text; ``top_n`` makes it a top-k, not a sort."""
    by = F.lower(F.coalesce("description", F.lit("")))
    out = df.orderBy(by.desc() if descending else by.asc(), F.col(key).asc())
    return out.limit(top_n) if top_n > 0 else out


def sorted_patients(patients: DataFrame, top_n: int | None = None) -> DataFrame:
    """Patients by last, then first name without regard to case, then id."""
    key = lambda c: F.lower(F.coalesce(c, F.lit("")))
    out = patients.select("id", "last", "first").orderBy(key("last"), key("first"), "id")
    return out.limit(top_n) if top_n else out


def sorted_codes(medications: DataFrame, top_n: int | None = None) -> DataFrame:
    """Distinct drug codes, ascending."""
    out = medications.filter(F.coalesce("code", F.lit("")) != "").select("code").distinct().orderBy("code")
    return out.limit(top_n) if top_n else out


def page_after(df: DataFrame, keys: Sequence[str], after: Sequence | None = None, limit: int = 50) -> DataFrame:
    """The next ``limit`` rows after a key (possibly of several columns); deep pages cost no more."""
    if after is not None:
        df = df.filter(F.col(keys[0]) >= after[0])
        later = F.struct(*[F.col(k).alias(k) for k in keys]) > F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, after)])
        df = df.filter(later)
    return df.orderBy(*keys).limit(limit)


def drug_sort_key(c: Column) -> Column:
    """Description without an NDA prefix and a leading strength, trimmed, in lower case."""
    # Prefix patterns.
    c = F.regexp_replace(c, r"(?i)^NDA\w*\s+", "")
    c = F.regexp_replace(c, r"(?i)^\d+(\.\d+)?\s+(HR|ML|ACTUAT|MG|MCG|UNT)\s+", "")
    return F.lower(strip(c))


def sorted_drugs(df: DataFrame) -> DataFrame:
    """Medication choices ordered by :func:`drug_sort_key`, then id."""
    return df.withColumn("sort_key", drug_sort_key(F.col("description"))).orderBy("sort_key", "id")


def drug_conditions(drugs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the condition list of each drug; the stored text holds one condition per line."""
    lines = F.transform(F.split("conditions", "\n"), strip)
    conditions = mapping.select("drug_name", F.filter(lines, lambda c: c != "").alias("conditions"))
    return drugs.join(conditions, "drug_name", "left")


def multi_medication_flat(medications: DataFrame, patients: DataFrame) -> DataFrame:
    """Patients with more than one distinct code: one row per patient and code.

    Both levels aggregate map-side; a patient with very many rows shuffles only distinct codes.
    """
    per_code = (
        medications.filter(blank_to_null(F.col("patient")).isNotNull() & F.col("code").isNotNull() & (F.col("code") != ""))
        .groupBy(F.col("patient").alias("patient_id"), F.col("code").alias("medication_id"))
        .agg(F.min(F.nullif("description", F.lit(""))).alias("medication_name"), F.count(F.lit(1)).alias("count"))
    )
    several = per_code.groupBy("patient_id").agg(F.count(F.lit(1)).alias("medication_count")).filter("medication_count > 1")
    return per_code.join(with_patient_names(several, patients, "patient_id"), "patient_id")


def patients_with_multiple_medications(medications: DataFrame, patients: DataFrame, top_n: int = 0) -> DataFrame:
    """Nested report: patients by number of codes, their codes by count; ties by id and code.

    The array of a patient has one entry per distinct drug code; :func:`multi_medication_parts` bounds it. With ``top_n`` the patients are
    chosen before any nesting. Use :func:`multi_medication_flat` to avoid nesting altogether.
    """
    flat = multi_medication_flat(medications, patients)
    order = [F.col("medication_count").desc(), F.col("patient_id").asc()]
    if top_n > 0:
        chosen = flat.select("patient_id", "medication_count").distinct().orderBy(*order).limit(top_n)
        flat = flat.join(chosen.select("patient_id"), "patient_id", "left_semi")
    entry = F.struct((-F.col("count")).alias("neg"), "medication_id", "medication_name", "count")
    nested = flat.groupBy("patient_id", "patient_name", "medication_count").agg(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["medication_id"].alias("medicationId"), e["medication_name"].alias("medicationName"), e["count"].alias("count")),
        ).alias("medications")
    )
    return nested.orderBy(*order)


def multi_medication_parts(medications: DataFrame, patients: DataFrame, size: int = nesting.PART_ROWS) -> DataFrame:
    """The nested report for all patients with several codes, in parts of at most ``size`` codes.

    As :func:`patients_with_multiple_medications`, but a patient's array is cut into numbered parts, so no row grows with
    the number of codes.
    """
    flat = multi_medication_flat(medications, patients).withColumn("neg", -F.col("count"))
    entry = F.struct(F.col("medication_id").alias("medicationId"), F.col("medication_name").alias("medicationName"), "count")
    group = ["patient_id", "patient_name", "medication_count"]
    return nesting.nested_parts(flat, group, ["neg", "medication_id"], entry, "medications", size)
