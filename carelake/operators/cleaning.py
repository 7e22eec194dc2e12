"""Claims cleaning, its quality report, whole-row deduplication and claim shaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, IntegralType, StringType, TimestampNTZType

from carelake.functions.dates import parse_date
from carelake.functions.numbers import nullable_number
from carelake.functions.rows import null_safe_equal, row_hash_of
from carelake.functions.text import blank_to_null, is_missing, strip, strip_or_empty
from carelake.session import materialise, shuffles_freed

# The claims schema, in column order.
CLAIM_TYPES = {
    "claim_id": "string",
    "patient_id": "string",
    "patient_name": "string",
    "service_date": "date",
    "status": "string",
    "claim_type": "string",
    "use": "string",
    "provider_id": "string",
    "provider_name": "string",
    "diagnosis_code": "string",
    "diagnosis_description": "string",
    "procedure_code": "string",
    "procedure_description": "string",
    "unit_price": "double",
    "quantity": "int",
    "net_amount": "double",
    "currency": "string",
    "insurance_member_id": "string",
    "priority": "string",
}
CLAIM_COLUMNS = list(CLAIM_TYPES)
LOWER_CASE = ["status", "claim_type", "use", "priority"]
NUMERIC = ["unit_price", "quantity", "net_amount"]
REQUIRED_CODES = ["claim_id", "diagnosis_code", "procedure_code"]
CURRENCY = "^[A-Z]{3}$"
DEFAULT_CURRENCY = "USD"
# Claim ids that are broadcast at most, and the slices in which the rows of more are read again.
FEW_IDS = 100_000
REREAD_SLICES = 4
# Types whose text tells their values apart.
_PLAIN = (StringType, IntegralType, FloatType, DoubleType, BooleanType, DateType, TimestampNTZType)


def normalise_case(df: DataFrame) -> DataFrame:
    """Categorical columns in lower case, the currency in upper case."""
    changes = {name: F.lower(name) for name in LOWER_CASE if name in df.columns}
    if "currency" in df.columns:
        changes["currency"] = F.upper("currency")
    return df.withColumns(changes)


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unparsable numbers become null."""
    return df.withColumns({name: nullable_number(F.col(name)) for name in cols})


def bad_currency(c: Column) -> Column:
    return F.coalesce(~c.rlike(CURRENCY), F.lit(True))


def fix_currency(df: DataFrame) -> DataFrame:
    """Anything but three capital letters becomes the default currency."""
    return df.withColumn("currency", F.when(bad_currency(F.col("currency")), DEFAULT_CURRENCY).otherwise(F.col("currency")))


def amount_mismatch(net: Column, price: Column, quantity: Column) -> Column:
    """Net amount differs from price times quantity by more than one percent."""
    expected = price * quantity
    return F.abs(net - expected) / F.greatest(expected, F.lit(0.01)) > 0.01


def standardise(raw: DataFrame) -> DataFrame:
    """The 19 claim columns trimmed, case-folded, numbers as doubles; absent text is empty here."""
    df = raw.select(*[strip_or_empty(F.col(name)).alias(name) for name in CLAIM_COLUMNS], *_extra(raw))
    return coerce_numeric(normalise_case(df), NUMERIC)


def _extra(raw: DataFrame) -> list[str]:
    return [name for name in raw.columns if name not in CLAIM_TYPES]


def _codes_missing(claim: str) -> Column:
    missing = F.lit(False)
    for name in REQUIRED_CODES:
        missing = missing | is_missing(F.col(f"{claim}.{name}"))
    return missing


def _reject_reason() -> Column:
    """First failing step before deduplication; null for rows that go on."""
    any_number_missing = F.lit(False)
    for name in NUMERIC:
        any_number_missing = any_number_missing | F.col(name).isNull()
    return (
        F.when(is_missing(F.col("service_date")), "missing_date")
        .when(any_number_missing, "invalid_numerics")
        .when(F.col("quantity") <= 0, "non_positive_qty")
    )


def claim_verdicts(raw: DataFrame, by: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
    """One row per claim id (and per ``by`` group): row counts per early step and the kept claim.

    Keep-first is a ``min`` over a struct in one aggregation rather than a ranking window: every
    task reduces its rows of a claim id to one before the shuffle, so an id that fills a third of
    the table costs no more than any other. ``order_by`` names columns that define "first" (say
    file and position); the 19 claim columns follow as tie-break.
    """
    reason = _reject_reason()
    claim = F.struct(*order_by, *CLAIM_COLUMNS)
    return (
        standardise(raw)
        .withColumn("reason", reason)
        .groupBy(*by, F.col("claim_id").alias("key_id"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("reason") == "missing_date").alias("n_missing_date"),
            F.count_if(F.col("reason") == "invalid_numerics").alias("n_invalid_numerics"),
            F.count_if(F.col("reason") == "non_positive_qty").alias("n_non_positive_qty"),
            F.min(F.when(F.col("reason").isNull(), claim)).alias("claim"),
        )
        .withColumn("reject", _late_reject())
    )


def merge_unidentified(verdicts: DataFrame) -> DataFrame:
    """Stored verdicts of ``by`` groups that a claim id determines, with one verdict for all rows without an id."""
    counts = [c for c in verdicts.columns if c.startswith("n_")]
    known = verdicts.filter("key_id <> ''").select("key_id", *counts, "claim", "reject")
    rest = verdicts.filter("key_id = ''").groupBy("key_id").agg(*[F.sum(c).alias(c) for c in counts], F.min("claim").alias("claim"))
    return known.unionByName(rest.withColumn("reject", _late_reject()))


def _late_reject() -> Column:
    return (
        F.when(F.col("claim").isNull(), "early")
        .when(_codes_missing("claim"), "missing_codes")
        .when(parse_date(F.col("claim.service_date")).isNull(), "invalid_date")
    )


def _finished(claims: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns in schema order; currency repaired, date parsed, quantity cut to an integer. ``keep`` names columns that go first."""
    typed = fix_currency(claims).withColumn("service_date", parse_date(F.col("service_date")))
    out = [
        F.nullif(F.col(n), F.lit("")).alias(n) if t == "string" else F.col(n).try_cast(t).alias(n)
        for n, t in CLAIM_TYPES.items()
    ]
    return typed.select(*keep, *out)


def clean_from_verdicts(verdicts: DataFrame) -> DataFrame:
    """The clean claims held in :func:`claim_verdicts`."""
    return _finished(verdicts.filter(F.col("reject").isNull()).select(*[f"claim.{n}" for n in CLAIM_COLUMNS]))


def clean_claims(raw: DataFrame, order_by: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
    """Raw text claims to typed clean claims.

    Step order: trim, case, missing date, numbers, positive quantity, first row per claim id,
    missing codes, currency, date. A kept first row with a bad date removes the whole claim.
    Early rejects are left out inside the aggregation: as a filter, Catalyst would push the parsing
    below the projection and do it twice. Counters nobody asks for are pruned.

    ``within`` names further columns that a claim id determines: input that is partitioned by them is not shuffled again.
    Claims without an id are never clean, so they may differ there.
    """
    return clean_from_verdicts(claim_verdicts(raw, within, order_by))


def claim_digest() -> Column:
    """SHA-256 over all fields of a clean claim; negative zero equals zero."""
    numbers = {n: F.col(n) + F.lit(0.0) for n, t in CLAIM_TYPES.items() if t == "double"}
    return F.unhex(row_hash_of({n: F.col(n) for n in CLAIM_TYPES} | numbers))


def new_claims(raw: DataFrame, known: DataFrame) -> DataFrame:
    """:func:`clean_claims` without those whose id and digest are ``known`` (``claim_id, digest``).

    Where ``spark.sql.requireAllClusterKeysForCoPartition`` is off, the claims meet the digests in the partitioning by id that
    keep-first leaves them in, and are shuffled once.
    """
    kept = claim_verdicts(raw).filter(F.col("reject").isNull()).select("key_id", *[f"claim.{n}" for n in CLAIM_COLUMNS])
    claims = _finished(kept, ["key_id"]).withColumn("digest", claim_digest())
    same = (F.col("n.key_id") == F.col("k.claim_id")) & (F.col("n.digest") == F.col("k.digest"))
    return claims.alias("n").join(known.alias("k"), same, "left_anti").select(*CLAIM_COLUMNS)


def report_from_verdicts(verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts per cleaning step."""
    c = "claim"
    after_codes = F.col("claim").isNotNull() & ~_codes_missing(c)
    n_valid = F.col("n_rows") - F.col("n_missing_date") - F.col("n_invalid_numerics") - F.col("n_non_positive_qty")
    total = lambda col: F.coalesce(F.sum(col), F.lit(0)).cast("bigint")
    report = [
        total(F.col("n_rows")).alias("original_rows"),
        total(F.col("n_missing_date")).alias("dropped_missing_date"),
        total(F.col("n_invalid_numerics")).alias("dropped_invalid_numerics"),
        total(F.col("n_non_positive_qty")).alias("dropped_non_positive_qty"),
        (total(n_valid) - F.count("claim")).alias("dropped_duplicate_claims"),
        F.count_if(F.col("reject") == "missing_codes").alias("dropped_missing_codes"),
        F.count_if(after_codes & bad_currency(F.col("claim.currency"))).alias("corrected_currency"),
        F.count_if(
            after_codes & amount_mismatch(F.col("claim.net_amount"), F.col("claim.unit_price"), F.col("claim.quantity"))
        ).alias("rows_amount_mismatch"),
        F.count_if(F.col("reject") == "invalid_date").alias("dropped_invalid_dates"),
        F.count_if(F.col("reject").isNull()).alias("clean_rows"),
    ]
    return verdicts.groupBy(*by).agg(*report)


def quality_report(raw: DataFrame, by: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
    """The cleaning report, one row in total or one per ``by`` group, from one pass over the input."""
    return report_from_verdicts(claim_verdicts(raw, by, order_by), by)


def stored_quality_report(raw: DataFrame, by: Sequence[str]) -> DataFrame:
    """:func:`quality_report` per ``by`` group of rows that are stored, and so may be read twice, without shuffling whole claims.

    A claim id whose valid rows all give the same answers counts the same whichever of them is first, so the rows are shuffled as
    the id and the row's answers alone. Ids whose rows differ are noted, and only their rows are read again for the kept claim; where such
    ids are many, in slices by id, so that disk holds the shuffles of one slice.
    """
    late = ["dropped_missing_codes", "corrected_currency", "rows_amount_mismatch", "dropped_invalid_dates", "clean_rows"]
    early = {n: f"dropped_{n}" for n in ("missing_date", "invalid_numerics", "non_positive_qty")}
    rows = standardise(raw).withColumns({"reason": _reject_reason(), "claim": F.struct(*CLAIM_COLUMNS)})
    answers = F.when(F.col("reason").isNull(), _answers())
    ids = rows.select(*by, F.col("claim_id").alias("key_id"), "reason", answers.alias("answers")).groupBy(*by, "key_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("reason") == n).alias(n) for n in early],
        F.min("answers").alias("answers"),
        (F.min("answers") != F.max("answers")).alias("differ"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    valid = F.col("n_rows") - sum((F.col(n) for n in early), F.lit(0))
    alike = F.when(~F.col("differ"), F.col("answers"))
    # one row per group, and one per id whose rows differ
    counts = ids.groupBy(*by, F.when(F.col("differ"), F.col("key_id")).alias("asked_id")).agg(
        total(F.col("n_rows")).alias("original_rows"),
        *[total(F.col(n)).alias(name) for n, name in early.items()],
        (total(valid) - F.count("answers")).alias("dropped_duplicate_claims"),
        *[F.count_if(alike.bitwiseAND(F.lit(1 << i)) != 0).alias(n) for i, n in enumerate(late)],
    )
    counts = materialise(counts, "claim-counts")
    asked = counts.filter(F.col("asked_id").isNotNull()).select(*by, "asked_id")
    few = (n := asked.count()) <= FEW_IDS
    slices = min(n, 1) if few else REREAD_SLICES
    same = null_safe_equal("r", "a", by) & (strip_or_empty(F.col("r.claim_id")) == F.col("a.asked_id"))
    for i in range(slices):
        own = lambda key: F.pmod(F.xxhash64(key), F.lit(slices)) == i  # noqa: E731, B023
        side = F.broadcast(asked) if few else asked.filter(own("asked_id"))
        again = raw if few else raw.filter(own(strip_or_empty(F.col("claim_id"))))
        kept = quality_report(again.alias("r").join(side.alias("a"), same, "left_semi"), by).select(*by, *late)
        with shuffles_freed(raw.sparkSession):
            counts = counts.unionByName(materialise(kept, "kept-claims"), allowMissingColumns=True)
    report = [c for c in counts.columns if c not in (*by, "asked_id")]
    return counts.groupBy(*by).agg(*[total(F.col(n)).alias(n) for n in report])


def _answers() -> Column:
    """What the report asks of a valid row as bits: codes missing, currency corrected, amounts differ, bad date, clean."""
    found = F.coalesce(_late_reject(), F.lit("clean"))
    coded = ~_codes_missing("claim")
    mismatch = amount_mismatch(F.col("net_amount"), F.col("unit_price"), F.col("quantity"))
    bits = [found == "missing_codes", coded & bad_currency(F.col("currency")), coded & mismatch, found == "invalid_date", found == "clean"]
    return sum((F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)), F.lit(0))


def drop_any_blank(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim every cell and keep only rows without a blank or missing field."""
    names = list(cols or df.columns)
    # as a filter over a projection, Spark would trim every cell again in the filter
    cells = F.array(F.struct(*[blank_to_null(F.col(name)).alias(name) for name in names]))
    whole = F.filter(cells, lambda row: reduce(Column.__and__, [row[name].isNotNull() for name in names]))
    others = [F.col(c) for c in df.columns if c not in names]
    return df.select(*others, F.inline(whole)).select(*df.columns)


def blank_report(df: DataFrame) -> DataFrame:
    """Input, dropped and kept row counts of :func:`drop_any_blank`."""
    kept = F.lit(True)
    for name in df.columns:
        kept = kept & blank_to_null(F.col(name)).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_input"),
        F.count_if(~kept).alias("dropped"),
        F.count_if(kept).alias("written"),
    )


def anti_join_existing(incoming: DataFrame, stored: DataFrame, prune: str | None = None) -> DataFrame:
    """Incoming rows whose fields do not all equal those of a stored row; incoming copies stay.

    Nulls equal nulls. Rows of plain cells are known by a SHA-256 over all fields, so stored rows shrink to distinct digests and
    are shuffled once; others are joined field by field. A row stored many times is one join key either way. ``prune`` names a
    column (a date) whose incoming range bounds the stored scan.
    """
    if prune:
        low, high = incoming.agg(F.min(prune), F.max(prune)).first()
        in_range = F.col(prune).between(low, high) if low is not None else F.lit(False)
        holds_null = F.col(prune).isNull()
        stored = stored.filter(in_range | holds_null)
    cols = incoming.columns
    types = {f.name: f.dataType for f in incoming.schema}
    if all(isinstance(t, _PLAIN) and stored.schema[n].dataType == t for n, t in types.items()):
        # as Spark's equality has it, negative zero equals zero
        cells = {n: (F.col(f"`{n}`") + F.lit(0).cast(t) if isinstance(t, (FloatType, DoubleType)) else F.col(f"`{n}`")).cast("string") for n, t in types.items()}
        digest = F.unhex(row_hash_of(cells)).alias("__digest")
        known = stored.select(digest).distinct()
        return incoming.select("*", digest).join(known, "__digest", "left_anti").drop("__digest")
    known = stored.select(*cols).distinct().alias("known")
    return incoming.alias("new").join(known, null_safe_equal("new", "known", cols), "left_anti")


def claims_resource(claims: DataFrame) -> DataFrame:
    """Flat claims as nested claim resources; ``created`` is absent without a service date."""
    # Resource constants of the exchange format.
    coding = lambda system, code, display: F.struct(
        F.array(F.struct(F.lit(system).alias("system"), F.lit(code).alias("code"), F.lit(display).alias("display"))).alias(
            "coding"
        )
    )
    reference = lambda kind, c: F.struct(F.concat(F.lit(kind), c).alias("reference"))
    resource = F.struct(
        F.lit("Claim").alias("resourceType"),
        F.col("claim_id").alias("id"),
        F.lit("active").alias("status"),
        coding("http://terminology.hl7.org/CodeSystem/claim-type", "professional", "Professional").alias("type"),
        F.lit("claim").alias("use"),
        reference("Patient/", F.col("patient_id")).alias("patient"),
        reference("Practitioner/", F.col("provider_id")).alias("provider"),
        coding("http://terminology.hl7.org/CodeSystem/processpriority", "normal", "Normal").alias("priority"),
        F.array(
            F.struct(
                F.lit(1).alias("sequence"),
                F.lit(True).alias("focal"),
                reference("Coverage/cov-", F.col("patient_id")).alias("coverage"),
            )
        ).alias("insurance"),
        F.concat(F.date_format("service_date", "yyyy-MM-dd"), F.lit("T00:00:00+00:00")).alias("created"),
    )
    return claims.select("claim_id", resource.alias("resource"))
