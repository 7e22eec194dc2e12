"""Registered queries: medications, patients, analytics, item catalog and table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.rows import flat_text, row_contains
from carelake.functions.text import contains_text
from carelake.operators import analytics, items, keys, medications, pages
from carelake.plans.claims_queries import CLEAN_CTE, clean
from carelake.plans.domain import cte, run_sql, table, view
from carelake.session import scratch_path

PATIENT = "42"
CODE = "77"
PAGE_START = ["2", ""]
#: Codes or names in one cell of a nested report.
PART_CODES = 500

_KEYED_ORDERS = """
SELECT o_orderkey, to_json(named_struct(
  'urgent', CASE WHEN o_orderpriority LIKE '1%' THEN true END, 'id', o_orderkey,
  'done', CASE WHEN o_orderstatus = 'F' THEN o_custkey END, 'open', CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END,
  'tags', CASE WHEN o_orderstatus = 'P' THEN array(o_orderpriority, o_orderstatus) END)) AS body
FROM orders"""

RAW_MEDICATIONS = """
SELECT substr(cast(l_shipdate AS string), 1, 10) AS START,
       CASE WHEN l_linestatus = 'O' THEN '' ELSE concat(substr(cast(l_shipdate AS string), 1, 10), 'T08:30:00Z') END AS STOP,
       cast(o_custkey AS string) AS PATIENT, 'payer' AS PAYER, cast(l_orderkey AS string) AS ENCOUNTER,
       CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE cast(l_partkey AS string) END AS CODE, p_name AS DESCRIPTION,
       CASE WHEN l_partkey % 23 = 0 THEN '12x' ELSE concat(' ', cast(cast(p_retailprice AS decimal(18,2)) AS string)) END
         AS BASE_COST,
       '' AS PAYER_COVERAGE, cast(cast(l_quantity AS int) AS string) AS DISPENSES,
       cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS TOTALCOST, l_returnflag AS REASONCODE,
       CASE WHEN l_returnflag = 'R' THEN concat('Reason ', p_type) END AS REASONDESCRIPTION
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey"""
_RAW_ORDER = (
    "START, STOP, PATIENT, PAYER, ENCOUNTER, CODE NULLS FIRST, DESCRIPTION, BASE_COST, PAYER_COVERAGE, DISPENSES,"
    " TOTALCOST, REASONCODE"
)

_GENERIC = """
SELECT p_brand AS Brand, concat(' ', cast(p_size AS string)) AS SIZE,
       cast(cast(p_retailprice AS decimal(18,2)) AS string) AS price, p_name AS name,
       CASE WHEN p_size > 25 THEN 'large' ELSE cast(p_size AS string) END AS mixed, ' ' AS empty,
       cast(p_partkey AS string) AS part
FROM part"""

_ALIASED_PATIENTS = """
SELECT cast(c_custkey AS string) AS Id, CASE WHEN c_nationkey < 5 THEN concat(' ', c_name) ELSE ' ' END AS fullName,
       CASE WHEN c_nationkey < 15 THEN c_mktsegment ELSE NULL END AS FIRST,
       CASE WHEN c_nationkey < 10 OR c_nationkey > 20 THEN n_name ELSE '' END AS lastName
FROM customer JOIN nation ON n_nationkey = c_nationkey"""

_DRUG_MAP = """
SELECT p_name AS drug_name, concat(' ', min(p_type), ' ', chr(10), ' ', chr(10), max(p_type), ' care') AS conditions
FROM part GROUP BY p_name"""

_CHANGES = """
SELECT cast(p_partkey AS string) AS itemId, concat(p_name, ' v', cast(p_size % 3 AS string)) AS itemName,
       p_retailprice * 2 AS price, 'USD' AS currency, {list(p_type, p_brand)} AS categories, p_size % 3 AS version
FROM part WHERE p_type = 'ECONOMY'
UNION ALL
SELECT cast(p_partkey AS string) AS itemId, concat(p_name, ' final') AS itemName,
       p_retailprice * 3 AS price, 'USD' AS currency, {list(p_type, p_brand)} AS categories, 9 AS version
FROM part WHERE p_type = 'ECONOMY' AND p_size > 25
UNION ALL
SELECT concat('new-', cast(p_partkey AS string)) AS itemId, p_name AS itemName, p_retailprice AS price, 'EUR' AS currency,
       {list(p_type, p_brand)} AS categories, 1 AS version
FROM part WHERE p_type = 'SMALL'"""


def _sql_list(text: str) -> str:
    return text.replace("{list(p_type, p_brand)}", "[p_type, p_brand]")


def _flat_items(df: DataFrame) -> DataFrame:
    return df.select("itemId", "itemName", "price", "currency", F.array_join("categories", "|").alias("categories"))


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [view(spark, sf_dir, n) for n in ("patients", "encounters", "medications", "conditions")]
    return analytics.patient_activity(*sides)


def _multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medications.multi_medication_flat(view(spark, sf_dir, "medications"), view(spark, sf_dir, "patients"))


def _multi_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested report for the top patients, shown flat: names joined for display."""
    nested = medications.patients_with_multiple_medications(
        view(spark, sf_dir, "medications"), view(spark, sf_dir, "patients"), top_n=25
    )
    codes = F.array_join(
        F.transform("medications", lambda m: F.concat_ws(":", m["medicationId"], m["count"].cast("string"))), ","
    )
    names = F.transform("medications", lambda m: m["medicationName"]).alias("names")
    shown = nested.select("patient_id", "patient_name", "medication_count", codes.alias("codes"), names)
    return shown.withColumn("names", analytics.display_names("names"))


def _multi_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested report of all patients in parts of bounded size, each shown as its codes and counts."""
    nested = medications.multi_medication_parts(view(spark, sf_dir, "medications"), view(spark, sf_dir, "patients"), PART_CODES)
    codes = F.transform("medications", lambda m: F.concat_ws(":", m["medicationId"], m["count"].cast("string")))
    return nested.select("patient_id", "patient_name", "medication_count", "part", F.array_join(codes, ",").alias("codes"))


def _name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of each patient's active medications, sorted, in parts of bounded size."""
    active = medications.active_medications(view(spark, sf_dir, "medications"))
    return analytics.display_name_parts(active, "patient", "description", PART_CODES)


def _key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as JSON whose keys differ by status and priority, spread to one table, with its header."""
    rows = run_sql(spark, sf_dir, _KEYED_ORDERS)
    wide = keys.union_of_keys(rows, "body", ["o_orderkey"])
    return wide.withColumn("header", F.lit(",".join(wide.columns)))


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = view(spark, sf_dir, "medications")
    by_patient = medications.find_medications(meds, patient_id=PATIENT).select(F.lit("patient").alias("lookup"), "*")
    by_code = medications.find_medications(meds, medication_id=CODE).select(F.lit("code").alias("lookup"), "*")
    nobody = medications.find_medications(meds, id="nobody").select(F.lit("id").alias("lookup"), "*")
    return by_patient.unionByName(by_code).unionByName(nobody)


def _aliased_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.sql_over(spark, _ALIASED_SQL, {n: view(spark, sf_dir, n) for n in ("medications", "patients", "encounters")})


_ALIASED_SQL = """
SELECT p.state, m.drug_name, count(*) AS prescriptions, count(DISTINCT m.patient_id) AS patients
FROM medications m JOIN patients p ON p.id = m.patient_id
WHERE EXISTS (SELECT 1 FROM encounters e WHERE e.id = m.encounter AND e.payer IS NOT NULL)
GROUP BY p.state, m.drug_name"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested catalog documents, one per part."""
    item = F.struct(
        F.col("p_partkey").cast("string").alias("itemId"),
        F.col("p_name").alias("itemName"),
        F.col("p_retailprice").alias("price"),
        F.lit("EUR").alias("currency"),
    )
    category = F.struct(
        F.col("p_type").alias("categoryName"),
        F.col("p_size").cast("string").alias("categoryId"),
        F.lit(1).alias("itemsCount"),
        F.array(item).alias("items"),
    )
    return table(spark, sf_dir, "part").select(F.array(category).alias("catalog"))


def _json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_text(view(spark, sf_dir, "items").withColumn("price", F.col("price").cast("decimal(18,2)")))


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = run_sql(spark, sf_dir, _CHANGES)
    return _flat_items(items.upsert(view(spark, sf_dir, "items"), changes, ["itemId"], ["version", "itemName"]))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = run_sql(spark, sf_dir, _CHANGES).filter("version = 9").select("itemId", "itemName", "price")
    return _flat_items(items.merge_update(view(spark, sf_dir, "items"), changes, "itemId"))


def _deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = run_sql(spark, sf_dir, _CHANGES).select("itemId")
    return items.deleted_keys(view(spark, sf_dir, "items"), keys)


def _delete_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = run_sql(spark, sf_dir, _CHANGES).select("itemId")
    left = items.delete_rows(view(spark, sf_dir, "items"), keys=keys)
    return _flat_items(items.delete_rows(left, where=F.col("price") < 910))


def _limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, truncated = analytics.limited_result(view(spark, sf_dir, "encounters"), ["id"], 200)
    return rows.select("id", "patient", F.lit(truncated).alias("truncated"))


def _generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medications.type_generic_rows(run_sql(spark, sf_dir, _GENERIC), ["part"])


def _drug_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    drugs = view(spark, sf_dir, "items").select(F.col("itemId"), F.col("itemName").alias("drug_name"))
    out = medications.drug_conditions(drugs, run_sql(spark, sf_dir, _DRUG_MAP))
    return out.select("itemId", "drug_name", F.array_join("conditions", "|").alias("conditions"))


def _contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = view(spark, sf_dir, "medications")
    return meds.filter(contains_text(" RING", [F.col("description"), F.col("code")])).select("id", "description", "code")


def _row_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_contains(view(spark, sf_dir, "patients"), "BUILD").select("id", "race")


def _drug_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit("NDA"), F.col("p_size").cast("string"), F.lit(" 24 HR "), "p_name", F.lit(" ")).alias("description"),
    )
    return medications.sorted_drugs(parts)


def _sorted_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All patients by last, then first name."""
    return medications.sorted_patients(view(spark, sf_dir, "patients"))


def _sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = view(spark, sf_dir, "medications").select("id", "description")
    return medications.sort_by_description(meds, descending=True, top_n=200)


def _page(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = view(spark, sf_dir, "medications").select("id", "patient", "code", "start")
    return medications.page_after(meds, ["id", "start"], PAGE_START, 50)


def _default_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = view(spark, sf_dir, "medications").withColumns(
        {"id": F.lit(""), "medicationId": F.when(F.col("reason_code") == "A", F.col("id"))}
    )
    return medications.medication_items(meds.withColumnRenamed("total_cost", "totalCost").withColumn("stop", F.concat("stop", F.lit("T10:15:00.5+00:00")))).select(
        "id", "start", "stop", "patient", "code", "totalCost"
    )


def _column_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients = view(spark, sf_dir, "patients").select("id", "gender", "state")
    encounters = view(spark, sf_dir, "encounters").select("id", "patient", "payer")
    return analytics.column_union([patients, encounters])


def _code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("patients", "encounters", "medications", "conditions", "observations", "items")
    return analytics.table_counts({n: view(spark, sf_dir, n) for n in names})


def _medication_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of a mixed upload go to each store."""
    blank = ", ".join(f"'' AS {c}" for c in ("PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST"))
    mixed = run_sql(spark, sf_dir, RAW_MEDICATIONS).select(*medications.MEDICATION_MARKS).unionByName(
        run_sql(spark, sf_dir, f"SELECT {blank} FROM orders")
    )
    meds, other = medications.route_rows(mixed)
    return analytics.table_counts({"medication": meds, "generic": other})


def _display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of each patient's active medications, sorted for display."""
    meds = medications.active_medications(view(spark, sf_dir, "medications"))
    listed = meds.groupBy("patient").agg(F.collect_list("description").alias("names"))
    return listed.select("patient", analytics.display_names("names").alias("names"))


def _deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in the middle of all items, from a stored order."""
    everything, path = view(spark, sf_dir, "items"), scratch_path(spark, "pages")
    pages.paginate(everything, ["itemId"], path)
    return _flat_items(pages.read_page(spark, path, everything.count() // 200 + 1, 100))


QUERIES = {
    "display_names": _display,
    "patient_activity": _activity,
    "condition_counts": lambda s, d: analytics.top_counts(view(s, d, "conditions"), "description", 20, "patient_count"),
    "total_rows": lambda s, d: analytics.total_rows(clean(s, d)),
    "claims_by_status": lambda s, d: analytics.claims_by_status(clean(s, d)),
    "claims_by_date": lambda s, d: analytics.claims_by_date(clean(s, d)),
    "payer_distribution": lambda s, d: analytics.payer_distribution(clean(s, d), view(s, d, "encounters")),
    "top_patients_by_spend": lambda s, d: analytics.top_patients_by_spend(clean(s, d)),
    "encounter_class_breakdown": lambda s, d: analytics.encounter_classes(clean(s, d), view(s, d, "encounters")),
    "patients_multi_medication": _multi,
    "patients_multi_medication_top": _multi_top,
    "patients_multi_medication_parts": _multi_parts,
    "display_name_parts": _name_parts,
    "key_union": _key_union,
    "medications_filtered": lambda s, d: medications.find_medications(
        view(s, d, "medications"), patient_id=PATIENT, medication_id=None
    ),
    "medications_lookup": _lookup,
    "active_medications": lambda s, d: medications.active_medications(view(s, d, "medications")),
    "resolved_patients": lambda s, d: medications.resolved_patients(run_sql(s, d, _ALIASED_PATIENTS)),
    "medications_page": _page,
    "medications_sorted": _sorted,
    "medication_rows": lambda s, d: medications.medication_rows(run_sql(s, d, RAW_MEDICATIONS)),
    "medication_default_ids": _default_ids,
    "medication_routes": _medication_routes,
    "generic_row_typing": _generic,
    "drug_conditions": _drug_conditions,
    "drug_lookup": _drug_lookup,
    "sorted_patients": _sorted_patients,
    "sorted_codes": lambda s, d: medications.sorted_codes(view(s, d, "medications")),
    "contains_text": _contains,
    "row_contains": _row_contains,
    "items_by_category": lambda s, d: _flat_items(items.find_by_category(view(s, d, "items"), "Brand#4")),
    "items_by_attributes": lambda s, d: _flat_items(
        items.find_by_attributes(view(s, d, "items"), {"itemName": "red widget", "currency": "EUR"})
    ),
    "items_page": lambda s, d: _flat_items(items.page(view(s, d, "items"), ["itemId"], 2, 100)),
    "items_deep_page": _deep_page,
    "catalog_items": lambda s, d: items.exploded_catalog(_catalog(s, d)),
    "catalog_category": lambda s, d: items.catalog_items(_catalog(s, d), "11"),
    "catalog_categories": lambda s, d: items.catalog_categories(_catalog(s, d)).distinct(),
    "upsert_items": _upserted,
    "merge_items": _merged,
    "delete_items": _delete_items,
    "deleted_item_keys": _deleted,
    "distinct_codes": lambda s, d: analytics.distinct_codes(view(s, d, "conditions")),
    "table_counts": _code_counts,
    "outcome_summary": lambda s, d: analytics.outcome_summary(view(s, d, "step_events"), "type", ["TaskFailed", "TaskStateExited"]),
    "choice_values": lambda s, d: analytics.distinct_values(view(s, d, "medications"), "description"),
    "preview": lambda s, d: analytics.preview(clean(s, d), ["claim_id"], 10),
    "limited_result": _limited,
    "column_union": _column_union,
    "aliased_sql": _aliased_sql,
    "json_columns": _json_columns,
    "step_status": lambda s, d: analytics.step_status(view(s, d, "step_events")),
}

_BILLING_CTE = f"""{CLEAN_CTE}, {cte("encounters")},
billing AS (SELECT c.*, c.net_amount AS total_amount, e.payer AS payer_name, e.encounter_class
  FROM clean c LEFT JOIN encounters e ON e.id = split_part(c.claim_id, '-', 1))"""
_FLAT_ITEMS = "itemId, itemName, price, currency, array_to_string(categories, '|') AS categories"
_CHANGES_CTE = f"changes AS ({_sql_list(_CHANGES)})"
_MULTI_CTE = f"""{cte("medications", "patients")},
per_code AS (SELECT patient AS patient_id, code AS medication_id, min(nullif(description, '')) AS medication_name,
  count(*) AS "count" FROM medications WHERE patient <> '' AND code <> '' GROUP BY 1, 2),
several AS (SELECT patient_id, count(*) AS medication_count FROM per_code GROUP BY 1 HAVING count(*) > 1),
named AS (SELECT s.*, p.first || ' ' || p.last AS patient_name FROM several s LEFT JOIN patients p ON p.id = s.patient_id)"""
_STATUS = """CASE WHEN type = 'TaskStateEntered' THEN 'RUNNING' WHEN type = 'TaskStateExited' THEN 'SUCCEEDED'
  WHEN type = 'TaskFailed' THEN 'FAILED' END"""
_STEP_LIST = ", ".join(f"'{s}'" for s in analytics.STEPS)

ORACLES = {
    "display_names": f"""WITH {cte("medications")}
SELECT patient, coalesce(string_agg(description, ', ' ORDER BY description) FILTER (description <> ''), '') AS names
FROM medications WHERE coalesce(trim(stop), '') = '' GROUP BY 1""",
    "patient_activity": f"""WITH {cte("patients", "encounters", "medications", "conditions")}
SELECT p.first, p.last, p.gender, p.race, count(DISTINCT e.id) AS encounters, count(DISTINCT m.code) AS medications,
  count(DISTINCT c.code) AS conditions
FROM patients p LEFT JOIN encounters e ON e.patient = p.id LEFT JOIN medications m ON m.patient = p.id
LEFT JOIN conditions c ON c.patient = p.id
GROUP BY ALL ORDER BY encounters DESC, 1, 2, 3, 4 LIMIT 20""",
    "condition_counts": f"""WITH {cte("conditions")} SELECT description, count(*) AS patient_count FROM conditions
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "total_rows": f"WITH {CLEAN_CTE} SELECT count(*) AS total_rows FROM clean",
    "claims_by_status": f"""WITH {_BILLING_CTE} SELECT status, count(*) AS claims, round(sum(total_amount), 2) AS total_billed
FROM billing GROUP BY 1""",
    "claims_by_date": f"""WITH {_BILLING_CTE} SELECT service_date, count(*) AS claims,
round(sum(total_amount), 2) AS total_billed FROM billing GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "payer_distribution": f"""WITH {_BILLING_CTE} SELECT payer_name, count(*) AS claims,
round(avg(total_amount), 2) AS avg_amount FROM billing GROUP BY 1""",
    "top_patients_by_spend": f"""WITH {_BILLING_CTE} SELECT patient_id, count(*) AS claims,
round(sum(total_amount), 2) AS total_spend FROM billing GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
    "encounter_class_breakdown": f"""WITH {_BILLING_CTE} SELECT encounter_class, count(*) AS claims FROM billing GROUP BY 1""",
    "patients_multi_medication": f"""WITH {_MULTI_CTE} SELECT * FROM per_code JOIN named USING (patient_id)""",
    "patients_multi_medication_top": f"""WITH {_MULTI_CTE},
top AS (SELECT * FROM named ORDER BY medication_count DESC, patient_id LIMIT 25)
SELECT t.patient_id, t.patient_name, t.medication_count,
  string_agg(medication_id || ':' || "count", ',' ORDER BY "count" DESC, medication_id) AS codes,
  coalesce(string_agg(medication_name, ', ' ORDER BY medication_name), '') AS names
FROM top t JOIN per_code USING (patient_id) GROUP BY 1, 2, 3""",
    "patients_multi_medication_parts": f"""WITH {_MULTI_CTE},
placed AS (SELECT *, (row_number() OVER (ORDER BY patient_id, patient_name NULLS FIRST, medication_count, "count" DESC, medication_id) - 1)
  // {PART_CODES} AS block FROM per_code JOIN named USING (patient_id)),
numbered AS (SELECT *, cast(block - min(block) OVER (PARTITION BY patient_id) AS int) AS part FROM placed)
SELECT patient_id, patient_name, medication_count, part,
  string_agg(medication_id || ':' || "count", ',' ORDER BY "count" DESC, medication_id) AS codes
FROM numbered GROUP BY 1, 2, 3, 4""",
    "display_name_parts": f"""WITH {cte("medications")},
placed AS (SELECT patient, description, (row_number() OVER (ORDER BY patient NULLS FIRST, description) - 1) // {PART_CODES} AS block
  FROM medications WHERE coalesce(trim(stop), '') = '' AND description <> ''),
numbered AS (SELECT *, cast(block - min(block) OVER (PARTITION BY patient) AS int) AS part FROM placed)
SELECT patient, part, string_agg(description, ', ' ORDER BY description) AS names FROM numbered GROUP BY 1, 2""",
    "key_union": """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'true' END AS urgent, cast(o_orderkey AS string) AS id,
  CASE WHEN o_orderstatus = 'F' THEN cast(o_custkey AS string) END AS done, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS open,
  CASE WHEN o_orderstatus = 'P' THEN '["' || o_orderpriority || '","' || o_orderstatus || '"]' END AS tags FROM orders),
seen AS (SELECT 'urgent' AS k, 0 AS pos, min(o_orderkey) AS f FROM r WHERE urgent IS NOT NULL UNION ALL SELECT 'id', 1, min(o_orderkey) FROM r
  UNION ALL SELECT 'done', 2, min(o_orderkey) FROM r WHERE done IS NOT NULL UNION ALL SELECT 'open', 3, min(o_orderkey) FROM r WHERE open IS NOT NULL
  UNION ALL SELECT 'tags', 4, min(o_orderkey) FROM r WHERE tags IS NOT NULL)
SELECT * EXCLUDE (o_orderkey), (SELECT string_agg(k, ',' ORDER BY f, pos) FROM seen) AS header FROM r""",
    "medications_filtered": f"WITH {cte('medications')} SELECT * FROM medications WHERE patient = '{PATIENT}'",
    "medications_lookup": f"""WITH {cte("medications")}
SELECT 'patient' AS lookup, * FROM medications WHERE patient = '{PATIENT}'
UNION ALL SELECT 'code' AS lookup, * FROM medications WHERE code = '{CODE}'""",
    "active_medications": f"WITH {cte('medications')} SELECT * FROM medications WHERE coalesce(trim(stop), '') = ''",
    "resolved_patients": f"""WITH p AS ({_ALIASED_PATIENTS}),
t AS (SELECT nullif(trim(Id), '') AS patient_id, nullif(trim(fullName), '') AS n, nullif(trim(FIRST), '') AS f,
  nullif(trim(lastName), '') AS l FROM p)
SELECT patient_id, coalesce(n, CASE WHEN f IS NOT NULL AND l IS NOT NULL THEN f || ' ' || l ELSE coalesce(f, l) END)
  AS patient_name FROM t""",
    "medications_page": f"""WITH {cte("medications")} SELECT id, patient, code, start FROM medications
WHERE (id, start) > ('{PAGE_START[0]}', '{PAGE_START[1]}') ORDER BY id, start LIMIT 50""",
    "medications_sorted": f"""WITH {cte("medications")} SELECT id, description FROM medications
ORDER BY lower(coalesce(description, '')) DESC, id LIMIT 200""",
    "medication_rows": f"""WITH raw AS ({RAW_MEDICATIONS}),
r AS (SELECT *, row_number() OVER (ORDER BY {_RAW_ORDER}) - 1 AS i FROM raw)
SELECT PATIENT || '-' || ENCOUNTER || '-' || coalesce(CODE, 'code') || '-' || START || '-'
    || coalesce(nullif(STOP, ''), 'nostop') || '-' || i AS id,
  START || 'T00:00:00' AS start, nullif(STOP, '') AS stop, PATIENT AS patient, PAYER AS payer, ENCOUNTER AS encounter,
  CODE AS code, DESCRIPTION AS description, try_cast(trim(BASE_COST) AS double) AS "baseCost",
  cast(NULL AS double) AS "payerCoverage", cast(DISPENSES AS double) AS dispenses, cast(TOTALCOST AS double) AS "totalCost",
  REASONCODE AS "reasonCode", REASONDESCRIPTION AS "reasonDescription"
FROM r""",
    "medication_default_ids": f"""WITH {cte("medications")}
SELECT CASE WHEN reason_code = 'A' THEN id ELSE patient || '-' || encounter || '-' || code END AS id,
  start || 'T00:00:00' AS start, stop || 'T10:15:00.500000Z' AS stop, patient, code, total_cost AS "totalCost"
FROM medications""",
    "medication_routes": f"""SELECT 'medication' AS table_name, count(*) AS rows FROM ({RAW_MEDICATIONS})
UNION ALL SELECT 'generic', count(*) FROM orders""",
    "generic_row_typing": f"""WITH raw AS ({_GENERIC}), r AS (SELECT *, row_number() OVER (ORDER BY part) - 1 AS i FROM raw)
SELECT Brand || '-' || trim(SIZE) || '-' || cast(cast(price AS double) AS varchar) || '-' || i AS id, Brand AS brand,
  cast(trim(SIZE) AS bigint) AS size, cast(price AS double) AS price, name, mixed, cast(NULL AS varchar) AS empty,
  cast(part AS bigint) AS part FROM r""",
    "drug_conditions": f"""WITH {_sql_list(cte("items"))}, m AS ({_DRUG_MAP})
SELECT itemId, itemName AS drug_name, array_to_string(list_filter(list_transform(string_split(conditions, chr(10)),
  lambda x: trim(x)), lambda x: x <> ''), '|') AS conditions
FROM items LEFT JOIN m ON m.drug_name = itemName""",
    "drug_lookup": """SELECT cast(p_partkey AS string) AS id,
  'NDA' || p_size || ' 24 HR ' || p_name || ' ' AS description, lower(p_name) AS sort_key FROM part""",
    "sorted_patients": f"""WITH {cte("patients")} SELECT id, last, first FROM patients
ORDER BY lower(last), lower(first), id""",
    "sorted_codes": f"""WITH {cte("medications")} SELECT DISTINCT code FROM medications WHERE code <> '' ORDER BY code""",
    "contains_text": f"""WITH {cte("medications")} SELECT id, description, code FROM medications
WHERE contains(lower(description), 'ring') OR contains(code, 'ring')""",
    "row_contains": f"""WITH {cte("patients")} SELECT id, race FROM patients
WHERE contains(lower(concat_ws('|', id, first, last, gender, race, state)), 'build')""",
    "items_by_category": f"WITH {cte('items')} SELECT {_FLAT_ITEMS} FROM items WHERE list_contains(categories, 'Brand#4')",
    "items_by_attributes": f"WITH {cte('items')} SELECT {_FLAT_ITEMS} FROM items WHERE itemName = 'red widget' AND currency = 'EUR'",
    "items_page": f"WITH {cte('items')} SELECT {_FLAT_ITEMS} FROM items ORDER BY itemId LIMIT 100 OFFSET 100",
    "items_deep_page": f"""WITH {cte('items')} SELECT {_FLAT_ITEMS} FROM items ORDER BY itemId
LIMIT 100 OFFSET (SELECT 100 * (count(*) // 200) FROM items)""",
    "catalog_items": """SELECT cast(p_size AS string) AS "categoryId", p_type AS "categoryName",
  cast(p_partkey AS string) AS "itemId", p_name AS "itemName", p_retailprice AS price, 'EUR' AS currency FROM part""",
    "catalog_category": """SELECT cast(p_size AS string) AS "categoryId", p_type AS "categoryName",
  cast(p_partkey AS string) AS "itemId", p_name AS "itemName", p_retailprice AS price, 'EUR' AS currency
FROM part WHERE p_size = 11""",
    "catalog_categories": """SELECT DISTINCT cast(p_size AS string) AS "categoryId", p_type AS "categoryName" FROM part""",
    "upsert_items": f"""WITH {cte("items")}, {_CHANGES_CTE},
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY itemId ORDER BY version DESC, itemName DESC) AS rn
  FROM changes) WHERE rn = 1)
SELECT {_FLAT_ITEMS} FROM items WHERE itemId NOT IN (SELECT itemId FROM last)
UNION ALL SELECT {_FLAT_ITEMS} FROM last""",
    "merge_items": f"""WITH {cte("items")}, {_CHANGES_CTE}, c AS (SELECT * FROM changes WHERE version = 9)
SELECT i.itemId, CASE WHEN c.itemId IS NULL THEN i.itemName ELSE c.itemName END AS itemName,
  CASE WHEN c.itemId IS NULL THEN i.price ELSE c.price END AS price,
  CASE WHEN c.itemId IS NULL THEN i.currency END AS currency,
  CASE WHEN c.itemId IS NULL THEN array_to_string(i.categories, '|') END AS categories
FROM items i LEFT JOIN c USING (itemId)""",
    "delete_items": f"""WITH {cte("items")}, {_CHANGES_CTE} SELECT {_FLAT_ITEMS} FROM items
WHERE itemId NOT IN (SELECT itemId FROM changes) AND NOT price < 910""",
    "deleted_item_keys": f"""WITH {cte("items")}, {_CHANGES_CTE}
SELECT DISTINCT c.itemId, i.itemId IS NOT NULL AS existed FROM changes c LEFT JOIN items i ON i.itemId = c.itemId""",
    "distinct_codes": f"""WITH {cte("conditions")} SELECT code, max(description) AS description FROM conditions GROUP BY 1""",
    "table_counts": f"""WITH {cte("patients", "encounters", "medications", "conditions", "observations", "items")}
""" + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}"
        for n in ("patients", "encounters", "medications", "conditions", "observations", "items")
    ),
    "outcome_summary": f"""WITH {cte("step_events")} SELECT count(*) AS total,
  count(*) FILTER (type = 'TaskFailed') AS "TaskFailed", count(*) FILTER (type = 'TaskStateExited') AS "TaskStateExited"
FROM step_events""",
    "choice_values": f"""WITH {cte("medications")} SELECT DISTINCT trim(description) AS description FROM medications
WHERE trim(description) <> ''""",
    "preview": f"WITH {CLEAN_CTE} SELECT * FROM clean ORDER BY claim_id LIMIT 10",
    "limited_result": f"""WITH {cte("encounters")} SELECT id, patient, (SELECT count(*) >= 200 FROM encounters) AS truncated
FROM encounters ORDER BY id LIMIT 200""",
    "column_union": f"""WITH {cte("patients", "encounters")}
SELECT id, gender, state, NULL AS patient, NULL AS payer FROM patients
UNION ALL SELECT id, NULL, NULL, patient, payer FROM encounters""",
    "aliased_sql": f"""WITH {cte("patients", "encounters")}, base AS ({cte("medications").split(" AS ", 1)[1][1:-1]}),
medications AS (SELECT *, description AS drug_name, patient AS patient_id FROM base) {_ALIASED_SQL}""",
    "json_columns": """SELECT cast(p_partkey AS string) AS "itemId", p_name AS "itemName",
  CASE WHEN cast(p_retailprice AS decimal(18,2)) = floor(p_retailprice)
    THEN cast(cast(p_retailprice AS bigint) AS string)
    ELSE cast(cast(cast(p_retailprice AS decimal(18,2)) AS double) AS string) END AS price,
  'EUR' AS currency, '["' || p_type || '","' || p_brand || '"]' AS categories FROM part""",
    "step_status": f"""WITH {cte("step_events")},
s AS (SELECT *, {_STATUS} AS state FROM step_events),
last AS (SELECT execution_id, step, arg_max(state, event_id) AS state FROM s WHERE state IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT DISTINCT execution_id, unnest([{_STEP_LIST}]) AS step FROM s)
SELECT g.execution_id, g.step, coalesce(l.state, 'PENDING') AS status FROM grid g LEFT JOIN last l USING (execution_id, step)""",
}
