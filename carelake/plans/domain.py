"""Healthcare views derived from the given tables.

The view texts run unchanged on Spark and on the oracle engine (``{list(a, b)}`` marks the one
construct they spell differently), so both sides start from the same rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake.operators.analytics import sql_over
from carelake.session import tune
from carelake.sources.readers import list_files, total_bytes

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "claims": """
SELECT concat(cast(l.l_orderkey AS string), '-', cast(l.l_linenumber AS string)) AS claim_id,
       cast(o.o_custkey AS string) AS patient_id,
       concat('  ', c.c_name, ' ') AS patient_name,
       CASE WHEN l.l_orderkey % 10 = 0 THEN ''
            WHEN l.l_orderkey % 97 = 0 THEN '2024-02-30'
            ELSE substr(cast(l.l_shipdate AS string), 1, 10) END AS service_date,
       CASE o.o_orderstatus WHEN 'F' THEN ' ACTIVE' WHEN 'O' THEN 'Draft' ELSE 'cancelled ' END AS status,
       'Professional' AS claim_type,
       'CLAIM' AS use,
       cast(l.l_suppkey AS string) AS provider_id,
       s.s_name AS provider_name,
       CASE WHEN l.l_partkey % 53 = 0 THEN NULL ELSE p.p_type END AS diagnosis_code,
       p.p_type AS diagnosis_description,
       cast(l.l_partkey AS string) AS procedure_code,
       p.p_name AS procedure_description,
       CASE WHEN l.l_suppkey % 41 = 0 THEN 'n/a'
            ELSE cast(cast(p.p_retailprice AS decimal(18,2)) AS string) END AS unit_price,
       cast(cast(CASE WHEN l.l_orderkey % 31 = 0 THEN 0 ELSE l.l_quantity END AS int) AS string) AS quantity,
       cast(cast(CASE WHEN l.l_orderkey % 7 = 0 THEN l.l_extendedprice
            ELSE p.p_retailprice * l.l_quantity END AS decimal(18,2)) AS string) AS net_amount,
       CASE WHEN l.l_orderkey % 13 = 0 THEN 'us' WHEN l.l_orderkey % 17 = 0 THEN NULL ELSE ' usd ' END AS currency,
       concat('MBR', cast(o.o_custkey AS string)) AS insurance_member_id,
       o.o_orderpriority AS priority
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN part p ON p.p_partkey = l.l_partkey""",
    "patients": """
SELECT cast(c_custkey AS string) AS id, c_name AS first, n_name AS last,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, c_mktsegment AS race, n_name AS state
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "encounters": """
SELECT cast(o_orderkey AS string) AS id, cast(o_custkey AS string) AS patient, o_orderpriority AS encounter_class,
       o_orderdate AS start, CASE WHEN o_orderkey % 25 = 0 THEN NULL ELSE n_name END AS payer
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "medications": """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-',
              cast(l_suppkey AS string)) AS id,
       cast(o_custkey AS string) AS patient, cast(l_orderkey AS string) AS encounter, cast(l_partkey AS string) AS code,
       CASE WHEN l_partkey % 29 = 0 THEN '' ELSE p_name END AS description,
       substr(cast(l_shipdate AS string), 1, 10) AS start,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE substr(cast(l_shipdate AS string), 1, 10) END AS stop,
       p_retailprice AS base_cost, l_quantity AS dispenses, l_extendedprice AS total_cost, l_returnflag AS reason_code
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "conditions": """
SELECT cast(o_custkey AS string) AS patient, cast(o_orderkey AS string) AS encounter, o_orderpriority AS code,
       concat('Condition ', o_orderpriority) AS description, o_orderdate AS start
FROM orders""",
    "observations": """
SELECT cast(user_id AS string) AS patient,
       CASE event_type WHEN 'view' THEN '8302-2' WHEN 'click' THEN '8480-6' WHEN 'purchase' THEN '4548-4'
            WHEN 'signup' THEN '8867-4' ELSE '9999-9' END AS code,
       event_type AS description, value, ts, event_id
FROM events""",
    "items": """
SELECT cast(p_partkey AS string) AS itemId, p_name AS itemName, p_retailprice AS price, 'EUR' AS currency,
       {list(p_type, p_brand)} AS categories
FROM part""",
    "step_events": """
SELECT user_id AS execution_id, event_id, ts,
       CASE event_id % 4 WHEN 0 THEN 'generate_synthetic_claims' WHEN 1 THEN 'clean_claims'
            WHEN 2 THEN 'store_claims_manifest' ELSE 'forecast_claims' END AS step,
       CASE event_type WHEN 'error' THEN 'TaskFailed' WHEN 'purchase' THEN 'TaskStateExited'
            ELSE 'TaskStateEntered' END AS type
FROM events""",
    "messages": """
SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN concat('broken ', props) ELSE props END AS body
FROM events""",
    "log_lines": """
SELECT event_id, ts,
       CASE event_type WHEN 'error' THEN concat('ERROR step failed for user ', cast(user_id AS string))
            WHEN 'view' THEN 'GET /health 200' WHEN 'click' THEN 'worker said: Traceback follows'
            ELSE concat('INFO ', event_type) END AS message
FROM events""",
    "documents_corpus": """
SELECT cast(doc_id AS string) AS id, text, source, lang AS shard FROM documents""",
}

#: How Spark joins a view whose rows are the same in any order: the large table meets the narrow side tables first and is left
#: partitioned by the key that its rows are grouped by next.
_JOINED = {
    "claims": """
FROM (SELECT * FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)
JOIN (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey) ON o_orderkey = l_orderkey""",
}
#: Bytes of lines that a slice is made for, and the most slices there are, as each reads all lines again.
SLICE_BYTES = 16 << 20
SLICES = 12
_QUALIFIER = re.compile(r"\b[a-z]\.(?=[a-z]_)")

_LIST = re.compile(r"\{list\(([^)]*)\)\}")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is looked up once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        tune(spark)
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Spark SQL over the given tables, without registering session-wide views."""
    text = _LIST.sub(r"array(\1)", text)
    used = [t for t in TABLES if re.search(rf"(FROM|JOIN)\s+{t}\b", text)]
    return sql_over(spark, text, {t: table(spark, sf_dir, t) for t in used})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived healthcare view."""
    return run_sql(spark, sf_dir, _spark_text(name))


def claims_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims view with ``order_key``, which every claim id contains and by which Spark leaves the rows partitioned."""
    return run_sql(spark, sf_dir, _spark_text("claims").replace("SELECT ", "SELECT l_orderkey AS order_key, ", 1))


def in_slices(spark: SparkSession, sf_dir: str, rows: DataFrame, key: str) -> list[DataFrame]:
    """Rows of a view over the lines in slices by ``key``, all rows together; written one by one, only one slice's shuffles are on disk."""
    lines = total_bytes(list_files(spark, f"{sf_dir}/lineitem.parquet")).first()["bytes"]
    n = max(1, min(SLICES, math.ceil(lines / SLICE_BYTES)))
    return [rows.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def claim_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The claims view in slices by order."""
    return [part.drop("order_key") for part in in_slices(spark, sf_dir, claims_by_order(spark, sf_dir), "order_key")]


def _spark_text(name: str) -> str:
    text = VIEWS[name]
    if name not in _JOINED:
        return text
    return _QUALIFIER.sub("", text[: text.index("\nFROM")]) + _JOINED[name]


def cte(*names: str) -> str:
    """``name AS (...)`` entries for oracle SQL."""
    return ",\n".join(f"{name} AS ({_LIST.sub(r'[\1]', VIEWS[name])})" for name in names)
