"""Registered queries: corpus building, retrieval, grounding, interaction labels and redaction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.text import SPACE_CHARS, slug
from carelake.operators import corpus, index, interactions, retrieval
from carelake.operators.analytics import distinct_codes
from carelake.plans.claims_queries import sql_strip
from carelake.operators.medications import find_medications, medication_rows
from carelake.plans.domain import cte, in_slices, run_sql, table, view
from carelake.plans.records_queries import RAW_MEDICATIONS
from carelake.session import materialise, scratch_path, shuffles_freed
from carelake.sources.readers import list_files

# Fixed value: Python's whitespace as a class of the oracle's regex engine.
SPACE_CLASS = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
INDEXED_AT = "2024-02-01 00:00:00"


def letter_profile(texts: list[str]) -> np.ndarray:
    """Encoder for the registered queries: letter counts, simple enough to restate in SQL."""
    lower = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    # the bytes of letters occur in no other character
    flat = np.frombuffer(b"".join(lower), dtype=np.uint8).astype(np.int64) + 256 * np.repeat(np.arange(len(lower)), [len(t) for t in lower])
    counts = np.bincount(flat, minlength=256 * len(lower)).reshape(len(lower), 256)
    return counts[:, ord(LETTERS[0]) : ord(LETTERS[-1]) + 1].astype(np.float64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents_corpus")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question vectors: the first vector of each label, by id."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("vector"))


def _cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    hits = retrieval.cosine_top_k(_centroids(spark, sf_dir), docs, 10)
    return hits.withColumn("score", F.round("score", 6))


def _bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.bm25_top_k(questions(spark, sf_dir), documents(spark, sf_dir), 10)
    return hits.withColumn("score", F.round("score", 6))


def _bm25_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.corpus_bm25_stats(documents(spark, sf_dir))[1]


def _hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = retrieval.embed(documents(spark, sf_dir), letter_profile)
    return retrieval.hybrid_retrieve(questions(spark, sf_dir), docs, letter_profile, 5)


def _hybrid_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval inside one shard; its statistics are those of the shard."""
    docs = retrieval.embed(documents(spark, sf_dir), letter_profile)
    return retrieval.hybrid_retrieve(questions(spark, sf_dir), docs, letter_profile, 5, shard="de")


def _hybrid_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword list alone and dense list alone."""
    docs = retrieval.embed(documents(spark, sf_dir), letter_profile)
    one = lambda a: retrieval.hybrid_retrieve(questions(spark, sf_dir), docs, letter_profile, 5, alpha=a).withColumn("alpha", F.lit(a))
    return one(0.0).unionByName(one(1.0))


def _hybrid_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other question carries a patient sentence."""
    features = F.when(F.col("query_id") % 2 == 0, F.concat(F.lit("conditions: the and of "), F.col("query_id").cast("string")))
    docs = retrieval.embed(documents(spark, sf_dir), letter_profile)
    return retrieval.hybrid_retrieve(questions(spark, sf_dir).withColumn("features", features), docs, letter_profile, 5)


def _corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.corpus_bm25_stats(documents(spark, sf_dir))[0].withColumn("avg_length", F.round("avg_length", 6))


def _index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index over every shard but one, then a run that changes one of them and adds the missing one."""
    docs = documents(spark, sf_dir)
    first = retrieval.build_index(docs.filter("shard IS DISTINCT FROM 'fr'"), letter_profile, scratch_path(spark, "index"), INDEXED_AT)
    change = docs.filter("shard IN ('de', 'fr')").withColumn("text", F.concat(F.lit("new "), "text"))
    merged = retrieval.build_index(change, letter_profile, scratch_path(spark, "index"), "2024-03-01 00:00:00", stored=first)
    return merged.select("id", "shard", F.md5("text").alias("hash"), F.date_format("indexed_at", "yyyy-MM-dd").alias("indexed_on"))


def _index_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of an index after a run that changes one of them: rows, and whether their files are the old ones."""
    docs, path = documents(spark, sf_dir), scratch_path(spark, "index")
    index.create(docs, letter_profile, path, INDEXED_AT)
    key = F.regexp_extract("key", "bucket=.*", 0).alias("key")
    files = lambda: list_files(spark, f"{path}/rows", ".parquet").select(F.regexp_extract("key", "shard=([^/]*)/", 1).alias("shard"), key)
    old = materialise(files().withColumn("old", F.lit(True)), "files")
    change = docs.filter("shard = 'de' AND id LIKE '%1'").withColumn("text", F.concat(F.lit("new "), "text"))
    index.update(spark, path, change, letter_profile, "2024-03-01 00:00:00")
    now = files().join(old, ["shard", "key"], "left").groupBy("shard").agg(F.bool_and(F.coalesce("old", F.lit(False))).alias("same_files"))
    rows = index.read(spark, path).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("text").startswith("new ")).alias("changed"))
    return rows.join(now, "shard")


def _index_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all documents, some with new text and some in another shard: only new texts are encoded again."""
    docs, path = documents(spark, sf_dir), scratch_path(spark, "index")
    index.create(docs, letter_profile, path, INDEXED_AT)
    text = F.when(F.col("id").endswith("7"), F.concat(F.lit("new "), "text")).otherwise(F.col("text"))
    shard = F.when(F.col("id").endswith("3"), F.lit("moved")).otherwise(F.col("shard"))
    index.update(spark, path, docs.withColumns({"text": text, "shard": shard}), letter_profile, "2024-03-01 00:00:00")
    day = lambda name: F.date_format(name, "yyyy-MM-dd")
    return index.read(spark, path).select(
        "id", "shard", F.md5("text").alias("hash"), day("indexed_at").alias("indexed_on"), day("encoded_at").alias("encoded_on")
    )


def _index_one_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index run of one patient over a stored index of all: their rows are replaced, others stay."""
    meds, path, found = view(spark, sf_dir, "medications"), scratch_path(spark, "index"), scratch_path(spark, "own")
    slices = in_slices(spark, sf_dir, meds, "encounter")
    index.create([corpus.medication_documents(part) for part in slices], letter_profile, path, INDEXED_AT, route="element_at(metadata, 'patient')")
    with shuffles_freed(spark):
        for part in slices:
            find_medications(part, patient_id="42").write.mode("append").parquet(found)
    own = corpus.medication_documents(spark.read.schema(meds.schema).parquet(found))
    index.update(spark, path, own, letter_profile, "2024-03-01 00:00:00")
    return index.read(spark, path).select("id", "text", F.date_format("indexed_at", "yyyy-MM-dd").alias("indexed_on"))


def _guidelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", F.concat(F.lit("Guide "), F.col("doc_id").cast("string")).alias("source"))
    out = corpus.guideline_documents(docs, size=100, overlap=20)
    return out.select("id", "source", F.md5("text").alias("hash"), F.element_at("metadata", "total_chunks").alias("total_chunks"))


def _raw_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences over rows as they come, upper-case names and no id."""
    out = corpus.medication_documents(run_sql(spark, sf_dir, RAW_MEDICATIONS))
    return out.select("id", "text")


def _typed_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences and payer over the library's own typed rows."""
    out = corpus.medication_documents(medication_rows(run_sql(spark, sf_dir, RAW_MEDICATIONS)))
    return out.select("text", F.element_at("metadata", "payer").alias("payer"))


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    docs = documents(spark, sf_dir).withColumn("metadata", F.create_map(F.lit("source"), F.col("source")))
    built = retrieval.build_index(docs, letter_profile, path, INDEXED_AT)
    cells = built.select("id", "shard", F.posexplode("vector").alias("position", "weight"))
    return cells.select("id", "shard", "position", F.round(F.col("weight").cast("double"), 5).alias("weight"))


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.bm25_top_k(questions(spark, sf_dir), documents(spark, sf_dir), 3)
    return retrieval.context_block(retrieval.passages(hits, documents(spark, sf_dir)))


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers quote a document id for every other question."""
    docs = documents(spark, sf_dir)
    hits = materialise(retrieval.bm25_top_k(questions(spark, sf_dir), docs, 3), "hits")
    quoted = F.when(F.col("query_id") % 2 == 0, F.concat(F.lit("See [source: "), F.col("doc_id").cast("string"), F.lit("]."))).otherwise("No idea.")
    answers = hits.filter("rank = 2").select("query_id", quoted.alias("answer"))
    cited = retrieval.cited_sources(answers, retrieval.passages(hits, docs, 200))
    return cited.select("query_id", "doc_id", "rank", "score", "source", "text", "cited")


_TURNS = """
SELECT a.conv_id, a.turn, a.text AS answer, u.text AS passage
FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
WHERE a.role = 'assistant'"""


def _ungrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = run_sql(spark, sf_dir, _TURNS)
    terms = retrieval.ungrounded_terms(F.col("answer"), F.array("passage"))
    return turns.select("conv_id", "turn", F.explode(terms).alias("term"))


_RESULTS = """
SELECT concat('model-', cast(conv_id % 5 AS string)) AS model, text AS answer, turn AS sources,
       cast(length(text) AS double) AS latency_ms
FROM conversations WHERE role = 'assistant'"""

# Document texts with interaction phrases and references worked in by rule.
_LABELLED = r"""
SELECT doc_id, concat(text,
    CASE doc_id % 5 WHEN 0 THEN ' Category  X warfarin, Aspirin and NSAIDs: risk of BLEEDING [source: fda-1-warnings-0]'
      WHEN 1 THEN ' monitor potassium loss; lithium toxic plasma level [source: a] [source: b-2] [source: c] [source: d]'
      WHEN 2 THEN ' Category B: mild, myopathy' WHEN 3 THEN ' significant QT prolongation, hmg-coa, beta blocker' ELSE '' END)
    AS text, doc_id % 3 AS n_sources
FROM documents"""

_DRUG_NAMES = """
SELECT p_partkey, concat('NDA020503 ', p_name, ' ', cast(p_size AS string), '.5 MG/ML Oral Tablet [', p_brand, ']  ', p_type) AS drug,
       concat(cast(p_size AS string), ' MG ', p_name, ' extra strength formula for ', p_type, ' use  Injectable') AS other
FROM part"""

_SECRETS = r"""
SELECT doc_id, concat(text, chr(10), 'API_TOKEN = ', substr(md5(cast(doc_id AS string)), 1, 10), chr(10), '{"db_password": "',
    md5(lang), '", "user": "x"}', chr(10), 'use sk-', md5(source), ' or eyJ', md5(source), '.', md5(lang), '.', md5('z'),
    ' hash = ', md5(lang), md5(source), ' end') AS text
FROM documents"""


def _labels(spark: SparkSession, sf_dir: str, expr) -> DataFrame:
    return run_sql(spark, sf_dir, _LABELLED).select("doc_id", expr)


def _severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = interactions.severity_label(F.col("text"), F.col("n_sources"))
    out = run_sql(spark, sf_dir, _LABELLED).select("doc_id", label.alias("severity"))
    ranked = out.withColumn("severity_rank", interactions.severity_rank(F.col("severity")))
    return interactions.severity_sort(ranked, then=["doc_id"])


def _short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = interactions.short_drug_name
    return run_sql(spark, sf_dir, _DRUG_NAMES).select("p_partkey", short(F.col("drug")).alias("drug"), short(F.col("other")).alias("other"))


def _word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunk_words(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn(
        "chunk_index", F.col("chunk_index").cast("bigint")
    )


def _sentence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return corpus.chunk_sentences(docs, size=100, overlap=20).select(
        "doc_id", F.col("total_chunks").cast("bigint").alias("total_chunks"), F.col("chunk_index").cast("bigint").alias("chunk_index"), "chunk"
    )


def _label_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a label: the section depends on its language, the key on its source."""
    docs = table(spark, sf_dir, "documents")
    array = lambda c: F.array(c)
    none = F.array().cast("array<string>")
    lang = F.col("lang")
    labels = docs.select(
        F.concat(F.lit("Drug "), "source").alias("drug_name"),
        F.struct(
            F.when(lang == "en", array(F.concat(F.lit("Brand "), "source"))).otherwise(none).alias("brand_name"),
            F.when(lang == "de", array(F.concat(F.lit("generic "), "source"))).alias("generic_name"),
            F.when(lang != "fr", array(F.col("doc_id").cast("string"))).alias("rxcui"),
        ).alias("openfda"),
        F.when(lang != "es", array("text")).alias("indications_and_usage"),
        F.when(lang == "es", array("text")).alias("boxed_warning"),
    )
    out = corpus.label_sections(labels)
    return out.select("id", "text", "source", F.element_at("metadata", "section").alias("section"))


def _code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.merge_code_map(distinct_codes(view(spark, sf_dir, "observations")), corpus.lab_codes(spark))


def _concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = distinct_codes(view(spark, sf_dir, "conditions"))
    synonyms = F.array(F.lower("description"), F.upper("description"), F.initcap("code"), F.lit("fourth"))
    text = corpus.concept_sentence(F.col("code"), F.col("description"), F.concat(F.lit("Priority "), "code", F.lit(".")), synonyms)
    return codes.select("code", text.alias("text"))


def _lab_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.lab_reference(view(spark, sf_dir, "observations")).select("event_id", "code", "unit", "reference_range", "class")


def _context_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = view(spark, sf_dir, "observations").withColumns({"unit": F.lit("u"), "value": F.round("value", 2)})
    meds = view(spark, sf_dir, "medications")
    return corpus.patient_context(
        view(spark, sf_dir, "patients"), meds, view(spark, sf_dir, "conditions"), observations,
        {"medications": ["start", *[c for c in meds.columns if c != "start"]], "conditions": ["encounter"], "observations": ["event_id"]},
    )


def _patient_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = _context_frame(spark, sf_dir).select("patient", corpus.patient_features().alias("features"))
    return context.withColumn("question", corpus.augment_query(F.lit("Is the dose right?"), F.col("features")))


def _case_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = _context_frame(spark, sf_dir)
    blank = F.array().cast("array<string>")
    labs = F.map_from_entries(
        F.transform(
            F.coalesce("observations", F.array().cast(context.schema["observations"].dataType)),
            lambda o: F.struct(F.concat(o["description"], F.lit("-"), o["position"].cast("string")), o["value"]),
        )
    )
    meds = F.coalesce(F.transform("active_meds", lambda e: e["description"]), blank)
    symptoms = F.coalesce(F.transform("conditions", lambda e: e["description"]), blank)
    age = F.col("patient").cast("int") % 90
    sex = F.when(age % 3 == 0, "F").when(age % 3 == 1, "")
    return context.select("patient", corpus.case_question(labs, meds, symptoms, age, sex).alias("question"))


QUERIES = {
    "word_chunks": _word_chunks,
    "sentence_chunks": _sentence_chunks,
    "html_text": lambda s, d: table(s, d, "pages").select("page_id", corpus.html_to_text(F.col("html")).alias("text")),
    "medication_sentences": lambda s, d: corpus.medication_documents(view(s, d, "medications")).select("id", "text", "shard"),
    "medication_metadata": lambda s, d: corpus.medication_documents(view(s, d, "medications")).select("id", F.explode("metadata").alias("name", "value")),
    "code_map": _code_map,
    "code_sentences": lambda s, d: _code_map(s, d).select("code", corpus.lab_sentence().alias("text")),
    "concept_sentences": _concepts,
    "lab_reference": _lab_reference,
    "label_section_chunks": _label_sections,
    "drug_keys": lambda s, d: corpus.drug_keys(view(s, d, "medications")),
    "slugs": lambda s, d: table(s, d, "pages").select("page_id", slug(F.col("url")).alias("slug")),
    "case_questions": _case_questions,
    "patient_context_text": _patient_text,
    "embedded_documents": _embedded,
    "cosine_top_k": _cosine,
    "bm25_terms": _bm25_terms,
    "bm25_top_k": _bm25,
    "hybrid_rrf": _hybrid,
    "context_blocks": _contexts,
    "cited_sources": _cited,
    "answer_checks": lambda s, d: retrieval.answer_checks(run_sql(s, d, _RESULTS)),
    "ungrounded_terms": _ungrounded,
    "citation_refs": lambda s, d: _labels(s, d, F.array_join(interactions.citation_refs(F.col("text")), "|").alias("refs")),
    "severity_labels": _severity,
    "drug_mentions": lambda s, d: _labels(s, d, F.array_join(interactions.drug_mentions(F.col("text")), "|").alias("mentions")),
    "risk_labels": lambda s, d: _labels(s, d, F.array_join(interactions.risk_labels(F.col("text")), "|").alias("risks")),
    "short_drug_names": _short_names,
    "redact_documents": lambda s, d: run_sql(s, d, _SECRETS).select("doc_id", interactions.redact_secrets(F.col("text")).alias("text")),
    "hybrid_shard": _hybrid_shard,
    "hybrid_alpha_edges": _hybrid_edges,
    "hybrid_patient_context": _hybrid_context,
    "bm25_corpus": _corpus_stats,
    "index_merge": _index_merge,
    "index_one_patient": _index_one_patient,
    "index_update": _index_update,
    "index_reuse": _index_reuse,
    "guideline_documents": _guidelines,
    "medication_sentences_raw": _raw_sentences,
    "medication_sentences_typed": _typed_sentences,
    "shard_stats": lambda s, d: retrieval.shard_stats(documents(s, d).withColumn("indexed_at", F.to_timestamp(F.lit(INDEXED_AT)))).withColumn("last_indexed", F.date_format("last_indexed", "yyyy-MM-dd")),
}

# --- oracle SQL -----------------------------------------------------------------------------------

def _sql_words(col: str) -> str:
    body = f"trim({col}, '{SPACE_CHARS}')"
    return f"CASE WHEN {body} = '' THEN [] ELSE regexp_split_to_array({body}, '{SPACE_CLASS}+') END"


_DOCS_CTE = f"{cte('documents_corpus')}, docs AS MATERIALIZED (SELECT id, source, text, {_sql_words('lower(text)')} AS toks FROM documents_corpus)"
_BM25_CTE = f"""{_DOCS_CTE},
stat AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM docs),
df AS MATERIALIZED (SELECT term, count(*) AS c FROM (SELECT unnest(list_distinct(toks)) AS term FROM docs) GROUP BY 1),
idf0 AS MATERIALIZED (SELECT term, ln(n - c + 0.5) - ln(c + 0.5) AS v FROM df, stat),
idf AS MATERIALIZED (SELECT term, CASE WHEN v < 0 THEN 0.25 * (SELECT avg(v) FROM idf0) ELSE v END AS v FROM idf0),
q AS MATERIALIZED (SELECT query_id, term, count(*) AS w FROM (
  SELECT item_id AS query_id, unnest({_sql_words('lower(text)')}) AS term FROM benchmark) GROUP BY 1, 2),
tf AS MATERIALIZED (SELECT id, dl, term, count(*) AS f FROM (SELECT id, len(toks) AS dl, unnest(toks) AS term FROM docs)
  WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
kw AS MATERIALIZED (SELECT query_id, id AS doc_id,
    round(sum(w * v * (f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / avgdl)))), 9) AS score
  FROM q JOIN idf USING (term) JOIN tf USING (term), stat GROUP BY 1, 2 HAVING score > 0),
kw_ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM kw)"""
_LETTER = "[{}]".format(", ".join(f"cast(len(t) - len(replace(t, '{c}', '')) AS double)" for c in LETTERS))
_SPLIT_SENTENCES = (
    f"regexp_split_to_array(regexp_replace(text, '([.!?]){SPACE_CLASS}+', '\\1' || chr(1), 'g'), chr(1))"
)
_LAB_ROWS = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in corpus.LAB_CODES)
_LAB_CTE = f"lab(code, name, unit, reference_range, class) AS (VALUES {_LAB_ROWS})"
_CODE_MAP_CTE = f"""{cte("observations")}, {_LAB_CTE},
seen AS (SELECT code, max(description) AS description FROM observations GROUP BY 1),
m AS (SELECT coalesce(s.code, l.code) AS code, coalesce(l.name, nullif(s.description, ''), s.code) AS name, unit, reference_range,
  class FROM seen s FULL JOIN lab l ON l.code = s.code)"""
_MED_SENTENCE = f"""concat_ws(' ',
  'Patient ' || coalesce({sql_strip("patient")}, 'unknown patient') || ' was prescribed ' ||
    coalesce({sql_strip("description")}, 'unknown medication'),
  '(RxNorm code: ' || {sql_strip("code")} || ')',
  'from ' || coalesce({sql_strip("start")}, '') || ' to ' || coalesce({sql_strip("stop")}, 'ongoing') || '.',
  'Total cost: $' || total_cost || '.')"""
_CONTEXT_CTE = f"""{cte("patients", "medications", "conditions", "observations")},
m AS (SELECT patient, description, row_number() OVER (PARTITION BY patient ORDER BY start NULLS FIRST, id, patient,
    encounter, code, description, stop NULLS FIRST, base_cost, dispenses, total_cost, reason_code) AS i
  FROM medications WHERE coalesce(trim(stop), '') = ''),
c AS (SELECT patient, description, row_number() OVER (PARTITION BY patient ORDER BY encounter) AS i FROM conditions),
o AS (SELECT patient, description, round(value, 2) AS value, row_number() OVER (PARTITION BY patient ORDER BY event_id) AS i
  FROM observations),
mt AS (SELECT patient, string_agg(description, ', ' ORDER BY i) FILTER (i <= 5) AS t5,
  string_agg(description, ', ' ORDER BY i) FILTER (i <= 10) AS t10 FROM m GROUP BY 1),
ct AS (SELECT patient, string_agg(description, ', ' ORDER BY i) FILTER (i <= 5) AS t5,
  string_agg(description, ', ' ORDER BY i) FILTER (i <= 10) AS t10 FROM c GROUP BY 1),
ot AS (SELECT patient, string_agg(description || '=' || value || 'u', '; ' ORDER BY i) FILTER (i <= 3) AS t3,
  string_agg(description || '-' || i || '=' || value, ', ' ORDER BY description || '-' || i) FILTER (i <= 10) AS t10 FROM o GROUP BY 1),
context AS (SELECT p.id AS patient, mt.t5 AS m5, mt.t10 AS m10, ct.t5 AS c5, ct.t10 AS c10, ot.t3 AS o3, ot.t10 AS o10
  FROM patients p LEFT JOIN mt ON mt.patient = p.id LEFT JOIN ct ON ct.patient = p.id LEFT JOIN ot ON ot.patient = p.id),
features AS (SELECT patient, concat_ws('. ', 'active medications: ' || m5, 'conditions: ' || c5, 'observations: ' || o3) AS features
  FROM context)"""


def _sql_list_labels(rules, most: int) -> str:
    cases = ", ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN '{label}' END" for label, p in rules)
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL)[1:{most}], '|')"


_SEVERITY_CASE = " ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{label}'" for label, p in interactions.SEVERITY_PATTERNS)
_SEVERITY_RANK = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(interactions.SEVERITY_ORDER))


def _sql_short(col: str) -> str:
    col = f"regexp_replace({col}, '\\d+(\\.\\d+)?\\s*(MG|UNT|ACTUAT|ML)(/[A-Z]+)?', '', 'gi')"
    col = f"regexp_replace({col}, '\\s*(Oral Tablet|Injectable Suspension|Mucosal Spray|Metered Dose Inhaler|Dry Powder Inhaler|Injection)\\b.*', '', 'i')"
    col = f"trim(regexp_replace(regexp_replace({col}, '\\[.*?\\]', '', 'g'), '\\s+', ' ', 'g'))"
    return f"left(regexp_replace({col}, '^NDA\\d+\\s+', ''), 40)"


def _sql_redact() -> str:
    """Nested replacements; one per secret length for the masks that keep it."""
    out = f"regexp_replace(text, '{interactions.JWT}', '{interactions.JWT_MASK}', 'g')"
    out = f"regexp_replace({out}, '{interactions.INLINE_KEY}', '{interactions.INLINE_KEY_MASK}', 'g')"
    name = r"([A-Z_]*(?:SECRET|PASSWORD|JWT|TOKEN|KEY|APIKEY|API_KEY|SMTP)[A-Z_]*)"
    field = r'("(?:[^"]*(?:secret|password|jwt|token|api_key|apikey|key)[^"]*)")'
    for n in range(1, interactions.MASK_LENGTH + 1):
        rest = f"{{{n - 1}}}" if n < interactions.MASK_LENGTH else f"{{{n - 1},}}"
        out = f"regexp_replace({out}, '(?im)^{name}\\s*=\\s*([^\\s#].{rest})$', '\\1=' || repeat('#', {n}), 'g')"
        if n >= 4:
            out = f"regexp_replace({out}, '(?i){field}\\s*:\\s*\"([^\"#][^\"]{rest})\"', '\\1: \"' || repeat('#', {n}) || '\"', 'g')"
    return f"regexp_replace({out}, '(=\\s)([A-Za-z0-9+/=_\\-]{{40,}})', '\\1' || repeat('#', 24), 'g')"


_HYBRID = f"""{_BM25_CTE},
vec AS MATERIALIZED (SELECT id, list_transform(x, lambda e: cast(cast(e / CASE WHEN norm = 0 THEN 1 ELSE norm END AS float) AS double)) AS v
  FROM (SELECT *, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS norm FROM (SELECT id, {_LETTER} AS x FROM (
    SELECT id, lower(text) AS t FROM docs UNION ALL SELECT 'q' || item_id, lower(text) FROM benchmark)))),
dense AS MATERIALIZED (SELECT item_id AS query_id, d.id AS doc_id, round(list_dot_product(d.v, w.v) /
    (sqrt(list_dot_product(d.v, d.v)) * sqrt(list_dot_product(w.v, w.v)) + 1e-9), 9) AS score
  FROM benchmark JOIN vec w ON w.id = 'q' || item_id, vec d WHERE d.id[1] <> 'q'),
dense_ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM dense),
fused AS (SELECT query_id, doc_id, round(sum(share), 6) AS score FROM (
    SELECT query_id, doc_id, 0.6 / (60 + rank) AS share FROM dense_ranked WHERE rank <= 15
    UNION ALL SELECT query_id, doc_id, 0.4 / (60 + rank) FROM kw_ranked WHERE rank <= 15) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM fused)"""
_ASKED = """bq AS (SELECT item_id, CASE WHEN item_id % 2 = 0 THEN text || ' [Patient context: conditions: the and of ' || item_id || ']'
  ELSE text END AS text FROM benchmark)"""
_RAW_SENTENCE = """concat_ws(' ', 'Patient ' || PATIENT || ' was prescribed ' || DESCRIPTION, '(RxNorm code: ' || CODE || ')',
  'from ' || {start} || ' to ' || coalesce(nullif(STOP, ''), 'ongoing') || '.', 'Reason: ' || REASONDESCRIPTION || '.', 'Payer: ' || PAYER || '.',
  'Total cost: $' || {cost} || '.')"""

ORACLES = {
    "hybrid_shard": f"WITH {_HYBRID.replace('FROM documents_corpus)', chr(70) + 'ROM documents_corpus WHERE shard = ' + chr(39) + 'de' + chr(39) + ')')} SELECT query_id, doc_id, score, rank FROM r WHERE rank <= 5",
    "hybrid_alpha_edges": f"""WITH {_HYBRID} SELECT query_id, doc_id, round(1.0 / (60 + rank), 6) AS score, rank, 0.0 AS alpha FROM kw_ranked WHERE rank <= 5
UNION ALL SELECT query_id, doc_id, round(1.0 / (60 + rank), 6) AS score, rank, 1.0 FROM dense_ranked WHERE rank <= 5""",
    "hybrid_patient_context": f"WITH {_ASKED}, {_HYBRID.replace('FROM benchmark', 'FROM bq')} SELECT query_id, doc_id, score, rank FROM r WHERE rank <= 5".replace("bq JOIN vec", "bq AS benchmark JOIN vec"),
    "bm25_corpus": f"WITH {_DOCS_CTE} SELECT count(*) AS n_docs, round(avg(len(toks)), 6) AS avg_length FROM docs",
    "index_merge": """SELECT cast(doc_id AS string) AS id, lang AS shard, md5(CASE WHEN lang IN ('de', 'fr') THEN 'new ' || text ELSE text END) AS hash,
  CASE WHEN lang IN ('de', 'fr') THEN '2024-03-01' ELSE '2024-02-01' END AS indexed_on FROM documents""",
    "index_update": """SELECT lang AS shard, count(*) AS rows, count(*) FILTER (lang = 'de' AND doc_id % 10 = 1) AS changed,
  lang <> 'de' AS same_files FROM documents GROUP BY 1""",
    "index_reuse": """SELECT cast(doc_id AS string) AS id, CASE WHEN doc_id % 10 = 3 THEN 'moved' ELSE lang END AS shard,
  md5(CASE WHEN doc_id % 10 = 7 THEN 'new ' || text ELSE text END) AS hash, '2024-03-01' AS indexed_on,
  CASE WHEN doc_id % 10 = 7 THEN '2024-03-01' ELSE '2024-02-01' END AS encoded_on FROM documents""",
    "index_one_patient": f"""WITH {cte("medications")} SELECT 'med-' || id AS id, {_MED_SENTENCE} AS text,
  CASE WHEN patient = '42' THEN '2024-03-01' ELSE '2024-02-01' END AS indexed_on FROM medications""",
    "medication_sentences_raw": f"""WITH r AS ({RAW_MEDICATIONS}) SELECT 'med-' || PATIENT || '-' || ENCOUNTER || '-' || coalesce(CODE, 'code') || '-' || START AS id,
  {_RAW_SENTENCE.format(start="START", cost="TOTALCOST")} AS text FROM r""",
    "medication_sentences_typed": f"""WITH r AS ({RAW_MEDICATIONS}) SELECT
  {_RAW_SENTENCE.format(start="START || 'T00:00:00'", cost="cast(TOTALCOST AS double)")} AS text, PAYER AS payer FROM r""",
    "word_chunks": f"""WITH w AS (SELECT doc_id, text, {_sql_words("text")} AS ws FROM documents),
p AS (SELECT doc_id, text, ws, unnest(CASE WHEN len(ws) <= 400 THEN [0] ELSE generate_series(0, len(ws) - 1, 350) END) AS s FROM w)
SELECT doc_id, cast(s // 350 AS bigint) AS chunk_index,
  CASE WHEN len(ws) <= 400 THEN text ELSE array_to_string(ws[s + 1 : s + 400], ' ') END AS chunk FROM p""",
    "sentence_chunks": f"""WITH s AS (SELECT doc_id, list_transform({_SPLIT_SENTENCES},
    lambda x: {{'done': cast([] AS varchar[]), 'cur': {_sql_words("x")}}}) AS parts FROM documents),
f AS (SELECT doc_id, list_reduce(parts, lambda a, x: CASE WHEN len(a.cur) > 0 AND len(a.cur) + len(x.cur) > 100
    THEN {{'done': list_append(a.done, array_to_string(a.cur, ' ')), 'cur': list_concat(a.cur[-20:], x.cur)}}
    ELSE {{'done': a.done, 'cur': list_concat(a.cur, x.cur)}} END,
    {{'done': cast([] AS varchar[]), 'cur': cast([] AS varchar[])}}) AS r FROM s),
c AS (SELECT doc_id, list_filter(list_append(r.done, array_to_string(r.cur, ' ')), lambda t: len(string_split(t, ' ')) >= 10) AS chunks FROM f)
SELECT doc_id, len(chunks) AS total_chunks, generate_subscripts(chunks, 1) - 1 AS chunk_index, unnest(chunks) AS chunk FROM c""",
    "guideline_documents": f"""WITH s AS (SELECT doc_id, list_transform({_SPLIT_SENTENCES},
    lambda x: {{'done': cast([] AS varchar[]), 'cur': {_sql_words("x")}}}) AS parts FROM documents),
f AS (SELECT doc_id, list_reduce(parts, lambda a, x: CASE WHEN len(a.cur) > 0 AND len(a.cur) + len(x.cur) > 100
    THEN {{'done': list_append(a.done, array_to_string(a.cur, ' ')), 'cur': list_concat(a.cur[-20:], x.cur)}}
    ELSE {{'done': a.done, 'cur': list_concat(a.cur, x.cur)}} END,
    {{'done': cast([] AS varchar[]), 'cur': cast([] AS varchar[])}}) AS r FROM s),
c AS (SELECT doc_id, list_filter(list_append(r.done, array_to_string(r.cur, ' ')), lambda t: len(string_split(t, ' ')) >= 10) AS chunks FROM f),
d AS (SELECT doc_id, len(chunks) AS n, generate_subscripts(chunks, 1) - 1 AS i, unnest(chunks) AS chunk FROM c)
SELECT 'guideline-guide-' || doc_id || '-' || i AS id, 'Guide ' || doc_id AS source, md5(chunk) AS hash, cast(n AS varchar) AS total_chunks FROM d""",
    "html_text": f"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'g'),
  '{SPACE_CLASS}+', ' ', 'g'), '{SPACE_CHARS}') AS text FROM pages""",
    "medication_sentences": f"""WITH {cte("medications")} SELECT 'med-' || id AS id, {_MED_SENTENCE} AS text, 'medications' AS shard
FROM medications""",
    "medication_metadata": f"""WITH {cte("medications")}, w AS (SELECT 'med-' || id AS id, coalesce(patient, '') AS patient,
  coalesce(code, '') AS code, coalesce(trim(description), '') AS description, coalesce(start, '') AS start,
  coalesce(stop, '') AS stop, '' AS payer FROM medications)
UNPIVOT w ON patient, code, description, start, stop, payer INTO NAME name VALUE value""",
    "code_map": f"""WITH {_CODE_MAP_CTE} SELECT code, name, coalesce(unit, '') AS unit,
  coalesce(reference_range, '') AS reference_range, coalesce(class, '') AS class FROM m""",
    "code_sentences": f"""WITH {_CODE_MAP_CTE}
SELECT code, concat_ws(' ', 'LOINC ' || code || ': ' || name || '.', 'Unit: ' || unit || '.',
  'Reference range: ' || nullif(reference_range, '—') || '.', 'Category: ' || class || '.') AS text FROM m""",
    "concept_sentences": f"""WITH {cte("conditions")}, d AS (SELECT code, max(description) AS description FROM conditions GROUP BY 1)
SELECT code, 'SNOMED CT ' || code || ': ' || description || '. Priority ' || code || '. Also known as: ' || lower(description)
  || ', ' || upper(description) || ', ' || array_to_string(list_transform(string_split(code, ' '),
    lambda x: upper(x[1]) || lower(x[2:])), ' ') || '.' AS text FROM d""",
    "lab_reference": f"""WITH {cte("observations")}, {_LAB_CTE} SELECT event_id, code, unit, reference_range, class
FROM observations LEFT JOIN lab USING (code)""",
    "label_section_chunks": f"""WITH w AS (SELECT *, {_sql_words("text")} AS ws FROM documents),
p AS (SELECT *, unnest(CASE WHEN len(ws) <= 400 THEN [0] ELSE generate_series(0, len(ws) - 1, 350) END) AS s,
  CASE lang WHEN 'en' THEN 'Brand ' || source WHEN 'de' THEN 'generic ' || source ELSE 'Drug ' || source END AS display,
  CASE WHEN lang = 'es' THEN 'boxed_warning' ELSE 'indications_and_usage' END AS section FROM w)
SELECT 'fda-' || CASE WHEN lang <> 'fr' THEN cast(doc_id AS varchar) ELSE 'drug_' || source END || '-' || section || '-' || (s // 350) AS id,
  'FDA Label — ' || display || ' | ' || CASE WHEN lang = 'es' THEN 'Boxed Warning' ELSE 'Indications And Usage' END || ':' || chr(10)
    || CASE WHEN len(ws) <= 400 THEN text ELSE array_to_string(ws[s + 1 : s + 400], ' ') END AS text,
  'FDA Drug Label — ' || display AS source, section FROM p""",
    "drug_keys": f"""WITH {cte("medications")}, k AS (SELECT DISTINCT split_part(coalesce(description, ''), ' ', 1) AS drug_key
FROM medications) SELECT drug_key FROM k WHERE length(drug_key) > 2 AND drug_key <> 'Medication'""",
    "slugs": "SELECT page_id, left(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), 40) AS slug FROM pages",
    "patient_context_text": f"""WITH {_CONTEXT_CTE}
SELECT patient, features, CASE WHEN features <> '' THEN 'Is the dose right? [Patient context: ' || features || ']'
  ELSE 'Is the dose right?' END AS question FROM features""",
    "case_questions": f"""WITH {_CONTEXT_CTE}, a AS (SELECT *, cast(patient AS int) % 90 AS age FROM context)
SELECT patient, concat_ws(' ', 'Evaluate this patient:', 'Lab values: ' || o10 || '.', 'Current medications: ' || m10 || '.',
  'Symptoms: ' || c10 || '.',
  CASE WHEN age > 0 THEN 'Patient is ' || age || ' years old' || CASE WHEN age % 3 = 0 THEN ' F' ELSE '' END || '.' END,
  'Provide primary diagnosis with ICD code, differential, guideline support, and recommended workup.') AS question FROM a""",
    "embedded_documents": f"""WITH t AS (SELECT cast(doc_id AS string) AS id, lang AS shard, lower(text) AS t FROM documents),
v AS (SELECT id, shard, {_LETTER} AS x FROM t), n AS (SELECT *, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS norm FROM v),
c AS (SELECT id, shard, generate_subscripts(x, 1) - 1 AS position, unnest(x) AS e, norm FROM n)
SELECT id, shard, cast(position AS int) AS position,
  round(cast(cast(e / CASE WHEN norm = 0 THEN 1 ELSE norm END AS float) AS double), 5) AS weight FROM c""",
    "cosine_top_k": """WITH d AS (SELECT vec_id AS doc_id, cast(embedding AS double[]) AS v FROM embeddings),
q AS (SELECT label AS query_id, cast(arg_min(embedding, vec_id) AS double[]) AS w FROM embeddings GROUP BY 1),
s AS (SELECT query_id, doc_id, round(list_dot_product(v, w) /
  (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(w, w)) + 1e-9), 9) AS score FROM q, d),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
    "bm25_terms": f"""WITH {_DOCS_CTE} SELECT term, count(*) AS doc_freq
FROM (SELECT unnest(list_distinct(toks)) AS term FROM docs) GROUP BY 1""",
    "bm25_top_k": f"WITH {_BM25_CTE} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM kw_ranked WHERE rank <= 10",
    "hybrid_rrf": f"WITH {_HYBRID} SELECT query_id, doc_id, score, rank FROM r WHERE rank <= 5",
    "context_blocks": f"""WITH {_BM25_CTE} SELECT query_id, string_agg('[' || rank || '] [source: ' || doc_id || '] (' || source || ')' || chr(10)
  || trim(text), chr(10) || chr(10) ORDER BY rank) AS context
FROM kw_ranked JOIN docs ON docs.id = doc_id WHERE rank <= 3 GROUP BY 1""",
    "cited_sources": f"""WITH {_BM25_CTE}, top AS (SELECT query_id, doc_id, rank, round(score, 4) AS score, source, left(text, 200) AS text
  FROM kw_ranked JOIN docs ON docs.id = doc_id WHERE rank <= 3),
a AS (SELECT query_id, CASE WHEN query_id % 2 = 0 THEN 'See [source: ' || doc_id || '].' ELSE 'No idea.' END AS answer FROM top WHERE rank = 2),
j AS (SELECT top.*, contains(answer, doc_id) AS cited FROM top JOIN a USING (query_id))
SELECT * FROM j WHERE cited OR (rank = 1 AND query_id NOT IN (SELECT query_id FROM j WHERE cited))""",
    "answer_checks": f"""WITH r AS ({_RESULTS}) SELECT model, count(*) AS questions, count(*) FILTER (length(trim(answer)) >= 10) AS answered,
  cast(sum(sources) AS bigint) AS sources, round(avg(latency_ms), 3) AS avg_latency_ms, bool_and(length(trim(answer)) >= 10) AS passed
FROM r GROUP BY 1""",
    "ungrounded_terms": f"""WITH t AS ({_TURNS}),
w AS (SELECT DISTINCT conv_id, turn, passage, unnest(regexp_split_to_array(answer, '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM t)
SELECT conv_id, turn, term FROM w WHERE regexp_full_match(term, '[A-Z][a-z]{{5,}}') AND NOT contains(lower(passage), lower(term))""",
    "citation_refs": f"""WITH t AS ({_LABELLED})
SELECT doc_id, array_to_string(regexp_extract_all(text, '\\[source: ([^\\]]+)\\]', 1)[1:3], '|') AS refs FROM t""",
    "severity_labels": f"""WITH t AS ({_LABELLED}), s AS (SELECT doc_id, CASE {_SEVERITY_CASE}
  WHEN n_sources = 0 THEN '{interactions.NO_DATA}' ELSE '{interactions.UNKNOWN}' END AS severity FROM t)
SELECT doc_id, severity, CASE severity {_SEVERITY_RANK} END AS severity_rank FROM s""",
    "drug_mentions": f"""WITH t AS ({_LABELLED}) SELECT doc_id,
  {_sql_list_labels([(n, chr(92) + 'b' + n + chr(92) + 'b') for n in interactions.DRUG_NAMES] + interactions.DRUG_CLASSES, 8)} AS mentions FROM t""",
    "risk_labels": f"WITH t AS ({_LABELLED}) SELECT doc_id, {_sql_list_labels(interactions.RISK_PATTERNS, 5)} AS risks FROM t",
    "short_drug_names": f"WITH t AS ({_DRUG_NAMES}) SELECT p_partkey, {_sql_short('drug')} AS drug, {_sql_short('other')} AS other FROM t",
    "redact_documents": f"WITH t AS ({_SECRETS}) SELECT doc_id, {_sql_redact()} AS text FROM t",
    "shard_stats": """SELECT lang AS shard, count(*) AS doc_count, '2024-02-01' AS last_indexed FROM documents GROUP BY 1
UNION ALL SELECT NULL, count(*), '2024-02-01' FROM documents""",
}
