import math
import re
import sys
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from carelake.functions.text import SPACE_CODES
from carelake.operators import corpus, interactions, keywords, retrieval

# Encoders given by the caller travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def windows(text, size, overlap):
    found = text.split()
    if len(found) <= size:
        return [text]
    return [" ".join(found[i : i + size]) for i in range(0, len(found), size - overlap)]


def test_word_windows(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) + " " for n in (0, 1, 400, 401, 750, 751)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = corpus.chunk_words(df).collect()
    for i, t in enumerate(texts):
        got = [r.chunk for r in sorted((r for r in out if r.i == i), key=lambda r: r.chunk_index)]
        assert got == windows(t, 400, 50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=12), st.integers(5, 25), st.integers(0, 4))
def test_sentence_fold_keeps_every_word(lengths, size, overlap):
    text = " ".join(" ".join(f"w{i}x{j}" for j in range(n)) + "." for i, n in enumerate(lengths))
    chunks = corpus._sentence_ranges(text, size, overlap)
    kept = {w for c in chunks for w in c.split()}
    assert all(len(c.split()) >= 10 for c in chunks) and kept <= set(text.split())
    if overlap == 0:
        assert len(" ".join(chunks).split()) == len(kept)


def test_long_sentence_is_one_chunk(spark):
    text = "a b. " + " ".join("w" for _ in range(30)) + ". " + " ".join("v" for _ in range(9)) + "."
    df = spark.createDataFrame([(text,)], "text string")
    out = [r.chunk for r in corpus.chunk_sentences(df, size=12, overlap=2).orderBy("chunk_index").collect()]
    assert out == ["a b. " + "w " * 29 + "w.", "w w. " + "v " * 8 + "v."]


def test_html_and_sentences(spark):
    html = "<p>A&amp;B<SCRIPT x>1<b>2</SCRIPT >\n</script><style>s</style>  c</p>"
    df = spark.createDataFrame([(html,)], "h string")
    expected = re.sub(r"<(script|style)[^>]*>.*?</\1>", " ", html, flags=re.S | re.I)
    expected = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", expected)).strip()
    assert df.select(corpus.html_to_text(F.col("h"))).first()[0] == expected
    med = spark.createDataFrame([(" ", "", "1", None, None, "12.5")], "patient string, description string, code string, start string, stop string, total_cost string")
    assert med.select(corpus.medication_sentence(med)).first()[0] == (
        "Patient unknown patient was prescribed unknown medication (RxNorm code: 1) from  to ongoing. Total cost: $12.5."
    )
    raw = spark.createDataFrame([("p", "d", "7", "2024-01-01", "", "me", "why", "9.50")], "PATIENT string, DESCRIPTION string, CODE string, START string, STOP string, PAYER string, REASONDESCRIPTION string, TOTALCOST string")
    assert corpus.medication_documents(raw).first()["text"] == (
        "Patient p was prescribed d (RxNorm code: 7) from 2024-01-01 to ongoing. Reason: why. Payer: me. Total cost: $9.50."
    )
    assert corpus.medication_documents(raw).first()["id"] == "med-p-encounter-7-2024-01-01"


def brute_cosine(queries, docs, k):
    out = []
    for q, v in queries:
        scored = [(round(float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w) + 1e-9)), 9), d) for d, w in docs]
        out += [(q, d, s, i) for i, (s, d) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return out


def test_cosine_for_any_block_size(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(np.float32(x)) for x in rng.normal(size=6)] for _ in range(60)]
    vectors += [vectors[3]] * 30 + [[0.0] * 6]
    docs = [(f"d{i:03d}", v) for i, v in enumerate(vectors)]
    queries = [(i, vectors[i]) for i in (0, 3, 7)]
    d = spark.createDataFrame(docs, "id string, vector array<float>").repartition(5)
    q = spark.createDataFrame(queries, "query_id bigint, vector array<float>")
    expected = brute_cosine(queries, docs, 5)
    close = lambda found: [(a, b, round(s, 6), r) for a, b, s, r in sorted(found)]
    assert close(tuple(r) for r in retrieval.cosine_top_k(q, d, 5).collect()) == close(expected)
    blocks = retrieval.cosine_top_k(q, d, 5, block_rows=1)
    assert close(tuple(r) for r in blocks.collect()) == close(expected)
    assert retrieval.cosine_top_k(q.limit(0), d, 5).count() == 0


def brute_bm25(queries, docs, k):
    toks = {d: t.lower().split() for d, t in docs}
    n, avgdl = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: v if v >= 0 else 0.25 * mean for t, v in idf.items()}
    out = []
    for q, text in queries:
        scored = []
        for d, ts in toks.items():
            tf = Counter(ts)
            s = sum(idf.get(t, 0) * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(ts) / avgdl)) for t in text.lower().split())
            if round(s, 9) > 0:
                scored.append((round(s, 9), d))
        out += [(q, d, s, i) for i, (s, d) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return out


def test_bm25_for_any_block_size(spark):
    texts = ["the cat's sat", "the dog the dog ran \\ far", "the  bird flew", "the", "", "the cat cat", "the cat's sat"]
    docs = [(f"d{i}", t) for i, t in enumerate(texts)]
    queries = [(1, "Cat's CAT cat unknown"), (2, "the"), (3, "nothing here"), (4, "dog \\ bird")]
    d = spark.createDataFrame(docs, "id string, text string").repartition(3)
    q = spark.createDataFrame(queries, "query_id bigint, text string")
    expected = sorted((a, b, round(s, 6), r) for a, b, s, r in brute_bm25(queries, docs, 3))
    for limit in (1000, 1):
        found = retrieval.bm25_top_k(q, d, 3, block=limit).collect()
        assert sorted((r.query_id, r.doc_id, round(r.score, 6), r.rank) for r in found) == expected


def test_bm25_statistics_cover_the_shard_only(spark):
    d = spark.createDataFrame([("a", "x y", "s"), ("b", "x z", "t"), ("c", "q r", "s"), ("e", "q r s", "s")], "id string, text string, shard string")
    q = spark.createDataFrame([(1, "y z")], "query_id bigint, text string")
    assert [r.doc_id for r in retrieval.bm25_top_k(q, d, 5, "s").collect()] == ["a"]


def test_repeated_ids_give_equal_rows_for_any_block_size(spark):
    d = spark.createDataFrame([("a", "x y", [1.0, 0.0]), ("a", "x y", [1.0, 0.0]), ("b", "z q r", [0.0, 1.0]), ("n", "x", None)], "id string, text string, vector array<double>")
    q = spark.createDataFrame([(1, "x", [1.0, 0.0]), (1, "z", [0.0, 1.0]), (2, "z", [0.0, 0.0])], "query_id bigint, text string, vector array<double>")
    for size in (1, 10**6):
        got = rows(retrieval.bm25_top_k(q, d, 5, block=size).select("query_id", "doc_id"))
        assert got == [(1, "a"), (1, "a"), (1, "b"), (1, "n"), (2, "b")]
        near = retrieval.cosine_top_k(q, d, 2, block_rows=size)
        assert rows(near.select("query_id", "doc_id", F.round("score", 6))) == [(1, "a", 1.0), (1, "a", 1.0), (2, "a", 0.0), (2, "a", 0.0)]


def test_many_question_terms_stay_within_memory(spark):
    q = spark.range(20_000).selectExpr("id AS query_id", "concat('w', id) AS text")
    d = spark.createDataFrame([(f"d{i}", " ".join(f"w{j}" for j in range(i, 20_000, 997))) for i in range(50)], "id string, text string")
    found = retrieval.bm25_top_k(q, d, 1)
    assert found.count() > 500


def test_many_questions_are_one_scan_of_the_documents(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 4))
    d = spark.createDataFrame([(f"d{i:03d}", v.tolist()) for i, v in enumerate(vectors)], "id string, vector array<double>").repartition(3)
    asked = rng.normal(size=(100_000, 4))
    q = spark.range(100_000).join(spark.createDataFrame([(i, v) for i, v in enumerate(asked.tolist())], "id bigint, vector array<double>"), "id").withColumnRenamed("id", "query_id")
    found = retrieval.cosine_top_k(q, d, 1, block_rows=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    scores = asked @ vectors.T / (np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :] + 1e-9)
    got = {r.query_id: r.doc_id for r in found.select("query_id", "doc_id").collect()}
    assert got == {i: f"d{j:03d}" for i, j in enumerate(np.round(scores, 9).argmax(axis=1).tolist())}


def zipf_texts(rng, n, vocabulary=300):
    words = [f"w{i}" for i in range(vocabulary)]
    weights = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(rng.choice(words, size=rng.integers(1, 40), p=weights / weights.sum())) for _ in range(n)]


@pytest.mark.parametrize("block", [4, 256])
def test_index_search_is_exact(spark, block, tmp_path):
    rng = np.random.default_rng(block)
    docs = [(f"d{i:04d}", t) for i, t in enumerate(zipf_texts(rng, 600))]
    queries = [(i, t) for i, t in enumerate(zipf_texts(rng, 60))] + [(100, ""), (101, "unknown"), (102, "w0"), (103, "w0 w0 w1 w299")]
    d = spark.createDataFrame(docs, "id string, text string").repartition(4)
    q = spark.createDataFrame(queries, "query_id bigint, text string")
    keywords.build(d, str(tmp_path), block=block)
    expected = sorted((a, b, round(s, 6), r) for a, b, s, r in brute_bm25(queries, docs, 5))
    found = retrieval.keyword_top_k(q, str(tmp_path), 5)
    assert sorted((r.query_id, r.doc_id, round(r.score, 6), r.rank) for r in found.collect()) == expected


def test_index_search_reads_the_buckets_asked_for(spark, tmp_path):
    d = spark.createDataFrame([(f"d{i}", f"w{i} w{i + 1}") for i in range(200)], "id string, text string")
    keywords.build(d, str(tmp_path))
    plan = keywords.postings(spark, str(tmp_path), [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_no_pair_of_question_and_document_is_a_row(spark, tmp_path):
    d = spark.createDataFrame([(f"d{i:03d}", f"the same words w{i % 3} x{i}") for i in range(300)], "id string, text string").repartition(4)
    q = spark.createDataFrame([(i, f"the words w{i % 3}") for i in range(20)], "query_id bigint, text string")
    keywords.build(d, str(tmp_path), block=100)
    index = keywords.postings(spark, str(tmp_path), list(range(-1, keywords.TERM_BUCKETS)))
    assert index.where("term IS NOT NULL").groupBy("part", "term").count().agg({"count": "max"}).first()[0] == 1
    assert index.where("bucket = -1").selectExpr("max(aggregate(freqs, 0, (a, n) -> a + n))").first()[0] <= 100
    found = retrieval.keyword_top_k(q, str(tmp_path), 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "FlatMapGroupsInArrow" in plan
    # equal texts tie over all parts, and ids decide
    assert rows(found.select("query_id", "rank", "doc_id")) == sorted(((i, r + 1, f"d{i % 3 + 3 * r:03d}") for i in range(20) for r in (0, 1)), key=repr)


def test_words_of_whole_texts_are_split_as_arrays(spark):
    spaces = "".join(map(chr, SPACE_CODES))
    rng = np.random.default_rng(3)
    letters = [*"aB ñİΣ", *spaces, "\u200b", "\u180e", "\ufeff", "  "]
    texts = ["".join(rng.choice(letters, size=rng.integers(0, 30))) for _ in range(500)] + ["", " ", f" {spaces}x{spaces}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").orderBy("i")
    lowered, expected = zip(*df.select(F.lower("text"), keywords.tokens(F.col("text"))).collect(), strict=True)
    words, lengths = keywords.split_words(pa.array(lowered))
    assert lengths.tolist() == [len(e) for e in expected]
    assert words.to_pylist() == [w for e in expected for w in e]


def test_index_parts_list_their_own_words_only(spark, tmp_path):
    texts = [f"{chr(0x2003).join(['all', f'w{i}'])}\tALL x{i}" for i in range(100)]
    d = spark.createDataFrame([(f"d{i:02d}", t) for i, t in enumerate(texts)], "id string, text string").coalesce(1)
    keywords.build(d, str(tmp_path), block=16)
    index = keywords.postings(spark, str(tmp_path), list(range(-1, keywords.TERM_BUCKETS)))
    found = index.where("term IS NOT NULL").selectExpr("count(*) AS n", "min(size) AS least", "count(distinct part) AS parts").first()
    assert tuple(found) == (25 + 200, 1, 25)  # four texts of four words a part
    assert index.where("term = 'all'").selectExpr("flatten(collect_list(freqs)) AS f").first().f == [2] * 100


def test_index_of_nothing(spark):
    d = spark.createDataFrame([("a", None), ("b", "")], "id string, text string")
    q = spark.createDataFrame([(1, "x")], "query_id bigint, text string")
    assert retrieval.bm25_top_k(q, d, 3).count() == 0
    assert retrieval.bm25_top_k(q, d.limit(0), 3).count() == 0
    assert retrieval.bm25_top_k(q.limit(0), d, 3).count() == 0


def test_every_text_is_encoded_once(spark, tmp_path):
    def encode(texts):
        (tmp_path / f"{uuid.uuid4().hex}").write_text("\n".join(texts))
        return np.array([[len(t), 1.0] for t in texts])

    d = spark.createDataFrame([(f"d{i}", f"doc {i}") for i in range(6)], "id string, text string")
    q = spark.createDataFrame([(1, "asked doc")], "query_id bigint, text string")
    retrieval.hybrid_retrieve(q, retrieval.embed(d, encode), encode, 2).collect()
    seen = Counter(line for f in tmp_path.iterdir() for line in f.read_text().split("\n"))
    assert set(seen.values()) == {1} and len(seen) == 7


def lengths(texts):
    return np.array([[len(t), t.count("a"), 1.0] for t in texts])


def test_hybrid_weights(spark):
    d = spark.createDataFrame([("a", "aaa b"), ("b", "b b"), ("c", "zzz zzz zzz")], "id string, text string")
    q = spark.createDataFrame([(1, "aaa", "")], "query_id bigint, text string, features string")
    docs = retrieval.embed(d, lengths)
    both = retrieval.hybrid_retrieve(q, docs, lengths, 2)
    assert both.first().doc_id == "a" and both.count() == 2
    assert retrieval.hybrid_retrieve(q, docs, lengths, 2, alpha=0.0).count() == 1
    assert retrieval.hybrid_retrieve(q, docs, lengths, 2, alpha=7.0).count() == 2
    norms = [np.linalg.norm(r.vector) for r in docs.collect()]
    assert np.allclose(norms, 1.0)


def test_grounding(spark):
    df = spark.createDataFrame(
        [("Aspirin 500 MG with Warfarin and Élevated Abcdefé", ["has aspirin 500 mg", "x"]), ("Warfarin", [])],
        "a string, p array<string>",
    )
    out = [r[0] for r in df.select(retrieval.ungrounded_terms(F.col("a"), F.col("p"))).collect()]
    assert out == [["Warfarin"], []]


def test_index_and_stats(spark, tmp_path):
    d = spark.createDataFrame([("a", "x", "s", "m"), ("b", "y", "t", "m")], "id string, text string, shard string, source string")
    first = retrieval.build_index(d, lengths, str(tmp_path / "one"), "2024-01-01 00:00:00")
    change = d.filter("id = 'a'").withColumn("text", F.lit("new"))
    second = retrieval.build_index(change, lengths, str(tmp_path / "two"), "2024-01-02 00:00:00", stored=first)
    assert rows(second.select("id", "text")) == [("a", "new"), ("b", "y")]
    assert rows(retrieval.shard_stats(second).select("shard", "doc_count")) == [("s", 1), ("t", 1), (None, 2)]
    plan = retrieval.shard_filter(second, "s")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_labels(spark):
    texts = ["Category I risk", "category Ix", "BLEEDING", "Nothing", "beta-blocker and Aspirin, aspirins", "increased drug\nlevel", "increased drug level"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    out = df.select(
        interactions.severity_label(t, F.lit(0)).alias("s"), interactions.drug_mentions(t).alias("m"), interactions.risk_labels(t).alias("r")
    ).collect()
    assert [r.s for r in out] == ["🔴 Critical", interactions.NO_DATA, "🟠 Major"] + [interactions.NO_DATA] * 4
    assert out[4].m == ["Aspirin", "Beta-Blocker"]
    assert out[2].r == ["Bleeding / Hemorrhage"] and out[5].r == [] and out[6].r == ["Increased Drug Levels"]
    everything = df.limit(1).select(interactions.drug_mentions(F.lit(" ".join(interactions.DRUG_NAMES))).alias("m"))
    assert everything.first().m == interactions.DRUG_NAMES[:8]


def test_severity_order(spark):
    df = spark.createDataFrame([("Unknown",), ("🟢 Minor",), ("odd",), ("🔴 Critical",), (interactions.ERROR,)], "severity string")
    assert [r[0] for r in interactions.severity_sort(df, then=["severity"]).collect()][:3] == ["🔴 Critical", "🟢 Minor", interactions.ERROR]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("DB_PASSWORD = abc", "DB_PASSWORD=###"),
        ('{"api_key": "abcd", "k": "v"}', '{"api_key": "####", "k": "v"}'),
        ("x sk-" + "a" * 30, "x sk-" + "#" * 20),
        ("h = " + "A" * 50 + " end", "h = " + "#" * 24 + " end"),
        ("plain text", "plain text"),
        (None, None),
    ],
)
def test_redaction(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(interactions.redact_secrets(F.col("t"))).first()[0] == expected


def test_short_names(spark):
    df = spark.createDataFrame([("NDA020503 200 ACTUAT Albuterol 0.09 MG/ACTUAT Metered Dose Inhaler [Proventil] x",)], "n string")
    assert df.select(interactions.short_drug_name(F.col("n"))).first()[0] == "Albuterol"


def test_case_question_and_features(spark):
    df = spark.sql("SELECT map('b', 2, 'a', 1) AS labs, array('m') AS meds, cast(array() AS array<string>) AS sym, 0 AS age, 'F' AS sex")
    out = df.select(corpus.case_question(F.col("labs"), F.col("meds"), F.col("sym"), F.col("age"), F.col("sex"))).first()[0]
    assert out.startswith("Evaluate this patient: Lab values: a=1, b=2. Current medications: m. Provide primary")
    assert df.select(corpus.augment_query(F.lit("q"), F.lit(""))).first()[0] == "q"


def test_one_patient_run_stands_over_the_whole_index(spark):
    from carelake.plans import retrieval_queries
    from carelake.plans.domain import view

    sf_dir = "/root/testdata/sf0.001"
    out = retrieval_queries.QUERIES["index_one_patient"](spark, sf_dir).collect()
    meds = view(spark, sf_dir, "medications").select("id", "patient").collect()
    assert any(r.patient == "42" for r in meds)
    assert sorted((r.id, r.indexed_on) for r in out) == sorted((f"med-{r.id}", "2024-03-01" if r.patient == "42" else "2024-02-01") for r in meds)


def test_numbers_a_task_holds_are_bounded():
    """Vectors gathered by a task (twice while they are joined) and one block of scores, 8 bytes a number."""
    assert 8 * (2 * retrieval._TASK_CELLS + 4 * retrieval._DENSE_CELLS) < 1 << 27


def test_vectors_reach_spark_as_one_array_a_batch(spark):
    """Unwanted rows stay null, a null text counts as empty, and letters are counted as before."""
    from carelake.plans.retrieval_queries import LETTERS, letter_profile

    texts = ["Abc zZ é İ ß", None, "", "aab", "no"]
    d = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    found = retrieval.embed(d, letter_profile, batch_size=2, wanted=F.col("id") < 4)
    assert "ArrowEvalPython" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "pandas" not in plan
    plain = np.array([[(t or "").lower().count(c) for c in LETTERS] for t in texts], dtype=float)
    norms = np.linalg.norm(plain, axis=1, keepdims=True)
    expected = (plain / np.where(norms == 0, 1, norms)).astype(np.float32).tolist()
    assert [r.vector for r in found.orderBy("id").collect()] == [*expected[:4], None]
    assert letter_profile([]).shape == (0, 26)


def test_letters_are_counted_in_one_pass_over_a_batch():
    import time

    from carelake.plans.retrieval_queries import LETTERS, letter_profile

    texts = [f"Patient {i} takes large ring since 1998-07-01, encounter {i}." for i in range(20_000)]
    spent = []
    for count in (letter_profile, lambda ts: np.array([[t.lower().count(c) for c in LETTERS] for t in ts])):
        start = time.process_time()
        parts = [count(texts[i : i + 64]) for i in range(0, len(texts), 64)]
        spent.append((time.process_time() - start, np.concatenate(parts).sum()))
    assert spent[0][1] == spent[1][1] and spent[0][0] < spent[1][0]
