"""The pipeline stage by stage, and the registered queries."""

import os
import random
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402
import corpus_pipeline  # noqa: E402
from carelake.llm import jaccard, mixing, queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_five_stages_and_eleven_queries():
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "n-gram Jaccard join", "mixing", "packing"]
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] > kept[3]
    classes = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert all(a == b for a, b in classes.items())
    times = {r.doc_id: r.times for r in mixing.mix(docs).collect()}
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: t for d, t in times.items() if t}
    pieces = corpus_pipeline.run(spark, SF).collect()
    starts = {}
    for p in pieces:
        starts[p.doc_id] = starts.get(p.doc_id, 0) + (p.start == 0)
    assert starts == {d: t for d, t in times.items() if t}


def test_stages_on_edge_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = cases.edge_rows() + [(50 + i, cases.prose(rng, 40), "en", "a", 1) for i in range(30)]
    spark.createDataFrame([(4, 1, 0), (-3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = cases.documents(spark, rows, clashing=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert out.select("doc_id", "text").subtract(docs.select("doc_id", "text")).count() == 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).count() >= len(rows)


def test_near_copy_stage_keeps_one_of_each_class(spark):
    rows = cases.edge_rows()
    docs = cases.documents(spark, rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    classes = jaccard.near_duplicates(docs).where("n_shingles > 0 and component_id is not null").select("component_id").distinct().count()
    unworded = sum(not cases.words(r[1]) for r in rows)
    nameless = 1  # the class whose only row has no id
    assert len(kept) == classes + unworded + nameless
    assert (5, rows[6][1]) in {(r.doc_id, r.text) for r in kept}


def test_mixing_stage_merges_equal_rows(spark):
    rows = [(1, "a b c", "en", "s", 1)] * 3 + [(2, "d e f", "en", "s", 1), (3, "g h i", "en", "t", 1)]
    docs = cases.documents(spark, rows)
    taken = mixing.mix(docs).agg(F.sum("times")).first()[0]
    assert corpus_pipeline.mix_sources(spark, docs, SF).count() == taken


def test_toxic_rows_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    predicted = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - predicted


def test_near_copy_stage_drops_repeated_and_nameless_rows(spark):
    rng = random.Random(2)
    one, other, alone, nameless = (cases.prose(rng, 200) for _ in range(4))
    near = [cases.edited(rng, nameless, 1) for _ in range(3)]
    rows = [(7, one, "en", "a", 1)] * 20 + [(7, one, "en", "b", 2), (9, one, "en", "a", 1), (None, one, "en", "a", 1)]
    rows += [(None, other, "en", "a", 1)] * 5 + [(None, t, "en", "a", 1) for t in (nameless, *near)] + [(3, alone, "en", "a", 1)]
    rows += [(2, "", "en", "a", 0)] * 2
    docs = cases.documents(spark, rows).repartition(4)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(k for k in kept if k[0] is not None) == [(2, ""), (2, ""), (3, alone), (7, one)]
    texts = [t for i, t in kept if i is None]
    assert len(texts) == 2 and other in texts and set(texts) - {other} <= {nameless, *near}
