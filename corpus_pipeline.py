"""A corpus pipeline of five stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import jaccard, mixing, packing, quality, toxicity
from carelake.session import materialise


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _unused(name: str, docs: DataFrame) -> str:
    """``name``, lengthened until the table has no such column."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below the threshold. Null and empty texts stay; all columns pass.

    Repeated rows stay or go together; texts of any length are scored whole; an empty table gives no rows.
    """
    score = toxicity.score_udf(toxicity.train(docs, _labels(spark, sf_dir)))
    return docs.where(score(F.col("text").cast("string")) < toxicity.THRESHOLD)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the quality classifier. Null and empty texts go; all columns pass.

    Repeated rows stay or go together; texts of any length are judged whole; an empty table gives no rows.
    """
    kept = quality.verdict_udf(*quality.train(docs, _labels(spark, sf_dir)))
    return docs.where(kept(F.col("text").cast("string")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of linked documents; all columns pass.

    It is the first by doc_id (nulls last), text hash and row number; rows that repeat it go like all others of the class.
    Texts without words link with nothing and stay.
    """
    name = _unused("row_number", docs)
    numbered = materialise(docs.withColumn(name, F.monotonically_increasing_id()), "pipeline-numbered")
    classes = jaccard.classes(numbered, name).withColumn("alone", F.when(F.col("class").isNull(), F.col("row")))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "row")
    kept = classes.groupBy("class", "alone").agg(F.min(order).alias("first")).select(F.col("first.row").alias(name))
    return numbered.join(materialise(kept, "pipeline-kept"), name, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; all columns pass. Null texts have no words and are not taken; null is a source.

    Equal rows are taken as often as all of them together; an empty table gives no rows.
    """
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids; null and empty texts are the end id alone.

    Repeated rows are packed each for itself; a text longer than a sequence is cut; an empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Neither the classifiers nor the tokenizer can be put in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
