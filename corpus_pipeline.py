"""From raw documents to training windows: the corpus operators one after the other.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbtable.llm.decontaminate import remove_benchmark_spans
from plumbtable.llm.minhash import near_duplicates
from plumbtable.llm.packing import pack_documents
from plumbtable.llm.pii import pseudonymise_documents
from plumbtable.llm.quality import fit_quality, keep_good
from plumbtable.session import settle

#: Documents below this quality go.
LEAST_QUALITY = 0.3
#: Percent of shared word shingles from which documents are near copies; op7's contract has a value of its own.
NEAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``LEAST_QUALITY``; the classifier is fitted on all labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(docs, labels, F.lit(True)), LEAST_QUALITY)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; one row where an id is repeated.

    Rows without an id are kept.
    """
    own = {c: f"kept_{k}" for k, c in enumerate(docs.columns)}
    key = own["doc_id"]
    found = near_duplicates(docs, percent=NEAR_PERCENT).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.toDF(*own.values())
    kept = rows.join(found, F.col(key) == F.col("gone"), "left_anti")
    named = kept.where(F.col(key).isNotNull()).dropDuplicates([key])
    return named.unionByName(kept.where(F.col(key).isNull())).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    return remove_benchmark_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses replaced by pseudonyms of their format."""
    return pseudonymise_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows with their ids."""
    return pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Trained weights, signatures and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = settle(rows, f"pipeline-{name}")
    return rows
