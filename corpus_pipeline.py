"""A corpus pipeline: from the documents to packed sequences.

Each stage works on all that its predecessor kept and returns the columns of the documents, the last one the
packed pieces.  ``run`` writes every stage as Parquet and reads it again for the next.

Defined results: null and empty texts are kept by all stages and packed as their end id; rows without an id take part as any others;
of equal rows one stays; of near duplicates the one with the smallest id, then hash; very long texts are read whole;
an empty table gives empty stages; other columns come through all stages but the last, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.llm import decontamination, jaccard, packing, secrets, toxicity
from weekcast.llm.common import free_name, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; its labels are those of ``sf_dir``."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "_toxicity")
    return toxicity.score_texts(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles link at a similarity of 0.8 or more."""
    return jaccard.drop_near_duplicates(docs, k=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or edited."""
    row = free_name(docs.columns, "_row")
    rows = jaccard.with_rows(docs, row)
    leaks = decontamination.find_leaks(rows.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = written(leaks.select(F.col("doc_id").alias(row)).distinct(), "leaks")
    return rows.join(leaks, row, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced; ``n_chars`` follows where a text changed."""
    count = free_name(docs.columns, "_n_secrets")
    found = secrets.redact(docs, count=count)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(count) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: No SQL: trained scores, alignments and packing; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
