"""The corpus pipeline: documents to a mixed training corpus, five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.

- toxicity: texts that the classifier scores 0.5 or more go. It learns from the labels of the
  documents it is given, by the same held-out rule as ``op5_toxicity``.
- near_dedup: one document of each near-duplicate component stays, the one with the smallest id
  (rows without id, and rows that share the kept id, stay).
- decontamination: documents that hold a window of the benchmark go.
- secrets: spans of secrets are replaced by ``[secret]`` and n_chars follows.
- mixing: the documents' placements in the mixed corpus, a row for each epoch that one is
  taken in (``mixing.mix``), its text included.

Nulls, empty and long texts, ties, repeated rows and clashing column names behave as each
operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm import decontaminate, mixing, near_dups, secrets_crf, toxicity_cnn
from cellwatch.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SECRET = "[secret]"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_cnn.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity_cnn.score_texts(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.select(*COLUMNS).join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = secrets_crf.learn_field(docs)
    clean = secrets_crf.find_secrets(docs.select(*COLUMNS), field=field, redact=SECRET)
    n_chars = F.when(F.col("spans") != "", F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixture),
]

#: A convolutional network and a random field have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
