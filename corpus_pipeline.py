"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every function takes (spark, docs, sf_dir); all but the last return the columns of documents.
Each bounds the Arrow batches of the session (``small_arrow_batches``), since executors keep their Python workers, and
what these have taken, from stage to stage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, decontaminate, lines, minhash, quality
from headway.llm.queries import table, vocabulary
from headway.session import ensure_checkpoint_dir, small_arrow_batches

#: Shared shingles of all shingles of two documents, in percent, from which on they are near copies.
PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones among them, rejects go."""
    small_arrow_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Aligned common blocks go from later documents; documents of which nothing is left go too."""
    small_arrow_batches(spark)
    shortened = lines.dedup_lines(docs, counts=False, keep_emptied=False)
    return shortened.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (likeness ``PERCENT`` or more) stays, the one with the smallest id."""
    small_arrow_batches(spark)
    kept = minhash.near_duplicates(docs, PERCENT).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_arrow_batches(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of what is left."""
    small_arrow_batches(spark)
    coded = bpe.encode_decode(docs, vocabulary("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what lies between them is written beside the checkpoints."""
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        path = os.path.join(folder, str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
