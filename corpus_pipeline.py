"""A five-stage pipeline over the documents table, each stage one of the data-preparation operators.

Stages take (spark, docs, sf_dir) and return a DataFrame; each result is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import decontaminate, quality_classifier, quality_rules, sentencepiece, simhash
from folioscope.llm.common import shared_folder, table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.keep(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.keep(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, in counts and digests."""
    return sentencepiece.encode_digests(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("sentencepiece", tokens),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what passes between stages lies in the cluster's shared folder.

    A stage's folder is removed once the next one's is written; the last stage
    is read lazily, so the folder that it reads stays.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            if i:
                _remove(spark, f"{folder}/{i - 1}")
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
