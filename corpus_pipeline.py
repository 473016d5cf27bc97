"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of their input; an empty table passes through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskframe.catalog.base import load
from riskframe.llm import bpe, decontaminate, jaccard_join, pii, quality
from riskframe.llm.common import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier, trained on those of this input that have labels, rejects."""
    return quality.keep_good(docs, quality.fit_quality(docs, load(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group linked by shingle similarity."""
    return jaccard_join.keep_one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are contaminated with benchmark text."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks in the text."""
    return pii.mask_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the checksum of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("personal data", without_personal_data),
    ("byte-level BPE", tokens),
]

#: Learned scores, votes and token ids cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
