"""The corpus pipeline: stages over ``documents``, each calling one operator.

Each stage gets what the one before kept, reread from Parquet. Quality rules reject documents and cut lines, one document
of each near-duplicate group stays, repeated strings go, personal data is generalised, and the rest is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from smeltery.llm import packing, pii, quality_rules, simhash, suffix_dedup
from smeltery.llm.common import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without lines that are frequent on their host."""
    return quality_rules.apply_quality_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that documents with smaller ids hold."""
    return suffix_dedup.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data generalised and disclosing terms removed."""
    return pii.sanitise(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("personal data", personal_data),
    ("best-fit packing", sequences),
]

#: Fingerprint components, token ids and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
