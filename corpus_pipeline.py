"""Documents to packed training sequences, stage by stage.

Each stage takes the table its predecessor wrote and returns the documents it keeps with
the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradelane.llm import minhash_dedup, packing, quality_classifier, quality_rules, suffix_dedup
from tradelane.llm.common import materialize, read

#: Near copies: Jaccard similarity of five-word shingles, in percent.
NEAR = 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # labellers and scorer are fitted on the whole input: the rules leave them nothing bad to learn from
    return quality_classifier.keep(docs, read(spark, sf_dir, "documents"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.dedup(docs, NEAR)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.clean(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passages),
    ("best_fit_packing", sequences),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
