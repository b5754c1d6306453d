"""Corpus pipeline: five stages from raw documents to packed sequences.

    quality rules       rejects documents by weak supervision (operator 5)
    quality classifier  rejects documents a factorisation machine scores low (9)
    near duplicates     keeps one document of each n-gram Jaccard component (10)
    personal data       masks what the bootstrapped extraction finds (8)
    packing             best-fit packs the rest into token sequences (2)

Every stage gets what its predecessor kept, as columns of ``documents`` (and
any further ones), and returns the same columns; the last returns a row per
piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Results
are written to the shared folder between stages. Null texts, empty tables,
repeated rows and null ids have the results the operators define for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelens.llm import factorization, ngram_join, personal_data, quality_rules
from farelens.llm.common import stored, table
from farelens.llm.queries import held_out, packed


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """It learns from the labelled rows of the whole corpus, as the rules have
    taken most bad examples out of ``docs``, and never from held-out labels."""
    everything = table(spark, sf_dir, "documents")
    model = factorization.fit(everything, table(spark, sf_dir, "labels").filter(~held_out()))
    return factorization.keep_good(docs, model)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("near duplicates", duplicates_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]
#: Trained scores and token ids cannot be had in SQL; the tests hold each
#: stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k + 1}")
    return docs
