"""From raw documents to token ids: each stage works on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.

Null and empty texts fail the quality rules and so reach no later stage; the
stages alone take them (null ids stay in near-dedup, texts without words are
not contaminated, have no ids and no personal data). Long texts are read whole,
repeated rows are copies of which one stays, ties go to the smallest id, an
empty table stays empty. Columns of the caller's pass the stages but the last
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plainweave.llm import decontaminate, pieces, pseudonyms, quality, queries, simhash
from plainweave.operators.staging import stage
from plainweave.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and are no outliers."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal numbers and dates."""
    made = pseudonyms.pseudonymise(docs, queries.pseudonym_key(spark))
    return made.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    coded = pieces.encode(docs, queries.tokenizer_path())
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", encoding),
]

# concentration steps, fingerprints and pieces are beyond SQL: tests compare
# the stages with plain versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = step(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs)
    return docs
