"""The corpus pipeline: five operators in a row over ``documents``, each stage written as Parquet and read again.

language ID -> quality -> near-duplicates -> personal data -> packing. A stage works on all rows that the stage before kept.
All stages but the last return the columns of their input; the last returns one row for each piece of a packed sequence.

All stages: columns beyond ``doc_id`` and ``text`` may be null and may have any name, those of a stage's own helper columns
included; they pass through. Rows with a null id are judged by their text like others. Texts of any length are read whole. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoweave.llm import langid, minhash, packing, pii, quality
from chronoweave.llm._common import materialize, release


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows, learned from the rows that have a ``lang`` and are not held out.

    A text that is null or has no letter goes; so do all if no row has a ``lang``. Of equally near languages the first by name
    counts. Repeated rows stay or go together.
    """
    return langid.keep_identified(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality, as learned from ``labels``.

    A null, empty or blank text gets the share of good labels, and stays where that is at least the cut; so do all texts if
    labels are of one class or missing. A score of exactly the cut stays. Repeated rows stay or go together.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Texts without words, null ones included, and rows with a null id stay. Repeated rows are copies: one stays, the first by all
    its columns written as JSON. An id with several texts goes only if all of them are copies of others.
    """
    return minhash.drop_near_duplicates(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked, and ``n_chars`` made to fit. No row goes; null and empty texts stay as they are."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences. A null text counts as empty, and an empty one is its end id; every row is packed, repeated ones each."""
    return packing.pack(docs)


STAGES = [("language", language), ("quality", good), ("near_duplicates", distinct), ("personal_data", private), ("packing", packed)]

#: Language models, the field over lines and near-duplicates have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        release(docs)  # only the next stage reads it
        docs = made
    return docs
