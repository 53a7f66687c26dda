"""A training-data pipeline over ``documents``: each stage takes what the one before kept.

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows the text wherever a stage changes it.
Each stage is written to the shared checkpoint folder as Parquet and read again, and deletes what the stages before it have
left there besides their results. Repeated rows, nulls, empty texts and empty
tables pass as the operators define; columns besides the five of ``documents`` are kept until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import discard, ship, step, stored, table
from culvert.llm.jaccard import representatives
from culvert.llm.langid import language_id
from culvert.llm.packing import default_tokenizer, packed
from culvert.llm.pii import masked
from culvert.llm.suffix_dedup import without_repeats


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


@step
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; without letters, or ambiguous between languages, they go."""
    ship(spark)
    got, _ = language_id(docs)
    return got.where((F.col("_lang_id.lang") != "und") & ~F.col("_lang_id.ambiguous")).select(*docs.columns)


@step
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by n-gram Jaccard similarity, the one of least doc_id."""
    return representatives(docs)


@step
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur elsewhere too."""
    return _counted(without_repeats(docs))


@step
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets."""
    return _counted(masked(docs))


@step
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in token sequences, mixed by source."""
    return packed(docs, default_tokenizer())


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", repeats),
    ("pii", personal_data),
    ("packing", packing),
]

#: The learned, linked and packed rows cannot be expressed in SQL; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return docs
