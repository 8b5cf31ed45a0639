"""Documents to packed training sequences: quality rules, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.

Defined cases, stage by stage. Quality rules: a null or empty text has too few words and goes; null
languages and sources are groups. Near copies: of rows that are equal, or share an id and a group, one
stays; a group of rows without ids keeps one. Personal data: null text stays null. Packing: null or empty
text is its end mark alone. Very long texts are whole in every stage, and no rows give no rows. Columns
beside those of documents, whatever their names and types, stay up to packing, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowlit.llm import nearcopies, packing, pii, quality
from snowlit.llm.common import stored
from snowlit.llm.tokens import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    return nearcopies.drop_near_copies(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    masked = pii.mask(docs, pii.train(pii.label_by_patterns(docs)))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("near copies", keep_one_of_near_copies),
    ("personal data", mask_pii),
    ("packing", pack),
]

# Fingerprints, the random field and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
