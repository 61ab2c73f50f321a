"""A corpus pipeline: quality classifier, near-duplicate removal, pseudonyms, mixing to target weights, piece encoding.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqtable.llm import minhash, mixing, pieces, pii, quality_model
from seqtable.llm.queries import SEED, pseudonym_key, tokenizer_path
from seqtable.llm.scratch import discard, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality_model.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five words, similarity 0.8)."""
    return minhash.deduplicated(docs, k=5, percent=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms; every document stays. n_chars follows the text, whose length is unchanged."""
    return pii.pseudonymise(docs, pseudonym_key(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents of each source up to its target; a document that is taken several times stands several times."""
    return mixing.mixed_documents(docs, seed=SEED)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts with merge dropout: doc_id, lang, source, n_chars, piece_ids."""
    return pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model"), dropout=0.1, seed=SEED)


STAGES = [("quality classifier", quality), ("near duplicates", near_duplicates), ("pseudonyms", pseudonyms), ("mixture", mixture), ("piece ids", piece_ids)]

#: A classifier, sketches and merge dropout have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all stages, one after the other, over the documents of ``sf_dir``; a stage's table is deleted once the next is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir))
        if i:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
