"""A corpus pipeline: each stage works on all rows that the one before it kept.

Every stage takes null, empty and very long texts, null and repeated doc_ids, repeated rows, ties, empty tables and further
columns of any name; all but the last return the columns they were given. Rows are decided one by one. What each
operator makes of such rows stands in its docstring: texts without words are never toxic, near copies or
repeats, count nothing in the mix, and are packed as one end token.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import mixing, near, packing, substrings, tables, toxicity

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
PASSAGE_WORDS = 35
MIX_SEED = 11
SEQUENCE_TOKENS = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    return toxicity.reject(docs, tables.read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.drop_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that occur more than once."""
    return substrings.remove_repeats(docs, PASSAGE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    quality = mixing.label_quality(tables.read(spark, sf_dir, "labels"))
    return mixing.mixed_corpus(docs, tables.count_words(F.col("text")), quality, MIX_SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, packing.public_vocabulary("byte_bpe_50k"), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classification, sketches and tokenizers are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = tables.materialise(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
CHECKS = {}
