"""Registered queries of the language-data operators and the SQL that checks them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    checks,
    collocations,
    language,
    maintext,
    mixing,
    near,
    negatives,
    neighbours,
    packing,
    sharding,
    substrings,
    tables,
    tokens,
    topk,
    toxicity,
)

QUERIES = {}
CHECKS = {}


def query(check: str | None = None):
    """Register a query under its function name, with its check in DuckDB SQL if there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if check is not None:
            CHECKS[function.__name__] = check
        return function

    return add


MIX_SEED = 11


@query(checks.mix(MIX_SEED))
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to target weights 1, 2, 3 of the sources, budget: all words."""
    docs = tables.documents(spark, folder)
    quality = mixing.label_quality(tables.read(spark, folder, "labels"))
    mixed = mixing.mix_documents(docs, tables.count_words(F.col("text")), quality, MIX_SEED)
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("size") * F.col("times")).alias("taken"),
        "times",
    )


@query(checks.SUBSTRINGS)
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of 35-word passages that occur anywhere else."""
    return substrings.digest(tables.documents(spark, folder), 35)


@query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole document under the public SentencePiece model."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return tokens.count_tokens(tables.documents(spark, folder), model, limit=4096)


@query()
def op4_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(tables.documents(spark, folder), packing.public_vocabulary("byte_bpe_50k"), 2048)


SHARD_SEED = 5


@query()
def op5_shard_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All documents shuffled into 24 shards whose row counts differ by one at most."""
    docs = tables.documents(spark, folder).select("doc_id", "text")
    sharded = sharding.shard_rows(docs, 24, SHARD_SEED)
    text = F.coalesce("text", F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(checks.TOP_K)
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 largest inner products of every hundredth vector with all others."""
    return topk.exact_top_k(tables.read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query(checks.NEAR)
def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the component of their near copies: three-word shingles, 85 percent in common."""
    return near.near_duplicates(tables.documents(spark, folder), 3, 85)


@query()
def op8_page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every page, from its text, markup, address and host; text model from all documents."""
    return language.identify_languages(tables.read(spark, folder, "pages"), tables.documents(spark, folder))


@query()
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found among all others for every twentieth vector."""
    return neighbours.nearest(tables.read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every whole document, learned from the labels that are not held out."""
    return toxicity.score(tables.documents(spark, folder), tables.read(spark, folder, "labels"))


@query(checks.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every hundredth vector; every seventh label is wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(tables.read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query(checks.COLLOCATIONS)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of two or three words of each language, from all documents."""
    return collocations.collocations(tables.documents(spark, folder))


@query()
def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return maintext.extract_main_text(tables.read(spark, folder, "pages"))
