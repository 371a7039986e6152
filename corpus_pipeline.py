"""A training corpus from raw documents: the stages in order, each writing what the next one reads.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``. Each defines what it does with missing texts, ties
and repeated rows where its operator does; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazgrid.llm import bpe, linededup, mixing, quality, simhash
from hazgrid.llm.common import DOCUMENT_COLUMNS, stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def sound_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are better than the lowest grade more likely than not."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return quality.selected(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that came before; one of which nothing is left goes. ``n_chars`` follows the text."""
    cut = linededup.without_repeats(docs.select(*DOCUMENT_COLUMNS))
    left = cut.filter("n_removed = 0 OR text <> ''")
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*DOCUMENT_COLUMNS)


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.first_of_each_group(docs.select(*DOCUMENT_COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights."""
    return mixing.sample(docs.select(*DOCUMENT_COLUMNS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids (packed, see ``bpe``), their number, and whether they decode to its text.

    Ids are stored before they are decoded: in one plan a task would hold a worker that encodes
    beside one that decodes, and as workers change places each would come to hold the memory of both.
    """
    ids = stored(bpe.encoded(docs.select("doc_id", "lang", "source", "text"), TOKENIZER), "pipeline-ids")
    both = bpe.decoded(ids, TOKENIZER)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return both.select("doc_id", "lang", "source", bpe.n_tokens().alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", sound_documents),
    ("line dedup", first_passages),
    ("simhash near-dedup", first_of_near_copies),
    ("mixing to target weights", mixed),
    ("bpe encoding", token_ids),
]

#: A trained classifier and BPE are beyond SQL; a test holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
