"""From raw documents to packed training sequences: the stages and the job that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shielded, table
from tidemark.llm.lines import dedup_lines
from tidemark.llm.mixing import take_words
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import score, train
from tidemark.llm.simhash import keep_one_per_group
from tidemark.session import materialize


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is too low go; the rest stay as they are."""
    model = train(docs, table(spark, sf_dir, "labels"))
    rows, names = shielded(docs, ("doc_id", "text"))
    return score(rows, model).where("selected").select(*names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut out of the texts; documents left without any text go."""
    rows, names = shielded(docs, ("doc_id", "text", "n_chars"))
    cleaned = dedup_lines(rows).where("n_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts within 4 bits stays: the one with the smallest doc_id."""
    return keep_one_per_group(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often and as far as the mix takes it: its leading words in up to two passes."""
    return take_words(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", select_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained weights, tokens and linear programs are no SQL; the tests hold the operators of the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
