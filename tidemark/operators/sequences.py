"""Texts as id sequences of fixed length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import sequence_tokens

# Vocabulary size (two ids are reserved), sequence length, reserved ids.
VOCABULARY, LENGTH = 30_000, 128
PADDING, UNKNOWN = 0, 1


def sequence_vocabulary(docs: DataFrame, text_col: str = "text", size: int = VOCABULARY) -> DataFrame:
    """(word, word_id): the most frequent words over whole texts; equal counts in reverse word order."""
    counts = docs.select(F.explode(sequence_tokens(text_col)).alias("word")).groupBy("word").count()
    kept = counts.orderBy(F.desc("count"), F.desc("word")).limit(size - 2)
    # size - 2 rows at most, so one ordering task is enough.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), F.desc("word")))
    return kept.select("word", (rank + UNKNOWN).alias("word_id"))


def sequence_ids(
    docs: DataFrame,
    vocabulary: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """(id, ids). The sequence length is the operator's; only those tokens are looked up.

    Hand in a written vocabulary: its known size lets Spark broadcast it.
    """
    # cut before the exchange: it carries the heads, never the texts
    heads = docs.select(F.col(id_col).alias("id"), F.slice(sequence_tokens(text_col), 1, length).alias("words"))
    head = heads.repartition("id").select("id", F.posexplode_outer("words").alias("pos", "word"))
    looked_up = head.join(vocabulary, "word", "left")
    token = F.when(F.col("word").isNotNull(), F.struct("pos", F.coalesce("word_id", F.lit(UNKNOWN)).alias("word_id")))
    rows = looked_up.groupBy("id").agg(F.sort_array(F.collect_list(token)).alias("tokens"))
    padding = F.array_repeat(F.lit(PADDING), F.lit(length) - F.size("tokens"))
    return rows.select("id", F.concat(F.col("tokens.word_id"), padding).alias("ids"))
