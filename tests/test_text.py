from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.labels import engaged, sentiment
from tidemark.functions.text import clean_text, sequence_tokens, unigrams_and_bigrams, words


def value(spark, column, **fields):
    schema = ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'int'}" for n, v in fields.items())
    return spark.createDataFrame([tuple(fields.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("<b>Great</b> product http://x.co &amp; MORE   spaces", "great product more spaces"),
        (None, ""),
        ("", ""),
        ("it&#39;s <br/>fine", "it&#39;s fine"),
        ("a\n\tb", "a b"),
        ("see https://a.b/c?d=e now", "see now"),
        ("1 < 2 and 3 > 2", "1 2"),
    ],
)
def test_clean_text(spark, raw, expected):
    assert value(spark, clean_text("t"), t=raw) == expected


def test_words_and_pairs(spark):
    tokens = words("t")
    assert value(spark, tokens, t="A déjà-vu x2 _ok b") == ["déjà", "vu", "x2", "_ok"]
    assert value(spark, unigrams_and_bigrams(tokens), t="aa bb cc") == ["aa", "bb", "cc", "aa bb", "bb cc"]
    assert value(spark, unigrams_and_bigrams(tokens), t="aa") == ["aa"]
    assert value(spark, unigrams_and_bigrams(tokens), t="") == []


def test_sequence_tokens(spark):
    assert value(spark, sequence_tokens("t"), t=" It's a [TEST], ok\\ ") == ["its", "a", "test", "ok"]
    assert value(spark, sequence_tokens("t"), t="...") == []


@pytest.mark.parametrize(
    "score, label", [(5, "positive"), (4, "positive"), (3, "neutral"), (2, "negative"), (None, "neutral"), (99, "positive")]
)
def test_sentiment(spark, score, label):
    df = spark.createDataFrame([(score,)], "score int")
    assert df.select(sentiment("score").alias("v")).first()["v"] == label


@pytest.mark.parametrize(
    "comments, score, flag", [(5, 0, True), (0, 20, True), (4, 19, False), (None, 20, True), (None, 1, None), (4, None, None)]
)
def test_engaged_is_three_valued(spark, comments, score, flag):
    df = spark.createDataFrame([(comments, score)], "c int, s int")
    assert df.select(engaged("c", "s").alias("v")).first()["v"] is flag


def test_expressions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "t string").select(clean_text("t"), words("t"), F.length("t"))
    assert "Python" not in df._jdf.queryExecution().toString()
