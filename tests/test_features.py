from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.operators import tfidf
from tidemark.operators.models import Featurizer
from tidemark.operators.sequences import sequence_ids, sequence_vocabulary
from tidemark.operators.text_pipeline import TfidfModel
from tidemark.operators.tfidf import _term_sums, as_features, fit_vocabulary, term_df, tfidf_vectors, tfidf_weights

TEXTS = {1: "red fish blue fish", 2: "red bird", 3: "blue bird red bird", 4: "", 5: "zebra"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id int, text string").repartition(3).cache()


def brute_force(min_df, max_terms=10**6):
    counts = {}
    for i, text in TEXTS.items():
        tokens = text.split()
        counts[i] = Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])
    df = Counter(t for c in counts.values() for t in c)
    total = sum(counts.values(), Counter())
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-total[t], t))[:max_terms]
    out = {}
    for i, c in counts.items():
        raw = {t: (1 + math.log(c[t])) * (math.log((1 + len(TEXTS)) / (1 + df[t])) + 1) for t in kept if c[t]}
        length = math.sqrt(sum(v * v for v in raw.values()))
        out |= {(i, t): v / length for t, v in raw.items()}
    return out


@pytest.mark.parametrize("min_df, max_terms", [(1, 10**6), (2, 10**6), (1, 4)])
def test_weights(docs, min_df, max_terms):
    vocabulary = fit_vocabulary(docs, min_df=min_df, max_terms=max_terms)
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf_weights(docs, vocabulary).collect()}
    assert got == pytest.approx(brute_force(min_df, max_terms))


def test_vectors_keep_empty_documents(docs):
    vocabulary = fit_vocabulary(docs, min_df=2)
    terms = {r["idx"]: r["term"] for r in vocabulary.collect()}
    assert sorted(terms) == list(range(len(terms))) and [terms[i] for i in sorted(terms)] == sorted(terms.values())
    rows = {r["id"]: r for r in tfidf_vectors(docs, vocabulary).collect()}
    assert set(rows) == set(TEXTS) and rows[4]["indices"] == [] and rows[5]["values"] == []
    want = brute_force(2)
    got = {(i, terms[n]): v for i, r in rows.items() for n, v in zip(r["indices"], r["values"])}
    assert got == pytest.approx(want)


def test_ml_vectors(docs):
    featurizer = Featurizer.fit(docs, min_df=2)
    rows = {r["id"]: r["features"] for r in featurizer.features(docs).collect()}
    assert all(v.size == featurizer.size for v in rows.values())
    assert rows[4].numNonzeros() == 0 and rows[1].norm(2) == pytest.approx(1.0)


def test_documents_are_shuffled_once(docs):
    plan = tfidf_weights(docs, fit_vocabulary(docs))._jdf.queryExecution().executedPlan().toString()
    stream = plan[: plan.index("BroadcastExchange")]
    assert stream.count("Exchange hashpartitioning") <= 1


def test_the_vocabulary_is_broadcast_and_texts_go_to_bounded_partitions(spark, docs, monkeypatch):
    monkeypatch.setattr(tfidf, "PARTITION_CHARS", 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weights = tfidf_weights(docs, fit_vocabulary(docs, min_df=1))
        plan = weights._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "REPARTITION_BY_NUM" in plan and ", 5), REP" in plan
        assert {(r["id"], r["term"]): r["weight"] for r in weights.collect()} == pytest.approx(brute_force(1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sequences(spark):
    docs = spark.createDataFrame([(1, "b b a, A! c"), (2, ""), (3, "a x " * 100)], "id int, text string")
    vocabulary = sequence_vocabulary(docs, size=4)
    assert {r["word"]: r["word_id"] for r in vocabulary.collect()} == {"a": 2, "x": 3}
    rows = {r["id"]: r["ids"] for r in sequence_ids(docs, vocabulary, length=6).collect()}
    assert rows == {1: [1, 1, 2, 2, 1, 0], 2: [0] * 6, 3: [2, 3, 2, 3, 2, 3]}


def test_equal_counts_go_in_reverse_word_order(spark):
    docs = spark.createDataFrame([(1, "a b c")], "id int, text string")
    assert [r["word"] for r in sequence_vocabulary(docs).orderBy("word_id").collect()] == ["c", "b", "a"]


def test_terms_are_added_up_before_spark_sees_a_row_of_them(spark, monkeypatch):
    texts = [(1, "ab cd ab cd"), (2, None), (3, ""), (4, "cd"), (5, "ab cd"), (6, "x")]
    docs = spark.createDataFrame(texts, "id int, text string").repartition(1)
    assert "Generate" not in term_df(docs)._jdf.queryExecution().optimizedPlan().toString()
    for words_at_a_time in (1, 3, 1 << 20):
        monkeypatch.setattr("tidemark.operators.tfidf.COUNTED_WORDS", words_at_a_time)
        rows = {r["term"]: (r["df"], r["total"]) for r in term_df(docs, min_df=2).collect()}
        assert rows == {"ab": (2, 3), "cd": (3, 4), "ab cd": (2, 3)}
    many = pa.array([["ab", "cd", "ab"], None, ["cd"]], pa.list_(pa.string()))
    assert {t: (d, n) for t, d, n in zip(*(c.to_pylist() for c in _term_sums(many).columns))} == {
        "ab": (1, 2), "cd": (2, 2), "ab cd": (1, 1), "cd ab": (1, 1),
    }


def test_pipeline_weights_from_words_alone(spark, monkeypatch):
    """Weights of words and pairs, added up by hand; pairs are never made as strings, and pieces do not matter."""
    monkeypatch.setattr("tidemark.operators.tfidf.COUNTED_WORDS", 4)
    terms, idf = ["bb", "aa bb", "aa", "bb aa", "x y z", "cc dd"], [1.5, 2.0, 1.25, 3.0, 9.0, 7.0]
    texts = ["aa bb aa, bb aa", None, "", "zz cc aa zz bb", "dd cc", "cc dd x y z bb bb bb", "é_1 AA  bb", "bb", "zz"]
    rows = [(k, text) for k, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    out = TfidfModel(terms=terms, idf=idf).transform(frame)
    for row in out.collect():
        found = re.findall(r"\w{2,}", (row.text or "").lower())
        counts = Counter(t for t in found + [f"{a} {b}" for a, b in zip(found, found[1:])] if t in terms)
        raw = {terms.index(t): (math.log(n) + 1) * idf[terms.index(t)] for t, n in counts.items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        assert row.features.size == len(terms) and list(row.features.indices) == sorted(raw)
        assert list(row.features.values) == pytest.approx([raw[i] / length for i in sorted(raw)], rel=1e-14)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "zip_with" not in plan and "concat_ws" not in plan
    assert [r.features.size for r in TfidfModel(terms=[], idf=[]).transform(frame).collect()] == [1] * len(texts)


def test_rows_of_one_id_are_one_document_whatever_the_batches(spark, monkeypatch):
    """Pairs don't reach from one row to the next; no row is made for each term."""
    monkeypatch.setattr(tfidf, "COUNTED_WORDS", 3)
    rows = [(1, "red fish"), (2, "red bird blue"), (1, "blue fish red"), (None, "red"), (None, "blue red"), (3, None), (2, "bird"), (4, "zebra")]
    vocabulary = spark.createDataFrame([(t, n, 1, 1.0 + n) for n, t in enumerate(["blue", "fish", "red", "red fish", "fish blue"])], "term string, idx int, df long, idf double")
    vectors = tfidf_vectors(spark.createDataFrame(rows, "id int, text string").coalesce(1), vocabulary)
    assert "HashAggregate" not in vectors._jdf.queryExecution().toString()
    raw = {1: {0: 1.0, 1: 2 * (1 + math.log(2)), 2: 3 * (1 + math.log(2)), 3: 4.0}, 2: {0: 1.0, 2: 3.0}, None: {0: 1.0, 2: 3 * (1 + math.log(2))}, 3: {}, 4: {}}
    got = {r["id"]: dict(zip(r["indices"], r["values"])) for r in vectors.collect()}
    assert set(got) == set(raw)
    for i, terms in raw.items():
        length = math.sqrt(sum(x * x for x in terms.values()))
        assert got[i] == pytest.approx({t: x / length for t, x in terms.items()})
