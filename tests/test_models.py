from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pyspark.ml import PipelineModel

from tidemark.operators.models import Featurizer, search_knn, with_folds
from tidemark.operators.registry import best_candidate, promote
from tidemark.operators.text_pipeline import MacroF1, TextForest, TfidfVectorizer, score, search_forest
from tidemark.plans.training import (
    METRICS_SCHEMA,
    RUNS_SCHEMA,
    champion_scores,
    current_aliases,
    log_run,
    make_splits,
    register_version,
    run_promotion,
    train_classical,
)
from tidemark.sources.tables import rebuild

GOOD, BAD, FILLER = ["great", "tasty", "lovely", "fresh"], ["awful", "stale", "bland", "broken"], ["food", "box", "today", "again", "with"]


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        label = i % 2
        picked = rng.choices(GOOD if label else BAD, k=3) + rng.choices(FILLER, k=4)
        rng.shuffle(picked)
        rows.append((i, " ".join(picked), label))
    return spark.createDataFrame(rows, "id int, text string, label int").cache()


def test_searches_find_working_models(reviews):
    knn, forest = search_knn(reviews, (3, 5), folds=2), search_forest(reviews, {"trees": (5,), "depth": (4, 6)}, folds=2)
    assert knn[1] > 0.9 and knn[0]["k"] in (3, 5)
    assert forest.f1_macro > 0.8 and forest.params["trees"] == 5 and forest.params["depth"] in (4, 6)


def test_search_equals_a_loop_over_the_folds(reviews):
    grid = [{"trees": 2, "depth": 1}, {"trees": 5, "depth": 4}]
    folded, means = with_folds(reviews, 2), []
    for params in grid:
        scores = []
        for fold in range(2):
            model = TextForest(**params).fit(folded.filter(F.col("fold") != fold))
            scores.append(MacroF1().evaluate(model.transform(folded.filter(F.col("fold") == fold))))
        means.append(sum(scores) / 2)
    found = search_forest(reviews, {"trees": (2, 5), "depth": (1, 4)}, folds=2)
    assert found.f1_macro >= max(means) - 1e-12
    alone = search_forest(reviews, {"trees": (2,), "depth": (1,)}, folds=2)
    assert alone.f1_macro == pytest.approx(means[0])


def test_macro_f1_is_not_weighted_by_support(spark):
    rows = spark.createDataFrame([(0, 0.0)] * 8 + [(1, 0.0), (1, 1.0)], "label int, prediction double")
    assert MacroF1().evaluate(rows) == pytest.approx((16 / 17 + 2 / 3) / 2)
    assert MacroF1().evaluate(rows.limit(0)) == 0.0


def test_pipeline_vectors_equal_the_shuffled_ones(spark, reviews):
    odd = [(900, "", 0), (901, None, 1), (902, "zzz unheard", 0), (903, "great great great food", 1), (903, "great great great food", 1)]
    docs = reviews.unionByName(spark.createDataFrame(odd, reviews.schema))
    once = docs.dropDuplicates()
    got = TfidfVectorizer(minDF=3).fit(once).transform(docs)
    want = Featurizer.fit(once, min_df=3).features(once)
    wanted = {r["id"]: r["features"] for r in want.collect()}
    rows = got.collect()
    assert len(rows) == 125
    for row in rows:
        other = wanted[row["id"]]
        assert row["features"].size == other.size and list(row["features"].indices) == list(other.indices)
        assert list(row["features"].values) == pytest.approx(list(other.values))


def test_a_loaded_pipeline_scores_tables_and_streams_alike(spark, reviews, tmp_path):
    odd = spark.createDataFrame([(900, "", 0), (901, None, 1), (900, "", 0)], reviews.schema)
    docs = reviews.unionByName(odd).withColumn("text", F.concat("text", F.repeat(F.lit(" great"), 30)))
    folder = str(tmp_path / "docs")
    docs.repartition(4).write.parquet(folder)
    TextForest(trees=5, depth=4).fit(reviews).write().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = score(stream, model).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    plan = score(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    one, two = (sorted(map(tuple, df.collect()), key=repr) for df in (score(docs, model), spark.read.parquet(str(tmp_path / "out"))))
    assert one == two and len(one) == 123


def test_folds_do_not_depend_on_partitioning(reviews):
    one, two = (dict(df.select("id", "fold").collect()) for df in (with_folds(reviews), with_folds(reviews.repartition(5))))
    assert one == two and set(one.values()) == {0, 1, 2}


def test_scoring_projection(reviews):
    model = TextForest(trees=10, depth=6).fit(reviews)
    long = reviews.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 5))
    rows = score(long, model).collect()
    assert len(rows) == 120 and max(len(r["text"]) for r in rows) == 120
    assert {(r["label"], r["sentiment"]) for r in rows} == {(1, "positive"), (0, "negative")}


def test_training_job_end_to_end(spark, settings, reviews):
    rebuild(reviews, settings.path("gold", "gold_text_features"))
    make_splits(spark, settings)
    name, version = train_classical(spark, settings, "m", knn_ks=(3,), forest_grid={"trees": (5,), "depth": (4,)})
    assert name in ("knn", "random_forest") and version == 1
    runs = spark.read.schema(RUNS_SCHEMA).parquet(settings.path("_meta", "runs"))
    assert {r["name"] for r in runs.filter("kind = 'tag'").collect()} == {"project", "environment", "dataset"}
    scores = spark.read.schema(METRICS_SCHEMA).parquet(settings.path("_meta", "metrics"))
    assert {"val_f1_macro", "test_f1_macro", "test_roc_auc"} <= {r["metric"] for r in scores.collect()}
    assert run_promotion(spark, settings, "m")
    assert [tuple(r) for r in current_aliases(spark, settings).collect()] == [("m", "champion", 1)]
    scored = champion_scores(spark, settings, "m", reviews.select("id", "text"))
    truth = dict(reviews.select("id", "label").collect())
    assert sum(truth[r["id"]] == r["label"] for r in scored.collect()) > 96
    with pytest.raises(LookupError):
        champion_scores(spark, settings, "unknown", reviews)


def test_promotion_over_time(spark, settings):
    def publish(run, f1):
        log_run(spark, settings, run, {}, {"test_f1_macro": f1}, {})
        return register_version(spark, settings, "m", run)

    with pytest.raises(LookupError):
        run_promotion(spark, settings, "m")
    assert publish("r1", 0.5) == 1 and run_promotion(spark, settings, "m")
    assert publish("r2", 0.505) == 2 and not run_promotion(spark, settings, "m", min_uplift=0.01)
    assert run_promotion(spark, settings, "m", min_uplift=0.0)


def test_missing_scores_count_as_minus_one(spark):
    versions = spark.createDataFrame([("m", 9, "a"), ("m", 10, "b"), ("n", 1, "c")], "model string, version int, run_id string")
    metrics = spark.createDataFrame([("a", "test_f1_macro", 0.4), ("c", "other", 0.9)], METRICS_SCHEMA)
    aliases = spark.createDataFrame([("m", "champion", 9)], "model string, alias string, version int")
    rows = {r["model"]: r for r in promote(versions, metrics, aliases).collect()}
    assert (rows["m"]["challenger"], rows["m"]["challenger_score"], rows["m"]["promoted"]) == (10, -1.0, False)
    assert (rows["n"]["champion"], rows["n"]["champion_score"], rows["n"]["promoted"]) == (None, -1.0, True)


def test_first_candidate_wins_ties(spark):
    rows = [(2, "c", 0.7), (1, "b", 0.7), (0, "a", 0.6), (3, "d", None)]
    assert best_candidate(spark.createDataFrame(rows, "position int, name string, f1_macro double")).first()["name"] == "b"
