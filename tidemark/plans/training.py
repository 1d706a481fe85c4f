"""Training: splits, search, evaluation, run records, registration, promotion."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import metrics
from tidemark.operators.models import FOREST_GRID, KNN_GRID, Featurizer, forest_predictions, knn_predictions, scored_texts, search_knn
from tidemark.operators.neighbors import nearest
from tidemark.operators.registry import CHAMPION, best_candidate, promote
from tidemark.operators.splits import read_splits, sample_cap, stratified_split, write_splits
from tidemark.operators.text_pipeline import score, search_forest
from tidemark.session import materialize
from tidemark.settings import Settings
from tidemark.sources.tables import read_or_none, read_table

RUNS_SCHEMA = "run_id string, kind string, name string, value string"
VERSIONS_SCHEMA = "model string, version int, run_id string"
METRICS_SCHEMA = "run_id string, metric string, value double"
ALIASES_SCHEMA = "model string, alias string, version int, set_at timestamp"


def make_splits(spark: SparkSession, settings: Settings) -> None:
    features = read_table(spark, settings.path("gold", "gold_text_features"))
    divided = stratified_split(
        features.select("id", "text", "label"), "label", settings.test_size, settings.val_size, settings.seed, text_col="text"
    )
    # only what is fitted is bounded; validation and test rows stay whole
    fitted = sample_cap(divided.filter("split = 'train'"), settings.sample_rows, settings.seed)
    divided = divided.filter("split <> 'train'").unionByName(fitted)
    write_splits(divided, settings.path("_meta", "ml_splits"))


def _append(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def standard_tags(settings: Settings) -> dict[str, str]:
    return {"project": settings.project, "environment": settings.environment, "dataset": settings.dataset}


def log_run(
    spark: SparkSession,
    settings: Settings,
    run_id: str,
    params: Mapping[str, object],
    measured: Mapping[str, float | None],
    tags: Mapping[str, str],
) -> None:
    """One long record per parameter, metric and tag; undefined metrics are left out."""
    known = {name: value for name, value in measured.items() if value is not None}
    rows = [
        (run_id, kind, name, str(value))
        for kind, entries in (("param", params), ("metric", known), ("tag", tags))
        for name, value in entries.items()
    ]
    _append(spark, rows, RUNS_SCHEMA, settings.path("_meta", "runs"))
    _append(spark, [(run_id, n, float(v)) for n, v in known.items()], METRICS_SCHEMA, settings.path("_meta", "metrics"))


def register_version(spark: SparkSession, settings: Settings, model: str, run_id: str) -> int:
    path = settings.path("_meta", "versions")
    known = read_or_none(spark, path, VERSIONS_SCHEMA)
    last = known.filter(F.col("model") == model).agg(F.max("version")).first()[0] if known is not None else None
    version = (last or 0) + 1
    _append(spark, [(model, version, run_id)], VERSIONS_SCHEMA, path)
    return version


def current_aliases(spark: SparkSession, settings: Settings) -> DataFrame:
    stored = read_or_none(spark, settings.path("_meta", "aliases"), ALIASES_SCHEMA)
    if stored is None:
        return spark.createDataFrame([], "model string, alias string, version int")
    newest = F.max(F.struct("set_at", "version")).alias("newest")
    return stored.groupBy("model", "alias").agg(newest).select("model", "alias", F.col("newest.version").alias("version"))


def run_promotion(spark: SparkSession, settings: Settings, model: str, min_uplift: float = 0.0) -> bool:
    versions = read_or_none(spark, settings.path("_meta", "versions"), VERSIONS_SCHEMA)
    own = versions.filter(F.col("model") == model) if versions is not None else None
    if own is None or own.isEmpty():
        raise LookupError(f"no versions of {model}")
    scores = read_or_none(spark, settings.path("_meta", "metrics"), METRICS_SCHEMA)
    if scores is None:
        scores = spark.createDataFrame([], METRICS_SCHEMA)
    decision = promote(own, scores, current_aliases(spark, settings), min_uplift).first()
    if decision["promoted"]:
        spark.createDataFrame([(model, CHAMPION, decision["challenger"])], "model string, alias string, version int").select(
            "*", F.current_timestamp().alias("set_at")
        ).coalesce(1).write.mode("append").parquet(settings.path("_meta", "aliases"))
    return decision["promoted"]


def _measured(predicted: DataFrame, prefix: str) -> dict[str, float | None]:
    row = metrics(predicted, "label", "pred", "proba").first().asDict()
    return {f"{prefix}_{name}": value for name, value in row.items()}


def train_classical(
    spark: SparkSession,
    settings: Settings,
    model_name: str = "sentiment-classical",
    knn_ks=KNN_GRID,
    forest_grid=FOREST_GRID,
    min_df: int = 3,
) -> tuple[str, int]:
    """Search both models, refit on the training split, measure, register the better one by validation F1."""
    path = settings.path("_meta", "ml_splits")
    train, val, test = (read_splits(spark, path, name).drop("split") for name in ("train", "val", "test"))
    forest = search_forest(train, forest_grid, seed=settings.seed, min_df=min_df)
    searched = {"knn": search_knn(train, knn_ks, seed=settings.seed, min_df=min_df)[0], "random_forest": forest.params}
    featurizer = Featurizer.fit(train, min_df=min_df)
    candidates = []
    for position, (name, params) in enumerate(searched.items()):
        run_id = uuid.uuid4().hex
        measured: dict[str, float | None] = {}
        if name == "random_forest":
            forest.model.write().overwrite().save(settings.path("_models", run_id))
        for part, rows in (("val", val), ("test", test)):
            if name == "random_forest":
                predicted = forest_predictions(forest.model, rows)
            else:
                predicted = _voted(rows, featurizer, train, params["k"]).join(rows.select("id", "label"), "id")
            measured |= _measured(materialize(predicted, "predicted"), part)
        log_run(spark, settings, run_id, {"model": name, **params}, measured, standard_tags(settings))
        candidates.append((position, name, run_id, measured["val_f1_macro"]))
    chosen = best_candidate(
        spark.createDataFrame(candidates, "position int, name string, run_id string, f1_macro double")
    ).first()
    featurizer.vocabulary.write.mode("overwrite").parquet(settings.path("_models", f"{chosen['run_id']}-vocabulary"))
    return chosen["name"], register_version(spark, settings, model_name, chosen["run_id"])


def _voted(rows: DataFrame, featurizer: Featurizer, train: DataFrame, k: int) -> DataFrame:
    return knn_predictions(nearest(featurizer.sparse(rows), featurizer.sparse(train), k), train, k)


def champion_scores(spark: SparkSession, settings: Settings, model: str, docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) labelled by the champion as it was stored.

    A forest's pipeline labels tables and streams. Neighbours are searched among the training split, which is for tables only.
    """
    named = current_aliases(spark, settings).filter((F.col("model") == model) & (F.col("alias") == CHAMPION)).first()
    if named is None:
        raise LookupError(f"no champion of {model}")
    versions = spark.read.schema(VERSIONS_SCHEMA).parquet(settings.path("_meta", "versions"))
    run_id = versions.filter((F.col("model") == model) & (F.col("version") == named["version"])).first()["run_id"]
    runs = spark.read.schema(RUNS_SCHEMA).parquet(settings.path("_meta", "runs"))
    logged = runs.filter((F.col("run_id") == run_id) & (F.col("kind") == "param")).select("name", "value")
    params = dict(map(tuple, logged.collect()))
    if params["model"] == "random_forest":
        return score(docs, PipelineModel.load(settings.path("_models", run_id)))
    if docs.isStreaming:
        raise ValueError(f"{model}: neighbours cannot be searched for a stream")
    vocabulary = spark.read.parquet(settings.path("_models", f"{run_id}-vocabulary"))
    train = read_splits(spark, settings.path("_meta", "ml_splits"), "train").drop("split")
    voted = _voted(docs, Featurizer(vocabulary, vocabulary.count()), train, int(params["k"]))
    return scored_texts(voted.join(docs.select("id", "text"), "id"))
