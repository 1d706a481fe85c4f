"""Every registered query: an operator or job applied to the whole supplied tables.

Results are given in types that compare across engines: dates and times as text, decimals as double,
booleans as text, arrays as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import engaged, sentiment
from tidemark.functions.text import clean_text
from tidemark.operators import gold
from tidemark.operators.approximate import nearest_approximate, recall_rows
from tidemark.operators.contracts import CONTRACTS
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import (
    duplicate_keys,
    live_rows,
    plan_merge,
    plan_upsert,
    plan_versioned,
    reconcile_deletes,
    with_tombstones,
)
from tidemark.operators.metrics import class_report, metrics, roc_auc
from tidemark.operators.models import Featurizer, fit_forest, forest_predictions, scored_texts
from tidemark.operators.neighbors import knn_vote, nearest
from tidemark.operators.quality import POST_RULES, REVIEW_RULES, Action, Rule, check, evaluate, percent
from tidemark.operators.ranges import reconcile_ranges
from tidemark.operators.registry import best_candidate, promote
from tidemark.operators.sequences import sequence_ids, sequence_vocabulary
from tidemark.operators.splits import sample_cap, stratified_split
from tidemark.operators.text_pipeline import TextForest, score
from tidemark.operators.tfidf import fit_vocabulary, term_df, tfidf_weights
from tidemark.plans.cdc_batch import as_changes
from tidemark.plans.delivery import deliver, read_delivered
from tidemark.plans.fixtures import (
    customers_src,
    envelopes,
    labelled_texts,
    order_changes,
    posts_src,
    predictions,
    reviews_src,
    spread,
    table,
)
from tidemark.plans.silver import conform_posts, conform_reviews
from tidemark.session import materialize, scratch_path
from tidemark.sources.audited import audit, write_audited
from tidemark.sources.incremental import extract_since, latest_watermarks, max_watermark
from tidemark.sources.landing import normalize_posts, normalize_reviews
from tidemark.sources.buckets import Buckets
from tidemark.sources.tables import read_batches, replace_batches
from tidemark.streaming.cdc import ORDERS, VERSION, change_stream, read_live, serving_view, start_cdc
from tidemark.streaming.serving import served, start_serving
from tidemark.streaming.envelope import ORDER_CASTS, ORDER_ROW, repair_types, unwrap

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SYNC_SINCE = "1999-01-01 00:00:00"
SERVED_AS_OF = "2001-08-01 00:00:00"
NEIGHBOURS = 11


def portable(df: DataFrame) -> DataFrame:
    def plain(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd")
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        if kind.startswith("decimal"):
            return column.cast("double")
        if kind == "boolean":
            return column.cast("string")
        if kind.startswith("array"):
            return F.concat_ws(" ", column)
        return column

    return df.select(*[plain(name, kind).alias(name) for name, kind in df.dtypes])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(build(spark, folder))
        return build

    return register


# --- landing -------------------------------------------------------------------------------------------


@query("normalize_reviews")
def normalize_reviews_query(spark, folder):
    raw = reviews_src(spark, folder).select(
        F.col("review_id").alias("Id"),
        F.col("product_id").alias("ProductId"),
        F.col("user_id").alias("UserId"),
        F.col("score").cast("bigint").alias("Score"),
        F.unix_seconds(F.col("review_ts").cast("timestamp")).alias("Time"),
        F.col("summary").alias("Summary"),
        F.col("text").alias("Text"),
    )
    return normalize_reviews(raw)


@query("normalize_posts")
def normalize_posts_query(spark, folder):
    raw = posts_src(spark, folder).select(
        F.col("post_id").cast("string").alias("id"),
        "subreddit",
        "author",
        "title",
        "selftext",
        F.col("score").cast("string").alias("score"),
        F.col("num_comments").cast("string").alias("num_comments"),
        F.col("upvote_ratio").cast("string").alias("upvote_ratio"),
        F.unix_seconds(F.col("created_ts").cast("timestamp")).alias("created_utc"),
    )
    return normalize_posts(raw)


@query("batch_ids")
def batch_ids(spark, folder):
    return reviews_src(spark, folder).select("_batch_id").distinct()


@query("bronze_replay")
def bronze_replay(spark, folder):
    """Batches written to a bronze table, then one of them replayed: same table."""
    path = scratch_path(spark, "bronze-replay")
    source = reviews_src(spark, folder)
    replace_batches(source, path)
    replace_batches(source.filter("_batch_id = 'B2'"), path)
    return read_batches(spark, path).select("review_id", "product_id", "score", "review_ts", "text", "_batch_id")


# --- silver --------------------------------------------------------------------------------------------


@query("dedupe_latest")
def dedupe_latest(spark, folder):
    return latest_per_key(reviews_src(spark, folder), ["review_id"], ["_batch_id"]).select(
        "review_id", "score", "summary", "_batch_id"
    )


@query("clean_text_pages")
def clean_text_pages(spark, folder):
    return spread(spark, folder, "pages", "page_id").select("page_id", clean_text("html").alias("html_clean"))


@query("clean_text_docs")
def clean_text_docs(spark, folder):
    return spread(spark, folder, "documents", "doc_id").select("doc_id", clean_text("text").alias("text_clean"))


@query("sentiment_label")
def sentiment_label(spark, folder):
    return reviews_src(spark, folder).select("review_id", "_batch_id", "score", sentiment("score").alias("sentiment_label"))


@query("is_engaged")
def is_engaged(spark, folder):
    return posts_src(spark, folder).select("post_id", engaged("num_comments", "score").alias("is_engaged"))


def _silver_reviews(spark, folder) -> DataFrame:
    return conform_reviews(reviews_src(spark, folder), ["_batch_id"])


def _silver_posts(spark, folder) -> DataFrame:
    return conform_posts(posts_src(spark, folder), ["_batch_id"])


def _gated(spark, rows: DataFrame, rules, name: str) -> DataFrame:
    return audit(write_audited(rows, rules, scratch_path(spark, name)), name, fail_pct=5.0).kept()


@query("silver_reviews")
def silver_reviews(spark, folder):
    return _gated(spark, _silver_reviews(spark, folder), REVIEW_RULES, "silver.reviews")


@query("silver_posts")
def silver_posts(spark, folder):
    return _gated(spark, _silver_posts(spark, folder), POST_RULES, "silver.reddit_posts")


@query("merge_upsert")
def merge_upsert(spark, folder):
    """The first batch as target, the second merged into it."""
    reviews = reviews_src(spark, folder)
    return plan_upsert(reviews.filter("_batch_id = 'B1'"), reviews.filter("_batch_id = 'B2'"), ["review_id"]).select(
        "review_id", "score", "summary", "_batch_id"
    )


# --- quality -------------------------------------------------------------------------------------------

COUNTED_RULES = (
    Rule("pk_not_null", "review_id IS NOT NULL", Action.FAIL),
    Rule("text_present", "length(text) > 0", Action.DROP),
    Rule("score_in_range", "score BETWEEN 1 AND 5", Action.DROP),
    Rule("low_score", "score <= 3", Action.WARN),
    Rule("known_language", "user_id IN ('en', 'de')", Action.WARN),
)


def _result_frame(spark, results) -> DataFrame:
    rows = [(t.rule.name, t.rule.action.value, t.incoming, t.broken, percent(t)) for t in results]
    return spark.createDataFrame(
        rows, "rule string, action string, total_rows bigint, violations bigint, violation_pct double"
    ).withColumn("violation_pct", F.round("violation_pct", 6))


@query("dq_counts")
def dq_counts(spark, folder):
    results, _, _ = evaluate(reviews_src(spark, folder), COUNTED_RULES)
    return _result_frame(spark, results)


@query("dq_warn")
def dq_warn(spark, folder):
    rules = [Rule("score_in_range", "score BETWEEN 1 AND 5", Action.WARN)]
    kept, _ = check(reviews_src(spark, folder), rules, "reviews")
    return kept.select("review_id", "_batch_id", "score")


@query("dq_drop")
def dq_drop(spark, folder):
    rules = [
        Rule("text_present", "score > -1", Action.DROP),
        Rule("score_in_range", "score BETWEEN 1 AND 5", Action.DROP),
    ]
    kept, _ = check(reviews_src(spark, folder), rules, "reviews")
    return kept.select("review_id", "_batch_id", "score")


@query("dq_fail_pct")
def dq_fail_pct(spark, folder):
    """A failing gate over a rule list, counted while the rows are written: what is audited, up to the rule that fails."""
    rules = [
        Rule("score_in_range", "score BETWEEN 1 AND 5", Action.DROP),
        Rule("good_score", "score >= 2", Action.FAIL),
        Rule("never_reached", "review_id > 0", Action.WARN),
    ]
    written = write_audited(reviews_src(spark, folder), rules, scratch_path(spark, "gate"), fail_pct=5.0)
    failing = written.failed.rule.name if written.failed else None
    return _result_frame(spark, written.tallies).withColumn("failed", F.col("rule") == F.lit(failing))


# --- gold ----------------------------------------------------------------------------------------------


@query("reviews_daily")
def reviews_daily(spark, folder):
    return gold.reviews_daily(_silver_reviews(spark, folder))


@query("engagement_daily")
def engagement_daily(spark, folder):
    return gold.engagement_daily(_silver_posts(spark, folder))


def _live_orders(spark, folder) -> DataFrame:
    changes = order_changes(spark, folder)
    last = latest_per_key(changes, ["order_id"], ["ts_ms", "lsn"]).filter("op <> 'd'")
    return last.withColumn("amount", F.col("amount").cast("decimal(12,2)"))


def _orders_enriched(spark, folder) -> DataFrame:
    return gold.orders_enriched(_live_orders(spark, folder), customers_src(spark, folder))


@query("orders_enriched")
def orders_enriched(spark, folder):
    return _orders_enriched(spark, folder)


@query("text_features")
def text_features(spark, folder):
    return gold.text_features(_silver_reviews(spark, folder))


@query("serving_view")
def serving_orders(spark, folder):
    return serving_view(_orders_enriched(spark, folder), SERVED_AS_OF)


# --- change data ---------------------------------------------------------------------------------------


def _typed(changes: DataFrame) -> DataFrame:
    return changes.withColumn("amount", F.col("amount").cast("decimal(12,2)"))


@query("cdc_unwrap")
def cdc_unwrap(spark, folder):
    """Envelopes in both shapes back to change rows."""
    return unwrap(envelopes(order_changes(spark, folder)), ORDER_ROW, ORDER_CASTS)


@query("cdc_typed")
def cdc_typed(spark, folder):
    """Texts that parse and texts that do not: every seventh amount and every eleventh time is broken."""
    changes = order_changes(spark, folder).select(
        "order_id",
        "lsn",
        F.when(F.expr("lsn % 7 = 0"), F.concat(F.lit("n/a "), "amount"))
        .when(F.expr("lsn % 13 = 0"), F.concat(F.lit("9999999999"), "amount"))
        .otherwise(F.col("amount"))
        .alias("amount"),
        F.when(F.expr("lsn % 11 = 0"), "soon")
        .otherwise(F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("updated_at"),
    )
    return repair_types(changes, ORDER_CASTS)


@query("latest_change")
def latest_change(spark, folder):
    return latest_per_key(order_changes(spark, folder), ["order_id"], ["ts_ms", "lsn"])


@query("cdc_merge")
def cdc_merge(spark, folder):
    """State after versioned merges of all creates, then all later changes."""
    changes = _typed(order_changes(spark, folder)).withColumnRenamed("op", "_op")
    step = lambda state, rows: plan_versioned(state, with_tombstones(rows), ["order_id"], ["ts_ms", "lsn"])
    state = materialize(step(None, changes.filter("_op = 'c'")), "state")
    state = step(state, changes.filter("_op <> 'c'"))
    return live_rows(state).select("order_id", "customer_id", "status", "amount", "updated_at")


@query("cdc_merge_deletes")
def cdc_merge_deletes(spark, folder):
    """Clause merge: creates before June 1998 as target; the last later change of every order, early ones without op."""
    columns = ["order_id", "customer_id", "status", "amount"]
    changes = _typed(order_changes(spark, folder))
    target = changes.filter("op = 'c' AND updated_at < '1998-06-01'").select(*columns)
    later = latest_per_key(changes.filter("op <> 'c'"), ["order_id"], ["ts_ms", "lsn"])
    source = later.select(*columns, F.expr("CASE WHEN updated_at >= '1996-01-01' THEN op END").alias("_op"))
    return plan_merge(target, source, ["order_id"])


@query("cdc_extract_since")
def cdc_extract_since(spark, folder):
    return extract_since(table(spark, folder, "orders"), "o_orderdate", SYNC_SINCE).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query("cdc_watermark")
def cdc_watermark(spark, folder):
    return max_watermark(order_changes(spark, folder), "updated_at")


@query("watermark_latest")
def watermark_latest(spark, folder):
    """One sync per event: the event type is the table, its time the sync time, its value the watermark."""
    syncs = table(spark, folder, "events").select(
        F.col("event_type").alias("table"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"),
        F.format_string("%012d", F.col("event_id")).alias("watermark"),
    )
    return latest_watermarks(syncs)


@query("cdc_batch_sync")
def cdc_batch_sync(spark, folder):
    """The table as of the watermark, then everything changed since merged into it."""
    orders = _typed(order_changes(spark, folder))
    columns = ["order_id", "customer_id", "status", "amount", "updated_at"]
    target = orders.filter("op = 'c'").select(*columns)
    source = latest_per_key(orders.filter("op <> 'd'"), ["order_id"], ["ts_ms", "lsn"]).select(*columns)
    incoming = as_changes(extract_since(source, "updated_at", SYNC_SINCE), "updated_at")
    state = as_changes(target, "updated_at").withColumn("_event_ts_ms", F.lit(0).cast("bigint"))
    stored, new = materialize(with_tombstones(state), "state"), materialize(with_tombstones(incoming), "incoming")
    merged = plan_versioned(stored, new, ["order_id"], VERSION)
    return live_rows(merged).select(*columns)


@query("cdc_reconcile")
def cdc_reconcile(spark, folder):
    """Orders the source no longer has become deletes."""
    target = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    return reconcile_deletes(target, _live_orders(spark, folder), ["order_id"])


@query("cdc_reconcile_ranges")
def cdc_reconcile_ranges(spark, folder):
    """Orders that a source which lost whole stretches of keys no longer has, found by digests of key ranges."""
    target = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    source = _live_orders(spark, folder).unionByName(order_changes(spark, folder).filter("op = 'd' AND order_id % 1000 >= 100"), True)
    return reconcile_ranges(target, materialize(source.select("order_id"), "source"), ["order_id"], leaf_rows=100)


@query("cdc_stream")
def cdc_stream(spark, folder):
    """All envelopes as files, drained by the change stream; the live table it leaves behind."""
    inbox, target, checkpoint = (scratch_path(spark, f"stream-{part}") for part in ("inbox", "table", "checkpoint"))
    envelopes(order_changes(spark, folder)).write.text(inbox)
    stream = change_stream(spark, "text", inbox)
    start_cdc(stream, ORDERS, target, checkpoint, once=True).awaitTermination()
    return read_live(spark, target, ORDERS)


@query("serving_stream")
def serving_stream(spark, folder):
    """All versions of the orders as a stream of two batches of files, the second with late ones: what is served in the end."""
    versions = _typed(order_changes(spark, folder)).where("op <> 'd'")
    versions = versions.select("order_id", "customer_id", "status", F.col("amount").cast("double").alias("amount"), "updated_at", "lsn")
    inbox, checkpoint = scratch_path(spark, "serving-inbox"), scratch_path(spark, "serving-checkpoint")
    late = F.pmod(F.xxhash64("lsn"), F.lit(2)) == 0
    versions.where(~late).write.mode("append").parquet(inbox)
    table = Buckets(scratch_path(spark, "serving-table"), ["order_id"], ["updated_at", "lsn"])
    for rows in (None, versions.where(late)):
        if rows is not None:
            rows.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(versions.schema).parquet(inbox)
        start_serving(stream, table, checkpoint, once=True).awaitTermination()
    columns = [F.date_trunc("millisecond", c).alias(c) if c == "updated_at" else F.col(c) for c in versions.columns if c != "lsn"]
    return served(spark, table, SERVED_AS_OF).select(*columns)


# --- delivery ------------------------------------------------------------------------------------------


def _delivered(spark, name: str, before: DataFrame, now: DataFrame) -> DataFrame:
    path = scratch_path(spark, f"deliver-{name}")
    for rows in (before, now):
        deliver(materialize(rows, name), path, CONTRACTS[name])
    return read_delivered(spark, path, CONTRACTS[name])


@query("deliver_reviews_daily")
def deliver_reviews_daily(spark, folder):
    """Metrics of the first batch delivered, then those of the second upserted over them."""
    first, second = (
        gold.reviews_daily(conform_reviews(reviews_src(spark, folder).filter(F.col("_batch_id") == batch), ["_batch_id"]))
        for batch in ("B1", "B2")
    )
    return _delivered(spark, "gold_reviews_daily", first, second)


@query("deliver_engagement")
def deliver_engagement(spark, folder):
    """Metrics of all posts delivered, then those of the engaged posts upserted over them."""
    posts = _silver_posts(spark, folder)
    first, second = gold.engagement_daily(posts), gold.engagement_daily(posts.filter("is_engaged"))
    return _delivered(spark, "gold_subreddit_engagement", first, second)


@query("deliver_orders")
def deliver_orders(spark, folder):
    """Every created order delivered, then the live ones upserted; delivered rows are never deleted."""
    created = _typed(order_changes(spark, folder).filter("op = 'c'"))
    first = gold.orders_enriched(created, customers_src(spark, folder))
    return _delivered(spark, "gold_orders_enriched", first, _orders_enriched(spark, folder))


@query("contract_unique")
def contract_unique(spark, folder):
    """Declared keys that are not unique, on the raw two-batch reviews where there are some."""
    return duplicate_keys(reviews_src(spark, folder), ["review_id"])


# --- features and models -------------------------------------------------------------------------------


@query("sample_cap")
def sample_capped(spark, folder):
    return sample_cap(table(spark, folder, "orders"), 4000, 42, "o_orderkey").select("o_orderkey", "o_custkey")


def _split(spark, folder) -> DataFrame:
    return stratified_split(predictions(spark, folder), "label", seed=42)


@query("split_assign")
def split_assign(spark, folder):
    return _split(spark, folder).select("id", "label", "split")


@query("split_counts")
def split_counts(spark, folder):
    return _split(spark, folder).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def _clean_docs(spark, folder) -> DataFrame:
    docs = spread(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("id"), clean_text("text").alias("text"))
    return materialize(docs, "texts")


@query("term_df")
def term_frequencies(spark, folder):
    return term_df(_clean_docs(spark, folder))


@query("tfidf_weights")
def tfidf(spark, folder):
    docs = _clean_docs(spark, folder)
    weights = tfidf_weights(docs, materialize(fit_vocabulary(docs), "vocabulary"))
    return weights.select("id", "term", F.round("weight", 6).alias("weight"))


def _embeddings(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"), "label")
    return rows.filter("id % 5 = 0"), rows.filter("id % 5 <> 0")


@query("knn_neighbors")
def knn_neighbors(spark, folder):
    asked, known = _embeddings(spark, folder)
    return nearest(asked, known, NEIGHBOURS).withColumn("similarity", F.round("similarity", 6))


@query("knn_recall")
def knn_recall(spark, folder):
    """What the hashed index finds of the exact neighbours: embeddings."""
    asked, known = _embeddings(spark, folder)
    return recall_rows(nearest_approximate(asked, known, NEIGHBOURS), nearest(asked, known, NEIGHBOURS))


@query("knn_text_recall")
def knn_text_recall(spark, folder):
    """What the hashed index finds of the exact neighbours: term vectors, every twentieth document asking."""
    docs = _clean_docs(spark, folder)
    featurizer = Featurizer.fit(docs)
    asked, known = (materialize(featurizer.sparse(docs.filter(side)), "vectors") for side in ("id % 20 = 0", "id % 20 <> 0"))
    return recall_rows(nearest_approximate(asked, known, NEIGHBOURS), nearest(asked, known, NEIGHBOURS))


@query("knn_vote")
def knn_votes(spark, folder):
    asked, known = _embeddings(spark, folder)
    votes = knn_vote(nearest(asked, known, NEIGHBOURS), known)
    return votes.withColumns({"vote": F.round("vote", 6), "proba": F.round("proba", 6)})


@query("metrics_macro")
def metrics_macro(spark, folder):
    return _rounded(metrics(predictions(spark, folder), "label", "pred"))


@query("roc_auc")
def auc(spark, folder):
    return _rounded(roc_auc(predictions(spark, folder), "label", "proba"))


@query("class_report")
def class_metrics(spark, folder):
    return _rounded(class_report(predictions(spark, folder), "label", "pred")).drop("hits")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query("best_candidate")
def candidate(spark, folder):
    """Score thresholds as candidate models: the best by macro F1, the first in order on ties."""
    scored = predictions(spark, folder)
    out = None
    for position, threshold in enumerate((0.3, 0.5, 0.7)):
        judged = scored.withColumn("pred", (F.col("proba") >= threshold).cast("int"))
        named = [F.lit(position).alias("position"), F.lit(threshold).alias("threshold")]
        one = metrics(judged, "label", "pred").select(*named, "f1_macro")
        out = one if out is None else out.unionByName(one)
    return _rounded(best_candidate(out))


@query("promotion")
def promotion(spark, folder):
    """Event types as models, days as versions, the mean event value of a day as its score; models without score and champion added."""
    events = table(spark, folder, "events")
    days = events.groupBy("event_type", F.expr("datediff(cast(ts AS date), DATE '2020-01-01')").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("value")
    )
    run = F.concat_ws("/", "event_type", F.col("day").cast("string"))
    versions = days.select(F.col("event_type").alias("model"), F.col("day").alias("version"), run.alias("run_id"))
    scores = days.select(run.alias("run_id"), F.lit("test_f1_macro").alias("metric"), "value")
    aliases = versions.groupBy("model").agg(F.min("version").alias("version"))
    # Added to what the table holds: per model a newest version without a score under a new name, which has no champion either.
    unscored = aliases.select(F.concat("model", F.lit("-new")).alias("model"), "version", F.concat("model", F.lit("/unscored")).alias("run_id"))
    versions = versions.unionByName(unscored)
    return promote(versions, scores, aliases.withColumn("alias", F.lit("champion")), min_uplift=0.01)


@query("score_projection")
def score_projection(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return scored_texts(predictions(spark, folder).select("id", "pred").join(docs, "id"))


@query("score_stream")
def score_stream(spark, folder):
    """All documents as a stream, labelled by a pipeline that was fitted on the labelled ones, stored and loaded."""
    labelled = labelled_texts(spark, folder).withColumn("text", clean_text("text"))
    stored, inbox, out, checkpoint = (scratch_path(spark, f"scoring-{part}") for part in ("model", "inbox", "out", "checkpoint"))
    TextForest(trees=20, depth=8).fit(labelled).write().save(stored)
    docs = spread(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("id"), clean_text("text").alias("text"))
    docs.write.parquet(inbox)
    stream = spark.readStream.schema(docs.schema).parquet(inbox)
    scored = score(stream, PipelineModel.load(stored)).writeStream.format("parquet").option("path", out)
    scored.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query("seq_ids")
def sequences(spark, folder):
    docs = _clean_docs(spark, folder)
    return sequence_ids(docs, materialize(sequence_vocabulary(docs), "words"))


@query("random_forest")
def forest_scores(spark, folder):
    """Forest on TF-IDF of the training split, applied to the test split."""
    split = materialize(stratified_split(labelled_texts(spark, folder), "label", seed=42, text_col="text"))
    cleaned = split.withColumn("text", clean_text("text"))
    train, test = cleaned.filter("split = 'train'"), cleaned.filter("split = 'test'")
    featurizer = Featurizer.fit(train)
    model = fit_forest(featurizer.features(train, "label"))
    return forest_predictions(model, featurizer.features(test, "label"))
