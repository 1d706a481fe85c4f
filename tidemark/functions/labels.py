"""Business labels and the repeatable row order used for sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds of the published label definitions.
POSITIVE_FROM, NEGATIVE_UPTO = 4, 2
ENGAGED_COMMENTS, ENGAGED_SCORE = 5, 20
SCORED_TEXT_LENGTH = 120


def sentiment(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    bucket = F.when(score >= POSITIVE_FROM, "positive").when(score <= NEGATIVE_UPTO, "negative")
    return F.coalesce(bucket, F.lit("neutral"))


def engaged(comments: Column | str, score: Column | str) -> Column:
    """Three-valued: NULL when neither side decides."""
    comments = F.col(comments) if isinstance(comments, str) else comments
    score = F.col(score) if isinstance(score, str) else score
    return (comments >= ENGAGED_COMMENTS) | (score >= ENGAGED_SCORE)


def seeded_hash(seed: int, *ids: Column | str) -> Column:
    """A uniform, partitioning-independent order key: md5 of ``seed-id``."""
    parts = [(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *parts))
