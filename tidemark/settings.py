"""Run settings per environment."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# They must equal the published per-environment settings.
FAIL_PCT = {"dev": 5.0, "qa": 2.0, "prod": 1.0}
SHUFFLE_PARTITIONS = {"dev": 8, "qa": 64, "prod": 200}
SAMPLE_ROWS = {"dev": 20_000, "qa": 40_000, "prod": 0}
# Buckets of tables merged by key, for tables written first: a bucket should be a few files.
MERGE_BUCKETS = {"dev": 8, "qa": 64, "prod": 4096}


@dataclass(frozen=True)
class Settings:
    root: str
    environment: str = "dev"
    project: str = "tidemark"
    dataset: str = "reviews"
    fail_pct: float = FAIL_PCT["dev"]
    shuffle_partitions: int = SHUFFLE_PARTITIONS["dev"]
    sample_rows: int = 0  # bound of the rows that are fitted; 0 fits all
    test_size: float = 0.2
    val_size: float = 0.1
    seed: int = 42
    trigger: str = "30 seconds"
    merge_buckets: int = MERGE_BUCKETS["dev"]
    delivered: tuple[str, ...] = field(
        default=("gold_reviews_daily", "gold_subreddit_engagement", "gold_orders_enriched")
    )

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))


def for_environment(root: str, environment: str = "dev", **overrides) -> Settings:
    base = Settings(
        root=root,
        environment=environment,
        fail_pct=FAIL_PCT[environment],
        shuffle_partitions=SHUFFLE_PARTITIONS[environment],
        sample_rows=SAMPLE_ROWS[environment],
        merge_buckets=MERGE_BUCKETS[environment],
    )
    return replace(base, **overrides)
