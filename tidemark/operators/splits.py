"""Exact, repeatable sampling and stratified splits without sorting whole classes.

Rows are ordered by a seeded hash. To find the k-th row of a class, the hashes are counted per prefix
bucket, and only the one bucket that holds the k-th row is ranked. What comes out is one cut-off hash per
class; applying it is a comparison on the map side, so wide rows are never shuffled and a class that
holds most of the data is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.labels import seeded_hash
from tidemark.operators.joins import join_checked

# 16**3 buckets per class.
PREFIX_DIGITS = 3
# Sorts after every hexadecimal digit.
AFTER_ALL = "g"


def hash_cuts(
    hashed: DataFrame, group: Sequence[str], ranks: Mapping[str, Column], hash_col: str = "_hash"
) -> DataFrame:
    """Per group, the hash of the row at each wanted rank; NULL where the group is shorter than that.

    ``ranks`` are expressions over the group's row count ``_total``. The hash column should be unique;
    equal hashes stay on one side of a cut.
    """
    bucket = F.substring(hash_col, 1, PREFIX_DIGITS)
    per_bucket = hashed.groupBy(*group, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 4096 rows per group from here on.
    within = Window.partitionBy(*group, F.lit(0))
    counted = per_bucket.select(
        *group,
        "_bucket",
        "_n",
        F.sum("_n").over(within.orderBy("_bucket")).alias("_upto"),
        F.sum("_n").over(within).alias("_total"),
    )
    wanted = F.array(*[F.struct(F.lit(n).alias("cut"), k.cast("bigint").alias("rank")) for n, k in ranks.items()])
    boundary = (
        counted.withColumn("_want", F.explode(wanted))
        .filter("_want.rank > _upto - _n AND _want.rank <= _upto")
        .select(*group, "_bucket", F.col("_want.cut").alias("_cut"), (F.expr("_want.rank - (_upto - _n)")).alias("_need"))
    )
    rows = hashed.select(*group, hash_col, bucket.alias("_bucket"))
    contested = join_checked(rows, boundary, [*group, "_bucket"])
    order = Window.partitionBy(*group, "_bucket", "_cut").orderBy(hash_col)
    found = contested.withColumn("_at", F.row_number().over(order)).filter("_at = _need")
    return found.groupBy(*group).agg(*[F.max(F.when(F.col("_cut") == n, F.col(hash_col))).alias(n) for n in ranks])


def sample_cap(df: DataFrame, cap: int, seed: int, id_col: str = "id") -> DataFrame:
    """Exactly ``cap`` rows (all, when there are fewer); 0 means no cap."""
    if cap <= 0:
        return df
    order = seeded_hash(seed, id_col)
    cuts = hash_cuts(df.select(order.alias("_hash")), [], {"cut": F.lit(cap)})
    return df.filter(order <= F.coalesce(cuts.select("cut").scalar(), F.lit(AFTER_ALL)))


def _rounded_up(count: Column, share: Fraction) -> Column:
    """ceil(count * share) in integers."""
    return F.floor((count * share.numerator + (share.denominator - 1)) / F.lit(share.denominator))


def split_ranks(test_size: float, val_size: float) -> dict[str, Column]:
    """Last rank of the test and of the validation part in a class of ``_total`` rows."""
    test, val = Fraction(str(test_size)), Fraction(str(val_size))
    total = F.col("_total")
    tested = _rounded_up(total, test)
    validated = _rounded_up(total - tested, val / (1 - test))
    return {"_test_cut": tested, "_val_cut": tested + validated}


def stratified_split(
    df: DataFrame,
    label_col: str = "label",
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = 42,
    id_col: str = "id",
    text_col: str | None = None,
) -> DataFrame:
    """Adds ``split``; every class is divided in the same proportions. Rows without label (or text) go."""
    usable = df.dropna(subset=[c for c in (label_col, text_col) if c])
    order = seeded_hash(seed, id_col)
    cuts = hash_cuts(usable.select(label_col, order.alias("_hash")), [label_col], split_ranks(test_size, val_size))
    split = (
        F.when(order <= F.col("_test_cut"), "test")
        .when(order <= F.coalesce("_val_cut", F.lit(AFTER_ALL)), "val")
        .otherwise("train")
    )
    return join_checked(usable, cuts, [label_col]).withColumn("split", split).drop("_test_cut", "_val_cut")


def write_splits(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def read_splits(spark, path: str, split: str | None = None) -> DataFrame:
    """One split reads one folder."""
    splits = spark.read.parquet(path)
    return splits.filter(F.col("split") == split) if split else splits
