from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import Action, QualityGateError, Rule, evaluate
from tidemark.sources import audited
from tidemark.sources.audited import gate_batches, publish_gated, read_gated, read_parts, write_audited
from tidemark.sources.tables import path_exists

FIELDS = "a int, b int, c int"
CONDITIONS = ["a >= 2", "b <= 3", "c IN (1, 2)", "a = b", "a < 99", "b + c > 3"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    return spark.createDataFrame([tuple(rng.choice([None, 1, 2, 3, 4]) for _ in range(3)) for _ in range(300)], FIELDS).cache()


def rules_of(actions):
    return [Rule(f"r{i}", condition, action) for i, (condition, action) in enumerate(zip(CONDITIONS, actions))]


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("policy", ["reference", "violation"])
@pytest.mark.parametrize("limit", [512, 0])
def test_counts_equal_those_of_two_reads(rows, tmp_path, monkeypatch, policy, limit):
    monkeypatch.setattr(audited, "OBSERVED", limit)
    mixes = [list(itertools.islice(itertools.cycle(mix), 6)) for mix in ([Action.DROP, Action.WARN], [Action.WARN, Action.DROP, Action.DROP])]
    for i, actions in enumerate(mixes):
        rules = rules_of(actions)
        written = write_audited(rows, rules, str(tmp_path / f"{i}"), 100.0, policy)
        assert (written.tallies, written.active, written.failed) == evaluate(rows, rules, 100.0, policy)
        assert plain(written.kept().unionByName(written.rejected())) == plain(rows)
        for rule in written.active:
            assert written.kept().filter(f"NOT coalesce({rule.condition}, false)").count() == 0
        assert not path_exists(rows.sparkSession, f"{tmp_path}/{i}/_SUCCESS")


def test_the_input_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    counted = spark.range(100).withColumn("a", F.udf(seen, "long")("id"))
    publish_gated(counted, [Rule("small", "a < 90", Action.DROP), Rule("known", "a IS NOT NULL", Action.FAIL)], str(tmp_path / "t"), "t")
    assert read.value == 100 and read_gated(spark, str(tmp_path / "t")).count() == 90


def test_a_failed_gate_leaves_the_old_rows_current(spark, tmp_path):
    path, audits = str(tmp_path / "t"), str(tmp_path / "audit")
    rules = [Rule("sign", "a >= 0", Action.DROP), Rule("known", "b IS NOT NULL", Action.FAIL)]
    good = spark.createDataFrame([(1, 1), (-1, 2), (1, 1), (None, 3)], "a int, b int")
    publish_gated(good, rules, path, "t", audit_path=audits)
    assert plain(read_gated(spark, path)) == [(1, 1), (1, 1)]
    with pytest.raises(QualityGateError, match="50.00%.*known"):
        publish_gated(spark.createDataFrame([(1, None), (2, 2)], "a int, b int"), rules, path, "t", audit_path=audits)
    assert plain(read_gated(spark, path)) == [(1, 1), (1, 1)]
    assert spark.read.parquet(audits).count() == 4
    # a job lost between write and audit
    write_audited(good.limit(1), rules, f"{path}/snapshot-99999999999999999999")
    assert plain(read_gated(spark, path)) == [(1, 1), (1, 1)]


def test_empty_input_and_reserved_name(spark, rows, tmp_path):
    for i, empty in enumerate((rows.limit(0), spark.createDataFrame([], FIELDS))):
        written = write_audited(empty, rules_of([Action.DROP, Action.FAIL]), str(tmp_path / f"{i}"), 0.0)
        assert [(t.incoming, t.broken) for t in written.tallies] == [(0, 0), (0, 0)]
        assert written.kept().count() == written.rejected().count() == 0 and written.failed is None
    with pytest.raises(ValueError):
        write_audited(rows.withColumn(audited.FAILED, F.lit(1)), [], str(tmp_path / "x"))


def test_micro_batches_pass_whole_or_not_at_all(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "t")
    rules = [Rule("sign", "a >= 0", Action.DROP), Rule("known", "b IS NOT NULL", Action.FAIL)]

    def run():
        stream = spark.readStream.schema("a int, b int").option("maxFilesPerTrigger", 1).parquet(inbox)
        query = stream.writeStream.foreachBatch(gate_batches(rules, path, "t")).option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(availableNow=True).start().awaitTermination()

    def land(*landed):
        spark.createDataFrame(landed, "a int, b int").coalesce(1).write.mode("append").parquet(inbox)

    land((1, 1), (-1, 2))
    run()
    land((2, 2), (2, 2))
    run()
    assert plain(read_parts(spark, path)) == [(1, 1), (2, 2), (2, 2)]
    gate_batches(rules, path, "t")(spark.createDataFrame([(1, 1), (-1, 2)], "a int, b int"), 0)
    assert read_parts(spark, path).count() == 3
    land((3, None))
    with pytest.raises(Exception, match="known"):
        run()
    assert read_parts(spark, path).count() == 3
