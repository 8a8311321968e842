"""Ledger, summary, profile and column reconciliation."""

import pytest
from pyspark.sql import functions as F

from tidehaul.operators import (
    isolate_failed_batches,
    load_ledger,
    load_summary,
    profile_columns,
    reconcile_columns,
    running_total,
)


def test_running_total_over_many_blocks(spark):
    n = 40_000
    df = spark.range(n).select((F.lit(n - 1) - F.col("id")).alias("b"), (F.col("id") % 5).alias("v"), F.lit(1).alias("o"))
    got = running_total(df, "b", running={"v": "sum_v", "o": "sum_o"}, overall={"v": "all_v"}).sort("b").collect()
    total = 0
    for i, row in enumerate(got):
        total += (n - 1 - i) % 5
        assert (row["b"], row["sum_v"], row["sum_o"]) == (i, total, i + 1)
    assert got[0]["all_v"] == total


def test_no_task_sorts_all_batches(spark):
    """Only the sums of whole blocks meet in one task."""
    batches = spark.range(10).selectExpr("id AS batch_id", "id AS rows", "'LOADED' AS status")
    plan = load_ledger(batches)._jdf.queryExecution().executedPlan().toString()
    lone = plan.split("Exchange SinglePartition")
    assert len(lone) == 2
    assert "HashAggregate(keys=[__part" in lone[1].split("\n")[1]


def test_ledger_and_summary(spark):
    df = spark.range(95).withColumn("batch_id", F.expr("id div 10"))
    batches = isolate_failed_batches(df, F.col("id").isin(25, 91))
    ledger = load_ledger(batches).sort("batch_id").collect()
    assert [r["rows"] for r in ledger] == [10] * 9 + [5]
    assert [r["status"] for r in ledger].count("FAILED") == 2
    assert [r["loaded_rows"] for r in ledger] == [10, 20, 20, 30, 40, 50, 60, 70, 80, 80]
    assert [r["percent"] for r in ledger][:2] == [10.5, 21.1] and ledger[-1]["percent"] == 84.2
    summary = load_summary(load_ledger(batches), seconds=4.0).first()
    assert (summary["batches"], summary["failed_batches"], summary["loaded_rows"]) == (10, 2, 80)
    assert (summary["seconds"], summary["rows_per_second"]) == (4.0, 20.0)
    assert load_summary(load_ledger(batches), seconds=0).first()["rows_per_second"] is None


def test_ledger_of_nothing(spark):
    empty = spark.range(0).selectExpr("id AS batch_id", "id AS rows", "'LOADED' AS status")
    assert load_ledger(empty).isEmpty()
    assert tuple(load_summary(load_ledger(empty)).first()) == (0, 0, 0, 0)
    zero = spark.range(1).selectExpr("id AS batch_id", "0L AS rows", "'LOADED' AS status")
    assert load_ledger(zero).first()["percent"] == 0.0


def test_reject_rule_that_is_null_does_not_fail_a_batch(spark):
    df = spark.sql("SELECT id AS batch_id, CAST(NULL AS INT) AS n FROM range(3)")
    assert {r["status"] for r in isolate_failed_batches(df, F.col("n") > 1).collect()} == {"LOADED"}


def test_profile(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, '', 1.5D, array(1)), (2, NULL, double('NaN'), NULL), (3, concat('ab', char(0)), NULL, NULL)
           AS t(id, `a.b`, d, arr)"""
    )
    rows = {r["column_name"]: r for r in profile_columns(df).collect()}
    assert [rows[c]["position"] for c in ("id", "a.b", "d", "arr")] == [1, 2, 3, 4]
    text = rows["a.b"]
    assert [text[m] for m in ("null_count", "empty_count", "max_length", "nul_count", "nan_count")] == [1, 1, 3, 1, 0]
    assert (rows["d"]["null_count"], rows["d"]["nan_count"]) == (1, 1)
    assert (rows["arr"]["null_count"], rows["arr"]["target_type"], rows["arr"]["source_type"]) == (2, "JSONB", "array<int>")
    nothing = profile_columns(df.where("id < 0")).collect()
    assert len(nothing) == 4 and all(r["null_count"] == 0 and r["max_length"] == 0 for r in nothing)


def test_profile_is_one_pass(spark):
    plan = profile_columns(spark.range(10).withColumn("s", F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("status", ["ok", "missing", "extra", "type_diff", "null_diff"])
def test_reconcile_columns(spark, status):
    source = spark.sql("SELECT id, CAST(id AS STRING) AS s FROM range(5)")
    target = {
        "ok": source,
        "missing": source.drop("s"),
        "extra": source,
        "type_diff": source.withColumn("s", F.col("id")),
        "null_diff": source.withColumn("s", F.when(F.col("id") > 1, F.col("s"))),
    }[status]
    if status == "extra":
        source = source.drop("s")
    got = {r["column_name"]: r["status"] for r in reconcile_columns(source, target).collect()}
    assert got == {"id": "ok", "s": status}
