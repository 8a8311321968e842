"""The load ledger: one row per batch, with running totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidehaul.functions.typemap import ref
from tidehaul.operators.isolate import FAILED, LOADED
from tidehaul.session import written


def running_total(
    df: DataFrame, order: str, *, running: Mapping[str, str], overall: Mapping[str, str]
) -> DataFrame:
    """Running sums by ``order``, and sums over all rows.

    ``running`` and ``overall`` map a column to the name of its sum. Rows are
    dealt out by ranges of ``order``, whatever gaps it has, and added up within
    them; only the sums of the ranges, one row for each, meet in one task.
    """
    values = sorted({*running, *overall})
    parted = written(df.repartitionByRange(ref(order)).select("*", F.spark_partition_id().alias("__part")), "in-order")
    sums = parted.groupBy("__part").agg(*[F.sum(ref(v)).alias(v) for v in values])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = sums.select(
        "__part",
        *[F.coalesce(F.sum(ref(v)).over(before), F.lit(0)).alias(f"__before_{i}") for i, v in enumerate(running)],
        *[F.sum(ref(v)).over(everything).alias(name) for v, name in overall.items()],
    )
    upto = Window.partitionBy("__part").orderBy(ref(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = parted.select("*", *[F.sum(ref(v)).over(upto).alias(f"__within_{i}") for i, v in enumerate(running)])
    return inside.join(totals, "__part").select(
        *[ref(c) for c in df.columns],
        *[(F.col(f"__before_{i}") + F.col(f"__within_{i}")).alias(name) for i, name in enumerate(running.values())],
        *overall.values(),
    )


def with_totals(batches: DataFrame, *carried: str) -> DataFrame:
    """``batch_id, rows, status, loaded_rows, percent`` and the ``carried`` columns."""
    marked = batches.select(
        "batch_id",
        "rows",
        "status",
        *carried,
        F.when(F.col("status") == LOADED, F.col("rows")).otherwise(F.lit(0)).alias("__ok"),
    )
    counted = running_total(marked, "batch_id", running={"__ok": "loaded_rows"}, overall={"rows": "__all_rows"})
    share = F.when(F.col("__all_rows") > 0, F.col("loaded_rows") * 100.0 / F.col("__all_rows")).otherwise(F.lit(0.0))
    return counted.select("batch_id", "rows", "status", "loaded_rows", F.round(share, 1).alias("percent"), *carried)


def load_ledger(batches: DataFrame) -> DataFrame:
    """``batch_id, rows, status, loaded_rows, percent`` from ``batch_id, rows, status``.

    ``loaded_rows`` is the running total over committed batches, ``percent`` its
    share of all source rows (0 for an empty source).
    """
    return with_totals(batches)


def load_summary(ledger: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row of totals. With ``seconds`` also the time and rows per second, NULL when no time passed."""
    ok = F.col("status") == LOADED
    totals = ledger.agg(
        F.count(F.lit(1)).alias("batches"),
        F.count(F.when(F.col("status") == FAILED, F.lit(1))).alias("failed_batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("loaded_rows"),
    )
    if seconds is None:
        return totals
    rate = F.col("loaded_rows") / F.lit(seconds) if seconds > 0 else F.lit(None).cast("double")
    return totals.select("*", F.lit(float(seconds)).alias("seconds"), rate.alias("rows_per_second"))
