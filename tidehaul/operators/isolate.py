"""Batches that the target would refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehaul.functions.typemap import ref

LOADED = "LOADED"
FAILED = "FAILED"

# Batch numbers of 8 bytes each that may be sent to every executor.
MAX_BROADCAST_BATCHES = 1_000_000


def isolate_failed_batches(df: DataFrame, reject: Column, *, batch: str = "batch_id") -> DataFrame:
    """``batch_id, rows, rejected_rows, status``: a batch with any rejected row is FAILED.

    One pass; each task sends one partial row per batch it saw.
    """
    refused = F.count(F.when(reject, F.lit(1)))
    return (
        df.groupBy(ref(batch).alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("rows"), refused.alias("rejected_rows"))
        .select(
            "batch_id",
            "rows",
            "rejected_rows",
            F.when(F.col("rejected_rows") > 0, F.lit(FAILED)).otherwise(F.lit(LOADED)).alias("status"),
        )
    )


def rows_of_loaded_batches(
    df: DataFrame,
    batches: DataFrame,
    *,
    batch: str = "batch_id",
    max_broadcast_batches: int = MAX_BROADCAST_BATCHES,
) -> DataFrame:
    """The rows of ``df`` whose batch did not fail.

    ``batches`` should be read from where it is stored, as it is used twice:
    to see whether the failed batches are few enough to broadcast, and in the
    join. Beyond the bound both sides are exchanged on the batch, and a batch
    is at most ``batch_size`` rows, so no key is hot.
    """
    failed = batches.where(F.col("status") == FAILED).select(F.col("batch_id").alias("__failed"))
    n = failed.count()
    if n == 0:
        return df
    side = F.broadcast(failed) if n <= max_broadcast_batches else failed.hint("merge")
    return df.join(side, ref(batch) == F.col("__failed"), "left_anti")
