"""COPY files staged on shared storage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehaul.functions.encode import read_back
from tidehaul.functions.statements import null_text
from tidehaul.functions.typemap import ref, whole_div
from tidehaul.session import ship_package

RANGE_COL = "batch_range"

# How Spark reads the line format. The text standing for NULL is one that no
# staged field can be, so an unquoted empty field is NULL and "" is empty; in a
# table of one column it is the text that the lines have for NULL.
READ_OPTIONS = {
    "header": "false",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "multiLine": "true",
    "emptyValue": "",
    "nullValue": "\u0000",
    "mode": "FAILFAST",
}


def stage_copy_files(
    lines: DataFrame,
    path: str,
    *,
    batch: str = "batch_id",
    line: str = "line",
    batches_per_folder: int = 1,
    compression: str = "none",
    mode: str = "errorifexists",
) -> None:
    """Write ``line`` as text under ``path``, one folder per range of batches.

    Every task writes the rows it has; they are not shuffled. A file never
    holds rows of two ranges, so with the default of one batch per folder a
    file can be sent to the target as a transaction of its own.
    """
    (
        lines.select(whole_div(batch, batches_per_folder).alias(RANGE_COL), ref(line).alias("value"))
        .write.partitionBy(RANGE_COL)
        .option("compression", compression)
        .mode(mode)
        .text(path)
    )


def _read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    names = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    # Only files that hold whole batches lie here; each is one task.
    return (
        spark.read.schema(T.StructType(names))
        .options(**{**READ_OPTIONS, **({"nullValue": null_text(1)} if len(names) == 1 else {})})
        .option("recursiveFileLookup", "true")
        .csv(path)
    )


def read_staged(
    spark: SparkSession, path: str | list[str], schema: T.StructType, also: Sequence[Column] = ()
) -> DataFrame:
    """The staged rows as values of the source ``schema``, and ``also`` columns such as of the file's name."""
    return read_back(_read_lines(spark, path, schema), schema, also)


def _fold_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a file: the records that end in it, should it begin outside of quotes, or inside; and whether it turns one to the other."""
    blocks: dict[tuple, list[int]] = {}
    for batch in batches:
        files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
        odd = batch.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
        codes = files.indices.to_numpy()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, len(codes)], strict=True):
            if low < high:
                held = blocks.setdefault((files.dictionary[codes[low]].as_py(), int(starts[low])), [0, 0, 0])
                # Lines after which the quotes seen so far are even in number, the block's own earlier ones included.
                inside = (held[2] + np.cumsum(odd[low:high])) % 2
                held[0] += int((inside == 0).sum())
                held[1] += int((inside == 1).sum())
                held[2] = int(inside[-1])
    rows = [(f, s, *counts) for (f, s), counts in blocks.items()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _BLOCKS, strict=True)], schema=_BLOCKS
    )


_BLOCKS = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64()), ("turns", pa.int64())]
)


def staged_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, rows``: the records in each file, counted block by block.

    A record may go over several lines, inside quotes, so whether a line ends
    one depends on all quotes before it. Files are read in the blocks that Spark
    cuts them to, wherever those begin. Each gives its count for either case and
    whether it has an odd number of quotes; put in order, these say which case
    holds for each block. One row per block is exchanged, and no text leaves
    the task that reads it.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    quotes = F.expr("length(value) - length(replace(value, '\"', ''))")
    odd = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (quotes % 2 == 1).alias("odd"),
    )
    blocks = odd.mapInArrow(_fold_lines, "file string, start long, outside long, inside long, turns long")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins_inside = F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2 == 1
    ended = blocks.select("file", F.when(begins_inside, F.col("inside")).otherwise(F.col("outside")).alias("rows"))
    return ended.groupBy("file").agg(F.sum("rows").alias("rows"))


def target_row_count(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One row, ``target_rows``: the records in the staged files. Lines are counted, so their ``schema`` is not looked at."""
    return staged_records(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("target_rows"))


def staged_manifest(
    spark: SparkSession, path: str, schema: T.StructType, *, batches_per_folder: int = 1
) -> DataFrame:
    """One row per staged file: ``file, first_batch, last_batch, rows, bytes``.

    Rows are counted in the files themselves, so the manifest tells what is on
    storage. ``last_batch`` is the last one that the folder may hold.
    """
    sizes = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    )
    folder = F.regexp_extract("file", RANGE_COL + r"=(\d+)/", 1).cast("bigint")
    return (
        sizes.join(staged_records(spark, path), "file", "left")
        .withColumn("__range", folder)
        .select(
            "file",
            (F.col("__range") * batches_per_folder).alias("first_batch"),
            ((F.col("__range") + 1) * batches_per_folder - 1).alias("last_batch"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            "bytes",
        )
    )
