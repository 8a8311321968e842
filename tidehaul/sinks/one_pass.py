"""Staging in one pass: tasks write the files and report what they wrote.

Ledger, manifest and counts are made from the reports, so nothing is read again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidehaul.operators.isolate import FAILED, LOADED
from tidehaul.session import ship_package, written
from tidehaul.sinks.staged import RANGE_COL
from tidehaul.sinks.stream import Refused, put_whole, whole_batches

FORMAT = "tidehaul_stage"
# By compression: Arrow's name for it, and the ending by which readers know it.
COMPRESSIONS = {"none": (None, ""), "gzip": ("gzip", ".gz"), "bzip2": ("bz2", ".bz2")}

# One row for each piece of a batch: the rows of it that one task had in a row. Pieces with rejected rows have no file.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
    ]
)


@dataclass
class TaskReport(WriterCommitMessage):
    """What a task tells the driver: totals only. Its pieces are in its own report file."""

    pieces: int = 0
    rows: int = 0


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that Arrow's file systems open; without a scheme it is on Hadoop's default file system."""
    if "://" in path:
        return path.rstrip("/")
    plain = path.removeprefix("file:")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if plain != path or default.startswith("file:"):
        return "file:///" + plain.strip("/")
    return f"{default.rstrip('/')}/{plain.strip('/')}"


class StageWriter(DataSourceArrowWriter):
    """Writes each run of rows of a batch as a file.

    Names follow from the batch, the task's partition and the run's place in it.
    A second attempt at a task finds the same rows in the same order, so it
    replaces what the first one left with the same files.
    """

    def __init__(self, options: Mapping[str, str]):
        self.root, self.reports = options["root"], options["reports"]
        self.batches_per_folder = int(options["batches_per_folder"])
        self.codec, self.ending = COMPRESSIONS[options["compression_kind"]]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskReport:
        fs, root = FileSystem.from_uri(self.root)
        part, reports = TaskContext.get().partitionId(), []
        for run, batch in enumerate(whole_batches(iterator, split=True)):
            folder = f"{RANGE_COL}={batch.batch_id // self.batches_per_folder}"
            name = f"part-{batch.batch_id:020d}-{part:06d}-{run:06d}.csv{self.ending}"
            fs.create_dir(f"{root}/{folder}", recursive=True)
            place, file = f"{root}/{folder}/{name}", f"{self.root}/{folder}/{name}"
            try:
                put_whole(fs, place, batch, self.codec)
                size = fs.get_file_info(place).size
            except Refused:
                batch.drain()
                file, size = None, None
            reports.append(
                {"batch_id": batch.batch_id, "rows": batch.rows, "rejected_rows": batch.rejected, "file": file, "bytes": size}
            )
        if reports:
            fs, place = FileSystem.from_uri(f"{self.reports}/part-{part:06d}.json")
            text = "".join(json.dumps(r) + "\n" for r in reports).encode()
            put_whole(fs, place, pa.BufferReader(text))
        return TaskReport(len(reports), sum(r["rows"] for r in reports))


class StageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> StageWriter:
        return StageWriter(self.options)


def stage_once(
    lines: DataFrame, path: str, *, batches_per_folder: int = 1, compression: str = "none"
) -> DataFrame:
    """Write ``lines`` (batch_id, line, refused) under ``path`` and return what was written, by piece.

    A file holds one batch, or the part of one that a task had. Rows are
    written where they are and go through one pass only. A piece with a refused
    row leaves no file. ``path`` must be new. The result, ``batch_id, rows,
    rejected_rows, file, bytes``, is read from the tasks' reports, which lie
    beside ``path``.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {sorted(COMPRESSIONS)}")
    spark = lines.sparkSession
    root = qualified(spark, path)
    reports = f"{root}__reports"
    for folder in (root, reports):
        fs, place = FileSystem.from_uri(folder)
        if fs.get_file_info(place).type != FileType.NotFound:
            raise FileExistsError(f"{folder} is there already")
        fs.create_dir(place, recursive=True)
    ship_package(spark)
    spark.dataSource.register(StageSource)
    lines.select("batch_id", "line", "refused").write.format(FORMAT).mode("append").options(
        root=root, reports=reports, batches_per_folder=str(batches_per_folder), compression_kind=compression
    ).save()
    return spark.read.schema(REPORT_SCHEMA).json(reports)


def reported_batches(pieces: DataFrame) -> DataFrame:
    """``batch_id, rows, rejected_rows, status`` of the batches that the reported pieces make up."""
    return (
        pieces.groupBy("batch_id")
        .agg(F.sum("rows").alias("rows"), F.sum("rejected_rows").alias("rejected_rows"))
        .withColumn("status", F.when(F.col("rejected_rows") > 0, F.lit(FAILED)).otherwise(F.lit(LOADED)))
    )


def withdraw_failed(pieces: DataFrame, batches: DataFrame) -> None:
    """Remove the files of pieces without rejected rows whose batch has failed by another piece.

    Such a batch lies across tasks, so there are few, and they are removed where
    tasks run. A file that is gone already, by an earlier attempt, is no error.
    """
    failed = batches.where(F.col("status") == FAILED).select("batch_id")
    if failed.isEmpty():
        return
    left = pieces.where("file is not null").join(failed, "batch_id", "left_semi").select("file")

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = 0
        for part in parts:
            for file in part.column("file").to_pylist():
                fs, place = FileSystem.from_uri(file)
                if fs.get_file_info(place).type != FileType.NotFound:
                    fs.delete_file(place)
                    gone += 1
        yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], names=["gone"])

    ship_package(pieces.sparkSession)
    left.mapInArrow(remove, "gone long").agg(F.sum("gone")).first()


def reported_manifest(pieces: DataFrame, batches: DataFrame) -> DataFrame:
    """``file, first_batch, last_batch, rows, bytes`` of the files of loaded batches; each holds rows of one batch."""
    loaded = batches.where(F.col("status") == LOADED).select("batch_id")
    kept = pieces.where("file is not null").join(loaded, "batch_id", "left_semi")
    return kept.select(
        "file", F.col("batch_id").alias("first_batch"), F.col("batch_id").alias("last_batch"), "rows", "bytes"
    )


def reported_row_count(manifest: DataFrame) -> DataFrame:
    """One row, ``target_rows``: the rows that tasks say are in the files of the manifest."""
    return manifest.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("target_rows"))


@dataclass
class StagedBatches:
    """What a pass has left: ledger rows by batch, and the files of loaded batches."""

    batches: DataFrame
    manifest: DataFrame


def stage_batches(
    lines: DataFrame, path: str, *, batches_per_folder: int = 1, compression: str = "none"
) -> StagedBatches:
    """``stage_once``, with the batches it makes up and without the files of failed ones."""
    pieces = stage_once(lines, path, batches_per_folder=batches_per_folder, compression=compression)
    batches = written(reported_batches(pieces), "ledger")
    withdraw_failed(pieces, batches)
    return StagedBatches(batches, reported_manifest(pieces, batches))
