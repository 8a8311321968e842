"""The COPY sink: every task sends its batches over a connection of its own."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from time import monotonic

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidehaul.functions.encode import encode_copy_rows, rejected
from tidehaul.functions.typemap import ref
from tidehaul.operators.batching import (
    MAX_PARTITIONS,
    batch_by_position,
    batch_global,
    batch_within_partition,
    co_locate_batches,
    content_hash,
    partition_count,
)
from tidehaul.operators.isolate import LOADED
from tidehaul.operators.ledger import load_summary, running_total, with_totals
from tidehaul.operators.verify import CountMismatch, reconcile_counts
from tidehaul.session import ship_package, written
from tidehaul.sources.parquet import FILE_COL, ROW_COL, source_row_count
from tidehaul.sinks.staged import staged_manifest
from tidehaul.sinks.stream import BatchStream, FileStream, whole_batches
from tidehaul.sinks.targets import LoadPlan, plan_load, resolve

FORMAT = "tidehaul_copy"
FILE_FORMAT = "tidehaul_copy_files"
# Bytes of staged files that a task is given, where nothing else is asked for.
BYTES_IN_TASK = 1 << 28


@dataclass
class TaskTotals(WriterCommitMessage):
    """What a task tells the driver: totals only, whatever the number of its batches."""

    batches: int = 0
    failed_batches: int = 0
    rows: int = 0
    loaded_rows: int = 0


@dataclass
class CopyLoad:
    """A finished load: its plan, its target, where its ledger is, and the seconds that sending took."""

    plan: LoadPlan
    target: object
    seconds: float


class CopyWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.target_name = options["target"]
        self.target_args = json.loads(options["target_secret_args"])
        self.plan = LoadPlan(**json.loads(options["plan"]))
        self.strict = options["strict"] == "true"

    def _target(self):
        return resolve(self.target_name)(**self.target_args)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskTotals:
        return self._send(whole_batches(iterator))

    def _send(self, batches: Iterator[BatchStream | FileStream]) -> TaskTotals:
        totals = TaskTotals()
        task = self._target().open(self.plan)
        try:
            for batch in batches:
                with batch:
                    status = task.send(batch)
                totals.batches += 1
                totals.rows += batch.rows
                if status == LOADED:
                    totals.loaded_rows += batch.rows
                else:
                    totals.failed_batches += 1
        finally:
            task.close()
        return totals

    def commit(self, messages: list[TaskTotals | None]) -> None:
        """Every task is done: let the new table take the target's place."""
        failed = sum(m.failed_batches for m in messages if m)
        if failed and self.strict:
            raise CountMismatch(f"{failed} batches failed, the target was left as it was")
        self._target().publish(self.plan)

    def abort(self, messages: list[TaskTotals | None]) -> None:
        """Nothing is taken back: a run with the same load id goes on from here."""


class FileWriter(CopyWriter):
    """Sends staged files as they are. A row names a file; a task reads the files it was given, one after the other."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskTotals:
        return self._send(
            FileStream(*row)
            for batch in iterator
            for row in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)
        )


class CopySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> CopyWriter:
        return CopyWriter(self.options)


class FileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FILE_FORMAT

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options)


def batches_in_place(
    df: DataFrame, batch_size: int, layout: str | Sequence[str], rows: int, max_connections: int | None
) -> DataFrame:
    """``df`` with a ``__batch`` column, each batch whole in one partition."""
    if layout == "partition":
        parts = batch_within_partition(df, batch_size, part="__part", batch="__no")
        numbered = parts.withColumn("__batch", F.shiftleft(F.col("__part").cast("bigint"), 33) + F.col("__no"))
        numbered = numbered.drop("__part", "__no")
        # Numbered first and put together afterwards, so the batches do not depend on the connections.
        return numbered.coalesce(max_connections) if max_connections else numbered
    if layout == "position":
        numbered = batch_by_position(df, batch_size, batch="__batch")
    else:
        numbered = batch_global(df, layout, batch_size, batch="__batch")
    most = min(max_connections or MAX_PARTITIONS, MAX_PARTITIONS)
    return co_locate_batches(
        numbered, batches=partition_count(rows, batch_size), batch="__batch", max_partitions=most
    )


def _file_facts(df: DataFrame) -> list[Column]:
    """Path, size and time of the file of a row, where ``df`` is a scan or a projection of one."""
    facts = [F.col(f"_metadata.{f}") for f in ("file_path", "file_size", "file_modification_time")]
    try:
        df.select(*facts)
    except AnalysisException:
        return []
    return facts


def how_cut(df: DataFrame, batch_size: int, layout: str | Sequence[str]) -> tuple[int, str]:
    """All rows, and how the batches are cut.

    The text is equal for two runs only if they read the same files (path,
    size, time and row count of each), cut the same way; with keys, the keys'
    values count as well. Where rows do not come from files their values are
    hashed instead. Hashes are added up, so that no pair of rows cancels out.
    The order in which an input without positions gives its rows is not covered.
    """
    facts = _file_facts(df)
    by = [f.alias(f"__fact_{i}") for i, f in enumerate(facts)]
    keys = []
    if layout == "partition":
        by.append(F.spark_partition_id().alias("__piece"))
    elif layout != "position":
        keys = [layout] if isinstance(layout, str) else list(layout)
    wide = "decimal(38,0)"
    values = keys if facts else [c for c in df.columns if c not in (FILE_COL, ROW_COL)]
    hashed = content_hash(df.select(*[ref(c) for c in values])) if values else F.lit(0)
    pieces = df.select(*by, hashed.cast(wide).alias("__hash"), F.lit(1).alias("__one"))
    pieces = pieces.groupBy(*[c for c in pieces.columns if c not in ("__hash", "__one")]).agg(
        F.count("__one").alias("__rows"), F.sum("__hash").alias("__hash")
    )
    each = F.xxhash64(*[ref(c) for c in pieces.columns if c != "__hash"]).cast(wide)
    row = pieces.agg(F.sum("__rows"), F.sum(each), F.sum("__hash")).first()
    rows = row[0] or 0
    hashes = [str(row[1] or 0), str(row[2] or 0)]
    return rows, json.dumps({"layout": layout, "batch_size": batch_size, "rows": rows, "hash": hashes})


def load_copy(
    df: DataFrame,
    target,
    table: str,
    *,
    batch_size: int = 100_000,
    layout: str | Sequence[str] | None = None,
    mode: str = "overwrite",
    null_mode: str = "lossless",
    not_null: Sequence[str] = (),
    check: Column | None = None,
    max_connections: int | None = None,
    load_id: str | None = None,
    strict: bool = False,
    on_start: Callable[[CopyLoad], None] | None = None,
) -> CopyLoad:
    """COPY ``df`` into ``table``, each batch a transaction, all tasks at once.

    ``df`` is a scan, or a projection of one: a task that is started again must
    find the same rows in the same order.

    ``layout`` says what a batch is: ``"partition"`` cuts each scan partition
    by itself and moves no rows; ``"position"`` gives batches of exactly
    ``batch_size`` rows of a source scanned with ``position=True``; a list of
    keys gives them in key order. The last two exchange the rows once and cut
    the same batches on any cluster; scan partitions depend on its size and
    settings. The default is ``"position"`` for a source scanned with
    ``position=True`` and ``"partition"`` for any other.

    A batch with a rejected row, or one the target refuses, is FAILED and the
    load goes on; with ``strict`` it then ends in an error and the target keeps
    its old rows, which only ``overwrite`` can promise, so ``append`` refuses
    it. A load that broke off is continued by its ``load_id``, given the same
    source, ``layout``, ``batch_size`` and ``mode``; if the batches would not
    hold the same rows as before, it refuses. Failed batches of a finished load
    are sent again by ``mode="append"`` with its ``load_id``.

    Each task has a connection of its own: as many at a time as Spark has
    cores, or at most ``max_connections``, whatever the layout; batches then
    share partitions, but they are cut as they would be without.

    ``on_start`` is called with the load before its first batch is sent, for
    instance to follow it by ``copy_progress`` from another thread.
    """
    if strict and mode == "append":
        raise ValueError("strict needs mode='overwrite': batches that are appended cannot be taken back")
    spark = df.sparkSession
    content = [f for f in df.schema.fields if f.name not in (FILE_COL, ROW_COL)]
    schema = type(df.schema)(content)
    names = schema.fieldNames()
    if layout is None:
        layout = "position" if ROW_COL in df.columns else "partition"
    rows, cut = how_cut(df, batch_size, layout)
    plan = plan_load(schema, table, mode, load_id, tuple(not_null), cut)
    batched = batches_in_place(df, batch_size, layout, rows, max_connections)
    refused = rejected(schema, not_null=not_null, check=check)
    lines = encode_copy_rows(
        batched,
        names,
        carry=[F.col("__batch").alias("batch_id"), refused.alias("refused")],
        null_mode=null_mode,
    ).select("batch_id", "line", "refused")
    return _send(spark, lines, plan, target, strict, on_start=on_start)


def copy_staged(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target,
    table: str,
    *,
    files: DataFrame | None = None,
    batches_per_folder: int = 1,
    mode: str = "overwrite",
    not_null: Sequence[str] = (),
    load_id: str | None = None,
    strict: bool = False,
    bytes_in_task: int = BYTES_IN_TASK,
    max_connections: int | None = None,
) -> CopyLoad:
    """COPY the staged files under ``path`` into ``table``, each file a transaction.

    ``files`` is their manifest where there is one already (``file, first_batch,
    rows, bytes``); otherwise the files are read once to make it. Only names are
    dealt out: a task gets files that follow each other, of ``bytes_in_task``
    bytes or one file, opens them itself and sends them in pieces, so no text
    goes through an exchange and none is held whole. At most ``max_connections``
    tasks share the files, if given.

    A file's number in the ledger is the first batch of its folder times 2**20,
    plus its place among the folder's files by name. Load id, mode and
    ``strict`` mean the same as in ``load_copy``; a load is continued only over
    the same files, sizes and rows.
    """
    if strict and mode == "append":
        raise ValueError("strict needs mode='overwrite': batches that are appended cannot be taken back")
    if files is None:
        files = staged_manifest(spark, path, schema, batches_per_folder=batches_per_folder)
    place = F.row_number().over(Window.partitionBy("first_batch").orderBy("file")) - 1
    numbered = files.where("rows > 0").select(
        (F.col("first_batch") * (1 << 20) + place).alias("batch_id"), "file", "rows", "bytes"
    )
    placed = written(
        running_total(numbered, "batch_id", running={"bytes": "upto"}, overall={"bytes": "all_bytes"}), "manifest"
    )
    facts = F.xxhash64("file", "bytes", "rows").cast("decimal(38,0)")
    rows, hashes, count, size = placed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)), F.sum(facts), F.count(F.lit(1)), F.max("all_bytes")
    ).first()
    cut = json.dumps({"staged": path, "rows": rows, "hash": str(hashes)})
    plan = plan_load(schema, table, mode, load_id, tuple(not_null), cut)
    tasks = max(1, min(-(-(size or 0) // bytes_in_task), count, max_connections or count, MAX_PARTITIONS))
    # By the bytes before it a file goes to the task of its share of all bytes.
    task = F.least(F.expr(f"cast((upto - bytes) * {tasks}L div greatest(all_bytes, 1) as int)"), F.lit(tasks - 1))
    names = placed.repartitionById(tasks, task).sortWithinPartitions("batch_id").select("batch_id", "file", "rows")
    return _send(spark, names, plan, target, strict, FILE_FORMAT)


def _send(
    spark: SparkSession,
    rows: DataFrame,
    plan: LoadPlan,
    target,
    strict: bool,
    writer: str = FORMAT,
    on_start: Callable[[CopyLoad], None] | None = None,
) -> CopyLoad:
    started = monotonic()
    ship_package(spark)
    for source in (CopySource, FileSource):
        spark.dataSource.register(source)
    target_name, target_args = target.spec()
    target.begin(plan)
    if on_start is not None:
        on_start(CopyLoad(plan, target, 0.0))
    rows.write.format(writer).mode("append").options(
        target=target_name,
        # The key's name makes Spark hide the value where it prints options.
        target_secret_args=json.dumps(target_args),
        plan=json.dumps(asdict(plan)),
        strict=str(strict).lower(),
    ).save()
    return CopyLoad(plan, target, monotonic() - started)


def copy_ledger(spark: SparkSession, load: CopyLoad, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """``batch_id, rows, status, loaded_rows, percent, message, finished_at`` of a load's batches."""
    return with_totals(load.target.ledger(spark, load.plan, jdbc or {}), "message", "finished_at")


def copy_progress(spark: SparkSession, load: CopyLoad, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """One row, ``batches, failed_batches, loaded_rows, source_rows, percent``, of a load that may still be running.

    What its target has recorded so far, against the rows that were counted
    before it began. ``load`` is what ``on_start`` was given, or the finished load.
    """
    rows = json.loads(load.plan.batches)["rows"]
    so_far = load_summary(load.target.ledger(spark, load.plan, jdbc or {}))
    share = F.round(F.col("loaded_rows") * 100.0 / F.lit(rows), 1) if rows else F.lit(0.0)
    return so_far.select(
        "batches", "failed_batches", "loaded_rows", F.lit(rows).cast("long").alias("source_rows"), share.alias("percent")
    )


def copy_summary(spark: SparkSession, load: CopyLoad, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """One row of totals over the load's batches, with the seconds it took and its rows per second."""
    return load_summary(load.target.ledger(spark, load.plan, jdbc or {}), load.seconds)


def copy_counts(spark: SparkSession, load: CopyLoad, source: DataFrame, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """``source_rows, target_rows, diff, match``: the source against what the target itself counts."""
    schema = type(source.schema)([f for f in source.schema.fields if f.name not in (FILE_COL, ROW_COL)])
    return reconcile_counts(source_row_count(source), load.target.row_count(spark, load.plan, schema, jdbc or {}))
