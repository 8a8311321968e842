"""A whole staged load: scan, batch, check, encode and stage in one pass, verify, send."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from time import monotonic

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidehaul.functions.encode import encode_copy_rows, rejected
from tidehaul.functions.statements import copy_statement, create_table_statement
from tidehaul.functions.typemap import ref
from tidehaul.operators.batching import (
    batch_by_position,
    batch_global,
    co_locate_batches,
    is_lopsided,
    partition_count,
)
from tidehaul.operators.ledger import load_ledger, load_summary
from tidehaul.operators.verify import reconcile_counts, require_match
from tidehaul.session import scratch_path
from tidehaul.sinks.copy_load import CopyLoad, copy_staged
from tidehaul.sinks.one_pass import reported_row_count, stage_batches
from tidehaul.sinks.staged import target_row_count
from tidehaul.sources.parquet import FILE_COL, ROW_COL, footer_row_count, row_count, scan_source

# Fixed value: rows per COPY batch where the caller names none.
DEFAULT_BATCH_SIZE = 100_000


@dataclass
class StagedLoad:
    """What a load leaves behind. The DataFrames are read from storage when used.

    ``sent`` is the load of the staged files into a target, where one was given.
    """

    path: str
    schema: T.StructType
    create_table: str
    copy_into: str
    ledger: DataFrame
    summary: DataFrame
    counts: DataFrame
    manifest: DataFrame
    sent: CopyLoad | None = None


def encoded_batches(
    scanned: DataFrame,
    schema: T.StructType,
    keys: str | Sequence[str] | None,
    batch_size: int,
    refused: Column,
    null_mode: str,
    rows_per_range: int,
) -> DataFrame:
    """``batch_id, refused, line`` of a source scanned with positions, the rows of a batch side by side."""
    if keys is not None:
        batched = batch_global(scanned, keys, batch_size, batch="__batch", rows_per_range=rows_per_range)
    else:
        batched = batch_by_position(scanned, batch_size, batch="__batch")
        # Encoding and writing follow the scan's partitions unless one of them would do most of the work.
        plain = scanned.select(*schema.fieldNames())
        if is_lopsided(plain, batch_size):
            expected = partition_count(row_count(plain), batch_size)
            batched = co_locate_batches(batched, batches=expected, batch="__batch")
    carry = [ref("__batch").alias("batch_id"), refused.alias("refused")]
    return encode_copy_rows(batched, schema.fieldNames(), carry=carry, null_mode=null_mode)


def bulk_load(
    spark: SparkSession,
    source: str,
    table: str,
    *,
    path: str | None = None,
    keys: str | Sequence[str] | None = None,
    batch_size: int = DEFAULT_BATCH_SIZE,
    null_mode: str = "lossless",
    not_null: Sequence[str] = (),
    check: Column | None = None,
    compression: str = "none",
    batches_per_folder: int = 1,
    strict: bool = False,
    rows_per_range: int = 1_000_000,
    verify: str = "reports",
    target=None,
    load_id: str | None = None,
    mode: str = "overwrite",
) -> StagedLoad:
    """Load the Parquet ``source`` into staged COPY files for ``table``, and on into ``target``.

    The source's columns are read once, and its rows are written once: the tasks
    that write the files report the rows, rejected rows and bytes of each, and
    ledger, manifest and counts are made from that. Batches follow the order of
    the source, or of ``keys`` where given. Batches with rejected rows leave no
    files and show as FAILED in the ledger; ``strict`` makes any difference
    between source and files an error. The source's rows are counted on their
    own, from its footers; ``verify="files"`` counts the records in the staged
    files as well, instead of going by the reports.

    With a ``target`` the files are then sent to it, each as a transaction under
    ``load_id``. Without one, the statements for them come with the result.
    Nothing is dropped before the files stand.
    """
    if verify not in ("reports", "files"):
        raise ValueError("verify must be 'reports' or 'files'")
    started = monotonic()
    path = path or scratch_path(spark, "staged")
    scanned = scan_source(spark, source, position=True)
    schema = T.StructType([f for f in scanned.schema.fields if f.name not in (FILE_COL, ROW_COL)])
    refused = rejected(schema, not_null=not_null, check=check)
    lines = encoded_batches(scanned, schema, keys, batch_size, refused, null_mode, rows_per_range)
    staged = stage_batches(lines, path, batches_per_folder=batches_per_folder, compression=compression)
    found = reported_row_count(staged.manifest) if verify == "reports" else target_row_count(spark, path, schema)
    counts = reconcile_counts(footer_row_count(spark, source), found)
    if strict:
        require_match(counts)
    sent = None
    if target is not None:
        sent = copy_staged(
            spark, path, schema, target, table,
            files=staged.manifest, mode=mode, not_null=not_null, load_id=load_id, strict=strict and mode == "overwrite",
        )
    ledger = load_ledger(staged.batches)
    return StagedLoad(
        path=path,
        schema=schema,
        create_table=create_table_statement(schema, table, not_null),
        copy_into=copy_statement(schema, table),
        ledger=ledger,
        summary=load_summary(ledger, monotonic() - started),
        counts=counts,
        manifest=staged.manifest,
        sent=sent,
    )
