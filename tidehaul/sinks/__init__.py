from tidehaul.sinks.catalog import TargetCatalog
from tidehaul.sinks.copy_load import CopyLoad, copy_counts, copy_ledger, copy_progress, copy_staged, copy_summary, load_copy
from tidehaul.sinks.jdbc import jdbc_columns, jdbc_row_count, load_jdbc
from tidehaul.sinks.jdbc_load import JdbcLoad, jdbc_ledger, load_jdbc_batches
from tidehaul.sinks.one_pass import reported_batches, reported_manifest, stage_batches, stage_once
from tidehaul.sinks.staged import read_staged, stage_copy_files, staged_manifest, staged_records, target_row_count
from tidehaul.sinks.targets import FolderTarget, PostgresTarget

__all__ = [
    "CopyLoad",
    "FolderTarget",
    "JdbcLoad",
    "PostgresTarget",
    "TargetCatalog",
    "copy_counts",
    "copy_ledger",
    "copy_progress",
    "copy_staged",
    "copy_summary",
    "jdbc_columns",
    "jdbc_ledger",
    "jdbc_row_count",
    "load_copy",
    "load_jdbc",
    "load_jdbc_batches",
    "read_staged",
    "reported_batches",
    "reported_manifest",
    "stage_batches",
    "stage_copy_files",
    "stage_once",
    "staged_manifest",
    "staged_records",
    "target_row_count",
]
