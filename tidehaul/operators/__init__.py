from tidehaul.operators.batching import (
    batch_by_position,
    batch_global,
    batch_within_partition,
    co_locate_batches,
    is_lopsided,
    partition_count,
    partition_by_weight,
    partition_for_load,
    partition_sizes,
)
from tidehaul.operators.digest import DigestTree, batch_digests, differing_batches, digest_tree
from tidehaul.operators.isolate import FAILED, LOADED, isolate_failed_batches, rows_of_loaded_batches
from tidehaul.operators.ledger import load_ledger, load_summary, running_total
from tidehaul.operators.profile import profile_columns
from tidehaul.operators.verify import CountMismatch, reconcile_columns, reconcile_counts, require_match

__all__ = [
    "FAILED",
    "LOADED",
    "CountMismatch",
    "DigestTree",
    "batch_by_position",
    "batch_digests",
    "batch_global",
    "batch_within_partition",
    "co_locate_batches",
    "differing_batches",
    "digest_tree",
    "is_lopsided",
    "isolate_failed_batches",
    "load_ledger",
    "load_summary",
    "partition_by_weight",
    "partition_count",
    "partition_for_load",
    "partition_sizes",
    "profile_columns",
    "reconcile_columns",
    "reconcile_counts",
    "require_match",
    "rows_of_loaded_batches",
    "running_total",
]
