from tidehaul.sources.parquet import (
    FILE_COL,
    ROW_COL,
    footer_row_count,
    footer_scan,
    footer_statistics,
    row_count,
    scan_source,
    source_row_count,
)

__all__ = [
    "FILE_COL",
    "ROW_COL",
    "footer_row_count",
    "footer_scan",
    "footer_statistics",
    "row_count",
    "scan_source",
    "source_row_count",
]
