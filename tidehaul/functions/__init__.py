from tidehaul.functions.encode import encode_copy_rows, read_back, rejected
from tidehaul.functions.statements import copy_statement, create_table_statement, quote_identifier, quote_table
from tidehaul.functions.typemap import (
    TargetColumn,
    is_nested,
    nested_to_json,
    project_to_target,
    target_columns,
    target_type,
)

__all__ = [
    "TargetColumn",
    "copy_statement",
    "create_table_statement",
    "encode_copy_rows",
    "is_nested",
    "nested_to_json",
    "project_to_target",
    "quote_identifier",
    "quote_table",
    "read_back",
    "rejected",
    "target_columns",
    "target_type",
]
