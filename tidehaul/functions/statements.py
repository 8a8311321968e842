"""Text of the statements a load sends to its target."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from tidehaul.functions.typemap import target_columns

# The COPY options the line format is made for.
COPY_OPTIONS = "FORMAT csv, HEADER false, DELIMITER ',', NULL '{null}', QUOTE '\"', ESCAPE '\"'"
# What stands for NULL: nothing, but in a table of one column a text of its own,
# as readers skip a line with nothing on it. A text equal to it is refused.
NULL_TEXT = ""
NULL_TEXT_ALONE = "\\N-null"


def null_text(columns: int) -> str:
    return NULL_TEXT_ALONE if columns == 1 else NULL_TEXT


def quote_identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quote_table(table: str) -> str:
    """``schema.table`` as two quoted identifiers."""
    return ".".join(quote_identifier(part) for part in table.split("."))


def create_table_statement(schema: T.StructType, table: str, not_null: Iterable[str] = ()) -> str:
    required = set(not_null)
    unknown = required - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not_null names unknown columns: {sorted(unknown)}")
    body = ", ".join(
        f"{quote_identifier(c.name)} {c.target_type}" + (" NOT NULL" if c.name in required else "")
        for c in target_columns(schema)
    )
    return f"CREATE TABLE IF NOT EXISTS {quote_table(table)} ({body})"


def copy_statement(schema: T.StructType, table: str) -> str:
    names = ", ".join(quote_identifier(name) for name in schema.fieldNames())
    return f"COPY {quote_table(table)} ({names}) FROM STDIN WITH ({COPY_OPTIONS.format(null=null_text(len(schema)))})"
