"""From Spark types to target types, and the projection that makes it true."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The target type of each simple source type.
SIMPLE_TARGETS = {
    T.ByteType: "SMALLINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.StringType: "TEXT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.BinaryType: "BYTEA",
}

NESTED = (T.ArrayType, T.MapType, T.StructType)

# Null members stay visible; times keep their microseconds, instants are in UTC.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class TargetColumn:
    position: int
    name: str
    source_type: str
    target_type: str


def sql_name(name: str) -> str:
    """A column's exact name, dots and backticks included, as SQL text.

    Expressions over all columns of a table are put together as SQL text and
    parsed once, as one call per function and column would take the driver
    seconds on a wide table.
    """
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ref(name: str) -> Column:
    return F.col(sql_name(name))


def whole_div(name: str, divisor: int) -> Column:
    """Integer division of a column; never passes through a double."""
    return F.expr(f"cast({sql_name(name)} as bigint) div {divisor}L")


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, NESTED)


def is_flat(data_type: T.DataType) -> bool:
    """Whether a column of this type is a single Parquet column."""
    return not is_nested(data_type) and not isinstance(data_type, T.VariantType)


def _known(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.DecimalType):
        return f"NUMERIC({data_type.precision},{data_type.scale})"
    if is_nested(data_type):
        return "JSONB"
    for spark_class, name in SIMPLE_TARGETS.items():
        if isinstance(data_type, spark_class):
            return name
    return None


def target_type(data_type: T.DataType) -> str:
    """The target's type name; TEXT, with a warning, for a type it has no match for."""
    known = _known(data_type)
    if known is None:
        warnings.warn(f"no target type for {data_type.simpleString()}, using TEXT", stacklevel=2)
        return "TEXT"
    return known


def target_columns(schema: T.StructType) -> list[TargetColumn]:
    return [
        TargetColumn(i, f.name, f.dataType.simpleString(), target_type(f.dataType))
        for i, f in enumerate(schema.fields, start=1)
    ]


def to_target(name: str, data_type: T.DataType) -> str:
    """SQL for the column ``name`` in a type that the sinks can store as it is."""
    col = sql_name(name)
    if is_nested(data_type):
        options = ", ".join(f"{sql_text(k)}, {sql_text(v)}" for k, v in JSON_OPTIONS.items())
        return f"to_json({col}, map({options}))"
    if isinstance(data_type, T.BinaryType):
        return f"concat(r'\\x', hex({col}))"
    if isinstance(data_type, T.TimestampType):
        # The UTC wall clock of the instant, whatever the session time zone is.
        return f"timestampadd(MICROSECOND, unix_micros({col}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    if isinstance(data_type, T.VariantType):
        return f"to_json({col})"
    if _known(data_type) is None or isinstance(data_type, T.StringType):
        return f"cast({col} AS STRING)"
    return col


def project_to_target(df: DataFrame) -> DataFrame:
    """Every column in a target-safe type, names and order kept.

    Nested values and variants become JSON text, binary ``\\x`` hex text,
    instants their UTC wall clock, and types without a target plain text.
    """
    return df.selectExpr(*[f"{to_target(f.name, f.dataType)} AS {sql_name(f.name)}" for f in df.schema.fields])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text; all others as they are."""
    return df.selectExpr(
        *[
            f"{to_target(f.name, f.dataType) if is_nested(f.dataType) else sql_name(f.name)} AS {sql_name(f.name)}"
            for f in df.schema.fields
        ]
    )
