"""One-pass profile of all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehaul.functions.encode import DATED, far_date
from tidehaul.functions.typemap import TargetColumn, sql_name, target_columns

MEASURES = ("null_count", "empty_count", "max_length", "nul_count", "invalid_count", "nan_count", "far_date_count")


def _measures(field: T.StructField) -> str:
    """SQL for a struct of the measures of one column."""
    col = sql_name(field.name)
    text = isinstance(field.dataType, T.StringType)
    floating = isinstance(field.dataType, (T.FloatType, T.DoubleType))
    sql = {
        "null_count": f"count_if({col} IS NULL)",
        "empty_count": f"count_if({col} = '')" if text else "0L",
        "max_length": f"cast(coalesce(max(length({col})), 0) AS BIGINT)" if text else "0L",
        "nul_count": f"count_if(contains({col}, char(0)))" if text else "0L",
        "invalid_count": f"count_if(NOT is_valid_utf8({col}))" if text else "0L",
        "far_date_count": f"count_if({far_date(field.name)})" if isinstance(field.dataType, DATED) else "0L",
        "nan_count": f"count_if(isnan({col}))" if floating else "0L",
    }
    return "named_struct(" + ", ".join(f"'{m}', {sql[m]}" for m in MEASURES) + ")"


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, types, and what can go wrong when it is loaded.

    Counted are NULLs, empty strings, NUL characters, text that is not valid
    UTF-8, NaNs, and dates outside the years 1 to 9999, next to the longest text; counts that do not apply to a type are 0. All columns are
    measured in one aggregate, which meets as one row per task.
    """
    columns = target_columns(df.schema)
    totals = df.agg(
        *[
            F.expr(f"{_measures(f)} AS c{c.position}") for f, c in zip(df.schema.fields, columns, strict=True)
        ]
    )
    return totals.select(F.inline(F.array(*[_entry(c) for c in columns])))


def _entry(column: TargetColumn) -> Column:
    return F.struct(
        F.lit(column.position).alias("position"),
        F.lit(column.name).alias("column_name"),
        F.lit(column.source_type).alias("source_type"),
        F.lit(column.target_type).alias("target_type"),
        F.expr(f"c{column.position}.*"),
    )
