"""Did everything arrive: row counts and columns of source and target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehaul.functions.typemap import ref, sql_name, target_columns


class CountMismatch(RuntimeError):
    """The target does not hold the rows it should."""


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source_rows, target_rows, diff, match`` of two one-row counts.

    Each side's only column is its count.
    """
    nothing = F.lit(0).cast("bigint")
    # The target's side goes first: the source's may come from a session with settings of its own.
    sides = target.select(nothing.alias("source_rows"), ref(target.columns[0]).alias("target_rows")).unionAll(
        source.select(ref(source.columns[0]).alias("source_rows"), nothing.alias("target_rows"))
    )
    return sides.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")).select(
        "source_rows",
        "target_rows",
        F.abs(F.col("source_rows") - F.col("target_rows")).alias("diff"),
        (F.col("source_rows") == F.col("target_rows")).alias("match"),
    )


def require_match(reconciled: DataFrame) -> None:
    """Raise unless the counts match."""
    row = reconciled.first()
    if not row["match"]:
        raise CountMismatch(f"source has {row['source_rows']} rows, target {row['target_rows']}")


def _filled(df: DataFrame, side: str) -> DataFrame:
    """One row per column with its position, target type and non-null count."""
    columns = target_columns(df.schema)
    counts = df.selectExpr(*[f"count({sql_name(c.name)}) AS c{c.position}" for c in columns])
    entries = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("column_name"),
                F.lit(c.position).alias(f"{side}_position"),
                F.lit(c.target_type).alias(f"{side}_type"),
                F.col(f"c{c.position}").alias(f"{side}_values"),
            )
            for c in columns
        ]
    )
    return counts.select(F.inline(entries))


def reconcile_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per column of either side, in position order of the source.

    ``status`` is ``missing`` or ``extra`` for a column on one side only,
    ``type_diff`` when the target types differ, ``null_diff`` when one side
    holds more values than the other (which equal row counts do not show),
    and else ``ok``. One pass over each side.
    """
    joined = _filled(source, "source").join(_filled(target, "target"), "column_name", "full_outer")
    status = (
        F.when(F.col("target_position").isNull(), F.lit("missing"))
        .when(F.col("source_position").isNull(), F.lit("extra"))
        .when(F.col("source_type") != F.col("target_type"), F.lit("type_diff"))
        .when(F.col("source_values") != F.col("target_values"), F.lit("null_diff"))
        .otherwise(F.lit("ok"))
    )
    return joined.select("*", status.alias("status")).orderBy(
        F.col("source_position").asc_nulls_last(), "target_position"
    )
