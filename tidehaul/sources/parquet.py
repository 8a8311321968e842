"""The Parquet source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehaul.functions.typemap import is_flat, sql_name

# Where a row sits in its source: the file and the row's index in that file.
# Both come from the reader's metadata, so they stay the same however the scan
# is split and however often a task is retried.
FILE_COL = "_src_file"
ROW_COL = "_src_row"


def scan_source(spark: SparkSession, path: str | list[str], *, position: bool = False) -> DataFrame:
    """A Parquet file or directory as a DataFrame with the files' own schema."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if not position:
        return df
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_COL),
        F.col("_metadata.row_index").alias(ROW_COL),
    )


# With these Spark answers counts and bounds from the files' footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The source as a scan whose counts, and bounds of numbers and dates, Spark takes from the footers.

    The settings for that are those of a session of its own, so ``spark`` keeps
    its settings. Aggregates that footers cannot answer (of nested columns, or
    after a filter) read the columns as usual.
    """
    session = spark.newSession()
    for name, value in FOOTER_SETTINGS.items():
        session.conf.set(name, value)
    return session.read.parquet(*([path] if isinstance(path, str) else path))


def footer_row_count(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row, ``row_count``: what the footers say. No row group is opened."""
    return source_row_count(footer_scan(spark, path))


def footer_statistics(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, row_count, value_count, null_count`` of the simple ``columns`` (by default all), in order.

    One row of sums per file is all that tasks read.
    """
    scan = footer_scan(spark, path)
    kinds = {f.name: f.dataType for f in scan.schema.fields}
    names = [n for n in kinds if is_flat(kinds[n])] if columns is None else list(columns)
    if not names:
        return spark.createDataFrame([], "column_name string, row_count long, value_count long, null_count long")
    counts = scan.selectExpr("count(*) AS n", *[f"count({sql_name(c)}) AS c{i}" for i, c in enumerate(names)])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n").alias("row_count"),
            F.col(f"c{i}").alias("value_count"),
            (F.col("n") - F.col(f"c{i}")).alias("null_count"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def source_row_count(df: DataFrame) -> DataFrame:
    """One row, ``row_count``. Reads no column data, only row-group counts."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def row_count(df: DataFrame) -> int:
    return source_row_count(df).first()["row_count"]
