"""What several of these operators need: cuts, ranks, running numbers, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidehaul.session import ship_package, written

# Rows that Spark hands to Python at a time. Texts are long, and the buffers of a
# batch lie outside the heap, in the executor and in the worker.
ROWS_IN_BATCH = "1000"

# ASCII white space, as the contracts of these operators have it.
WORD = r"[^\x20\x09-\x0D]+"


def ready_for_python(spark: SparkSession) -> None:
    """Make this package known to the executors, and batches of rows small; the setting stays with the session."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_IN_BATCH)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def replace_columns(df: DataFrame, own: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add under these names."""
    return df.drop(*[c for c in df.columns if c in own])


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores added until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def numbered(df: DataFrame, *order: Column, label: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``_rank`` (0-based, over all rows in this order) and running sums before each row.

    Rows are dealt by range and sorted in their partitions, the result is kept
    in the shared folder with each row's place, and only one row per partition
    takes part in the offsets. So no task gets more than its range, and a task
    that runs again finds the same places. ``sums`` maps a name to a column
    whose running total before the row is wanted; its total stands in
    ``<name>_all``, the number of rows in ``_rows``.
    """
    sums = sums or {}
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    held = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), place.alias("_at")),
        label,
    )
    parts = held.groupBy("_part").agg(
        F.count("*").alias("_n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"_sum_{k}") for k, c in sums.items()]
    )
    # One row per partition, so at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_from_{k}") for k in sums],
        *[F.sum(f"_sum_{k}").over(everything).alias(f"{k}_all") for k in sums],
    )
    out = held.join(F.broadcast(starts), "_part")
    here = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    for k, c in sums.items():
        out = out.withColumn(k, F.col(f"_from_{k}") + F.coalesce(F.sum(c).over(here), F.lit(0))).drop(f"_from_{k}")
    return out.withColumn("_rank", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def cuts(df: DataFrame, column: Column, bins: int) -> list[tuple[int, object]]:
    """Exact quantile cuts: (bin, least value in it), at most ``bins`` of them, bin 0 left out.

    A value's bin is ``bins * (rows with smaller values) // rows``, so equal
    values share a bin. Values are counted before they are ordered. NULL is the
    smallest value.
    """
    return cuts_of(df, [column], bins)[0]


def cuts_of(df: DataFrame, columns: list[Column], bins: int) -> list[list[tuple[int, object]]]:
    """The ``cuts`` of several columns, of any types: all values are counted and ordered together, column by column."""
    names = [f"v{i}" for i in range(len(columns))]
    plain = df.select(*[c.alias(n) for c, n in zip(columns, names, strict=True)])
    kinds = [f.dataType for f in plain.schema]
    # A row for each value, in its own column; those of the other columns are NULL.
    values = F.array(*[
        F.struct(
            F.lit(i).alias("axis"),
            *[(F.col(n) if i == k else F.lit(None).cast(kinds[k])).alias(n) for k, n in enumerate(names)],
        )
        for i in range(len(names))
    ])
    counts = plain.select(F.inline(values)).groupBy("axis", *names).agg(F.count("*").alias("n"))
    order = [F.col("axis"), *[F.col(n).asc_nulls_first() for n in names]]
    placed = numbered(counts, *order, label="cuts", sums={"before": F.col("n")})
    # Each column has as many values as there are rows.
    rows = f"(before_all div {len(names)})"
    found = (
        placed.withColumn("bin", F.expr(f"((before - axis * {rows}) * {bins}) div {rows}"))
        .where(" or ".join(f"{n} is not null" for n in names))
        .where("bin > 0")
        .groupBy("axis", "bin")
        .agg(*[F.min(n).alias(n) for n in names])
        .collect()
    )
    return [sorted((r["bin"], r[n]) for r in found if r["axis"] == i) for i, n in enumerate(names)]


def bin_of(column: Column, found: list[tuple[int, object]]) -> Column:
    """The bin of a value under ``cuts``; NULL and what lies under the first cut are in bin 0."""
    out = None
    for number, least in reversed(found):
        test = column >= F.lit(least)
        out = F.when(test, F.lit(number)) if out is None else out.when(test, F.lit(number))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of ``links`` (a, b: long) with the least node it is connected to.

    Large-star and small-star steps in turn (Kiveris and others, "Connected
    Components in MapReduce and Beyond", 2014) until the edges stay the same.
    Least neighbours are aggregated before they are joined back, so a node with
    very many links is summed up on the map side and its join can be split.
    Each step's edges are a table in the shared folder.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).where("a <> b").distinct()
        large = written(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select("a", F.col("m").alias("b")))
        )
        edges = written(small.where("a <> b").distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
