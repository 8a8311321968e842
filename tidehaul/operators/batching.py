"""Load partitions and fixed-size batches.

Three ways to number batches, cheapest first:

* ``batch_within_partition``: batches that end with their scan partition. No
  shuffle, no second pass.
* ``batch_by_position``: batches of exactly ``batch_size`` rows over the whole
  source in file order. No shuffle of the rows; one pass over row counts.
* ``batch_global``: the same in key order. One shuffle on ranges of the key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehaul.functions.typemap import is_nested, ref, sql_name, to_target, whole_div
from tidehaul.session import parallel_tasks, scratch_path, written
from tidehaul.sources.parquet import FILE_COL, ROW_COL, row_count

# Most partitions one exchange should have. More batches than this share partitions.
MAX_PARTITIONS = 50_000
# Most rows of a small side that is sent to every executor (a few MB).
MAX_BROADCAST_ROWS = 100_000
# Most files whose offsets are sent to every executor, 16 bytes each: over 300 TB in files of 256 MB.
MAX_BROADCAST_FILES = 1_500_000
# Rows of a file that share a join key when file offsets are too many to broadcast.
ROWS_PER_SLICE = 1 << 20


def _check_size(batch_size: int) -> None:
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")


# -- load partitions ---------------------------------------------------------


def partition_count(rows: int, batch_size: int, mode: str = "ceil", at_least: int = 1) -> int:
    """Partitions of about ``batch_size`` rows, and at least ``at_least``.

    ``"ceil"`` keeps each at or below ``batch_size``; with ``"floor"`` the
    remainder is spread over the others.
    """
    _check_size(batch_size)
    if mode not in ("ceil", "floor"):
        raise ValueError("mode must be 'ceil' or 'floor'")
    return max(-(-rows // batch_size) if mode == "ceil" else rows // batch_size, at_least, 1)


def partition_for_load(
    df: DataFrame,
    batch_size: int,
    *,
    rows: int | None = None,
    mode: str = "ceil",
    at_least: int = 1,
    max_partitions: int = MAX_PARTITIONS,
) -> DataFrame:
    """``df`` in evenly filled partitions of about ``batch_size`` rows.

    A source scanned with ``position=True`` is dealt out by the rows' places in
    it, so the sizes of a whole source differ by at most one row, however many
    files it has, and no sort is needed to make the exchange repeatable. The
    places take one count per file, as in ``batch_by_position``. Other inputs go
    round-robin. There are never more than ``max_partitions``, whatever
    ``at_least`` says: beyond that each partition holds several batches.
    """
    n = min(partition_count(row_count(df) if rows is None else rows, batch_size, mode, at_least), max_partitions)
    if ROW_COL not in df.columns:
        return df.repartition(n)
    if FILE_COL not in df.columns:
        return df.repartitionById(n, F.pmod(F.col(ROW_COL), F.lit(n)).cast("int"))
    # A file's next row would start where its last one ends, also where rows have been left out.
    counts = written(df.groupBy(FILE_COL).agg((F.max(ROW_COL) + 1).alias("__rows")), "files")
    placed = _with_offsets(df, counts, MAX_BROADCAST_FILES)
    dealt = placed.repartitionById(n, F.pmod(F.col("__offset") + F.col(ROW_COL), F.lit(n)).cast("int"))
    return dealt.select(*[ref(c) for c in df.columns])


def partition_by_weight(df: DataFrame, weight: Column, partitions: int) -> DataFrame:
    """``df`` in ``partitions`` parts of near equal weight: rows follow each other, and a part ends where its share is full.

    ``weight`` is a whole number of each row, not negative, such as the length
    of its line. A part's weight is within the heaviest row's of an even share,
    however rows differ. ``df`` is a scan, or a projection of one: its partitions
    are weighed first, then a row's place is the weight of the partitions before
    its own and of the rows before it there. Only the weights go through Python,
    and one sum per partition meets in one task. The rows are exchanged once.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    n = min(partitions, MAX_PARTITIONS)
    weighed = df.select(weight.cast("long").alias("__weight"))
    sums = weighed.groupBy(F.spark_partition_id().alias("__part")).agg(F.sum("__weight").alias("__sum"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = written(
        written(sums, "weights").select(
            "__part",
            F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__from"),
            F.sum("__sum").over(everything).alias("__all"),
        ),
        "weights-before",
    )

    @F.pandas_udf("long")
    def before(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = 0
        for part in parts:
            sums = part.cumsum()
            yield sums - part + total
            total += int(sums.iloc[-1]) if len(sums) else 0

    tagged = df.select("*", weight.cast("long").alias("__weight"), F.spark_partition_id().alias("__part"))
    tagged = tagged.withColumn("__before", before(F.col("__weight")))
    # One row of 24 bytes for each scan partition; beyond the bound they are joined.
    side = F.broadcast(offsets) if offsets.count() <= MAX_BROADCAST_FILES else offsets.hint("merge")
    place = "cast((`__from` + `__before`) as decimal(38,0))"
    share = f"least(cast({place} * {n} div greatest(`__all`, 1) as int), {n - 1})"
    return (
        tagged.join(side, "__part")
        .withColumn("__to", F.expr(share))
        .drop("__weight", "__part", "__before", "__from", "__all")
        .repartitionById(n, F.col("__to"))
        .drop("__to")
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """``partition_id, rows`` of the partitions that hold rows."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def is_lopsided(df: DataFrame, batch_size: int) -> bool:
    """Whether some scan partition has so many rows that its task would hold up all others.

    That is more than twice its even share, and more than two batches. A file
    with one huge row group is read by one task, however many there are. Only
    row counts are read.
    """
    largest, total = partition_sizes(df).agg(F.max("rows"), F.sum("rows")).first()
    if not total:
        return False
    return largest > 2 * max(batch_size, -(-total // parallel_tasks(df.sparkSession)))


def co_locate_batches(
    df: DataFrame, *, batches: int, batch: str = "batch_id", max_partitions: int = MAX_PARTITIONS
) -> DataFrame:
    """Each batch whole in one partition, its rows next to each other.

    ``batches`` is how many there are, numbered from 0. The partition is the
    batch number itself, not its hash, so no partition gets two batches while
    another gets none. Only partitions that have to hold several are sorted.
    """
    n = max(min(batches, max_partitions), 1)
    target = F.pmod(F.coalesce(ref(batch), F.lit(0)), F.lit(n)).cast("int")
    placed = df.repartitionById(n, target)
    return placed if n >= batches else placed.sortWithinPartitions(ref(batch))


# -- batches -----------------------------------------------------------------


def batch_within_partition(
    df: DataFrame, batch_size: int, *, part: str = "part_id", batch: str = "batch_no"
) -> DataFrame:
    """Batches of ``batch_size`` rows that never cross a partition.

    Adds the partition's number and the batch's number in it. The last batch of
    each partition may be short.
    """
    _check_size(batch_size)
    numbered = df.withColumn("__id", F.monotonically_increasing_id())
    # The id holds the partition in its upper bits, the row's index in the lower 33.
    return numbered.selectExpr(
        *[sql_name(c) for c in df.columns],
        f"cast(shiftright(`__id`, 33) AS INT) AS {sql_name(part)}",
        f"(`__id` & {(1 << 33) - 1}L) div {batch_size}L AS {sql_name(batch)}",
    )


def _range_offsets(counts: DataFrame) -> DataFrame:
    """Adds the rows before each range; at most ``MAX_BROADCAST_ROWS`` rows, so one task can add them up."""
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0).cast("bigint")))


def _file_offsets(counts: DataFrame) -> DataFrame:
    """Adds the rows before each file. ``counts`` has one row per file, and there can be millions.

    Files are dealt out in order and added up within each part; only the sums of
    the parts, one row for each, meet in one task.
    """
    parted = written(
        counts.repartitionByRange(FILE_COL).select("*", F.spark_partition_id().alias("__part")), "files-in-order"
    )
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy("__part").agg(F.sum("__rows").alias("__sum"))
    parts = parts.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__from"))
    within = Window.partitionBy("__part").orderBy(FILE_COL).rowsBetween(Window.unboundedPreceding, -1)
    inside = parted.withColumn("__inside", F.coalesce(F.sum("__rows").over(within), F.lit(0)))
    placed = inside.join(parts, "__part").select(
        FILE_COL, "__rows", (F.col("__from") + F.col("__inside")).cast("bigint").alias("__offset")
    )
    return written(placed, "file-offsets")


def _with_offsets(df: DataFrame, counts: DataFrame, max_broadcast_files: int) -> DataFrame:
    """Adds ``__offset``, the rows of the files before a row's own. ``counts`` has ``__rows`` of each file, written down."""
    slices, files, hashes = counts.agg(
        F.sum(whole_div("__rows", ROWS_PER_SLICE) + 1), F.count(F.lit(1)), F.count_distinct(F.xxhash64(FILE_COL))
    ).first()
    offsets = _file_offsets(counts)
    if files <= max_broadcast_files and hashes == files:
        compact = offsets.select(F.xxhash64(FILE_COL).alias("__file"), "__offset")
        return df.withColumn("__file", F.xxhash64(FILE_COL)).join(F.broadcast(compact), "__file")
    per_slice = offsets.select(
        FILE_COL,
        "__offset",
        F.explode(F.sequence(F.lit(0).cast("bigint"), whole_div("__rows", ROWS_PER_SLICE))).alias("__slice"),
    )
    sliced = df.withColumn("__slice", whole_div(ROW_COL, ROWS_PER_SLICE)).repartition(
        min(slices or 1, MAX_PARTITIONS), FILE_COL, "__slice"
    )
    placed = sliced.join(per_slice.hint("shuffle_hash"), [FILE_COL, "__slice"])
    # A scan gives a file's rows in order, an exchange does not.
    return placed.sortWithinPartitions(FILE_COL, ROW_COL)


def _content(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (FILE_COL, ROW_COL)]


def _with_batch(placed: DataFrame, index: str, columns: list[str], batch_size: int, batch: str) -> DataFrame:
    number = f"(`__offset` + `{index}`) div {batch_size}L AS {sql_name(batch)}"
    return placed.selectExpr(*[sql_name(c) for c in columns], number)


def batch_by_position(
    df: DataFrame,
    batch_size: int,
    *,
    batch: str = "batch_id",
    max_broadcast_files: int = MAX_BROADCAST_FILES,
) -> DataFrame:
    """Batches of exactly ``batch_size`` rows in file order, the last one shorter.

    ``df`` is a whole source scanned with ``position=True``. The row's number is
    its index in its file plus the rows of the files before it. Those come from
    one count per file, which reads no column data and is written down, as
    later jobs need it again. The rows are not shuffled while the source has at
    most ``max_broadcast_files`` files: a hash of the file's name and the offset,
    16 bytes a file, go to every executor. Beyond that, or should two names have
    the same hash, the offsets are joined on slices of the files, so that a
    very large file is not one join key. Either way gives the same batches.
    """
    _check_size(batch_size)
    counts = written(
        df.groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("__rows"), (F.max(ROW_COL) + 1).alias("__end")), "files"
    )
    filtered = counts.agg(F.count(F.when(F.col("__rows") != F.col("__end"), F.lit(1)))).first()[0]
    if filtered:
        raise ValueError("batches by position need the whole source; filter after batching")
    placed = _with_offsets(df, counts.drop("__end"), max_broadcast_files)
    return _with_batch(placed, ROW_COL, _content(df), batch_size, batch)


def _is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def batch_global(
    df: DataFrame,
    keys: str | Sequence[str],
    batch_size: int,
    *,
    batch: str = "batch_id",
    unique: bool = False,
    rows_per_range: int = 1_000_000,
    max_ranges: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Batches of exactly ``batch_size`` rows in key order, the last one shorter.

    NULL keys come last. For an integer key the rows are numbered inside equal
    ranges of the key and the rows of the ranges before are added; at most
    ``max_ranges`` counts are broadcast. If a range turns out far larger than
    the others (a sparse key, or one value on many rows), or the key is no
    integer, the rows are sorted into files instead, which also splits a single
    hot value or many copies of one row.

    The key need not be unique. Equal keys are kept in source order (files by
    name, rows by index) if ``df`` was scanned with ``position=True``, and else
    are ordered by a hash of the row, however the key is distributed; rows that
    are equal in that too are alike. ``unique`` says that neither is needed, so that only the key is read
    where no other column is asked for. ``df`` is a scan or a stored table.
    """
    _check_size(batch_size)
    names = [keys] if isinstance(keys, str) else list(keys)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if _is_integral(kinds[names[0]]):
        lead = ref(names[0])
        lo, hi, n = df.agg(F.min(lead), F.max(lead), F.count(F.lit(1))).first()
        ranges = max(1, min(-(-n // rows_per_range), max_ranges))
        width = 1 if lo is None else min(-(-(hi - lo + 1) // ranges), (1 << 63) - 1)
        # Division rounds towards zero, so ranges stay in key order.
        null_range = 0 if hi is None else abs(hi) // width + 1
        tagged = df.withColumn(
            "__range", F.coalesce(whole_div(names[0], width), F.lit(null_range).cast("bigint"))
        )
        counts = written(tagged.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows")), "ranges")
        largest = counts.agg(F.max("__rows")).first()[0] or 0
        if largest <= 4 * max(rows_per_range, -(-n // ranges)):
            first = 0 if lo is None else -(-lo // width) if lo < 0 else lo // width
            return _number_in_ranges(tagged, counts, names, batch_size, batch, first, null_range, unique)
    else:
        n = row_count(df)
    return _number_sorted_files(df, names, batch_size, batch, max(1, min(-(-n // rows_per_range), max_ranges)))


def _source_order(df: DataFrame) -> list[Column]:
    if ROW_COL in df.columns:
        return [F.col(FILE_COL), F.col(ROW_COL)]
    return [content_hash(df)]


def content_hash(df: DataFrame) -> Column:
    """Equal for equal rows. Nested values are hashed as JSON, as maps have no hash."""
    values = [
        to_target(f.name, f.dataType) if is_nested(f.dataType) or isinstance(f.dataType, T.VariantType) else sql_name(f.name)
        for f in df.schema.fields
    ]
    return F.expr(f"xxhash64({', '.join(values)})")


def _number_in_ranges(
    tagged: DataFrame,
    counts: DataFrame,
    names: list[str],
    batch_size: int,
    batch: str,
    first_range: int,
    last_range: int,
    unique: bool,
) -> DataFrame:
    # A task that runs again must number its rows as before, or a row could be
    # in two batches and another in none. So equal keys get an order of their own.
    ties = [] if unique else _source_order(tagged.drop("__range"))
    order = [ref(k).asc_nulls_last() for k in names] + ties
    # A range goes to the partition of its number, not of its hash, so no task
    # gets several and another none. Rows are numbered by their place in the
    # sorted partition; ranges that share one are told apart by their counts.
    n = max(1, min(last_range - first_range + 1, MAX_PARTITIONS))
    dealt = F.pmod(F.col("__range") - F.lit(first_range), F.lit(n)).cast("int")
    earlier = Window.partitionBy(dealt).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _range_offsets(counts).select(
        "__range", (F.col("__offset") - F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).alias("__offset")
    )
    numbered = (
        tagged.repartitionById(n, dealt)
        .sortWithinPartitions("__range", *order)
        .withColumn("__index", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    placed = numbered.join(F.broadcast(offsets), "__range")
    return _with_batch(placed, "__index", [c for c in _content(tagged) if c != "__range"], batch_size, batch)


def _number_sorted_files(
    df: DataFrame, names: list[str], batch_size: int, batch: str, ranges: int
) -> DataFrame:
    """Sort once into files in the shared folder, then number by position.

    The bounds of a range exchange are sampled, so they are used once and their
    outcome is written down. A file is one range; row indexes in it are final.
    The last sort column differs between any two rows, so every group of equal
    rows can be split between files.
    """
    parts = min(ranges, MAX_PARTITIONS)
    ties = [*_source_order(df), F.monotonically_increasing_id()]
    tied = df.select("*", *[t.alias(f"__tie_{i}") for i, t in enumerate(ties)])
    order = [ref(k).asc_nulls_last() for k in names] + [F.col(f"__tie_{i}") for i in range(len(ties))]
    path = scratch_path(df.sparkSession, "sorted")
    (
        tied.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .selectExpr(*[sql_name(c) for c in _content(df)], "spark_partition_id() AS __range")
        .write.option("maxRecordsPerFile", 0)
        .parquet(path)
    )
    stored = df.sparkSession.read.parquet(path)
    counts = stored.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    indexed = stored.select("*", F.col("_metadata.row_index").alias("__index"))
    placed = indexed.join(F.broadcast(_range_offsets(counts).drop("__rows")), "__range")
    return _with_batch(placed, "__index", _content(df), batch_size, batch)
