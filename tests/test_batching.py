"""Batch sizes and order, against plain Python on small inputs."""

import pytest
from pyspark.sql import functions as F

from tidehaul.functions import project_to_target
from tidehaul.operators import (
    batch_by_position,
    batch_global,
    batch_within_partition,
    co_locate_batches,
    is_lopsided,
    partition_count,
    partition_for_load,
    partition_sizes,
)
from tidehaul.session import scratch_path
from tidehaul.sources import row_count, scan_source

B = 100
SIZES = [0, 1, B - 1, B, B + 1, 3 * B, 3 * B + 1]


def sizes_of(batched, batch="batch_id"):
    counted = batched.groupBy(batch).agg(F.count(F.lit(1)).alias("n")).collect()
    return [n for _, n in sorted((r[batch], r["n"]) for r in counted)]


def expected(n, size=B):
    return [size] * (n // size) + ([n % size] if n % size else [])


def stored(spark, df, files=1):
    path = scratch_path(spark, "test")
    df.repartition(files).write.parquet(path)
    return path


@pytest.mark.parametrize("parts", [1, 4, 7])
@pytest.mark.parametrize("n", SIZES)
def test_global_boundaries(spark, n, parts):
    df = spark.range(0, n, 1, parts)
    batched = batch_global(df, "id", B, rows_per_range=64)
    assert sizes_of(batched) == expected(n)
    assert batched.where(f"batch_id <> id div {B}").isEmpty()


@pytest.mark.parametrize("files", [1, 4, 7])
@pytest.mark.parametrize("n", [1, B - 1, B, B + 1, 3 * B + 1])
def test_position_boundaries(spark, n, files):
    source = scan_source(spark, stored(spark, spark.range(n), files), position=True)
    for limit in (1000, 0):
        batched = batch_by_position(source, B, max_broadcast_files=limit)
        assert batched.columns == ["id", "batch_id"]
        assert sizes_of(batched) == expected(n)


def test_position_of_an_empty_source(spark):
    source = scan_source(spark, stored(spark, spark.range(0)), position=True)
    assert batch_by_position(source, B).isEmpty()


def test_position_without_broadcast_is_the_same(spark, monkeypatch):
    """The join on file slices, with slices so small that every file has many."""
    import tidehaul.operators.batching as batching

    monkeypatch.setattr(batching, "ROWS_PER_SLICE", 16)
    source = scan_source(spark, stored(spark, spark.range(1003), 5), position=True)
    plain = batch_by_position(source, B).sort("id").collect()
    sliced = batch_by_position(source, B, max_broadcast_files=0)
    assert sliced.sort("id").collect() == plain
    assert "BroadcastHashJoin" not in sliced._jdf.queryExecution().executedPlan().toString()


def test_position_moves_no_rows(spark):
    source = scan_source(spark, stored(spark, spark.range(1000), 3), position=True)
    plan = batch_by_position(source, B)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 0
    assert plan.count("Exchange SinglePartition") == 0


def test_position_refuses_a_filtered_source(spark):
    source = scan_source(spark, stored(spark, spark.range(1000), 2), position=True)
    with pytest.raises(ValueError, match="whole source"):
        batch_by_position(source.where("id > 500"), B)


def test_position_does_not_depend_on_the_split(spark):
    path = stored(spark, spark.range(20_000).withColumn("pad", F.repeat(F.lit("x"), 50)), 3)
    whole = batch_by_position(scan_source(spark, path, position=True), B).select("id", "batch_id").sort("id").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = batch_by_position(scan_source(spark, path, position=True), B).select("id", "batch_id")
        assert split.sort("id").collect() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def numbered(rows, size):
    return {key: i // size for i, key in enumerate(rows)}


@pytest.mark.parametrize(
    "keys",
    [
        [i * i for i in range(700)],
        [-(i * 3) for i in range(700)] + [i * 5 + 1 for i in range(300)],
        [-(2**63), 2**63 - 1, 0, -1, 1],
        [2**62 + i for i in range(500)] + [-(2**62) - i for i in range(500)],
        [10**12] + list(range(999)),
    ],
    ids=["sparse", "signed", "extreme", "two ends", "outlier"],
)
def test_global_order_of_integer_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    batched = batch_global(df, "k", B, rows_per_range=50)
    assert {r["k"]: r["batch_id"] for r in batched.collect()} == numbered(sorted(keys), B)


def test_null_keys_come_last(spark):
    df = spark.createDataFrame([(i,) for i in range(250)] + [(None,)] * 70, "k int").repartition(4)
    batched = batch_global(df, "k", B, rows_per_range=60)
    got = batched.groupBy("batch_id").agg(F.count("k").alias("keys"), F.count(F.lit(1)).alias("n")).sort("batch_id")
    assert [(r["keys"], r["n"]) for r in got.collect()] == [(100, 100), (100, 100), (50, 100), (0, 20)]
    only_nulls = batch_global(df.where("k IS NULL"), "k", 50, rows_per_range=1000)
    assert sizes_of(only_nulls) == [50, 20]


def test_other_key_types_and_several_keys(spark):
    rows = [(f"n{i % 7}", i) for i in range(450)]
    df = spark.createDataFrame(rows, "name string, i int").repartition(6)
    batched = batch_global(df, ["name", "i"], B, rows_per_range=64)
    assert {(r["name"], r["i"]): r["batch_id"] for r in batched.collect()} == numbered(sorted(rows), B)


def test_hot_key_is_split(spark, monkeypatch):
    """A third of all rows share one key and are copies of one row."""
    import tidehaul.operators.batching as batching

    sorted_path = scratch_path(spark, "sorted")
    monkeypatch.setattr(batching, "scratch_path", lambda *_: sorted_path)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).repartition(4)
    batched = batch_global(df, "k", B, rows_per_range=200)
    assert sizes_of(batched) == expected(3000)
    order = batched.groupBy("batch_id").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).sort("batch_id").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(order, order[1:], strict=False))
    assert batched.select("k").exceptAll(df).isEmpty()
    # The 1000 copies lie in several of the sorted files.
    files = spark.read.parquet(sorted_path).where("k = 7").groupBy("_metadata.file_path").count()
    assert files.count() >= 4
    assert files.agg(F.max("count")).first()[0] < 500


def test_equal_keys_keep_source_order(spark):
    path = stored(spark, spark.range(0, 1000, 1, 1).select((F.col("id") % 10).alias("k"), "id"))
    source = scan_source(spark, path, position=True)
    for rows_per_range in (2000, 20):
        batched = batch_global(source, "k", 10, rows_per_range=rows_per_range)
        assert batched.columns == ["k", "id", "batch_id"]
        assert batched.where("batch_id <> k * 10 + id div 100").isEmpty()


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    first = None
    for parts in (1, 3, 16):
        got = batch_global(df.repartition(parts), "k", B, rows_per_range=300).sort("k").collect()
        first = first or got
        assert got == first


@pytest.mark.parametrize("parts", [1, 4, 7])
@pytest.mark.parametrize("n", SIZES)
def test_within_partition(spark, n, parts):
    df = spark.range(0, n, 1, parts)
    batched = batch_within_partition(df, 30)
    here = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    got = {}
    for r in batched.groupBy("part_id", "batch_no").count().collect():
        got.setdefault(r["part_id"], {})[r["batch_no"]] = r["count"]
    assert {p: [b[i] for i in range(len(b))] for p, b in got.items()} == {r["p"]: expected(r["count"], 30) for r in here}
    plan = batched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_partition_count():
    assert [partition_count(n, B) for n in SIZES] == [1, 1, 1, 1, 2, 3, 4]
    assert [partition_count(n, B, "floor") for n in SIZES] == [1, 1, 1, 1, 1, 3, 3]
    assert [partition_count(n, B, "floor", at_least=2) for n in SIZES] == [2, 2, 2, 2, 2, 3, 3]
    with pytest.raises(ValueError):
        partition_count(1, 0)
    with pytest.raises(ValueError):
        partition_count(1, 1, "round")


@pytest.mark.parametrize("files", [1, 3])
def test_partition_for_load(spark, files):
    path = stored(spark, spark.range(1001), files)
    source = scan_source(spark, path, position=True)
    sizes = [r["rows"] for r in partition_sizes(partition_for_load(source, B)).collect()]
    assert len(sizes) == 11 and sum(sizes) == 1001 and max(sizes) - min(sizes) <= files
    plain = scan_source(spark, path)
    assert partition_for_load(plain, B, mode="floor").rdd.getNumPartitions() == 10
    assert partition_for_load(plain, B, max_partitions=3).rdd.getNumPartitions() == 3
    assert partition_for_load(plain.where("id < 0"), B).rdd.getNumPartitions() == 1


def test_partitions_of_many_files_differ_by_one_row(spark):
    source = scan_source(spark, stored(spark, spark.range(1001), 7), position=True)
    placed = partition_for_load(source, B)
    assert placed.columns == source.columns
    assert sorted(r["rows"] for r in partition_sizes(placed).collect()) == [91] * 11
    assert sorted(r["id"] for r in placed.collect()) == list(range(1001))
    # Rows that are left out may make sizes differ, but none is lost.
    assert partition_for_load(source.where("id % 10 = 9"), B).count() == 100


@pytest.mark.parametrize(("rows", "files"), [(0, 1), (6_999, 2), (30_003, 7)])
def test_query_of_load_partitions_over_many_files(spark, rows, files):
    """Sizes of the partitions, not only that they are even, whatever the files."""
    import __spark_entry__ as entry

    folder = scratch_path(spark, "test")
    spark.range(rows).repartition(files).write.parquet(f"{folder}/lineitem.parquet")
    want = []
    for mode, n in (("ceil", max(1, -(-rows // 7000))), ("floor", max(1, rows // 7000))):
        want.append((mode, rows, 7000, n, rows // n, -(-rows // n)))
    got = entry.queries()["partition_for_load"](spark, folder)
    assert got.columns == ["mode", "row_count", "batch_size", "num_partitions", "min_rows", "max_rows"]
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("rows", [0, 6_999, 30_003])
def test_query_of_batches_within_partitions_gives_each_batch(spark, rows):
    """Rows of every batch, not only that they are lawful, for a source of several files and scan partitions."""
    import __spark_entry__ as entry

    folder = scratch_path(spark, "test")
    spark.range(rows).select(F.col("id").alias("o_orderkey")).repartition(5).write.parquet(f"{folder}/orders.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = entry.queries()["batch_within_partition"](spark, folder)
        assert got.columns == ["batch_no", "rows"]
        assert sorted(map(tuple, got.collect())) == list(enumerate(expected(rows, 1000)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batches_stay_whole(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("batch_id", F.col("id") % 13)
    for limit in (100, 4):
        placed = co_locate_batches(df, batches=13, max_partitions=limit)
        tagged = placed.select("batch_id", F.spark_partition_id().alias("p")).distinct()
        assert tagged.count() == 13
        assert placed.rdd.getNumPartitions() == min(13, limit)


def test_batches_of_projected_rows(spark):
    path = stored(spark, spark.range(300).withColumn("a", F.array("id")), 2)
    source = project_to_target(scan_source(spark, path, position=True))
    assert sizes_of(batch_by_position(source, B)) == [100, 100, 100]
    assert row_count(source) == 300


def test_lopsided_scans_are_seen(spark):
    even = spark.range(0, 8000, 1, 8)
    assert not is_lopsided(even, B)
    lopsided = spark.range(0, 8000, 1, 8).where("id < 1000 OR id % 100 = 0")
    assert is_lopsided(lopsided, B)
    assert not is_lopsided(lopsided, 1000)
    assert not is_lopsided(spark.range(0), B)


def test_equal_keys_are_numbered_the_same_again(spark):
    """Without a position the content decides, nested values included."""
    df = spark.range(900).select(
        (F.col("id") % 9).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"), F.array("id").alias("a")
    )
    first = None
    for parts in (1, 5):
        batched = batch_global(df.repartition(parts), "k", 30, rows_per_range=1000)
        got = batched.select("id", "batch_id").sort("id").collect()
        first = first or got
        assert got == first


def test_unique_key_reads_only_the_key(spark):
    path = stored(spark, spark.range(1000).withColumn("pad", F.lit("x")), 2)
    batched = batch_global(scan_source(spark, path), "id", B, unique=True, rows_per_range=300).select("id", "batch_id")
    assert "pad" not in batched._jdf.queryExecution().executedPlan().toString()
    assert batched.where(f"batch_id <> id div {B}").isEmpty()


@pytest.mark.parametrize("key", ["n", "t"])
def test_equal_keys_keep_the_order_of_files_and_rows(spark, key):
    """One order of equal keys, by ranges of a number and by sorted files of a text."""
    path = scratch_path(spark, "test")
    for k in range(4):
        part = spark.range(1000 * k, 1000 * k + 1000, 1, 1).selectExpr("id", "1L AS n", "'x' AS t")
        part.write.parquet(f"{path}/part-{3 - k}")
    source = scan_source(spark, [f"{path}/part-{k}" for k in range(4)], position=True)
    firsts = batch_global(source, key, 1000).groupBy("batch_id").agg(F.min("id").alias("first")).sort("batch_id").collect()
    assert [r["first"] for r in firsts] == [3000, 2000, 1000, 0]


def test_many_files_move_no_rows(spark):
    source = scan_source(spark, stored(spark, spark.range(3000), 300), position=True)
    batched = batch_by_position(source, B)
    plan = batched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert batched.count() == 3000 and batched.where("batch_id < 0 or batch_id >= 30").isEmpty()
