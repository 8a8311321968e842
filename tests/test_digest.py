"""Digests that name the batch that differs, parts of equal weight, and records counted by block."""

import os
import random
import tempfile

import pytest
from places import SF001, SF01
from pyspark.sql import functions as F

from tidehaul.functions import encode_copy_rows
from tidehaul.operators import batch_by_position, batch_digests, differing_batches, partition_by_weight
from tidehaul.session import scratch_path
from tidehaul.sinks import read_staged, stage_copy_files, staged_records, target_row_count
from tidehaul.sources import scan_source


@pytest.fixture(scope="module")
def orders(spark):
    return batch_by_position(scan_source(spark, f"{SF001}/orders.parquet", position=True), 10)


def found(source, target, **options):
    rows = differing_batches(batch_digests(source), batch_digests(target), **options).collect()
    return {(r["batch_id"], r["source_rows"], r["target_rows"]) for r in rows}


@pytest.mark.parametrize("fanout", [2, 7, 256])
def test_one_changed_value_names_its_batch(orders, fanout):
    changed = orders.withColumn("o_totalprice", F.expr("o_totalprice + if(o_orderkey = 777, 0.01, 0)"))
    assert found(orders, changed.repartition(5), fanout=fanout) == {(77, 10, 10)}


def test_order_and_place_do_not_matter(orders):
    assert found(orders, orders.orderBy(F.desc("o_custkey")).repartition(3)) == set()


def test_missing_rows_and_batches_show(orders):
    kept = orders.where("o_orderkey NOT BETWEEN 20 AND 29 AND o_orderkey <> 1499")
    assert found(orders, kept) == {(2, 10, 0), (149, 10, 9)}
    assert found(kept, orders) == {(2, 0, 10), (149, 9, 10)}
    assert found(orders.limit(0), orders.limit(0)) == set()
    assert len(found(orders, orders.limit(0))) == 150


def test_what_counts_and_sums_do_not_see(spark):
    """A row swapped for a double of another, values that trade places, NULL for an empty text, and columns that trade values."""
    rows = [(0, 1, "a", None), (0, 2, "b", ""), (1, 3, "c", "x"), (1, 4, None, "x")]
    make = lambda r: spark.createDataFrame(r, "batch_id long, k int, s string, t string")
    base = make(rows)
    for other, batch in (
        ([rows[0], rows[0], *rows[2:]], 0),
        ([(0, 1, "b", None), (0, 2, "a", ""), *rows[2:]], 0),
        ([(0, 1, "a", ""), *rows[1:]], 0),
        ([*rows[:3], (1, 4, "x", None)], 1),
    ):
        assert found(base, make(other)) == {(batch, 2, 2)}


def test_nested_and_odd_names(spark):
    df = spark.sql("SELECT id div 4 AS batch_id, map('k', id) AS `m.x`, array(id) AS a, named_struct('v', id) AS `s``t` FROM range(20)")
    other = df.withColumn("a", F.expr("if(a[0] = 9, array(0L), a)"))
    assert found(df, df) == set() and found(df, other) == {(2, 4, 4)}


def test_only_blocks_that_differ_are_compared(orders, monkeypatch):
    import sys

    module = sys.modules["tidehaul.operators.digest"]
    seen = []
    real = module._differing
    monkeypatch.setattr(module, "_differing", lambda a, b: (seen.append((a.count(), b.count())), real(a, b))[1])
    changed = orders.withColumn("o_custkey", F.expr("o_custkey + if(o_orderkey = 3, 1, 0)"))
    assert found(orders, changed, fanout=8) == {(0, 10, 10)}
    assert seen == [(1, 1), (3, 3), (8, 8), (8, 8)]
    seen.clear()
    assert found(orders, orders, fanout=8) == set() and seen == [(1, 1)]


# -- parts of equal weight ---------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("split", ["128m", "20k"])
def test_parts_have_equal_bytes(spark, parts, split):
    """Texts differ by a factor of thousands; the parts differ by no more than the largest text."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        docs = scan_source(spark, f"{SF01}/documents.parquet")
        size = F.octet_length("text") + 1
        placed = partition_by_weight(docs, size, parts)
        sizes = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(size).alias("s")).collect()
        total, most = docs.agg(F.sum(size), F.max(size)).first()
        assert len(sizes) == parts and placed.columns == docs.columns
        assert all(abs(r["s"] - total / parts) <= most for r in sizes)
        assert placed.exceptAll(docs).isEmpty() and placed.count() == docs.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_parts_of_edge_inputs(spark):
    empty = spark.range(0)
    assert partition_by_weight(empty, F.lit(1), 4).count() == 0
    same = spark.range(0, 100, 1, 7)
    assert partition_by_weight(same, F.lit(0), 4).count() == 100
    one = partition_by_weight(same, F.when(F.col("id") == 5, F.lit(10**6)).otherwise(1), 4)
    assert one.count() == 100
    with pytest.raises(ValueError):
        partition_by_weight(same, F.lit(1), 0)


def test_only_weights_leave_the_jvm(spark):
    docs = scan_source(spark, f"{SF01}/documents.parquet")
    plan = partition_by_weight(docs, F.octet_length("text"), 4)._jdf.queryExecution().executedPlan().toString()
    arrow = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "before(__weight" in arrow and plan.count("Exchange") <= 2


# -- records by block --------------------------------------------------------


@pytest.fixture
def tiny_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_whatever_the_blocks(spark, tiny_blocks):
    """Texts of many lines, quotes and commas; blocks begin anywhere, in quotes too."""
    rng = random.Random(2)
    texts = ["".join(rng.choice(['"', "\n", ",", "a", '""', "\r\n", "ü"]) for _ in range(rng.randrange(60))) for _ in range(700)]
    texts += ["\n" * 5000, '"' * 3001, "", None, "x" * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, s string").repartition(3)
    lines = encode_copy_rows(df.withColumn("batch_id", F.col("id") % 2), ["id", "s"], carry=["batch_id"])
    path = scratch_path(spark, "test")
    stage_copy_files(lines, path)
    blocks = spark.read.text(path, recursiveFileLookup=True).rdd.getNumPartitions()
    assert blocks > 30
    assert target_row_count(spark, path, df.schema).first()[0] == len(texts)
    assert staged_records(spark, path).count() == 6
    assert read_staged(spark, path, df.schema).count() == len(texts)


def test_records_of_documents_and_packed_files(spark, tiny_blocks):
    docs = scan_source(spark, f"{SF001}/documents.parquet")
    lines = encode_copy_rows(docs, docs.columns, carry=[F.lit(0).alias("batch_id")])
    for compression in ("none", "gzip"):
        path = scratch_path(spark, "test")
        stage_copy_files(lines, path, compression=compression)
        assert target_row_count(spark, path, docs.schema).first()[0] == docs.count()


def test_records_of_nothing(spark):
    path = tempfile.mkdtemp(prefix="run-")
    assert target_row_count(spark, path, None).first()[0] == 0
    open(os.path.join(path, "part-0.txt"), "w").close()
    assert target_row_count(spark, path, None).first()[0] == 0
