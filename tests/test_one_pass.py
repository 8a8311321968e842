"""Staging in one pass, and staged files sent on by the tasks that open them."""

import os
import sys
import tempfile

import pytest
from places import ROOT, SF001
from pyspark.sql import functions as F
from test_sinks import ask, content, database, ledger_of, standin  # noqa: F401

from tidehaul.functions import encode_copy_rows
from tidehaul.operators import batch_by_position
from tidehaul.plans import bulk_load
from tidehaul.plans.bulk_load import encoded_batches
from tidehaul.session import scratch_path
from tidehaul.sinks import (
    FolderTarget,
    copy_ledger,
    copy_progress,
    copy_staged,
    copy_summary,
    load_copy,
    read_staged,
    stage_batches,
    stage_once,
)
from tidehaul.sinks.one_pass import qualified
from tidehaul.sinks.stream import FileStream
from tidehaul.sources import scan_source


@pytest.fixture(scope="module", autouse=True)
def standin_on_workers(spark):
    spark.sparkContext.addPyFile(f"{ROOT}/tests/standin.py")


@pytest.fixture(scope="module")
def orders(spark):
    return scan_source(spark, f"{SF001}/orders.parquet", position=True)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many_files(spark):
    """1000 rows in seven files whose borders are no borders of batches."""
    path = scratch_path(spark, "test")
    spark.range(0, 1000, 1, 7).selectExpr("id", "repeat('x', cast(id % 50 AS INT)) AS s").write.parquet(path)
    return path


def test_rows_are_read_once_and_move_nowhere(spark, orders):
    """The one write has one scan of the source's columns; by position nothing is exchanged, by key once."""
    schema = content(orders).schema
    refused = F.col("o_totalprice") < 0
    by_position = plan_of(encoded_batches(orders, schema, None, 100, refused, "lossless", 1000))
    assert by_position.count("o_totalprice") and by_position.count("orders.parquet") == 1
    assert "Exchange hashpartitioning" not in by_position and "Exchange rangepartitioning" not in by_position
    by_key = plan_of(encoded_batches(orders, schema, "o_orderkey", 100, refused, "lossless", 1000))
    assert by_key.count("orders.parquet") == 1 and by_key.count("REPARTITION_BY_NUM") + by_key.count("Exchange direct") <= 1


def test_bulk_load_writes_once_and_reads_no_column_again(spark, orders, monkeypatch):
    """Besides the one write, only row counts and the tasks' reports are read."""
    module = sys.modules["tidehaul.plans.bulk_load"]

    seen = []
    real = module.stage_batches
    monkeypatch.setattr(module, "stage_batches", lambda lines, *a, **k: (seen.append(lines), real(lines, *a, **k))[1])
    load = bulk_load(spark, f"{SF001}/orders.parquet", "o", batch_size=100, strict=True)
    assert len(seen) == 1
    counted = plan_of(load.counts)
    assert "PushedAggregation: [COUNT(*)]" in counted and "o_totalprice" not in counted
    for report in (load.ledger, load.manifest):
        assert "orders.parquet" not in plan_of(report)


def test_reports_are_what_the_files_hold(spark, many_files):
    load = bulk_load(spark, many_files, "t", batch_size=100, batches_per_folder=3)
    files = {r["file"]: r for r in load.manifest.collect()}
    assert sum(r["rows"] for r in files.values()) == 1000 and len(files) > 10  # some batches lie across tasks
    for file, row in files.items():
        place = file.removeprefix("file://")
        with open(place, "rb") as f:
            data = f.read()
        assert len(data) == row["bytes"] and data.count(b"\n") == row["rows"]
        assert f"batch_range={row['first_batch'] // 3}/" in file
    assert read_staged(spark, load.path, load.schema).exceptAll(spark.read.parquet(many_files)).isEmpty()
    assert bulk_load(spark, many_files, "t", batch_size=100, verify="files", compression="bzip2").counts.first()["match"]


def test_no_file_of_a_failed_batch_stays(spark, many_files):
    """A rejected row takes out its whole batch, also the parts that other tasks have written."""
    for bad in (0, 142, 143, 285, 999):
        load = bulk_load(spark, many_files, "t", batch_size=100, check=F.col("id") == bad, batches_per_folder=4)
        batches = {r["batch_id"]: r for r in load.ledger.collect()}
        assert {b for b, r in batches.items() if r["status"] == "FAILED"} == {bad // 100}
        assert [batches[b]["rows"] for b in sorted(batches)] == [100] * 10
        assert bad // 100 not in {r["first_batch"] for r in load.manifest.collect()}
        back = {r["id"] for r in read_staged(spark, load.path, load.schema).collect()}
        assert back == {k for k in range(1000) if k // 100 != bad // 100}
        assert tuple(load.counts.first())[:3] == (1000, 900, 100)


def test_a_lost_task_leaves_nothing_twice(spark, many_files):
    """A task that dies after it has written some files is run again, and takes their names."""
    mark = os.path.join(tempfile.mkdtemp(prefix="run-"), "died")

    @F.udf("boolean")
    def dies_once(k):
        if k == 700:
            try:
                os.close(os.open(mark, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            raise RuntimeError("lost")
        return False

    load = bulk_load(spark, many_files, "t", batch_size=30, check=dies_once(F.col("id")), strict=True)
    assert os.path.exists(mark)
    assert read_staged(spark, load.path, load.schema).groupBy("id").count().where("count > 1").isEmpty()
    assert load.manifest.agg(F.sum("rows")).first()[0] == 1000


def test_batches_of_mixed_runs(spark):
    """Rows of a batch that are not side by side go to several files; nothing is lost or refused."""
    rows = spark.range(0, 200, 1, 3).selectExpr("id", "id % 5 AS batch_id", "id = 33 AS refused")
    lines = encode_copy_rows(rows, ["id"], carry=["batch_id", "refused"])
    staged = stage_batches(lines, scratch_path(spark, "test"))
    found = {r["batch_id"]: (r["rows"], r["status"]) for r in staged.batches.collect()}
    assert found == {b: (40, "FAILED" if b == 3 else "LOADED") for b in range(5)}
    assert staged.manifest.agg(F.sum("rows")).first()[0] == 160


def test_a_place_is_used_once(spark, many_files):
    path = scratch_path(spark, "test")
    bulk_load(spark, many_files, "t", path=path)
    with pytest.raises(FileExistsError):
        bulk_load(spark, many_files, "t", path=path)
    with pytest.raises(ValueError):
        bulk_load(spark, many_files, "t", compression="other")
    with pytest.raises(ValueError):
        bulk_load(spark, many_files, "t", verify="nothing")


def test_paths_are_uris(spark):
    assert qualified(spark, "/a/b/") == "file:///a/b" and qualified(spark, "file:/a") == "file:///a"
    assert qualified(spark, "file:///a/") == "file:///a" and qualified(spark, "hdfs://n/a") == "hdfs://n/a"


def test_a_load_can_end_in_the_target(spark, many_files, database):  # noqa: F811
    options = {"batch_size": 100, "check": F.col("id") == 250, "compression": "gzip"}
    load = bulk_load(spark, many_files, "t", target=standin(database), load_id="one", **options)
    assert ask(database, "SELECT count(*), count(DISTINCT id) FROM t") == [(900, 900)]
    assert sum(n for n, _ in ledger_of(database, "t").values()) == 900
    assert load.sent.seconds > 0 and load.sent.plan.load_id == "one"


@pytest.mark.parametrize("bytes_in_task", [1, 5000, 1 << 30])
def test_files_are_dealt_by_bytes(spark, many_files, bytes_in_task, monkeypatch):
    """However many tasks share the files, each file is sent once; only names are exchanged."""
    module = sys.modules["tidehaul.sinks.copy_load"]

    staged = bulk_load(spark, many_files, "t", batch_size=50)
    sent = []
    real = module._send
    monkeypatch.setattr(module, "_send", lambda s, rows, *a: (sent.append(rows), real(s, rows, *a))[1])
    target = FolderTarget(scratch_path(spark, "test"))
    load = copy_staged(spark, staged.path, staged.schema, target, "t", files=staged.manifest, bytes_in_task=bytes_in_task)
    (names,) = sent
    assert names.columns == ["batch_id", "file", "rows"] and "FileScan text" not in plan_of(names)
    files, size = staged.manifest.count(), staged.manifest.agg(F.sum("bytes")).first()[0]
    assert names.rdd.getNumPartitions() == min(files, -(-size // bytes_in_task))
    back = read_staged(spark, target.data_paths("t"), staged.schema)
    assert back.count() == 1000 and back.exceptAll(spark.read.parquet(many_files)).isEmpty()
    summary = copy_summary(spark, load).first()
    assert summary["loaded_rows"] == 1000 and summary["seconds"] > 0 and summary["rows_per_second"] > 0
    assert copy_ledger(spark, load).count() == files


def test_progress_before_a_load_is_done(spark):
    """What has arrived is seen while the load is not finished; here its one task fails on the way."""

    @F.udf("boolean")
    def dies(k):
        if k == 999:
            raise RuntimeError("lost")
        return False

    path = scratch_path(spark, "test")
    spark.range(0, 1000, 1, 2).selectExpr("id", "repeat('x', 5000) AS s").write.parquet(path)
    begun = []
    source, target = scan_source(spark, path), FolderTarget(scratch_path(spark, "test"))
    options = {"batch_size": 10, "max_connections": 1, "load_id": "x"}
    rows_at_once = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_at_once)
    spark.conf.set(rows_at_once, "20")
    try:
        with pytest.raises(Exception, match="lost"):
            load_copy(source, target, "t", check=dies(F.col("id")), on_start=begun.append, **options)
    finally:
        spark.conf.set(rows_at_once, before)
    row = copy_progress(spark, begun[0]).first()
    assert 0 < row["loaded_rows"] < 1000 == row["source_rows"] and 0 < row["percent"] < 100
    load = load_copy(source, target, "t", **options)
    assert tuple(copy_progress(spark, load).first())[1:] == (0, 1000, 1000, 100.0)


def test_a_file_is_read_in_pieces():
    folder = tempfile.mkdtemp(prefix="run-")
    with open(f"{folder}/x.csv", "wb") as f:
        f.write(b"line\n" * 100_000)
    with FileStream(1, f"file://{folder}/x.csv", 100_000) as stream:
        assert stream.source is None
        room, total = bytearray(1000), 0
        while n := stream.readinto(room):
            assert n <= 1000
            total += n
    assert total == 500_000 and stream.source.closed


def test_position_batches_keep_their_order_beyond_the_broadcast_bound(spark, many_files):
    """Offsets that are joined on slices exchange the rows; they are sorted again, so that batches stay in few files."""
    scanned = scan_source(spark, many_files, position=True)
    batched = batch_by_position(scanned, 100, max_broadcast_files=0)
    lines = encode_copy_rows(batched, ["id", "s"], carry=["batch_id", F.lit(False).alias("refused")])
    pieces = stage_once(lines, scratch_path(spark, "test"))
    assert pieces.agg(F.sum("rows")).first()[0] == 1000 and pieces.count() <= 10 + 7
