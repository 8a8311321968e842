"""Sinks: staged files, JDBC, and COPY with failures, lost connections and second attempts."""

import os
import sqlite3
import tempfile

import pytest
from places import ROOT, SF001, SF01
from pyspark.sql import functions as F

from tidehaul.functions import encode_copy_rows
from tidehaul.operators import (
    CountMismatch,
    batch_by_position,
    isolate_failed_batches,
    reconcile_columns,
    reconcile_counts,
    rows_of_loaded_batches,
)
from tidehaul.plans import bulk_load
from tidehaul.session import clean_scratch, scratch_path, shared_folder
from tidehaul.sinks import (
    FolderTarget,
    PostgresTarget,
    copy_counts,
    copy_ledger,
    copy_staged,
    jdbc_columns,
    jdbc_row_count,
    load_copy,
    load_jdbc,
    read_staged,
    stage_copy_files,
    staged_manifest,
    target_row_count,
)
from tidehaul.sinks.targets import OtherBatches, beside
from tidehaul.sources import scan_source, source_row_count


@pytest.fixture(scope="module", autouse=True)
def standin_on_workers(spark):
    spark.sparkContext.addPyFile(f"{ROOT}/tests/standin.py")


@pytest.fixture
def database():
    return os.path.join(tempfile.mkdtemp(prefix="run-"), "db")


@pytest.fixture(scope="module")
def orders(spark):
    return scan_source(spark, f"{SF001}/orders.parquet", position=True)


def standin(path, **options):
    return PostgresTarget("standin:connect", {"path": path, **options})


def ask(path, query):
    with sqlite3.connect(path) as db:
        return db.execute(query).fetchall()


def ledger_of(path, table="orders"):
    rows = ask(path, f"SELECT batch_id, row_count, status FROM {table}__batches WHERE batch_id >= 0 ORDER BY batch_id")
    return {b: (n, s) for b, n, s in rows}


def content(orders):
    return orders.drop("_src_file", "_src_row")


# -- COPY --------------------------------------------------------------------


@pytest.mark.parametrize("layout", ["partition", "position", ["o_orderkey"]], ids=str)
def test_copy_delivers_every_row(spark, orders, database, layout):
    df = orders if layout == "position" else content(orders)
    load_copy(df, standin(database), "orders", batch_size=100, layout=layout)
    got = {(int(k), float(p)) for k, p in ask(database, "SELECT o_orderkey, o_totalprice FROM orders")}
    assert got == {(r["o_orderkey"], r["o_totalprice"]) for r in orders.collect()}
    ledger = ledger_of(database)
    assert [n for n, _ in ledger.values()] == [100] * 15
    assert {s for _, s in ledger.values()} == {"LOADED"}


def test_copy_of_edge_text(spark, database):
    texts = [None, "", " ", 'a"b', "a,b", "a\nb", "a\r\nb", "\\.", "\\N", "ÄÖ😀", "x" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    load_copy(df, standin(database), "t", batch_size=4)
    assert [s for _, s in sorted((int(i), s) for i, s in ask(database, "SELECT id, s FROM t"))] == texts


def test_overwrite_and_append(orders, database):
    df = content(orders)
    load_copy(df, standin(database), "orders", batch_size=400)
    load_copy(df, standin(database), "orders", batch_size=400)
    assert ask(database, "SELECT count(*) FROM orders") == [(1500,)]
    load_copy(df, standin(database), "orders", batch_size=400, mode="append")
    assert ask(database, "SELECT count(*) FROM orders") == [(3000,)]
    with pytest.raises(ValueError):
        load_copy(df, standin(database), "orders", mode="other")


def test_rejected_rows_fail_their_batch_only(orders, database):
    rule = F.col("o_orderkey") == 250
    load_copy(orders, standin(database), "orders", batch_size=100, layout="position", check=rule)
    ledger = ledger_of(database)
    assert {b for b, (_, s) in ledger.items() if s == "FAILED"} == {2}
    assert ask(database, "SELECT count(*) FROM orders") == [(1400,)]


def test_refused_batch_is_recorded_and_the_rest_loads(orders, database):
    load_copy(orders, standin(database, refuse="777"), "orders", batch_size=100, layout="position")
    refused = orders.where("o_orderkey = 777 OR o_custkey = 777").select((F.col("_src_row") / 100).cast("int"))
    expected = {r[0] for r in refused.distinct().collect()}
    ledger = ledger_of(database)
    assert {b for b, (_, s) in ledger.items() if s == "FAILED"} == expected
    assert ask(database, "SELECT count(*) FROM orders") == [(1500 - 100 * len(expected),)]
    messages = ask(database, "SELECT DISTINCT message FROM orders__batches WHERE status = 'FAILED'")
    assert messages == [("value '777' refused",)]


def test_strict_load_keeps_the_old_table(orders, database):
    load_copy(orders, standin(database), "orders", batch_size=100, layout="position")
    with pytest.raises(Exception, match="failed, the target was left as it was"):
        load_copy(
            orders, standin(database), "orders", batch_size=100, layout="position",
            check=F.col("o_orderkey") == 250, strict=True,
        )
    assert ask(database, "SELECT count(*) FROM orders") == [(1500,)]


def test_failed_batches_are_tried_again_under_the_same_id(orders, database):
    first = load_copy(
        orders, standin(database, refuse="777"), "orders", batch_size=100, layout="position", mode="append"
    )
    assert "FAILED" in {s for _, s in ledger_of(database).values()}
    load_copy(
        orders, standin(database), "orders", batch_size=100, layout="position", mode="append",
        load_id=first.plan.load_id,
    )
    assert {s for _, s in ledger_of(database).values()} == {"LOADED"}
    assert ask(database, "SELECT count(*), count(DISTINCT o_orderkey) FROM orders") == [(1500, 1500)]


@pytest.mark.parametrize("when", ["before commit", "after commit"])
def test_lost_connection_leaves_no_duplicates(orders, database, when):
    """The task dies with its connection, is started again, and finds what it had committed."""
    load_copy(orders, standin(database, lose=when), "orders", batch_size=100, layout="position")
    assert os.path.exists(database + ".lost")
    assert ask(database, "SELECT count(*), count(DISTINCT o_orderkey) FROM orders") == [(1500, 1500)]
    assert {s for _, s in ledger_of(database).values()} == {"LOADED"}


@pytest.mark.parametrize("kind", ["database", "folder"])
def test_other_batches_are_not_taken_for_the_same(spark, orders, database, kind):
    """Batches of another size or source under an old load id would skip rows that never arrived."""
    target = standin(database) if kind == "database" else FolderTarget(scratch_path(spark, "test"))
    load_id = load_copy(orders, target, "orders", batch_size=100, layout="position", mode="append").plan.load_id
    more = {"layout": "position", "mode": "append", "load_id": load_id}
    load_copy(orders, target, "orders", batch_size=100, **more)
    with pytest.raises(OtherBatches):
        load_copy(orders, target, "orders", batch_size=50, **more)
    with pytest.raises(OtherBatches):
        load_copy(orders, target, "orders", batch_size=100, **{**more, "layout": "partition"})
    with pytest.raises(OtherBatches):
        load_copy(scan_source(spark, f"{SF01}/orders.parquet", position=True), target, "orders", batch_size=100, **more)


def test_in_place_batches_depend_on_the_split(spark, database):
    path = scratch_path(spark, "test")
    spark.range(0, 3000, 1, 6).write.parquet(path)
    target = standin(database)
    load_id = load_copy(scan_source(spark, path), target, "t", batch_size=100, mode="append").plan.load_id
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        with pytest.raises(OtherBatches):
            load_copy(scan_source(spark, path), target, "t", batch_size=100, mode="append", load_id=load_id)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_lopsided_scan_is_spread(spark, database):
    """One file with one row group is one task; the position of its rows lets others help."""
    path = scratch_path(spark, "test")
    spark.range(0, 5000, 1, 1).write.parquet(path)
    load_copy(scan_source(spark, path, position=True), standin(database), "t", batch_size=100)
    assert list(ledger_of(database, "t")) == list(range(50))
    assert ask(database, "SELECT count(*), count(DISTINCT id) FROM t") == [(5000, 5000)]


def test_a_load_in_place_is_not_replaced_by_nothing(orders, database):
    """Its batches are marked as sent, so another run would land an empty table."""
    options = {"batch_size": 100, "layout": "position"}
    load_id = load_copy(orders, standin(database, refuse="777"), "orders", **options).plan.load_id
    assert ask(database, "SELECT count(*) FROM orders")[0][0] < 1500
    with pytest.raises(ValueError, match="in place already"):
        load_copy(orders, standin(database), "orders", load_id=load_id, **options)
    load_copy(orders, standin(database), "orders", load_id=load_id, mode="append", **options)
    assert ask(database, "SELECT count(*), count(DISTINCT o_orderkey) FROM orders") == [(1500, 1500)]


def test_strict_load_goes_on_where_it_broke_off(orders, database):
    options = {"batch_size": 100, "layout": "position", "strict": True, "load_id": "again"}
    with pytest.raises(Exception, match="left as it was"):
        load_copy(orders, standin(database, refuse="777"), "orders", **options)
    before = dict(ask(database, "SELECT batch_id, finished_at FROM orders__batches WHERE status = 'LOADED'"))
    load_copy(orders, standin(database), "orders", **options)
    after = dict(ask(database, "SELECT batch_id, finished_at FROM orders__batches WHERE batch_id >= 0"))
    assert before.items() <= after.items() and len(after) == 15
    assert ask(database, "SELECT count(*), count(DISTINCT o_orderkey) FROM orders") == [(1500, 1500)]


def test_derived_names_fit_the_target():
    assert beside("s.orders", "__batches") == "s.orders__batches"
    long = beside("s." + "ä" * 60, "__load_0123456789ab")
    assert long.startswith("s.ä") and len(long.split(".")[1].encode()) <= 63
    assert long.endswith("__load_0123456789ab")
    assert beside("s." + "t" * 62 + "a", "__batches") != beside("s." + "t" * 62 + "b", "__batches")


def test_folder_target(spark, orders):
    target = FolderTarget(scratch_path(spark, "test"))
    schema = content(orders).schema
    load = load_copy(orders, target, "orders", batch_size=100, layout="position", check=F.col("o_orderkey") == 250)
    ledger = {r["batch_id"]: r["status"] for r in copy_ledger(spark, load).collect()}
    assert len(ledger) == 15 and [b for b, s in ledger.items() if s == "FAILED"] == [2]
    assert target_row_count(spark, target.data_paths("orders"), schema).first()[0] == 1400
    # The same load again, without the rule: only the failed batch is new.
    load_copy(orders, target, "orders", batch_size=100, layout="position", load_id=load.plan.load_id)
    back = read_staged(spark, target.data_paths("orders"), schema)
    assert back.exceptAll(content(orders)).isEmpty() and back.count() == 1500
    load_copy(orders, target, "orders", batch_size=100, layout="position", mode="append")
    assert target_row_count(spark, target.data_paths("orders"), schema).first()[0] == 3000


@pytest.mark.parametrize("layout", ["position", "partition", ["id"]], ids=str)
def test_connections_can_be_capped_in_every_layout(spark, layout):
    from tidehaul.sinks.copy_load import batches_in_place, how_cut

    path = scratch_path(spark, "test")
    spark.range(0, 1000, 1, 10).write.parquet(path)
    df = scan_source(spark, path, position=True)
    load = load_copy(df, FolderTarget(scratch_path(spark, "test")), "t", batch_size=50, layout=layout, max_connections=2)
    assert copy_ledger(spark, load).agg(F.sum("rows")).first()[0] == 1000
    batched = batches_in_place(df, 50, layout, how_cut(df, 50, layout)[0], 2)
    assert batched.select(F.spark_partition_id().alias("p")).distinct().count() <= 2


def rewritten(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "id long").repartition(1).write.mode("overwrite").parquet(path)
    return scan_source(spark, path), scan_source(spark, path, position=True)


@pytest.mark.parametrize("layout", ["partition", "position", ["id"]], ids=str)
def test_a_rewritten_source_is_not_continued(spark, database, layout):
    """Equal counts, and keys whose hashes would cancel out in pairs, are still other rows."""
    path = scratch_path(spark, "test")
    options = {"batch_size": 2, "layout": layout, "mode": "append", "load_id": "same"}
    load_copy(rewritten(spark, path, [1, 1, 5, 7])[1], standin(database, refuse="5"), "t", **options)
    with pytest.raises(OtherBatches):
        load_copy(rewritten(spark, path, [9, 9, 5, 7])[1], standin(database), "t", **options)
    assert sorted(ask(database, "SELECT id FROM t")) == [(1,), (1,)]


def test_values_count_where_there_are_no_files(spark, database):
    options = {"batch_size": 2, "mode": "append", "load_id": "same"}
    load_copy(spark.createDataFrame([(1,), (1,)], "id long").coalesce(1), standin(database), "t", **options)
    with pytest.raises(OtherBatches):
        load_copy(spark.createDataFrame([(9,), (9,)], "id long").coalesce(1), standin(database), "t", **options)


@pytest.mark.parametrize("kind", ["database", "folder"])
def test_a_broken_off_overwrite_is_not_continued_by_append(spark, orders, database, kind):
    """Its batches lie in the landing table, where an append would never look."""
    target = standin(database) if kind == "database" else FolderTarget(scratch_path(spark, "test"))
    options = {"batch_size": 100, "layout": "position", "load_id": "broken"}
    with pytest.raises(Exception, match="left as it was"):
        load_copy(orders, target, "orders", check=F.col("o_orderkey") == 250, strict=True, **options)
    with pytest.raises(OtherBatches, match="begun as overwrite"):
        load_copy(orders, target, "orders", mode="append", **options)
    load_copy(orders, target, "orders", strict=True, **options)


def test_strict_append_is_refused(orders, database):
    with pytest.raises(ValueError, match="overwrite"):
        load_copy(orders, standin(database), "orders", mode="append", strict=True)


def test_copy_ends_with_totals_and_counts(spark, orders):
    target = FolderTarget(scratch_path(spark, "test"))
    load = load_copy(orders, target, "orders", batch_size=100, check=F.col("o_orderkey") == 250)
    ledger = copy_ledger(spark, load).sort("batch_id").collect()
    assert [r["loaded_rows"] for r in ledger][:4] == [100, 200, 200, 300] and ledger[-1]["percent"] == 93.3
    assert {r["message"] for r in ledger} == {None, "rejected row in batch"}
    counts = copy_counts(spark, load, orders).first()
    assert (counts["source_rows"], counts["target_rows"], counts["diff"], counts["match"]) == (1500, 1400, 100, False)


def test_a_load_is_listed_once(orders, spark):
    target = FolderTarget(scratch_path(spark, "test"))
    options = {"batch_size": 100, "layout": "position", "load_id": "x"}
    for mode in ("overwrite", "append", "append"):
        load_copy(orders, target, "orders", mode=mode, **options)
    assert target.loads("orders") == ["x"]


def test_messages_are_kept_whole(database, spark):
    df = spark.createDataFrame([("v" * 5000,)], "s string")
    load_copy(df, standin(database, refuse="v" * 5000), "t", batch_size=1)
    ((message,),) = ask(database, "SELECT message FROM t__batches WHERE batch_id >= 0")
    assert len(message) > 5000


def test_staged_files_are_sent_on(spark, orders, database):
    path = scratch_path(spark, "test")
    spark.range(0, 1000, 1, 4).selectExpr("id", "repeat('a\\n\"b,', cast(id % 4 AS INT)) AS s").write.parquet(path)
    staged = bulk_load(spark, path, "t", batch_size=100, batches_per_folder=3, compression="gzip")
    options = {"batches_per_folder": 3, "load_id": "on"}
    load = copy_staged(spark, staged.path, staged.schema, standin(database), "t", **options)
    assert ask(database, "SELECT count(*), sum(id), sum(length(s)) FROM t") == [(1000, 499500, 7500)]
    assert sum(n for n, _ in ledger_of(database, "t").values()) == 1000
    with pytest.raises(ValueError, match="in place already"):
        copy_staged(spark, staged.path, staged.schema, standin(database), "t", **options)
    assert load.plan.load_id == "on"


def test_one_column_load(spark, database):
    path = scratch_path(spark, "test")
    spark.range(300).selectExpr("CASE WHEN id % 3 <> 0 THEN cast(id AS STRING) END AS s").write.parquet(path)
    load = bulk_load(spark, path, "t", batch_size=50, strict=True)
    assert load.counts.first()["target_rows"] == 300
    assert read_staged(spark, load.path, load.schema).where("s is null").count() == 100
    load_copy(scan_source(spark, path), standin(database), "t", batch_size=50)
    assert ask(database, "SELECT count(*), count(s) FROM t") == [(300, 200)]


def test_connections_can_be_capped(spark, database):
    """Two tasks share the batches of twenty partitions, which stay as they are."""
    df = spark.range(0, 1000, 1, 20)
    load_copy(df, standin(database), "t", batch_size=1000, max_connections=2)
    assert [n for n, _ in ledger_of(database, "t").values()] == [50] * 20


def test_table_names(spark, database):
    load_copy(spark.range(5).withColumnRenamed("id", 'a"b'), standin(database), "main.t x", batch_size=2)
    assert ask(database, 'SELECT sum("a""b") FROM "t x"') == [(10,)]


# -- staged files ------------------------------------------------------------


def test_manifest(spark):
    source = scan_source(spark, f"{SF01}/documents.parquet", position=True)
    names = source.columns[:-2]
    schema = source.select(*names).schema
    path = scratch_path(spark, "test")
    lines = encode_copy_rows(batch_by_position(source, 100), names, carry=["batch_id"])
    stage_copy_files(lines, path, batches_per_folder=4)
    manifest = staged_manifest(spark, path, schema, batches_per_folder=4).sort("first_batch").collect()
    assert [(m["first_batch"], m["last_batch"], m["rows"]) for m in manifest] == [(0, 3, 400), (4, 7, 400), (8, 11, 200)]
    assert all(m["bytes"] > 0 for m in manifest)


def test_loaded_rows_beyond_the_broadcast_bound(spark, orders):
    batched = batch_by_position(orders, 100)
    batches = isolate_failed_batches(batched, F.col("o_orderkey") % 300 == 7)
    small = rows_of_loaded_batches(batched, batches)
    large = rows_of_loaded_batches(batched, batches, max_broadcast_batches=0)
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert small.exceptAll(large).isEmpty() and large.count() == small.count() == 1000


def test_bulk_load(spark, orders):
    load = bulk_load(
        spark, f"{SF001}/orders.parquet", "public.orders", batch_size=100, check=F.col("o_orderkey") == 250,
        compression="gzip", not_null=["o_custkey"],
    )
    assert load.counts.first()["diff"] == 100
    summary = load.summary.first()
    assert (summary["batches"], summary["failed_batches"], summary["loaded_rows"]) == (15, 1, 1400)
    assert summary["rows_per_second"] > 0
    assert '"o_custkey" BIGINT NOT NULL' in load.create_table and load.copy_into.startswith('COPY "public"."orders"')
    back = read_staged(spark, load.path, load.schema)
    assert back.exceptAll(content(orders).where("o_orderkey NOT BETWEEN 200 AND 299")).isEmpty()
    assert back.count() == 1400
    assert load.manifest.count() == 14


def test_bulk_load_strict(spark):
    path = f"{SF001}/orders.parquet"
    assert bulk_load(spark, path, "orders", strict=True).counts.first()["match"]
    with pytest.raises(CountMismatch):
        bulk_load(spark, path, "orders", batch_size=100, strict=True, check=F.col("o_orderkey") == 0)


def test_bulk_load_of_an_empty_source(spark):
    path = scratch_path(spark, "test")
    spark.range(0).withColumn("s", F.lit("x")).write.parquet(path)
    for keys in (None, "id"):
        load = bulk_load(spark, path, "t", keys=keys, strict=True)
        assert load.ledger.isEmpty() and load.manifest.isEmpty()
        assert load.counts.first()["match"]
        assert load.summary.first()["loaded_rows"] == 0


def test_bulk_load_by_keys_of_any_kind(spark):
    path = f"{SF001}/lineitem.parquet"
    load = bulk_load(spark, path, "l", keys=["l_returnflag", "l_shipdate"], batch_size=500, rows_per_range=1000)
    assert [r["rows"] for r in load.ledger.sort("batch_id").collect()] == [500] * 12
    back = read_staged(spark, load.path, load.schema)
    assert back.exceptAll(spark.read.parquet(path)).isEmpty()
    assert load.counts.first()["match"]


# -- JDBC --------------------------------------------------------------------


@pytest.fixture
def jdbc_url():
    """A database inside this process; it has no server and no port."""
    return f"jdbc:derby:{tempfile.mkdtemp(prefix='run-')}/db;create=true"


def test_jdbc_round_trip(spark, jdbc_url):
    df = scan_source(spark, f"{SF001}/events.parquet")
    load_jdbc(df, jdbc_url, "events", batch_size=300)
    back = (
        spark.read.format("jdbc").options(url=jdbc_url, dbtable="events", preferTimestampNTZ="true").load()
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert {r["status"] for r in reconcile_columns(df, back).collect()} == {"ok"}


def test_jdbc_modes_and_nested_values(spark, jdbc_url):
    df = spark.sql("SELECT id, array(id) AS a, map('k', id) AS m, named_struct('x', id) AS s, X'01' AS b FROM range(10)")
    load_jdbc(df, jdbc_url, "t", max_connections=2)
    load_jdbc(df, jdbc_url, "t")
    assert jdbc_row_count(spark, jdbc_url, "t").first()["target_rows"] == 10
    load_jdbc(df, jdbc_url, "t", mode="append")
    assert jdbc_row_count(spark, jdbc_url, "t").first()["target_rows"] == 20
    row = spark.read.format("jdbc").options(url=jdbc_url, dbtable="t").load().where("id = 3").first()
    assert (row["a"], row["m"], row["s"], row["b"]) == ("[3]", '{"k":3}', '{"x":3}', "\\x01")


def test_catalog_listing(spark, jdbc_url):
    rows = [
        ("public", "t", "b", "integer", 2),
        ("public", "t", "a", "text", 1),
        ("other", "t", "z", "text", 3),
        ("public", "u", "z", "text", 1),
    ]
    catalog = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int"
    spark.createDataFrame(rows, catalog).write.format("jdbc").options(
        url=jdbc_url,
        dbtable="information_schema.columns",
        createTableColumnTypes="table_schema varchar(50), table_name varchar(50)",
    ).save()
    assert [tuple(r) for r in jdbc_columns(spark, jdbc_url, "public.t").collect()] == [("a", "text"), ("b", "integer")]
    assert [r[0] for r in jdbc_columns(spark, jdbc_url, "t").collect()] == ["a", "b", "z"]


def test_reconcile_counts(spark):
    a, b = source_row_count(spark.range(10)), source_row_count(spark.range(7)).withColumnRenamed("row_count", "n")
    assert tuple(reconcile_counts(a, b).first()) == (10, 7, 3, False)
    assert tuple(reconcile_counts(a, a).first()) == (10, 10, 0, True)


def test_batches_in_place_do_not_depend_on_the_connections(spark, database):
    """A load begun with few connections goes on with many, over the same batches."""
    path = scratch_path(spark, "test")
    spark.read.parquet(f"{SF001}/orders.parquet").repartition(7).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        source = scan_source(spark, path)
        load_copy(source, standin(database), "o", batch_size=40, mode="append", load_id="x", max_connections=2)
        few = ledger_of(database, "o")
        load_copy(source, standin(database), "o", batch_size=40, mode="append", load_id="x")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ledger_of(database, "o") == few and len(few) > 30
    assert ask(database, "SELECT count(*) FROM o") == [(1500,)]


def test_old_scratch_is_removed(spark):
    kept, old = scratch_path(spark, "new"), scratch_path(spark, "old")
    for path in (kept, old):
        spark.range(1).write.parquet(path)
    os.utime(old.removeprefix("file://"), (0, 0))
    assert clean_scratch(spark, older_than_hours=1000) == 1
    assert spark.read.parquet(kept).count() == 1 and not os.path.exists(old.removeprefix("file://"))


def test_shared_folder_is_the_sessions(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
