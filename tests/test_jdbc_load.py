"""JDBC loads that deliver every batch once, and a target read as a catalog. The database is inside this process."""

import sys
import tempfile

import pytest
from places import SF001
from pyspark.sql import functions as F

from tidehaul.operators import CountMismatch, reconcile_columns
from tidehaul.session import scratch_path
from tidehaul.sinks import TargetCatalog, jdbc_ledger, jdbc_row_count, load_jdbc, load_jdbc_batches
from tidehaul.sinks.jdbc_load import ATTEMPT_COL, BATCH_COL, Database
from tidehaul.sinks.targets import OtherBatches
from tidehaul.sources import footer_row_count, footer_statistics, scan_source

module = sys.modules["tidehaul.sinks.jdbc_load"]


@pytest.fixture
def url():
    return f"jdbc:derby:{tempfile.mkdtemp(prefix='run-')}/db;create=true"


@pytest.fixture(scope="module")
def orders(spark):
    return scan_source(spark, f"{SF001}/orders.parquet", position=True)


def content(df):
    return df.drop("_src_file", "_src_row")


def back(spark, url, table, like):
    options = {"url": url, "dbtable": f'"{table}"', "preferTimestampNTZ": "true"}
    read = spark.read.format("jdbc").options(**options).load()
    assert read.columns == content(like).columns
    return read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in content(like).schema])


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


@pytest.mark.parametrize("layout", ["partition", "position", ["o_orderkey"]], ids=str)
def test_every_batch_arrives_once(spark, orders, url, layout):
    df = orders if layout == "position" else content(orders)
    load = load_jdbc_batches(df, url, "orders", batch_size=100, layout=layout, load_id="one")
    assert same(back(spark, url, "orders", orders), content(orders))
    assert tuple(load.counts.first()) == (1500, 1500, 0, True)
    ledger = load.ledger.sort("batch_id").collect()
    assert [r["rows"] for r in ledger] == [100] * 15 and ledger[-1]["loaded_rows"] == 1500
    kept = {r["batch_id"]: (r["rows"], r["status"]) for r in jdbc_ledger(spark, url, "orders", "one").collect()}
    assert kept == {r["batch_id"]: (100, "LOADED") for r in ledger}
    with pytest.raises(ValueError, match="in place already"):
        load_jdbc_batches(df, url, "orders", batch_size=100, layout=layout, load_id="one")


def test_append_is_verified_and_not_repeated(spark, orders, url):
    """Appending twice under one id adds the rows once; under another id it adds them again."""
    load_jdbc_batches(orders, url, "orders", batch_size=500)
    for load_id, rows in (("a", 3000), ("a", 3000), ("b", 4500)):
        load = load_jdbc_batches(orders, url, "orders", batch_size=500, mode="append", load_id=load_id)
        assert tuple(load.counts.first()) == (1500, 1500, 0, True)
        assert jdbc_row_count(spark, url, '"orders"').first()[0] == rows


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_task_lost_after_its_commit_leaves_no_double_rows(spark, orders, url, monkeypatch, mode):
    """All tasks write, are lost, and write again: the landing table has each batch under two attempts."""
    real = module._land

    def twice(*args):
        real(*args)
        real(*args)
        counted = Database(spark, args[2]).read(f'SELECT COUNT(*) AS n FROM "{args[3]}"').first()[0]
        assert counted == 3000

    monkeypatch.setattr(module, "_land", twice)
    load = load_jdbc_batches(orders, url, "orders", batch_size=100, mode=mode)
    assert same(back(spark, url, "orders", orders), content(orders)) and load.counts.first()["match"]


def test_parts_of_attempts_are_taken_out(spark, orders, url, monkeypatch):
    """The earliest attempt at some batches is there in part only, as a database without transactions would leave it."""
    real = module._land

    def partly(*args):
        real(*args)
        with Database(spark, args[2]).transaction() as db:
            db.run(f'DELETE FROM "{args[3]}" WHERE "{BATCH_COL}" < 3 AND "o_orderkey" > 50 AND "o_orderkey" < 270')
        real(*args)

    monkeypatch.setattr(module, "_land", partly)
    load_jdbc_batches(orders, url, "orders", batch_size=100)
    assert same(back(spark, url, "orders", orders), content(orders))


def test_a_batch_that_is_not_whole_leaves_the_target_alone(spark, orders, url, monkeypatch):
    load_jdbc_batches(orders, url, "orders", batch_size=100)
    real = module._land

    def short(*args):
        real(*args)
        with Database(spark, args[2]).transaction() as db:
            assert db.run(f'DELETE FROM "{args[3]}" WHERE "o_orderkey" = 7') == 1

    monkeypatch.setattr(module, "_land", short)
    for mode in ("overwrite", "append"):
        with pytest.raises(CountMismatch, match="1 of 15 batches"):
            load_jdbc_batches(orders, url, "orders", batch_size=100, mode=mode, load_id=mode)
        assert jdbc_row_count(spark, url, '"orders"').first()[0] == 1500
    # The same id goes on where it broke off, and sends that batch alone.
    monkeypatch.setattr(module, "_land", real)
    sent = []
    monkeypatch.setattr(module, "_land", lambda rows, *a: (sent.append(rows.count()), real(rows, *a)))
    load = load_jdbc_batches(orders, url, "orders", batch_size=100, load_id="overwrite")
    assert sent == [100] and load.counts.first()["match"]
    assert same(back(spark, url, "orders", orders), content(orders))


def test_a_failure_while_putting_in_place_is_rolled_back(spark, orders, url, monkeypatch):
    load_jdbc_batches(orders, url, "orders", batch_size=100)

    def fails(self, *args):
        raise RuntimeError("gone")

    monkeypatch.setattr(Database, "rename", fails)
    with pytest.raises(RuntimeError, match="gone"):
        load_jdbc_batches(orders, url, "orders", batch_size=100, load_id="again")
    assert jdbc_row_count(spark, url, '"orders"').first()[0] == 1500
    monkeypatch.undo()
    load_jdbc_batches(orders, url, "orders", batch_size=100, load_id="again")
    assert same(back(spark, url, "orders", orders), content(orders))
    left = {r["table_name"] for r in TargetCatalog(spark, url).tables().collect()}
    assert {n for n in left if n.startswith("orders")} == {"orders", "orders__batches"}


def test_rejected_batches_stay_out(spark, orders, url):
    load = load_jdbc_batches(orders, url, "orders", batch_size=100, check=F.col("o_orderkey") == 250, load_id="x")
    assert {r["batch_id"] for r in load.ledger.where("status = 'FAILED'").collect()} == {2}
    assert tuple(load.counts.first()) == (1500, 1400, 100, False)
    # Sent again without the rule, the failed batch alone is added.
    load = load_jdbc_batches(orders, url, "orders", batch_size=100, mode="append", load_id="x")
    assert load.counts.first()["match"] and same(back(spark, url, "orders", orders), content(orders))


def test_other_batches_are_refused(spark, orders, url):
    load_jdbc_batches(orders, url, "orders", batch_size=100, mode="append", load_id="x")
    with pytest.raises(OtherBatches):
        load_jdbc_batches(orders, url, "orders", batch_size=200, mode="append", load_id="x")


def test_empty_and_nested_sources(spark, url):
    empty = spark.range(0).withColumn("s", F.lit("x"))
    assert load_jdbc_batches(empty, url, "nothing").counts.first()["match"]
    assert jdbc_row_count(spark, url, '"nothing"').first()[0] == 0
    path = scratch_path(spark, "test")
    spark.range(50).selectExpr("id", "array(id, 1) AS a", "CASE WHEN id % 2 = 0 THEN 'x,\"y' END AS s").write.parquet(path)
    load = load_jdbc_batches(scan_source(spark, path), url, "nested", batch_size=20, max_connections=2)
    assert load.counts.first()["match"]
    rows = spark.read.format("jdbc").options(url=url, dbtable='"nested"').load().collect()
    assert {r["a"] for r in rows} == {f"[{k},1]" for k in range(50)} and sum(r["s"] is None for r in rows) == 25


# -- the target as a catalog -------------------------------------------------


def test_catalog_lists_and_counts_a_live_target(spark, orders, url):
    load_jdbc_batches(orders, url, "orders", batch_size=500)
    load_jdbc(content(orders).limit(5), url, "Plain")
    catalog = TargetCatalog(spark, url)
    assert {"orders", "PLAIN"} <= {r["table_name"] for r in catalog.tables().collect()}
    listed = [(r["column_name"], r["position"], r["target_type"]) for r in catalog.columns("orders").collect()]
    assert listed[0] == ("o_orderkey", 1, "BIGINT") and [n for n, *_ in listed] == content(orders).columns
    counted = catalog.row_count("APP.orders")
    assert counted.first()[0] == 1500 and catalog.row_count("plain").first()[0] == 5
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregates: [COUNT(*)]" in plan
    values = catalog.value_counts("orders")
    assert "COUNT(o_custkey)" in values._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r)[1:] for r in values.collect()} == {(1500, 1500)}
    with pytest.raises(LookupError):
        catalog.table("none")
    assert spark.conf.get("spark.sql.catalog.target", None) is None


def test_columns_of_a_live_target_are_reconciled(spark, orders, url):
    changed = content(orders).drop("o_orderstatus").withColumn("o_custkey", F.when(F.col("o_custkey") > 40, F.col("o_custkey")))
    load_jdbc_batches(changed.withColumn("more", F.lit(1)), url, "orders")
    found = TargetCatalog(spark, url).reconcile(content(orders), "orders")
    status = {r["column_name"]: r["status"] for r in found.collect()}
    assert status["o_orderstatus"] == "missing" and status["more"] == "extra" and status["o_custkey"] == "null_diff"
    assert {s for c, s in status.items() if c not in ("o_orderstatus", "more", "o_custkey")} == {"ok"}
    assert reconcile_columns(content(orders), content(orders)).where("status <> 'ok'").isEmpty()


# -- footers -----------------------------------------------------------------


def test_footers_answer_counts(spark):
    path = scratch_path(spark, "test")
    spark.range(0, 1000, 1, 4).selectExpr(
        "id", "CASE WHEN id % 4 > 0 THEN 'x' END AS `a.b`", "array(id) AS list", "CAST(NULL AS DATE) AS d"
    ).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counted = footer_row_count(spark, path)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and counted.first()[0] == 1000
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    rows = [tuple(r) for r in footer_statistics(spark, path).collect()]
    assert rows == [("id", 1000, 1000, 0), ("a.b", 1000, 750, 250), ("d", 1000, 0, 1000)]
    assert footer_statistics(spark, path, []).isEmpty()
