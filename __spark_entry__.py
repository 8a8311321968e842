"""

Every query reads a whole table. Batch sizes are small because the tables are:
at the default of 100,000 rows a small table would be a single batch.
"""

from __future__ import annotations

import importlib
import os
import sys
import tempfile
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehaul.functions import encode_copy_rows, nested_to_json, project_to_target
from tidehaul.operators import (
    batch_by_position,
    batch_digests,
    batch_global,
    batch_within_partition,
    co_locate_batches,
    differing_batches,
    isolate_failed_batches,
    load_ledger,
    load_summary,
    partition_by_weight,
    partition_count,
    partition_for_load,
    partition_sizes,
    profile_columns,
    reconcile_columns,
    reconcile_counts,
    rows_of_loaded_batches,
)
from tidehaul.operators.batching import MAX_PARTITIONS
from tidehaul.plans import bulk_load
from tidehaul.session import scratch_path
from tidehaul.sinks import (
    FolderTarget,
    TargetCatalog,
    copy_counts,
    copy_ledger,
    copy_staged,
    copy_summary,
    jdbc_ledger,
    jdbc_row_count,
    load_copy,
    load_jdbc,
    load_jdbc_batches,
    read_staged,
    stage_copy_files,
    staged_manifest,
    staged_records,
    target_row_count,
)
from tidehaul.sources import footer_row_count, footer_statistics, scan_source, source_row_count

# Operators for training data and their pipeline can be taken out as a whole.
_OPTIONAL = ("tidehaul.llm", "tidehaul.llm.queries", "corpus_pipeline")
_more: list = []
for _name in _OPTIONAL[1:]:
    try:
        _more.append(importlib.import_module(_name))
    except ModuleNotFoundError as missing:
        if missing.name not in _OPTIONAL:
            raise

BATCH = 1000
PARTS = 16
RANGE = 4096
PARTITION = 7000
FOLDER = 25
REJECT = "o_totalprice > 499500"
CHANGED = "o_orderkey % 10007 = 4321"
LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
    "l_shipdate"
).split()


def _scan(spark: SparkSession, sf_dir: str, table: str, **options) -> DataFrame:
    return scan_source(spark, f"{sf_dir}/{table}.parquet", **options)


# -- source, projection, encoding --------------------------------------------


def q_scan_source(spark, sf_dir):
    return _scan(spark, sf_dir, "orders")


def q_source_row_count(spark, sf_dir):
    return footer_row_count(spark, f"{sf_dir}/lineitem.parquet")


def q_footer_statistics(spark, sf_dir):
    return footer_statistics(spark, f"{sf_dir}/lineitem.parquet")


def q_profile_columns(spark, sf_dir):
    return profile_columns(_scan(spark, sf_dir, "events"))


def _typed_orders(spark, sf_dir):
    """Orders with one column for each kind of cast."""
    return _scan(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("as_int"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("as_decimal"),
        (F.col("o_orderstatus") == "F").alias("as_boolean"),
        F.to_date("o_orderdate").alias("as_date"),
        F.col("o_orderdate").alias("as_ntz"),
        F.timestamp_seconds(F.col("o_custkey") * 86399).alias("as_instant"),
        F.col("o_orderpriority").cast("binary").alias("as_binary"),
        F.array("o_orderkey", "o_custkey").alias("as_array"),
        F.create_map(F.col("o_orderkey"), F.col("o_orderstatus")).alias("as_map"),
        F.struct(
            F.col("o_orderkey").alias("k"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("p"),
        ).alias("as_struct"),
    )


def q_project_to_target(spark, sf_dir):
    return project_to_target(_typed_orders(spark, sf_dir))


def q_project_to_target_events(spark, sf_dir):
    return project_to_target(_scan(spark, sf_dir, "events"))


def q_nested_to_json(spark, sf_dir):
    vectors = _scan(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    text = nested_to_json(vectors)
    values = text.select("vec_id", F.posexplode(F.from_json("embedding", "array<double>")).alias("pos", "value"))
    return values.select("vec_id", "pos", F.round("value", 6).alias("value"))


def _encoded(table: str, key: str):
    def query(spark, sf_dir):
        df = _scan(spark, sf_dir, table)
        return encode_copy_rows(df, df.columns, carry=[key])

    return query


# -- partitions and batches --------------------------------------------------


def q_partition_for_load(spark, sf_dir):
    source = _scan(spark, sf_dir, "lineitem", position=True)
    rows = source_row_count(source).first()["row_count"]

    def report(mode: str) -> DataFrame:
        loaded = partition_for_load(source, PARTITION, rows=rows, mode=mode)
        # Partitions without rows count as well.
        every = spark.range(partition_count(rows, PARTITION, mode)).select(F.col("id").cast("int").alias("partition_id"))
        size = F.coalesce("rows", F.lit(0).cast("bigint"))
        return every.join(partition_sizes(loaded), "partition_id", "full").agg(
            F.lit(mode).alias("mode"),
            F.sum(size).alias("row_count"),
            F.lit(PARTITION).cast("bigint").alias("batch_size"),
            F.count(F.lit(1)).alias("num_partitions"),
            F.min(size).alias("min_rows"),
            F.max(size).alias("max_rows"),
        )

    return report("ceil").unionAll(report("floor"))


def q_partition_by_bytes(spark, sf_dir):
    """Lines of documents, whose lengths differ by a factor of thousands, in parts of equal bytes."""
    docs = _scan(spark, sf_dir, "documents")
    lines = encode_copy_rows(docs, docs.columns)
    size = F.octet_length("line") + 1
    parts = partition_by_weight(lines, size, PARTS).groupBy(F.spark_partition_id().alias("part"))
    parts = parts.agg(F.sum(size).alias("bytes"), F.max(size).alias("longest"))
    found = parts.agg(
        F.count(F.lit(1)).alias("num_partitions"),
        F.sum("bytes").alias("bytes"),
        F.max("longest").alias("longest_line"),
        F.max("bytes").alias("largest"),
        F.min("bytes").alias("smallest"),
    )
    share = F.col("bytes") / F.col("num_partitions")
    near = (F.col("largest") <= share + F.col("longest_line")) & (F.col("smallest") >= share - F.col("longest_line"))
    return found.select("num_partitions", "bytes", "longest_line", near.alias("even"))


def q_batch_within_partition(spark, sf_dir):
    """Rows of each batch. The load partitions are of whole batches, so those of all partitions follow each other."""
    source = _scan(spark, sf_dir, "orders", position=True)
    rows = source_row_count(source).first()["row_count"]
    each = max(PARTITION // BATCH, -(-rows // (BATCH * MAX_PARTITIONS)))
    placed = batch_by_position(source, each * BATCH, batch="part")
    placed = co_locate_batches(placed, batches=-(-rows // (each * BATCH)), batch="part").drop("part")
    batches = batch_within_partition(placed, BATCH).groupBy("part_id", "batch_no").agg(F.count(F.lit(1)).alias("rows"))
    return batches.select((F.col("part_id") * F.lit(each) + F.col("batch_no")).alias("batch_no"), "rows")


def q_batch_by_position(spark, sf_dir):
    batched = batch_by_position(_scan(spark, sf_dir, "orders", position=True), BATCH)
    return batched.select("o_orderkey", "batch_id")


def q_batch_global(spark, sf_dir):
    batched = batch_global(_scan(spark, sf_dir, "orders"), "o_orderkey", BATCH, unique=True, rows_per_range=RANGE)
    return batched.select("o_orderkey", "batch_id")


def q_batch_global_events(spark, sf_dir):
    batched = batch_global(_scan(spark, sf_dir, "events"), "event_id", BATCH, unique=True, rows_per_range=RANGE)
    return batched.select("event_id", "batch_id")


def q_batch_global_skewed(spark, sf_dir):
    """A key of three values, each far larger than a range."""
    batched = batch_global(_scan(spark, sf_dir, "lineitem"), "l_returnflag", BATCH, rows_per_range=4 * RANGE)
    return batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("l_returnflag").alias("first_key"),
        F.max("l_returnflag").alias("last_key"),
    )


# -- failures, ledger, summary -----------------------------------------------


def _orders_batches(spark, sf_dir):
    batched = batch_by_position(_scan(spark, sf_dir, "orders", position=True), BATCH)
    return batched, isolate_failed_batches(batched, F.expr(REJECT))


def _kept_batches(spark, sf_dir):
    """The batches, once written down."""
    batched, batches = _orders_batches(spark, sf_dir)
    path = scratch_path(spark, "ledger")
    batches.write.parquet(path)
    return batched, spark.read.parquet(path)


def q_isolate_failed_batches(spark, sf_dir):
    return _orders_batches(spark, sf_dir)[1]


def q_rows_of_loaded_batches(spark, sf_dir):
    batched, batches = _kept_batches(spark, sf_dir)
    return rows_of_loaded_batches(batched, batches)


def q_load_ledger(spark, sf_dir):
    return load_ledger(_kept_batches(spark, sf_dir)[1])


def q_load_summary(spark, sf_dir):
    return load_summary(load_ledger(_kept_batches(spark, sf_dir)[1]))


# -- sinks -------------------------------------------------------------------


def _staged(spark, sf_dir, table: str, batch_size: int = BATCH):
    """A table staged as COPY files; the path and the source schema."""
    source = _scan(spark, sf_dir, table, position=True)
    names = source.columns[:-2]
    lines = encode_copy_rows(batch_by_position(source, batch_size), names, carry=["batch_id"])
    path = scratch_path(spark, "staged")
    stage_copy_files(lines, path, batches_per_folder=FOLDER)
    return path, source.select(*names).schema


def q_stage_copy_files(spark, sf_dir):
    path, schema = _staged(spark, sf_dir, "documents", 20)
    return read_staged(spark, path, schema)


def q_stage_copy_manifest(spark, sf_dir):
    path, schema = _staged(spark, sf_dir, "documents", 20)
    files = staged_manifest(spark, path, schema, batches_per_folder=FOLDER)
    return files.groupBy("first_batch", "last_batch").agg(F.sum("rows").alias("rows"))


def _one_column(spark, sf_dir):
    """One nullable column: the names of customers who owe nothing."""
    source = _scan(spark, sf_dir, "customer", position=True)
    lone = source.select(F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"), "_src_file", "_src_row")
    lines = encode_copy_rows(batch_by_position(lone, 100), ["c_name"], carry=["batch_id"])
    path, schema = scratch_path(spark, "one-column"), lone.select("c_name").schema
    stage_copy_files(lines, path, batches_per_folder=FOLDER)
    return path, schema


def q_one_column_rows(spark, sf_dir):
    return read_staged(spark, *_one_column(spark, sf_dir))


def q_one_column_count(spark, sf_dir):
    return target_row_count(spark, *_one_column(spark, sf_dir))


def q_batch_global_equal_keys(spark, sf_dir):
    """The same batches by the ranges of a number and by sorted files of the text that it stands for."""
    source = _scan(spark, sf_dir, "events", position=True)
    number = source.withColumn("kind", F.ascii("event_type"))
    ranges = batch_global(number, "kind", BATCH, rows_per_range=1_000_000).select("event_id", "batch_id")
    files = batch_global(source.withColumn("kind", F.substring("event_type", 1, 1)), "kind", BATCH, rows_per_range=RANGE)
    return ranges.select(F.lit("ranges").alias("way"), "*").unionAll(
        files.select(F.lit("files").alias("way"), "event_id", "batch_id")
    )


def q_copy_staged(spark, sf_dir):
    """Staged files sent on to a target from the executors, and read there."""
    path, schema = _staged(spark, sf_dir, "documents", 20)
    target = FolderTarget(scratch_path(spark, "sent"))
    copy_staged(spark, path, schema, target, "documents", batches_per_folder=FOLDER, strict=True)
    return read_staged(spark, target.data_paths("documents"), schema)


def q_target_row_count(spark, sf_dir):
    return target_row_count(spark, *_staged(spark, sf_dir, "orders"))


def _jdbc_url(spark) -> str:
    """The database named by the session, or one inside this process.

    Other processes cannot see a database inside this one, so without a
    setting the JDBC queries need a local master.
    """
    url = spark.conf.get("spark.tidehaul.jdbc.url", None)
    if url:
        return url
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.tidehaul.jdbc.url to a database that all executors reach")
    return f"jdbc:derby:{tempfile.mkdtemp(prefix='tidehaul-')}/db;create=true"


def q_load_jdbc(spark, sf_dir):
    url, source = _jdbc_url(spark), _scan(spark, sf_dir, "orders")
    load_jdbc(source, url, "orders_loaded")
    options = {"url": url, "dbtable": "orders_loaded", "preferTimestampNTZ": "true"}
    back = spark.read.format("jdbc").options(**options).load()
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema.fields])


def q_jdbc_row_count(spark, sf_dir):
    url = _jdbc_url(spark)
    load_jdbc(_scan(spark, sf_dir, "orders"), url, "orders_loaded")
    return jdbc_row_count(spark, url, "orders_loaded")


def _jdbc_batches(spark, sf_dir):
    """Orders loaded batch by batch; some batches have rejected rows and stay out."""
    url, source = _jdbc_url(spark), _scan(spark, sf_dir, "orders", position=True)
    load = load_jdbc_batches(source, url, "orders_once", batch_size=BATCH, check=F.expr(REJECT), mode="overwrite")
    return url, load


def q_load_jdbc_batches(spark, sf_dir):
    url, _ = _jdbc_batches(spark, sf_dir)
    schema = _scan(spark, sf_dir, "orders").schema
    options = {"url": url, "dbtable": '"orders_once"', "preferTimestampNTZ": "true"}
    back = spark.read.format("jdbc").options(**options).load()
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def q_load_jdbc_ledger(spark, sf_dir):
    return _jdbc_batches(spark, sf_dir)[1].ledger


def q_load_jdbc_counts(spark, sf_dir):
    return _jdbc_batches(spark, sf_dir)[1].counts


def q_jdbc_ledger(spark, sf_dir):
    url, load = _jdbc_batches(spark, sf_dir)
    return jdbc_ledger(spark, url, "orders_once", load.plan.load_id).select("batch_id", "rows", "status")


def _changed_customers(spark, sf_dir):
    source = _scan(spark, sf_dir, "customer")
    return source.drop("c_mktsegment").withColumn("c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))


def _live_target(spark, sf_dir):
    url = _jdbc_url(spark)
    load_jdbc_batches(_changed_customers(spark, sf_dir), url, "customer_live")
    return TargetCatalog(spark, url)


def q_target_columns(spark, sf_dir):
    """The columns of a live target, as its database lists them."""
    return _live_target(spark, sf_dir).columns("customer_live").select("column_name", "position", "target_type")


def q_target_value_counts(spark, sf_dir):
    return _live_target(spark, sf_dir).value_counts("customer_live")


def q_reconcile_live_target(spark, sf_dir):
    """The source's columns against those of a live target."""
    return _live_target(spark, sf_dir).reconcile(_scan(spark, sf_dir, "customer"), "customer_live")


def _copied(spark, sf_dir):
    source = _scan(spark, sf_dir, "events", position=True)
    target = FolderTarget(scratch_path(spark, "copied"))
    return load_copy(source, target, "events", batch_size=BATCH, layout="position"), source.drop(
        "_src_file", "_src_row"
    ).schema


def q_load_copy(spark, sf_dir):
    load, _ = _copied(spark, sf_dir)
    return copy_ledger(spark, load).select("batch_id", "rows", "status")


def q_load_copy_ledger(spark, sf_dir):
    load, _ = _copied(spark, sf_dir)
    return copy_ledger(spark, load).select("batch_id", "rows", "status", "loaded_rows", "percent")


def q_load_copy_counts(spark, sf_dir):
    load, _ = _copied(spark, sf_dir)
    return copy_counts(spark, load, _scan(spark, sf_dir, "events", position=True))


def q_copy_summary(spark, sf_dir):
    load, _ = _copied(spark, sf_dir)
    return copy_summary(spark, load).select("batches", "failed_batches", "source_rows", "loaded_rows")


def q_load_copy_rows(spark, sf_dir):
    load, schema = _copied(spark, sf_dir)
    return read_staged(spark, load.target.data_paths("events"), schema)


# -- verification ------------------------------------------------------------


def q_reconcile_columns(spark, sf_dir):
    source = _scan(spark, sf_dir, "customer")
    return reconcile_columns(source, _changed_customers(spark, sf_dir))


def q_reconcile_counts(spark, sf_dir):
    source = source_row_count(_scan(spark, sf_dir, "orders"))
    path, schema = _staged(spark, sf_dir, "orders")
    full = reconcile_counts(source, target_row_count(spark, path, schema))
    loaded = load_summary(load_ledger(_kept_batches(spark, sf_dir)[1])).select("loaded_rows")
    partial = reconcile_counts(source, loaded)
    return full.select(F.lit("full").alias("load"), "*").unionAll(partial.select(F.lit("partial").alias("load"), "*"))


def q_differing_batches(spark, sf_dir):
    """One value in ten thousand changed in a staged copy: the counts agree, the digests name the batches."""
    batched = batch_global(_scan(spark, sf_dir, "orders"), "o_orderkey", BATCH, unique=True, rows_per_range=RANGE)
    staged = read_staged(spark, *_staged(spark, sf_dir, "orders"))
    changed = staged.withColumn("o_totalprice", F.expr(f"o_totalprice + if({CHANGED}, 1, 0)"))
    path = scratch_path(spark, "changed")
    changed.write.parquet(path)
    there = batch_global(scan_source(spark, path), "o_orderkey", BATCH, unique=True, rows_per_range=RANGE)
    return differing_batches(batch_digests(batched), batch_digests(there))


def q_batch_digests(spark, sf_dir):
    """Digests of what was staged and read back, against those of the source: batches with equal content."""
    source = batch_by_position(_scan(spark, sf_dir, "documents", position=True), 20)
    lines = encode_copy_rows(source, source.columns[:-1], carry=["batch_id"])
    path = scratch_path(spark, "staged")
    stage_copy_files(lines, path)
    schema = source.drop("batch_id").schema
    number = F.regexp_extract(F.input_file_name(), r"batch_range=(\d+)/", 1).cast("long")
    staged = read_staged(spark, path, schema, also=[number.alias("batch_id")])
    a, b = batch_digests(source), batch_digests(staged)
    return a.join(b, ["batch_id", "rows", "one", "two"]).select("batch_id", "rows")


def q_staged_records(spark, sf_dir):
    """Records by staged file, counted block by block; the files hold texts of many lines."""
    path, _ = _staged(spark, sf_dir, "documents", 20)
    number = F.regexp_extract("file", r"batch_range=(\d+)/", 1).cast("long")
    return staged_records(spark, path).groupBy(number.alias("folder")).agg(F.sum("rows").alias("rows"))


def _bulk_load(spark, sf_dir, **options):
    path = f"{sf_dir}/orders.parquet"
    return bulk_load(
        spark, path, "public.orders", batch_size=BATCH, check=F.expr(REJECT), batches_per_folder=FOLDER, **options
    )


def q_bulk_load(spark, sf_dir):
    return _bulk_load(spark, sf_dir).ledger


def q_bulk_load_manifest(spark, sf_dir):
    """Files of loaded batches, as the tasks that wrote them report them."""
    files = _bulk_load(spark, sf_dir).manifest
    return files.groupBy("first_batch").agg(F.sum("rows").alias("rows"))


def q_bulk_load_counts(spark, sf_dir):
    return _bulk_load(spark, sf_dir).counts


def q_bulk_load_sent(spark, sf_dir):
    """Staged and sent on in one call; the rows of the target."""
    target = FolderTarget(scratch_path(spark, "sent"))
    load = _bulk_load(spark, sf_dir, target=target)
    return read_staged(spark, target.data_paths("public.orders"), load.schema)


def q_bulk_load_by_key(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    load = bulk_load(
        spark,
        path,
        "public.orders",
        keys="o_orderkey",
        batch_size=BATCH,
        rows_per_range=RANGE,
        check=F.expr(REJECT),
        batches_per_folder=FOLDER,
    )
    return load.ledger


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sf0.001 orders through a whole staged load; its ledger."""
    source = "/root/testdata/sf0.001/orders.parquet"
    return bulk_load(spark, source, "public.orders", keys="o_orderkey", batch_size=100, rows_per_range=500).ledger


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    return {
        "scan_source": q_scan_source,
        "source_row_count": q_source_row_count,
        "footer_statistics": q_footer_statistics,
        "profile_columns": q_profile_columns,
        "project_to_target": q_project_to_target,
        "project_to_target_events": q_project_to_target_events,
        "nested_to_json": q_nested_to_json,
        "encode_copy_rows": _encoded("documents", "doc_id"),
        "encode_copy_rows_pages": _encoded("pages", "page_id"),
        "encode_copy_rows_part": _encoded("part", "p_partkey"),
        "partition_for_load": q_partition_for_load,
        "partition_by_bytes": q_partition_by_bytes,
        "batch_within_partition": q_batch_within_partition,
        "batch_by_position": q_batch_by_position,
        "batch_global": q_batch_global,
        "batch_global_events": q_batch_global_events,
        "batch_global_equal_keys": q_batch_global_equal_keys,
        "batch_global_skewed": q_batch_global_skewed,
        "isolate_failed_batches": q_isolate_failed_batches,
        "rows_of_loaded_batches": q_rows_of_loaded_batches,
        "load_ledger": q_load_ledger,
        "load_summary": q_load_summary,
        "stage_copy_files": q_stage_copy_files,
        "stage_copy_manifest": q_stage_copy_manifest,
        "one_column_rows": q_one_column_rows,
        "one_column_count": q_one_column_count,
        "copy_staged": q_copy_staged,
        "target_row_count": q_target_row_count,
        "load_jdbc": q_load_jdbc,
        "jdbc_row_count": q_jdbc_row_count,
        "load_jdbc_batches": q_load_jdbc_batches,
        "load_jdbc_ledger": q_load_jdbc_ledger,
        "load_jdbc_counts": q_load_jdbc_counts,
        "jdbc_ledger": q_jdbc_ledger,
        "target_columns": q_target_columns,
        "target_value_counts": q_target_value_counts,
        "reconcile_live_target": q_reconcile_live_target,
        "load_copy": q_load_copy,
        "load_copy_ledger": q_load_copy_ledger,
        "load_copy_counts": q_load_copy_counts,
        "load_copy_rows": q_load_copy_rows,
        "copy_summary": q_copy_summary,
        "reconcile_columns": q_reconcile_columns,
        "reconcile_counts": q_reconcile_counts,
        "bulk_load": q_bulk_load,
        "bulk_load_by_key": q_bulk_load_by_key,
        "bulk_load_manifest": q_bulk_load_manifest,
        "differing_batches": q_differing_batches,
        "batch_digests": q_batch_digests,
        "staged_records": q_staged_records,
        "bulk_load_counts": q_bulk_load_counts,
        "bulk_load_sent": q_bulk_load_sent,
        **{k: q for m in _more for k, q in m.queries().items()},
    }


# -- the same in SQL ---------------------------------------------------------


def _sql_line(text: list[str], plain: list[str], order: list[str]) -> str:
    """A COPY line: quoting for ``text`` columns, plain text for the others."""
    fields = []
    for name in order:
        if name in text:
            fields.append(
                f"CASE WHEN {name} IS NULL THEN '' "
                f"WHEN {name} = '' OR contains({name}, '\"') OR contains({name}, ',') "
                f"OR contains({name}, chr(10)) OR contains({name}, chr(13)) "
                f"THEN '\"' || replace({name}, '\"', '\"\"') || '\"' ELSE {name} END"
            )
        else:
            assert name in plain
            fields.append(f"coalesce(CAST({name} AS VARCHAR), '')")
    return " || ',' || ".join(fields)


def _sql_profile(columns: list[tuple[str, str, str]]) -> str:
    parts = []
    for position, (name, source, target) in enumerate(columns, start=1):
        text, floating = source == "string", source in ("float", "double")
        parts.append(
            f"SELECT {position} AS position, '{name}' AS column_name, '{source}' AS source_type, "
            f"'{target}' AS target_type, count(*) - count({name}) AS null_count, "
            + (f"count(*) FILTER ({name} = '') " if text else "CAST(0 AS BIGINT) ")
            + "AS empty_count, "
            + (f"coalesce(max(length({name})), 0) " if text else "CAST(0 AS BIGINT) ")
            + "AS max_length, "
            + (f"count(*) FILTER (contains({name}, chr(0))) " if text else "CAST(0 AS BIGINT) ")
            + "AS nul_count, CAST(0 AS BIGINT) AS invalid_count, "
            + (f"count(*) FILTER (year({name}) NOT BETWEEN 1 AND 9999) " if source == "timestamp_ntz" else "CAST(0 AS BIGINT) ")
            + "AS far_date_count, "
            + (f"count(*) FILTER (isnan({name})) " if floating else "CAST(0 AS BIGINT) ")
            + "AS nan_count FROM events"
        )
    return " UNION ALL ".join(parts)


def _sql_batches(table: str, key: str, size: int) -> str:
    return f"SELECT *, (row_number() OVER (ORDER BY {key}) - 1) // {size} AS batch_id FROM {table}"


def _sql_partitions(mode: str, partitions: str) -> str:
    return (
        f"SELECT '{mode}' AS mode, n AS row_count, CAST({PARTITION} AS BIGINT) AS batch_size, "
        f"p AS num_partitions, n // p AS min_rows, (n + p - 1) // p AS max_rows "
        f"FROM (SELECT count(*) AS n, greatest({partitions}, 1) AS p FROM lineitem)"
    )


def _sql_columns() -> str:
    customer = [
        ("c_custkey", "BIGINT"),
        ("c_name", "TEXT"),
        ("c_nationkey", "INTEGER"),
        ("c_acctbal", "DOUBLE PRECISION"),
        ("c_mktsegment", "TEXT"),
    ]
    parts = []
    for position, (name, kind) in enumerate(customer, start=1):
        here = f"SELECT '{name}' AS column_name, {position} AS source_position, '{kind}' AS source_type, "
        values = f"count({name}) AS source_values, "
        if name == "c_mktsegment":
            target = (
                "CAST(NULL AS INTEGER) AS target_position, CAST(NULL AS VARCHAR) AS target_type, "
                "CAST(NULL AS BIGINT) AS target_values, 'missing' AS status"
            )
        elif name == "c_name":
            kept = "count(c_name) FILTER (c_acctbal >= 0)"
            target = (
                f"{position} AS target_position, '{kind}' AS target_type, {kept} AS target_values, "
                f"CASE WHEN count(c_name) = {kept} THEN 'ok' ELSE 'null_diff' END AS status"
            )
        else:
            target = (
                f"{position} AS target_position, '{kind}' AS target_type, count({name}) AS target_values, "
                "'ok' AS status"
            )
        parts.append(here + values + target + " FROM customer")
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    """For each query the same result in SQL over the same tables."""
    orders = _sql_batches("orders", "o_orderkey", BATCH)
    batches = (
        f"SELECT batch_id, count(*) AS rows, count(*) FILTER ({REJECT}) AS rejected_rows, "
        f"CASE WHEN bool_or({REJECT}) THEN 'FAILED' ELSE 'LOADED' END AS status "
        f"FROM ({orders}) GROUP BY batch_id"
    )
    ok = "CASE WHEN status = 'LOADED' THEN rows ELSE 0 END"
    ledger = (
        f"SELECT batch_id, rows, status, CAST(sum({ok}) OVER (ORDER BY batch_id) AS BIGINT) AS loaded_rows, "
        f"round(sum({ok}) OVER (ORDER BY batch_id) * 100.0 / sum(rows) OVER (), 1) AS percent FROM ({batches})"
    )
    loaded = f"SELECT CAST(sum({ok}) AS BIGINT) AS t FROM ({batches})"
    kept_orders = (
        f"SELECT o.* EXCLUDE (batch_id) FROM ({orders}) o JOIN ({batches}) b USING (batch_id) WHERE b.status = 'LOADED'"
    )
    order_counts = (
        "SELECT s AS source_rows, t AS target_rows, s - t AS diff, s = t AS match "
        f"FROM (SELECT (SELECT count(*) FROM orders) AS s, ({loaded}) AS t)"
    )
    return {
        "scan_source": "SELECT * FROM orders",
        "source_row_count": "SELECT count(*) AS row_count FROM lineitem",
        "footer_statistics": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS value_count, "
            f"count(*) - count({c}) AS null_count FROM lineitem"
            for c in LINEITEM
        ),
        "profile_columns": _sql_profile(
            [
                ("event_id", "bigint", "BIGINT"),
                ("ts", "timestamp_ntz", "TIMESTAMP"),
                ("user_id", "bigint", "BIGINT"),
                ("event_type", "string", "TEXT"),
                ("value", "double", "DOUBLE PRECISION"),
                ("props", "string", "TEXT"),
            ]
        ),
        "project_to_target": (
            "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS as_int, CAST(o_totalprice AS DECIMAL(12,2)) AS as_decimal, "
            "o_orderstatus = 'F' AS as_boolean, CAST(o_orderdate AS DATE) AS as_date, o_orderdate AS as_ntz, "
            "TIMESTAMP '1970-01-01' + to_seconds(o_custkey * 86399) AS as_instant, "
            "'\\x' || upper(hex(o_orderpriority)) AS as_binary, "
            "'[' || o_orderkey || ',' || o_custkey || ']' AS as_array, "
            "'{\"' || o_orderkey || '\":\"' || o_orderstatus || '\"}' AS as_map, "
            "'{\"k\":' || o_orderkey || ',\"p\":' || "
            "CASE WHEN o_orderstatus = 'F' THEN '\"' || o_orderpriority || '\"' ELSE 'null' END || '}' AS as_struct "
            "FROM orders"
        ),
        "project_to_target_events": "SELECT * FROM events",
        "nested_to_json": (
            "SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, round(CAST(embedding[p] AS DOUBLE), 6) AS value "
            "FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)"
        ),
        "encode_copy_rows": "SELECT doc_id, "
        + _sql_line(["text", "lang", "source"], ["doc_id", "n_chars"], ["doc_id", "text", "lang", "source", "n_chars"])
        + " AS line FROM documents",
        "encode_copy_rows_pages": "SELECT page_id, "
        + _sql_line(["url", "html"], ["page_id"], ["page_id", "url", "html"])
        + " AS line FROM pages",
        "encode_copy_rows_part": "SELECT p_partkey, "
        + _sql_line(
            ["p_name", "p_brand", "p_type"],
            ["p_partkey", "p_size", "p_retailprice"],
            ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        )
        + " AS line FROM part",
        "partition_by_bytes": (
            f"SELECT CAST({PARTS} AS BIGINT) AS num_partitions, CAST(sum(n) AS BIGINT) AS bytes, max(n) AS longest_line, "
            "true AS even FROM (SELECT octet_length(encode("
            + _sql_line(["text", "lang", "source"], ["doc_id", "n_chars"], ["doc_id", "text", "lang", "source", "n_chars"])
            + ")) + 1 AS n FROM documents)"
        ),
        "partition_for_load": _sql_partitions("ceil", f"(count(*) + {PARTITION} - 1) // {PARTITION}")
        + " UNION ALL "
        + _sql_partitions("floor", f"count(*) // {PARTITION}"),
        "batch_within_partition": f"SELECT batch_id AS batch_no, count(*) AS rows FROM ({orders}) GROUP BY batch_id",
        "batch_by_position": f"SELECT o_orderkey, batch_id FROM ({orders})",
        "batch_global": f"SELECT o_orderkey, batch_id FROM ({orders})",
        "batch_global_events": f"SELECT event_id, batch_id FROM ({_sql_batches('events', 'event_id', BATCH)})",
        "batch_global_equal_keys": (
            "SELECT unnest(['ranges', 'files']) AS way, event_id, batch_id "
            f"FROM ({_sql_batches('events', 'ascii(event_type), event_id', BATCH)})"
        ),
        "batch_global_skewed": (
            "SELECT batch_id, count(*) AS rows, min(l_returnflag) AS first_key, max(l_returnflag) AS last_key "
            f"FROM ({_sql_batches('lineitem', 'l_returnflag', BATCH)}) GROUP BY batch_id"
        ),
        "isolate_failed_batches": batches,
        "rows_of_loaded_batches": (
            f"SELECT o.* FROM ({orders}) o JOIN ({batches}) b ON o.batch_id = b.batch_id WHERE b.status = 'LOADED'"
        ),
        "load_ledger": ledger,
        "load_summary": (
            "SELECT count(*) AS batches, count(*) FILTER (status = 'FAILED') AS failed_batches, "
            f"CAST(sum(rows) AS BIGINT) AS source_rows, CAST(sum({ok}) AS BIGINT) AS loaded_rows FROM ({batches})"
        ),
        "stage_copy_files": "SELECT * FROM documents",
        "stage_copy_manifest": (
            f"SELECT batch_id // {FOLDER} * {FOLDER} AS first_batch, batch_id // {FOLDER} * {FOLDER} + {FOLDER - 1} "
            f"AS last_batch, count(*) AS rows FROM ({_sql_batches('documents', 'doc_id', 20)}) GROUP BY ALL"
        ),
        "one_column_rows": "SELECT CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name FROM customer",
        "one_column_count": "SELECT count(*) AS target_rows FROM customer",
        "copy_staged": "SELECT * FROM documents",
        "target_row_count": "SELECT count(*) AS target_rows FROM orders",
        "load_jdbc": "SELECT * FROM orders",
        "jdbc_row_count": "SELECT count(*) AS target_rows FROM orders",
        "load_jdbc_batches": kept_orders,
        "load_jdbc_ledger": ledger,
        "load_jdbc_counts": order_counts,
        "jdbc_ledger": f"SELECT batch_id, rows, status FROM ({batches}) WHERE status = 'LOADED'",
        "target_columns": (
            "SELECT * FROM (VALUES ('c_custkey', 1, 'BIGINT'), ('c_name', 2, 'TEXT'), ('c_nationkey', 3, 'INTEGER'), "
            "('c_acctbal', 4, 'DOUBLE PRECISION')) t(column_name, position, target_type)"
        ),
        "target_value_counts": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count({v}) AS value_count FROM customer"
            for c, v in (
                ("c_custkey", "c_custkey"),
                ("c_name", "CASE WHEN c_acctbal >= 0 THEN c_name END"),
                ("c_nationkey", "c_nationkey"),
                ("c_acctbal", "c_acctbal"),
            )
        ),
        "reconcile_live_target": _sql_columns(),
        "load_copy": (
            "SELECT batch_id, count(*) AS rows, 'LOADED' AS status "
            f"FROM ({_sql_batches('events', 'event_id', BATCH)}) GROUP BY batch_id"
        ),
        "load_copy_ledger": (
            "SELECT batch_id, rows, 'LOADED' AS status, CAST(sum(rows) OVER (ORDER BY batch_id) AS BIGINT) AS loaded_rows, "
            "round(sum(rows) OVER (ORDER BY batch_id) * 100.0 / sum(rows) OVER (), 1) AS percent FROM "
            f"(SELECT batch_id, count(*) AS rows FROM ({_sql_batches('events', 'event_id', BATCH)}) GROUP BY batch_id)"
        ),
        "load_copy_counts": (
            "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS diff, true AS match FROM events"
        ),
        "load_copy_rows": "SELECT * FROM events",
        "copy_summary": (
            f"SELECT (count(*) + {BATCH - 1}) // {BATCH} AS batches, CAST(0 AS BIGINT) AS failed_batches, "
            "count(*) AS source_rows, count(*) AS loaded_rows FROM events"
        ),
        "reconcile_columns": _sql_columns(),
        "reconcile_counts": (
            "SELECT 'full' AS load, s AS source_rows, s AS target_rows, CAST(0 AS BIGINT) AS diff, true AS match "
            "FROM (SELECT count(*) AS s FROM orders) UNION ALL "
            "SELECT 'partial' AS load, s AS source_rows, t AS target_rows, s - t AS diff, s = t AS match "
            f"FROM (SELECT (SELECT count(*) FROM orders) AS s, ({loaded}) AS t)"
        ),
        "bulk_load": ledger,
        "bulk_load_by_key": ledger,
        "differing_batches": (
            "SELECT batch_id, count(*) AS source_rows, count(*) AS target_rows "
            f"FROM ({orders}) GROUP BY batch_id HAVING bool_or({CHANGED})"
        ),
        "batch_digests": (
            f"SELECT batch_id, count(*) AS rows FROM ({_sql_batches('documents', 'doc_id', 20)}) GROUP BY batch_id"
        ),
        "staged_records": (
            f"SELECT batch_id // {FOLDER} AS folder, CAST(count(*) AS BIGINT) AS rows "
            f"FROM ({_sql_batches('documents', 'doc_id', 20)}) GROUP BY ALL"
        ),
        "bulk_load_manifest": f"SELECT batch_id AS first_batch, rows FROM ({batches}) WHERE status = 'LOADED'",
        "bulk_load_counts": order_counts,
        "bulk_load_sent": kept_orders,
        **{k: sql for m in _more for k, sql in m.oracle_sql().items()},
    }
