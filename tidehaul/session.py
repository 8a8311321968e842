"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings a load relies on. Speculation would start a second copy of a task
# that is talking to a database, so it stays off.
LOAD_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A task that writes one folder per batch range keeps this many files open
    # before it sorts its rows by range.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
}

_fallback_dirs: dict[str, str] = {}


def build_session(app: str = "tidehaul", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {**LOAD_SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}
    for name, value in merged.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Cores to reckon with where executors come and go without a stated limit.
ELASTIC_CORES = 4096


def parallel_tasks(spark: SparkSession) -> int:
    """How many tasks the session can run at once, executors still to come included."""
    cores = spark.sparkContext.defaultParallelism
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        limit = spark.conf.get("spark.dynamicAllocation.maxExecutors", None)
        each = int(spark.conf.get("spark.executor.cores", "1"))
        cores = max(cores, int(limit) * each if limit and limit.isdigit() else ELASTIC_CORES)
    return cores


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only where that setting is missing and the
    master is local; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="tidehaul-")
        spark.sparkContext.setCheckpointDir(_fallback_dirs[app])
    return _fallback_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/tidehaul/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Remove scratch tables that were last written to so long ago; how many there were.

    Ledgers and manifests of loads are read from scratch tables, so this is for
    the time when their loads are no longer needed. Tables of other
    applications in the same shared folder count as well.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidehaul")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    before = (time.time() - older_than_hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(folder) if s.getModificationTime() <= before]
    return sum(bool(fs.delete(path, True)) for path in old)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors (``--py-files`` at run time)."""
    marker = "_tidehaul_shipped"
    context = spark.sparkContext
    if getattr(context, marker, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidehaul-"), "tidehaul.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    setattr(context, marker, True)
