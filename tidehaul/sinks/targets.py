"""Where COPY batches go.

A target commits a batch and the record of it together, under the load's id and
the batch's number. A second attempt at a batch, by a retried or a lost task or
by a later run with the same load id, finds the record and sends nothing.
"""

from __future__ import annotations

import hashlib
import importlib
import io
import json
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidehaul.functions.statements import copy_statement, create_table_statement, quote_identifier, quote_table
from tidehaul.operators.isolate import FAILED, LOADED
from tidehaul.sinks.staged import target_row_count
from tidehaul.sinks.stream import REJECTED_ROW, Refused, put_whole

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("finished_at", T.StringType()),
    ]
)


@dataclass(frozen=True)
class LoadPlan:
    """What a target has to know of one load."""

    load_id: str
    table: str
    mode: str
    landing: str
    create_landing: str
    copy_into: str
    batches: str


# Fixed value: the longest name PostgreSQL keeps.
NAME_BYTES = 63
# The entry under which a ledger keeps how a load's batches were cut.
PLAN_ENTRY = -1
PUBLISHED = "PUBLISHED"


class OtherBatches(ValueError):
    """A load cannot go on, as its batches would now hold other rows than before."""


def plan_entry(plan: LoadPlan) -> str:
    return json.dumps({"batches": plan.batches, "mode": plan.mode, "landing": plan.landing})


def check_entry(plan: LoadPlan, recorded: str, published: bool) -> None:
    """Refuse to go on with other batches, or where those already sent do not lie in this load's place."""
    known = json.loads(recorded)
    if known["batches"] != plan.batches:
        raise OtherBatches(
            f"load {plan.load_id} was begun with batches {known['batches']}, these are {plan.batches}; use a new load id"
        )
    if not published and (known["mode"], known["landing"]) != (plan.mode, plan.landing):
        raise OtherBatches(
            f"load {plan.load_id} was begun as {known['mode']} and is not in place yet; its batches lie in "
            f"{known['landing']}, so it goes on in that mode only"
        )


def beside(table: str, suffix: str) -> str:
    """A table name next to ``table``. One too long for the target is cut, and a hash of the whole takes the rest's place."""
    schema, dot, name = table.rpartition(".")
    if len((name + suffix).encode()) > NAME_BYTES:
        mark = "_" + hashlib.sha256(table.encode()).hexdigest()[:12]
        name = name.encode()[: NAME_BYTES - len(suffix) - len(mark)].decode(errors="ignore") + mark
    return f"{schema}{dot}{name}{suffix}"


def plan_load(
    schema: T.StructType, table: str, mode: str, load_id: str | None, not_null: tuple[str, ...], batches: str
) -> LoadPlan:
    """``overwrite`` lands in a table of its own that later takes the target's place.

    ``batches`` says how the batches were cut, so that a load that is continued
    can be told from one that only looks the same.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    load_id = load_id or uuid.uuid4().hex
    landing = beside(table, "__load_" + hashlib.sha256(load_id.encode()).hexdigest()[:12])
    if mode == "append":
        landing = table
    return LoadPlan(
        load_id=load_id,
        table=table,
        mode=mode,
        landing=landing,
        create_landing=create_table_statement(schema, landing, not_null),
        copy_into=copy_statement(schema, landing),
        batches=batches,
    )


def resolve(name: str):
    """The object behind ``module:attribute``."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="milliseconds")


class PostgresTarget:
    """A PostgreSQL-style database, reached by a psycopg2-style connection.

    ``connect`` names an importable ``module:function`` that the executors call
    with ``connect_args``; it should find its credentials by itself. There is
    no such database where the tests run, so they use a stand-in connection.
    """

    def __init__(self, connect: str, connect_args: Mapping | None = None):
        self.connect = connect
        self.connect_args = dict(connect_args or {})

    def spec(self) -> tuple[str, dict]:
        return f"{__name__}:PostgresTarget", {"connect": self.connect, "connect_args": self.connect_args}

    def connection(self):
        return resolve(self.connect)(**self.connect_args)

    @staticmethod
    def ledger_table(table: str) -> str:
        return beside(table, "__batches")

    @contextmanager
    def _transaction(self):
        """A cursor whose statements are committed together."""
        conn = self.connection()
        try:
            yield conn.cursor()
            conn.commit()
        finally:
            conn.close()

    def begin(self, plan: LoadPlan) -> None:
        ledger = quote_table(self.ledger_table(plan.table))
        key = (plan.load_id, PLAN_ENTRY)
        with self._transaction() as cur:
            cur.execute(
                f"CREATE TABLE IF NOT EXISTS {ledger} (load_id TEXT NOT NULL, batch_id BIGINT NOT NULL, "
                "row_count BIGINT, status TEXT, message TEXT, finished_at TEXT, PRIMARY KEY (load_id, batch_id))"
            )
            cur.execute(f"SELECT message, status FROM {ledger} WHERE load_id = %s AND batch_id = %s", key)
            found = cur.fetchone()
            if not found:
                cur.execute(
                    f"INSERT INTO {ledger} (load_id, batch_id, message) VALUES (%s, %s, %s)", (*key, plan_entry(plan))
                )
            else:
                check_entry(plan, found[0], found[1] == PUBLISHED)
                if plan.mode == "overwrite" and found[1] == PUBLISHED:
                    # Its batches count as sent, but they are not in a new landing table.
                    raise ValueError(f"load {plan.load_id} is in place already; append to send failed batches again")
            cur.execute(plan.create_landing)

    def open(self, plan: LoadPlan) -> _PostgresTask:
        return _PostgresTask(self.connection(), plan, quote_table(self.ledger_table(plan.table)))

    def publish(self, plan: LoadPlan) -> None:
        """Put the landed table in the target's place, in one transaction."""
        if plan.mode == "append":
            return
        name = quote_identifier(plan.table.split(".")[-1])
        ledger = quote_table(self.ledger_table(plan.table))
        with self._transaction() as cur:
            cur.execute(f"DROP TABLE IF EXISTS {quote_table(plan.table)}")
            cur.execute(f"ALTER TABLE {quote_table(plan.landing)} RENAME TO {name}")
            cur.execute(
                f"UPDATE {ledger} SET status = '{PUBLISHED}' WHERE load_id = %s AND batch_id = %s",
                (plan.load_id, PLAN_ENTRY),
            )

    def ledger(self, spark: SparkSession, plan: LoadPlan, jdbc: Mapping[str, str]) -> DataFrame:
        """The load's batches, read over JDBC with the options in ``jdbc``."""
        load_id = plan.load_id.replace("'", "''")
        query = (
            "(SELECT batch_id, row_count, status, message, finished_at "
            f"FROM {quote_table(self.ledger_table(plan.table))} WHERE load_id = '{load_id}' AND batch_id >= 0) batches"
        )
        read = spark.read.format("jdbc").options(**jdbc).option("dbtable", query).load()
        return read.withColumnRenamed("row_count", "rows")

    def row_count(
        self, spark: SparkSession, plan: LoadPlan, schema: T.StructType, jdbc: Mapping[str, str]
    ) -> DataFrame:
        """One row, ``target_rows``, counted by the database over JDBC."""
        query = f"(SELECT COUNT(*) AS n FROM {quote_table(plan.table)}) counted"
        counted = spark.read.format("jdbc").options(**jdbc).option("dbtable", query).load()
        return counted.toDF("n").selectExpr("cast(n AS BIGINT) AS target_rows")


class _PostgresTask:
    """One task's connection."""

    def __init__(self, conn, plan: LoadPlan, ledger: str):
        self.conn, self.plan, self.ledger = conn, plan, ledger

    def _status(self, cur, batch_id: int) -> str | None:
        cur.execute(
            f"SELECT status FROM {self.ledger} WHERE load_id = %s AND batch_id = %s", (self.plan.load_id, batch_id)
        )
        found = cur.fetchone()
        return found[0] if found else None

    def _record(self, cur, batch_id: int, rows: int | None, status: str, message: str | None) -> None:
        key = (self.plan.load_id, batch_id)
        cur.execute(f"DELETE FROM {self.ledger} WHERE load_id = %s AND batch_id = %s AND status = '{FAILED}'", key)
        cur.execute(
            f"INSERT INTO {self.ledger} (load_id, batch_id, row_count, status, message, finished_at) "
            "VALUES (%s, %s, %s, %s, %s, %s)",
            (*key, rows, status, message, _now()),
        )

    def send(self, batch) -> str:
        """COPY one batch in a transaction of its own, unless it is there already."""
        cur = self.conn.cursor()
        if self._status(cur, batch.batch_id) == LOADED:
            self.conn.rollback()
            batch.drain()
            return LOADED
        try:
            # The record goes first: its key makes a second attempt that runs
            # at the same time wait, and then fail.
            self._record(cur, batch.batch_id, None, LOADED, None)
            cur.copy_expert(self.plan.copy_into, batch)
            cur.execute(
                f"UPDATE {self.ledger} SET row_count = %s WHERE load_id = %s AND batch_id = %s",
                (batch.rows, self.plan.load_id, batch.batch_id),
            )
            self.conn.commit()
            return LOADED
        except Exception as error:
            # A connection that is gone fails here again, and with it the task,
            # which Spark starts anew.
            self.conn.rollback()
            batch.drain()
            return self.fail(batch.batch_id, batch.rows, REJECTED_ROW if batch.refused else str(error))

    def fail(self, batch_id: int, rows: int, message: str) -> str:
        cur = self.conn.cursor()
        if self._status(cur, batch_id) == LOADED:
            self.conn.rollback()
            return LOADED
        self._record(cur, batch_id, rows, FAILED, message)
        self.conn.commit()
        return FAILED

    def close(self) -> None:
        self.conn.close()


class FolderTarget:
    """COPY batches as files in a shared folder.

    The folder form of the same contract, for targets that executors cannot
    reach and for tests: a batch is one file that appears whole, and the loads
    that make up a table are listed in a file that is replaced whole. The path
    is anything Arrow's file systems open, by URI or as a mounted folder.
    """

    def __init__(self, path: str):
        plain = path.removeprefix("file:")
        if plain.startswith("/"):
            path = "file:///" + plain.lstrip("/")
        self.path = path.rstrip("/")

    def spec(self) -> tuple[str, dict]:
        return f"{__name__}:FolderTarget", {"path": self.path}

    def _folder(self, plan: LoadPlan) -> str:
        return f"{self.path}/{plan.table}/{plan.load_id}"

    def _ledger_folder(self, plan: LoadPlan) -> str:
        return f"{self.path}/{plan.table}__batches/{plan.load_id}"

    def begin(self, plan: LoadPlan) -> None:
        for folder in (self._folder(plan), self._ledger_folder(plan)):
            fs, place = FileSystem.from_uri(folder)
            fs.create_dir(place, recursive=True)
        # Spark does not read files whose names begin like this.
        record = self._ledger_folder(plan) + "/_batches.txt"
        known = _read(record)
        if known is None:
            fs, place = FileSystem.from_uri(record)
            put_whole(fs, place, io.BytesIO(plan_entry(plan).encode()))
        else:
            check_entry(plan, known.decode(), plan.load_id in self.loads(plan.table))

    def open(self, plan: LoadPlan) -> _FolderTask:
        return _FolderTask(self._folder(plan), self._ledger_folder(plan))

    def _listing(self, table: str) -> str:
        return f"{self.path}/{table}/loads.json"

    def loads(self, table: str) -> list[str]:
        """The ids of the loads that make up ``table``."""
        return json.loads(_read(self._listing(table)) or b"[]")

    def publish(self, plan: LoadPlan) -> None:
        before = [i for i in self.loads(plan.table) if i != plan.load_id] if plan.mode == "append" else []
        fs, place = FileSystem.from_uri(self._listing(plan.table))
        put_whole(fs, place, io.BytesIO(json.dumps([*before, plan.load_id]).encode()))

    def data_paths(self, table: str) -> list[str]:
        return [f"{self.path}/{table}/{load}" for load in self.loads(table)]

    def ledger(self, spark: SparkSession, plan: LoadPlan, jdbc: Mapping[str, str] | None = None) -> DataFrame:
        return spark.read.schema(LEDGER_SCHEMA).json(self._ledger_folder(plan))

    def row_count(
        self, spark: SparkSession, plan: LoadPlan, schema: T.StructType, jdbc: Mapping[str, str] | None = None
    ) -> DataFrame:
        """One row, ``target_rows``: the records in the files of the loads that make up the table."""
        return target_row_count(spark, self.data_paths(plan.table), schema)


def _read(uri: str) -> bytes | None:
    fs, place = FileSystem.from_uri(uri)
    if fs.get_file_info(place).type == FileType.NotFound:
        return None
    with fs.open_input_stream(place) as file:
        return file.read()


class _FolderTask:
    def __init__(self, folder: str, ledger: str):
        self.fs, self.folder = FileSystem.from_uri(folder)
        _, self.ledger = FileSystem.from_uri(ledger)

    def _file(self, batch_id: int) -> str:
        return f"{self.folder}/batch-{batch_id:020d}.csv"

    def _loaded(self, batch_id: int) -> bool:
        return self.fs.get_file_info(self._file(batch_id)).type != FileType.NotFound

    def _record(self, batch_id: int, rows: int, status: str, message: str | None) -> str:
        row = {"batch_id": batch_id, "rows": rows, "status": status, "message": message, "finished_at": _now()}
        put_whole(self.fs, f"{self.ledger}/batch-{batch_id:020d}.json", io.BytesIO(json.dumps(row).encode() + b"\n"))
        return status

    def send(self, batch) -> str:
        if self._loaded(batch.batch_id):
            batch.drain()
            return self._record(batch.batch_id, batch.rows, LOADED, None)
        try:
            put_whole(self.fs, self._file(batch.batch_id), batch)
        except Refused as error:
            batch.drain()
            return self._record(batch.batch_id, batch.rows, FAILED, str(error))
        return self._record(batch.batch_id, batch.rows, LOADED, None)

    def close(self) -> None:
        pass
