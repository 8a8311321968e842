import zlib
from collections import Counter

import pytest
from llm_cases import EDGES
from pyspark.sql import functions as F

from tidehaul.llm import common
from tidehaul.llm.common import bin_of, cuts, cuts_of
from tidehaul.llm.queries import queries
from tidehaul.llm.shards import document_shards, hilbert_index, write_shards


def curve(x, bits):
    """The index of a point, in plain Python."""
    x, n, m = list(x), len(x), 1 << (bits - 1)
    q = m
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, m
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    return int("".join(str((v ^ t) >> k & 1) for k in range(bits - 1, -1, -1) for v in x), 2)


@pytest.mark.parametrize(("axes", "bits"), [(2, 3), (3, 2), (3, 3)])
def test_the_curve_visits_each_cell_and_steps_to_neighbours(spark, axes, bits):
    side = 1 << bits
    names = [f"x{i}" for i in range(axes)]
    cells = spark.range(side**axes).select(*[F.expr(f"(id div {side**i}) % {side}").alias(n) for i, n in enumerate(names)])
    copies = cells.select("*", *[F.col(n).alias(f"_{n}") for n in names])
    rows = hilbert_index(copies, [f"_{n}" for n in names], bits, "at").orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(side**axes))
    for a, b in zip(rows, rows[1:], strict=False):
        assert sum(abs(a[n] - b[n]) for n in names) == 1
    assert all(curve([r[n] for n in names], bits) == r["at"] for r in rows)


def test_the_curve_is_one_projection(spark):
    """The driver's memory goes with the plan, which must not grow with axes and bits."""
    names = ["a", "b", "c"]
    cells = spark.range(3000).select("id", *[F.expr(f"pmod(hash(id, {k}), 32)").alias(n) for k, n in enumerate(names)])
    placed = hilbert_index(cells.select("*", *[F.col(n).alias(f"_{n}") for n in names]), [f"_{n}" for n in names], 5, "at")
    assert placed._jdf.queryExecution().analyzed().toString().count("Project") <= 4
    assert all(curve([r[n] for n in names], 5) == r["at"] for r in placed.collect())


def test_cuts_of_several_columns_take_one_pass(spark, monkeypatch):
    rows = [(k % 7 if k % 5 else None, "äzA"[k % 3] if k % 4 else None, None, k / 3) for k in range(90)]
    df = spark.createDataFrame(rows, "n bigint, s string, e string, f double").repartition(4)
    labels = []
    monkeypatch.setattr(common, "written", lambda df, label, f=common.written: labels.append(label) or f(df, label))
    found = cuts_of(df, [F.col(c) for c in df.columns], 8)
    assert labels == ["cuts"]
    for k, got in enumerate(found):
        values = [r[k] for r in rows]
        least = {}
        for v in sorted({v for v in values if v is not None}):
            least.setdefault(sum(x is None or x < v for x in values) * 8 // len(rows), v)
        assert got == [(b, v) for b, v in least.items() if b]
    assert cuts_of(df.where("false"), [F.col("n"), F.col("s")], 8) == [[], []]


def test_cuts_are_exact_quantiles(spark):
    values = [None, None, *([5] * 40), *range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    found = cuts(df, F.col("v"), 8)
    got = {r["v"]: r["b"] for r in df.select("v", bin_of(F.col("v"), found).alias("b")).collect()}
    for v in set(values) - {None}:
        less = sum(x is None or x < v for x in values)
        assert got[v] == less * 8 // len(values)
    assert got[None] == 0


def check(rows, out, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] is None and r["law"] == "rows"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))


def test_query_over_the_whole_table(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    out = queries()["op3_hilbert_shards"](spark, "/root/testdata/sf0.001").collect()
    check(rows, out, 40)
    again = queries()["op3_hilbert_shards"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(out) == sorted(again)
    by_rank = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in by_rank] == sorted(r["curve"] for r in out)


def test_edges(documents):
    check(EDGES, document_shards(documents(EDGES, "shard slot curve _rank size"), 4).collect(), 4)
    assert document_shards(documents([])).collect() == []
    same = [(7, "same", "en", "s")] * 50
    check(same, document_shards(documents(same), 8).collect(), 8)


def test_files_have_narrow_ranges(documents, tmp_path):
    rows = [(k, "w" * (k % 97), ["de", "en"][k % 2], f"s{k % 5}") for k in range(400)]
    sharded = document_shards(documents(rows), 16)
    write_shards(sharded, str(tmp_path / "out"), 16)
    back = sharded.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400
    spread = back.groupBy("shard").agg((F.max("size") - F.min("size")).alias("w")).agg(F.avg("w")).first()[0]
    assert spread < 60
