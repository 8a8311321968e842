import itertools
import re

import pytest
from llm_cases import EDGES
from pyspark.sql import functions as F

from tidehaul.llm import mixing
from tidehaul.llm.mixing import document_mix, mix, mixed_documents, sainte_lague, source_targets
from tidehaul.llm.queries import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def highest_quotients(weights, seats):
    won = [0] * len(weights)
    if not any(weights):
        return won
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize(
    ("weights", "seats"),
    [([53, 24, 23], 7), ([1] * 9, 4), ([0, 5, 0], 3), ([0, 0], 5), ([1000, 1, 1, 1], 50), ([3.5, 2.25, 9.125, 7], 41)],
)
def test_apportionment_equals_the_highest_quotients(spark, weights, seats):
    rows = [("g", i, float(w), seats) for i, w in enumerate(weights)] + [("h", 0, 2.0, 3)]
    df = spark.createDataFrame(rows, "g string, i int, w double, s long")
    got = {(r["g"], r["i"]): r["quota"] for r in sainte_lague(df, ["g"], ["i"], "w", "s").collect()}
    assert [got["g", i] for i in range(len(weights))] == highest_quotients(weights, seats)
    assert got["h", 0] == 3


def reshared(sizes, limit=3):
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in fixed}
        left = total - sum(fixed.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > limit * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed |= {s: limit * sizes[s] for s in over}


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 1, "d": 50, None: 30}, {"a": 5}, {"a": 0, "b": 9}]
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df, [1, 2, 3], 3).collect()}
    assert got == pytest.approx(reshared(sizes))


def check(rows, out):
    sizes, per = {}, {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    want = reshared(sizes)
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        per[r["source"]] = per.get(r["source"], 0) + r["taken"]
    assert len(out) == len(rows)
    for s, n in per.items():
        assert abs(n - want[s]) <= 128


def test_query_over_the_whole_table(spark, table):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table("documents").collect()]
    out = queries()["op5_mix_sources"](spark, "/root/testdata/sf0.001").collect()
    check(rows, out)
    size = {r[0]: len(WORDS.findall(r[1])) for r in rows}
    assert all(r["size"] == size[r["doc_id"]] for r in out)
    assert sorted(out) == sorted(queries()["op5_mix_sources"](spark, "/root/testdata/sf0.001").collect())


def test_many_cells_share_a_hot_source(spark):
    df = spark.range(6000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else 's' || id % 7 end as source",
                                      "cast(id % 41 as long) as words")
    out = mix(df, F.col("words"), F.col("doc_id"), block_words=16, cell_words=900)
    got = out.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(abs(r["n"] - r["t"]) <= max(32, 0.01 * r["t"]) for r in got)
    assert out.where("taken > 3 * size").count() == 0 and out.count() == 6000


def test_edges(documents):
    df = documents(EDGES, "taken target size _cell")
    check(EDGES, document_mix(df).collect())
    assert document_mix(documents([])).collect() == []
    twice = EDGES + EDGES
    check(twice, document_mix(documents(twice)).collect())


def test_rows_without_an_id_do_not_share_a_cell(spark):
    """Their texts deal them, so no cell has more than a few times its share of words."""
    df = spark.range(4000).selectExpr("cast(null as bigint) doc_id", "repeat('w ', 100 + cast(id % 90 as int)) || id text", "'s' source")
    check([(None, r["text"], "en", "s") for r in df.collect()], document_mix(df).collect())
    packed = df.select("doc_id", "source", F.lit(300).alias("n"), mixing.document_key())
    cells = mixing._picked(packed, F.col("n"), F.col("_key"), "source", [1.0], 3, 64, 20_000, 1).groupBy("_cell").agg(F.sum("size").alias("s"))
    assert cells.count() == 60 and cells.agg(F.max("s")).first()[0] < 2.5 * 20_000


def test_stage_repeats_by_words_taken(documents):
    rows = [(k, "w " * 100, "en", "abc"[k % 10 // 9 + (k % 100 == 99)]) for k in range(300)]
    out = mixed_documents(documents(rows, "taken"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken"]
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert counts["a"] < 270 and counts["b"] >= 2 * 27 and counts["c"] >= 8


@pytest.mark.parametrize("weights", [(1.0, 2.0, 3.0), (1.0, 9.0, 20.0), (9.0, 4.0, 1.0)])
def test_stage_keeps_the_words_of_the_mix(spark, weights):
    """Sources with long documents, one of them hot: the stage's words are the mix's, and long ones come as often."""
    df = spark.range(9000).selectExpr(
        "id as doc_id",
        "repeat('w ', cast(case when id % 40 = 3 then 2000 + 37 * (id % 50) else 20 + id % 131 end as int)) as text",
        "case when id % 10 < 8 then 'hot' when id % 10 = 8 then 'b' else 'c' end as source",
    )
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    mixed = mix(df.withColumn("n", size), F.col("n"), F.col("doc_id"), weights=list(weights), cell_words=40_000)
    per = F.sum("taken").alias("n"), F.sum(F.expr("if(size >= 1000, taken, 0)")).alias("long")
    want = {r["source"]: r for r in mixed.groupBy("source").agg(*per, F.first("target").alias("t")).collect()}
    out = mixed_documents(df, weights=list(weights), cell_words=40_000).withColumn("n", size)
    per = F.sum("n").alias("n"), F.sum(F.expr("if(n >= 1000, n, 0)")).alias("long")
    got = {r["source"]: r for r in out.groupBy("source").agg(*per).collect()}
    for s, r in want.items():
        assert abs(got[s]["n"] - r["n"]) <= 0.02 * r["n"] and abs(got[s]["n"] - r["t"]) <= 0.03 * r["t"]
        assert abs(got[s]["long"] - r["long"]) <= max(4000, 0.15 * r["long"])
    copies = out.groupBy("doc_id").count().join(mixed, "doc_id")
    assert copies.where("count not in (taken div size, taken div size + 1) or count * size - taken >= size").count() == 0
