import random

import duckdb
from llm_cases import EDGES, SF01

from tidehaul.llm.licenses import TEMPLATES, license_scan
from tidehaul.llm.queries import oracle_sql, queries


def found(df):
    return sorted((str(r["doc_id"]), r["license"], round(r["containment"], 9), r["first_word"]) for r in df.collect())


def sql(df):
    c = duckdb.connect()
    c.register("documents", df.toPandas())
    return sorted((str(i), k, round(x, 9), w) for i, k, x, w in c.execute(oracle_sql()["op10_license_scan"]).fetchall())


def test_query_over_the_whole_table_equals_sql(spark, table):
    got = found(queries()["op10_license_scan"](spark, SF01))
    assert len(got) > 20 and got == sql(table("documents", SF01).select("doc_id", "text"))


def test_whole_cut_and_changed_notices(documents):
    rng = random.Random(6)
    rows = []
    for k in range(150):
        words = rng.choice(list(TEMPLATES.values())).split()
        if k % 3:
            at = rng.randrange(len(words))
            words[at : at + k % 4] = ["changed"] * (k % 2)
        filler = [f"w{rng.randrange(50)}" for _ in range(60)]
        at = rng.randrange(60)
        rows.append((k, " ".join(filler[:at] + words + filler[at:]), "en", "s"))
    df = documents(rows)
    got = found(license_scan(df))
    assert got == sql(df.select("doc_id", "text")) and 50 < len(got) < 200


def test_edges(documents):
    mit = TEMPLATES["MIT"]
    rows = [*EDGES, (20, mit, "en", "s"), (21, f"x {mit.upper()}. {mit}", "en", "s"), (22, "word " * 20_000 + mit, "en", "s"),
            (23, " ".join(mit.split()[:4]), "en", "s"), (20, mit, "en", "s")]
    got = found(license_scan(documents(rows, "license _words t")))
    assert got == [("20", "MIT", 1.0, 0), ("20", "MIT", 1.0, 0), ("21", "MIT", 1.0, 1), ("22", "MIT", 1.0, 20_000)]
    assert license_scan(documents([])).collect() == []
    assert license_scan(documents(rows), {"short": "two words"}).collect() == []
