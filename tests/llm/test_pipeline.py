import corpus_pipeline as cp
from llm_cases import EDGES, SF
from test_decontaminate import brute as leaks
from test_minhash import brute as groups
from test_minhash import shingles


def test_stages_take_effect_in_turn(spark, table):
    """Each stage against what it got: brute force where there is one, its law otherwise."""
    docs = table("documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in table("labels").collect()}
    kept, now = {}, docs
    for name, stage in cp.STAGES:
        now = cp.written(stage(spark, now, SF), name)
        kept[name] = now
        if name != "sharding":
            assert now.columns == docs.columns
    one = [r["doc_id"] for r in kept["toxicity"].collect()]
    gone = set(before) - set(one)
    assert len(one) == len(set(one)) and sum(toxic.get(i, 1) for i in gone) >= 0.9 * len(gone)
    component = groups([(i, before[i]["text"]) for i in one], 5, 80)
    two = sorted(r["doc_id"] for r in kept["near_dedup"].collect())
    assert two == sorted(i for i, (_, c) in component.items() if i == c)
    held = leaks([(i, before[i]["text"]) for i in two], [(r["item_id"], r["text"]) for r in table("benchmark").collect()])
    three = sorted(r["doc_id"] for r in kept["decontamination"].collect())
    assert three == sorted(set(two) - {d for d, _ in held})
    four = [tuple(r) for r in kept["mixing"].collect()]
    assert {r[0] for r in four} <= set(three) and max(four.count(r) for r in four) <= 3
    five = kept["sharding"].collect()
    assert sorted(map(str, four)) == sorted(str(tuple(r)[: len(docs.columns)]) for r in five)
    counts = [sum(r["shard"] == s for r in five) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(r["text"] == before[r["doc_id"]]["text"] for r in five) and shingles("a b", 5) == {(b"a", b"b")}


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns)
    assert out.count() > 50 and [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


def _folder(spark, docs, sf=SF):
    """A folder of tables with these documents, and the labels and benchmark of another."""
    folder = cp.written(docs, "documents").inputFiles()[0].rpartition("/")[0] + "-sf"
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_edges_and_clashing_columns(spark, documents, table):
    """NULL and empty texts, NULL and repeated ids, a long text, and columns with names that the stages use."""
    base = [tuple(r)[:4] for r in table("documents").limit(60).collect()]
    rows = [(None if i is None else 10**6 + i, *rest) for i, *rest in EDGES]
    docs = documents([*base, *rows], "_toxicity _hit _id _times _doc _cell _order size taken row item_id")
    out = cp.run(spark, _folder(spark, docs))
    assert set(docs.columns) <= set(out.columns) and {"shard", "slot"} <= set(out.columns)
    found = out.collect()
    assert all(r["_hit"] == r["_id"] == r["size"] == "x" for r in found)
    texts = {r["text"] for r in found}
    assert None in texts and "" in texts
    assert {r["text"] for r in found} <= {t for _, t, *_ in [*base, *rows]}


def test_an_empty_table_stays_empty(spark, documents):
    docs = documents([(1, "a", "en", "s")]).where("doc_id > 1")
    assert cp.run(spark, _folder(spark, docs)).count() == 0
