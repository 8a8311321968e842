import itertools
import zlib

import numpy as np
import pytest
from llm_cases import EDGES
from pyspark.sql import functions as F

from tidehaul.llm.queries import queries
from tidehaul.llm.toxicity import SEGMENT, document_toxicity, fit_field, learn, marginals, toxicity, without_toxic, word_features

SF1 = "/root/testdata/sf0.1"


def enumerated(e, transition, start):
    total, ones = 0.0, np.zeros(len(e))
    for y in itertools.product((0, 1), repeat=len(e)):
        s = start[y[0]] + sum(e[k] * v for k, v in enumerate(y)) + sum(transition[a][b] for a, b in zip(y, y[1:], strict=False))
        total += np.exp(s)
        ones += np.exp(s) * np.array(y)
    return ones / total


def plain(e, transition, start):
    """Forward-backward token by token."""
    k, n = np.exp(transition), len(e)
    a, b = np.zeros((n, 2)), np.ones((n, 2))
    for t in range(n):
        x = np.exp(start) if t == 0 else a[t - 1] @ k
        a[t] = x * [1, np.exp(e[t])]
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = k @ (b[t + 1] * [1, np.exp(e[t + 1])])
        b[t] /= b[t].sum()
    return (a * b)[:, 1] / (a * b).sum(1)


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    transition, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    e = rng.normal(size=9) * 2
    assert np.allclose(marginals(e, np.array([9]), transition, start), enumerated(e, transition, start))
    lengths = np.array([1, SEGMENT, SEGMENT + 1, 3, 5 * SEGMENT - 1, 2])
    e = rng.normal(size=lengths.sum()) * 3
    want = np.concatenate([plain(p, transition, start) for p in np.split(e, np.cumsum(lengths)[:-1])])
    assert np.allclose(marginals(e, lengths, transition, start), want)


def test_fit_learns_words_and_beginnings():
    words = [["a", "badword", "b", "c"], ["c", "badly", "a"], ["a", "b", "c"], ["b", "good"]] * 10
    labels = [[int(w.startswith("bad")) for w in s] for s in words]
    field = fit_field([[word_features(w) for w in s] for s in words], labels)
    e = np.array([field.weights[word_features(w)].sum() + field.bias for w in ["a", "badword", "badwords", "good"]])
    m = marginals(e, np.array([4]), field.transition, field.start)
    assert m[1] > 0.8 and m[2] > 0.5 and m[0] < 0.2 and m[3] < 0.2


def test_held_out_accuracy_over_the_whole_table(spark):
    out = queries()["op4_toxicity"](spark, SF1)
    rows = out.join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").collect()
    assert out.count() == 10_000
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    toxic, clean = [r for r in held if r["toxic"]], [r for r in held if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


@pytest.fixture(scope="module")
def small(spark):
    """Documents of which every third says a bad word, their labels, and the edge rows."""
    rows = [(100 + k, f"plain words for you, number n{k} here. " + ("You scoundrel, scoundrelly! " if k % 3 == 0 else "") + "more text " * (k % 7)) for k in range(400)]
    labels = [(i, int("scoundrel" in t)) for i, t in rows] + [(None, 1), (5, None), (100, 0), (999_999, 1)]
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_edges_and_spans(spark, documents, small):
    rows, labels = small
    df = documents([*EDGES, *[(i, t, "en", "s") for i, t in rows]], "score spans toxicity predicted")
    out = document_toxicity(df, labels).collect()
    assert len(out) == len(EDGES) + len(rows)
    texts = dict(rows)
    for r in out:
        if r["doc_id"] in texts:
            t = texts[r["doc_id"]]
            assert r["predicted"] == int("scoundrel" in t)
            assert [t[s["start"] : s["stop"]] for s in r["spans"]] == (["scoundrel, scoundrelly"] if "scoundrel" in t else [])
        else:
            assert r["predicted"] == 0 and r["spans"] == []
    assert document_toxicity(df.limit(0), labels).collect() == []
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["score"] for r in document_toxicity(documents(EDGES), none).collect()} == {0.0}


def test_stage_drops_what_is_rejected(documents, small):
    rows, labels = small
    df = documents([*EDGES, *[(i, t, "en", "s") for i, t in rows]], "score _x")
    out = without_toxic(df, labels)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [i for i, *_ in EDGES] + [i for i, t in rows if "scoundrel" not in t]))


def test_labels_of_held_out_rows_are_not_read(spark, documents, small):
    rows, labels = small
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    df = documents([(i, t, "en", "s") for i, t in rows])
    one, two = learn(df, labels), learn(df, turned)
    assert (one.weights == two.weights).all() and (one.curve == two.curve).all()
    key = "doc_id"
    assert toxicity(df, one).select(key, "toxicity.score").exceptAll(toxicity(df, two).select(key, "toxicity.score")).isEmpty()
