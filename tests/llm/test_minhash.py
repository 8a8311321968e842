import itertools
import random

import numpy as np
import pytest
from llm_cases import EDGES, SF01

from tidehaul.llm.minhash import deduplicated, near_duplicates, sketch
from tidehaul.llm.queries import queries


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    n = min(words, len(found))
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)}


def brute(rows, words, part):
    sets = {i: shingles(t, words) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    items = sorted(sets, key=lambda i: len(sets[i]))
    for k, a in enumerate(items):
        for b in items[k + 1 :]:
            if 100 * len(sets[a]) < part * len(sets[b]):
                break
            if sets[a] and root(a) != root(b):
                both = len(sets[a] & sets[b])
                if 100 * both >= part * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_over_the_whole_table(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents", SF01).collect()]
    out = queries()["op2_near_duplicates"](spark, SF01)
    assert got(out) == brute(rows, 3, 85)
    assert out.where("kept <> (doc_id = component_id)").count() == 0


def test_sketches_agree_with_the_similarity():
    rng = np.random.default_rng(5)
    for size, share in ((3, 1 / 3), (40, 0.5), (900, 0.8)):
        agree = []
        for _ in range(30):
            both = int(size * share)
            pool = rng.integers(1, 2**63, 2 * size - both, dtype=np.uint64)
            a, b = pool[:size], pool[size - both :]
            s = sketch([np.unique(a), np.unique(b)])
            assert (s != 0).all()
            agree.append((s[0] == s[1]).mean() - both / (2 * size - both))
        assert abs(np.mean(agree)) < 0.03


def chain(n, rng):
    """Texts each of which is near the next only, so that links lead through many."""
    words = [f"w{rng.random()}" for _ in range(300)]
    for k in range(n):
        yield " ".join(words)
        for j in range(12):
            words[(k * 12 + j) % 300] = f"c{k}-{j}"


def test_chains_groups_and_shared_passages(documents):
    rng = random.Random(3)
    rows = [(k, t) for k, t in enumerate(chain(25, rng))]
    base = [f"b{k}" for k in range(400)]
    for k in range(120):
        words = list(base)
        for _ in range(8):
            words[rng.randrange(400)] = f"x{rng.random()}"
        rows.append((1000 + k, " ".join(words)))
    passage = " ".join(f"p{k}" for k in range(300))
    rows += [(2000 + k, passage + " " + " ".join(f"o{k}-{j}" for j in range(55 + k))) for k in range(60)]
    rows += [(3000 + k, base_text) for k, base_text in enumerate(["same text here " * 20] * 40)]
    random.Random(1).shuffle(rows)
    df = documents([(i, t, "en", "s") for i, t in rows])
    assert got(near_duplicates(df, words=5, part=80)) == brute(rows, 5, 80)


def test_edges(documents):
    df = documents(EDGES, "component_id kept key rep n")
    out = near_duplicates(df, words=3, part=85).collect()
    assert len(out) == len(EDGES)
    by = {r["doc_id"]: r for r in out}
    assert by[None]["component_id"] is None and by[None]["kept"]
    for empty in (0, 1, 2):
        assert by[empty]["n_shingles"] == 0 and by[empty]["component_id"] == empty
    assert by[7]["component_id"] == 6 and not by[7]["kept"]
    assert near_duplicates(documents([])).collect() == []


def test_stage_keeps_one_row_of_each_group(documents):
    df = documents(EDGES, "kept")
    out = deduplicated(df)
    assert out.columns == df.columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert ids == sorted([0, 1, 2, 3, 4, 5, 6, 8, None], key=str)


def test_rows_of_an_id_link_by_any_of_their_texts(documents):
    """Two texts under one id, each near another document, in either order: all three are one group."""
    rng = random.Random(6)
    base = [[f"{k}w{rng.randrange(10**6)}" for _ in range(120)] for k in "ab"]
    near = [" ".join(w if j != 60 else "changed" for j, w in enumerate(words)) for words in base]
    a, b = (" ".join(words) for words in base)
    for five in ((a, b), (b, a)):
        rows = [(1, near[0], "en", "s"), (2, near[1], "en", "s"), *[(5, t, "en", "s") for t in five], (9, "alone", "en", "s")]
        out = near_duplicates(documents(rows), words=3, part=85, whole=100).collect()
        assert {(r["doc_id"], r["component_id"]) for r in out} == {(1, 1), (2, 1), (5, 1), (9, 9)}
