import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import EDGES, SF01

from tidehaul.llm import decontaminate as dc
from tidehaul.llm.decontaminate import common_subsequence, contaminated, decontaminated, terms_of
from tidehaul.llm.queries import queries

ITEMS = "item_id long, text string"


@pytest.mark.parametrize("seed", range(5))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 90))] for _ in range(2))
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    assert common_subsequence(a, b) == row[-1]


def brute(docs, items, least=dc.LEAST_COMMON):
    """Every document against every item: the best common share of any stretch as long as the search's regions."""
    out = set()
    for d, text in docs:
        said = terms_of(text)
        for i, item in items:
            words = terms_of(item)
            if not words or len(set(said) & set(words)) < least * len(set(words)) / 2:
                continue
            n = len(words)
            for first in range(0, max(1, len(said)), dc.BLOCK):
                region = said[max(0, first - n) : first + 2 * dc.BLOCK + n]
                if common_subsequence(words, region) >= least * n:
                    out.add((d, i))
                    break
    return out


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_query_over_the_whole_table(spark, table):
    docs = [(r["doc_id"], r["text"]) for r in table("documents", SF01).collect()]
    items = [(r["item_id"], r["text"]) for r in table("benchmark", SF01).collect()]
    want = brute(docs, items)
    got = pairs(queries()["op9_decontamination"](spark, SF01))
    assert got <= want and len(got & want) >= 0.95 * len(want) and len(want) > 10


def test_space_equals_the_exact_decomposition(spark):
    rng = np.random.default_rng(3)
    rows, dense = [], np.zeros((60, dc.DIMENSIONS))
    for k in range(60):
        at = np.sort(rng.choice(40, 8, replace=False))
        x = rng.random(8)
        dense[k, at] = x
        rows.append((at.tolist(), x.tolist()))
    df = spark.createDataFrame(rows, "at array<long>, x array<float>").repartition(4)
    q = dc.fit_space(df, rank=32, rounds=8)
    exact = np.linalg.svd(dense[:, :40])[2][:8]
    assert (np.linalg.norm(exact @ q[:40], axis=1) > 0.99).all()
    assert np.allclose(q.T @ q, np.eye(32), atol=1e-4)


def test_matrix_and_products_equal_plain_ones():
    """All passages of all texts, the last short ones too, and products in pieces."""
    rng = np.random.default_rng(5)
    idf = np.append(rng.random(dc.TERMS) + 1, 0).astype(np.float32)
    idf[:40] = 0
    texts = [rng.integers(0, 300, n) for n in (0, 1, 32, 33, 700, 5)] + [np.array([dc.TERMS, 3])]
    row, at, x = dc.passage_matrix(texts, idf)
    want = [dc.weighted(t[k : k + 32], idf) for t in texts for k in range(0, len(t), 32)]
    dense = np.zeros((len(want), 300), np.float32)
    for k, (a, v) in enumerate(want):
        dense[k, a] = v
    got = np.zeros_like(dense)
    got[row, at] = x
    assert np.allclose(got, dense, atol=1e-6) and (np.diff(row) >= 0).all()
    q = rng.standard_normal((300, 7)).astype(np.float32)
    for most in (1, 5, 16, 1000):
        out = np.zeros((300, 7), np.float32)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(dc, "ROWS_AT_ONCE", most)
            dc.add_product(out, row, at, x, q)
        assert np.allclose(out, dense.T @ (dense @ q), atol=1e-4)


def test_texts_are_numbered_together_as_one_by_one(monkeypatch):
    rng = random.Random(9)
    parts = ["a", "Bc", "z9", " ", "  ", "\t", "\n", "-", "…", "é", "漢", "'", "(", "\x0b", "\x1c", "\x00", "\u2003"]
    texts = [None, "", " ", "-", "ab", "cd"] + ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(200)]
    for most in (1, 50, 1 << 16):
        monkeypatch.setattr(dc, "BYTES_AT_ONCE", most)
        for some in (texts, [*texts, "x" * 1500 + " y", "tail"], ["a b " * 50000, None, "c"], [None], []):
            got = list(dc.numbered(pa.array(["cut", *some], pa.string())[1:]))
            assert len(got) == len(some)
            assert all(np.array_equal(g, dc.numbers_of(t)) for g, t in zip(got, some, strict=True))


def test_all_rows_are_read_once_for_all_rounds(spark):
    """In any order of columns, and where the last squares are not full."""
    rng = np.random.default_rng(2)
    size = 2 * dc.TILE + 30
    dense, rows = np.zeros((500, size), np.float32), []
    for k in range(500):
        at = rng.choice(size, rng.integers(1, 20), replace=False)
        dense[k, at] = rng.random(len(at))
        rows.append((at.tolist(), dense[k, at].tolist()))
    seen = spark.sparkContext.accumulator(0)

    def watch(batch):
        seen.add(batch.num_rows)
        yield from dc._listed(batch)

    df = spark.createDataFrame(rows, "at array<long>, x array<float>").repartition(4)
    held = np.zeros((6, dc.TILE**2), np.float32)
    for part in dc._listed(pa.RecordBatch.from_pylist([{"at": a, "x": x} for a, x in rows])):
        dc.add_gram(held.reshape(-1), *part, 3)
    q, out = rng.standard_normal((size, 5)).astype(np.float32), np.zeros((size, 5), np.float32)
    for k, (i, j) in enumerate(zip(*np.triu_indices(3), strict=True)):
        dc.add_tile(out, i, j, held[k].reshape(dc.TILE, dc.TILE), q)
    assert np.allclose(out, dense.T @ (dense @ q), atol=1e-2)
    space = dc.fit_space(df, rank=16, rounds=6, dimensions=size, rows=watch)
    assert seen.value == 500
    # The leading direction stands out, the others less.
    assert np.linalg.norm(np.linalg.svd(dense)[2][:1] @ space) > 0.99


def test_texts_without_passages(spark, documents):
    bench = spark.createDataFrame([(1, "red blue green white black")], ITEMS)
    assert contaminated(documents([(1, None, "en", "s"), (2, " - ", "en", "s")]), bench).collect() == []


def test_the_space_is_fitted_on_every_passage(spark, documents, monkeypatch):
    """More passages than the 4,000 of old; words late in long texts count as those at the start do."""
    rng = random.Random(6)
    rows = [(k, " ".join(_words(rng, "w", 640)), "en", "s") for k in range(250)]
    seen = {}
    fit = dc.fit_space

    def watch(passages, *args, rows, more, **options):
        seen["entries"] = sum(len(p["x"]) // 4 for p in passages.collect())
        seen["passages"] = sum(len(p["sizes"]) // 4 for p in passages.collect())
        seen["items"] = len(set(more[0].tolist()))
        return fit(passages, *args, rows=rows, more=more, **options)

    monkeypatch.setattr(dc, "fit_space", watch)
    bench = spark.createDataFrame([(k, " ".join(_words(rng, "w", 30))) for k in range(3)], ITEMS)
    contaminated(documents(rows), bench).collect()
    distinct = sum(len(set(t.split()[k : k + 32])) for _, t, *_ in rows for k in range(0, 640, 32))
    # Words of a number are one term, and those of two numbers one document have no dimension.
    assert 0.95 * distinct < seen["entries"] <= distinct and seen["passages"] == 5000 and seen["items"] == 3


@pytest.fixture(scope="module")
def planted(spark):
    """Filler documents, items, and documents that hold items whole, broken over lines, or paraphrased."""
    rng = random.Random(8)
    vocabulary = [f"word{k}" for k in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(15 + k)) for k in range(30)]
    rows = [(100 + k, text(rng.randrange(5, 400)), "en", "s") for k in range(200)]
    want = set()
    for k, item in items:
        words = item.split()
        if k % 3 == 1:
            words = [w if j % 9 else w + "\n" for j, w in enumerate(words)]
        if k % 3 == 2:
            words = [w if j % 6 else "other" for j, w in enumerate(words)]
        rows.append((1000 + k, text(rng.randrange(200)) + " " + " ".join(words) + " " + text(rng.randrange(200)), "en", "s"))
        want.add((1000 + k, k))
    return rows, items, want


def test_planted_items_are_found_and_others_left(spark, documents, planted):
    rows, items, want = planted
    df = documents([*EDGES, *rows], "item_id answer common x")
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (None, "…")], ITEMS)
    assert pairs(contaminated(df, bench)) == want
    # A benchmark of several passes gives the same.
    assert pairs(contaminated(df, bench, items_in_pass=11)) == want
    stage = decontaminated(df, bench)
    assert stage.columns == df.columns
    gone = {d for d, _ in want}
    assert sorted(str(r["doc_id"]) for r in stage.collect()) == sorted(str(i) for i, *_ in [*EDGES, *rows] if i not in gone)


def test_paraphrases_need_their_answer(spark, documents, planted):
    """Copies, whole or broken over lines, are found without it."""
    rows, items, _ = planted
    answers = [(k, t, t.split()[-7] if k % 2 else "elsewhere") for k, t in items]
    bench = spark.createDataFrame(answers, ITEMS + ", answer string")
    kept = {w for _, text, *_ in rows for w in text.split()}
    found = pairs(contaminated(documents(rows), bench))
    for k, text, answer in answers:
        place = next(r[1] for r in rows if r[0] == 1000 + k)
        needed = k % 3 == 2 and answer not in place.split()
        assert ((1000 + k, k) in found) == (not needed), k
    assert "elsewhere" not in kept and len(found) < len(items)


def test_short_items_match_whole_texts_only(spark, documents):
    rows = [(1, "the cat sat on the mat", "en", "s"), (2, "The!", "en", "s"), (3, "the the", "en", "s"), (4, "red, blue - GREEN", "en", "s")]
    rows += [(5, "a red blue green thing", "en", "s"), (6, "one two three four", "en", "s"), (7, "zero one two three four five", "en", "s")]
    bench = spark.createDataFrame([(1, "the"), (2, "red blue green"), (3, "one two three four"), (4, "red")], ITEMS)
    assert pairs(contaminated(documents(rows), bench)) == {(2, 1), (4, 2), (6, 3), (7, 3)}


def test_empty_tables(spark, documents, planted):
    _, items, _ = planted
    bench = spark.createDataFrame(items, ITEMS)
    assert contaminated(documents([]), bench).collect() == []
    assert contaminated(documents(EDGES), bench.limit(0)).collect() == []
    assert decontaminated(documents(EDGES), bench.limit(0)).count() == len(EDGES)


def _words(rng, stem, n):
    return [f"{stem}{rng.randrange(5000)}" for _ in range(n)]


def test_an_item_in_half_of_all_documents(spark, documents):
    """Its words are then the commonest of all, in a table of many rows and of few."""
    for count in (120, 6):
        rng = random.Random(count)
        item = " ".join(_words(rng, "item", 40))
        rows = [
            (k, " ".join(_words(rng, "w", 60) + item.split() * (k % 2) + _words(rng, "w", 60)), "en", "s") for k in range(count)
        ]
        bench = spark.createDataFrame([(5, item)], ITEMS)
        assert pairs(contaminated(documents(rows), bench)) == {(k, 5) for k in range(1, count, 2)}


def test_items_with_more_terms_than_dimensions(spark, documents):
    """Many items together, and a single one: copies of all of them are found."""
    rng = random.Random(4)
    items = [(k, " ".join(f"i{k}t{j}" for j in range(60))) for k in range(200)]
    items.append((900, " ".join(f"huge{j}" for j in range(9000))))
    rows = [(k, " ".join([*_words(rng, "w", 40), item, *_words(rng, "w", 40)]), "en", "s") for k, item in items]
    got = contaminated(documents(rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k, _ in items} and len(got) == len(items)
    assert all(r["common"] == 1.0 for r in got)


def test_long_and_short_items_equal_brute_force(spark, documents):
    """Items of 5, 15, 500 and 2000 words, copied, with words changed or put in, or below the share; rare and common words."""
    rng = random.Random(12)
    items = [(n + k, " ".join(_words(rng, f"v{n}x{k}x", n))) for n in (5, 500, 2000) for k in range(2)]
    items.append((15, " ".join(f"all{k}" for k in range(15))))
    rows = []
    for i, item in items:
        words = item.split()
        for share in (0.0, 0.2, 0.28, 0.5):
            changed = [w if j % 100 >= share * 100 else "other" for j, w in enumerate(words)]
            rng.shuffle(order := list(range(len(words))))
            spread = [w if k >= share * len(words) else f"new{j}" for j, (w, k) in enumerate(zip(words, order, strict=True))]
            for kind in (changed, spread, [x for w in words for x in ((w, "and") if rng.random() < share else (w,))]):
                around = [_words(rng, "w", rng.randrange(70)) for _ in range(2)]
                rows.append((len(rows), " ".join([*around[0], *kind, *around[1]]), "en", "s"))
    for _ in range(60):  # the words of item 15 are common ones
        text = _words(rng, "w", 300)
        rows.append((len(rows), " ".join(w if rng.random() < 0.9 else f"all{rng.randrange(15)}" for w in text), "en", "s"))
    want = brute([r[:2] for r in rows], items)
    got = contaminated(documents(rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 50
