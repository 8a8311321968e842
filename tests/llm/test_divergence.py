import re
from collections import Counter

import pytest
from llm_cases import EDGES

from tidehaul.llm import divergence
from tidehaul.llm.divergence import SCALE, Trees, share, source_divergence

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, least=30, ranks=50):
    """The contract with dictionaries; rows are (text, lang, source)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)) for t, _, _ in rows]
    docs, of_lang, of_group = {}, {}, {}
    for (_, lang, source), found in zip(rows, words, strict=True):
        docs.setdefault(lang, Counter()).update(set(found))
        of_lang.setdefault(lang, Counter()).update(found)
        of_group.setdefault((lang, source), Counter()).update(found)
    out = []
    for (lang, source), counts in of_group.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + SCALE * (c[t] + 5) // total for t in kept}

        p, q = shares(counts), shares(of_lang[lang])
        pairs = []
        for (other_lang, other), c in of_group.items():
            if other_lang == lang and other != source:
                o = shares(c)
                pairs.append((-sum(abs(p[t] - o[t]) for t in kept), other))
        terms = [(q[t] - p[t], t) for t in kept if counts[t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
            ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, -v, k) for k, (v, item) in enumerate(ranked, start=1)]
    return out


def check(docs, least=30, ranks=50):
    out = source_divergence(docs, least, ranks)
    assert out.dtypes == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")
    ]
    found = sorted(tuple(r) for r in out.collect())
    assert found == sorted(brute([(r["text"], r["lang"], r["source"]) for r in docs.collect()], least, ranks))
    return found


def test_whole_table_equals_brute_force(table):
    found = check(table("documents"))
    assert {r[2] for r in found} == {"pair", "term"}


def test_blocks_and_tiles(table, monkeypatch):
    """Many blocks of ids and many tiles of sources give what one of each gives."""
    monkeypatch.setattr(divergence, "BLOCK", 7)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "COUNTS_HELD", 50)
    found = check(table("documents"), least=3, ranks=4)
    assert max(r[5] for r in found if r[2] == "term") == 4


def test_edges_ties_and_clashing_columns(documents):
    """NULL is empty, in text, lang and source; groups without terms; terms beyond ASCII; names used inside."""
    rows = EDGES + [(k, "Éa éA ſs K a-b Z9z \x7f \U0001f600x", "en", s) for k, s in enumerate(["s1", "s2", None, ""])]
    rows += [(9, "one two two", "xx", "only"), (10, None, "xx", "empty"), (11, "", "", ""), (12, "!!", None, None)]
    docs = documents(rows, "term n docs _rank number side place size value rank item part")
    found = check(docs, least=1)
    assert next(r[4] for r in found if r[:4] == ("xx", "only", "pair", "empty")) > 0
    # Nothing is kept: all pairs are there, of value 0, by name.
    assert {r[4] for r in check(docs, least=10**6)} == {0}


def test_hot_source_and_repeated_rows(documents):
    rows = [(k, f"w{chr(97 + k % 7)} common", "en", "hot" if k % 3 else f"s{k % 11}") for k in range(300)]
    check(documents(rows + rows[:50]))


def test_empty_tables(documents):
    docs = documents([(1, "a", "en", "s")])
    assert source_divergence(docs.where("doc_id > 1")).count() == 0
    assert source_divergence(docs).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13])
def test_equal_subtrees_are_one_node_and_priced_once(size):
    trees = Trees()
    a = trees.tree({k: 1 + k % 2 for k in range(size)}, size)
    b = trees.tree({0: 4}, size)
    assert a == trees.tree({k: 1 + k % 2 for k in range(size)}, size)
    counts = [(1 + k % 2, 4 if k == 0 else 0) for k in range(size)]
    assert trees.price(a, b, 50, 70) == sum(abs(share(x, 50) - share(y, 70)) for x, y in counts)
    # 1024 equal places need a node for each level only.
    even = Trees()
    even.tree({k: 3 for k in range(1024)}, 1024)
    assert len(even.parts) == 12
