import hashlib
import random

import pytest
from llm_cases import EDGES, SF

from tidehaul.llm import fingerprints as fp
from tidehaul.llm.fingerprints import edit_distance_within, edited_fingerprints, fingerprints, likeness, near_documents, walks
from tidehaul.llm.queries import queries


def one(text):
    return walks().fingerprints([text])[0]


def embedded(text):
    """The written characters of a text, one walk after the other, in plain Python."""
    w, out = walks(), []
    for at in range(0, max(1, len(text)), fp.STRETCH):
        place, last = at, at + fp.STRETCH >= len(text)
        for j in range(fp.STEPS):
            if place >= len(text):
                # An earlier walk that has passed the end writes the end; the last one stops.
                if last:
                    break
                out.append("\0")
                continue
            out.append(text[place])
            c = ((ord(text[place]) * 2654435761 % 2**32) >> 7) % 255 + 1
            place += int(w.moves[j, c])
    return out


def sampled(text):
    w, chars = walks(), embedded(text)
    if not chars:
        return "0" * fp.SLOTS
    digits = []
    for salt, record in zip(w.salts, w.records, strict=True):
        p = max(int(r) for r in record if r < len(chars))
        q = min(p + 1, len(chars) - 1)
        x = (ord(chars[p]) << 32 | ord(chars[q])) ^ int(salt)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % 2**64
        digits.append((x ^ x >> 31) >> 60)
    return "".join("0123456789abcdef"[d] for d in digits)


def test_fingerprints_equal_plain_walks():
    rng = random.Random(4)
    texts = ["", "a", "ab", "ÄÖ \U0001f600", "\0\0x", "x" * 5000] + [
        "".join(rng.choice("abc def\n") for _ in range(n)) for n in (10, 1023, 1024, 1025, 4000)
    ]
    assert walks().fingerprints(texts) == [sampled(t) for t in texts] == [one(t) for t in texts]


def test_likeness_falls_with_edits():
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcdefghij klmnop") for _ in range(5000)) for _ in range(8)]
    text, means = texts[0], []
    for edits in (0, 3, 100, 1500):
        found = []
        for t in texts:
            chars = list(t)
            for _ in range(edits):
                k = rng.randrange(len(chars))
                chars[k : k + 1] = rng.choice([[], ["x"], [chars[k], "y"]])
            found.append(likeness(one(t), one("".join(chars))))
        means.append(sum(found) / len(found))
    assert means[0] == 1 and means[1] > 0.8 and means == sorted(means, reverse=True) and means[3] < 0.5
    other = "".join(rng.choice("abcdefghij klmnop") for _ in range(5000))
    assert likeness(one(text), one(other)) < 0.3


def expected(rows):
    # Highest id first, NULL ids last; equal ids by text.
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following))
    return out


def check(rows, out):
    prints = {}

    def of(text):
        if text not in prints:
            prints[text] = one(text)
        return prints[text]

    want = [(i, n, sha, of(t), of(e), likeness(of(t), of(e)), likeness(of(t), of(x))) for i, n, sha, t, e, x in expected(rows)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_query_over_the_whole_table(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    out = queries()["op1_edit_fingerprints"](spark, SF).collect()
    check(rows, out)
    assert sum(r["near_edited"] > r["near_next"] for r in out) > 0.9 * len(out)


def test_edges(documents):
    check(EDGES, edited_fingerprints(documents(EDGES, "part ghost head")).collect())
    assert edited_fingerprints(documents([])).collect() == []
    nulls = [(None, "b", None, None), (None, "a", None, None)]
    check(nulls, edited_fingerprints(documents(nulls)).collect())
    check(EDGES[:1], edited_fingerprints(documents(EDGES[:1])).collect())
    many = [(5, f"text {k}", "en", "s") for k in range(20)] + [(k, "x" * k, "en", "s") for k in range(300)]
    check(many, edited_fingerprints(documents(many)).collect())
    assert fingerprints(documents(EDGES)).count() == len(EDGES)


@pytest.mark.parametrize(("a", "b"), [("kitten", "sitting"), ("", "abc"), ("abc", "abc"), ("ab" * 40, "ba" * 40), ("x", "yyyyyyyyy")])
def test_edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    for most in (0, 2, 3, 8, 200):
        assert edit_distance_within(a, b, most) == (row[-1] if row[-1] <= most else None)


def test_banding_finds_near_texts(documents):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefgh ijkl") for _ in range(2000)) for _ in range(8)]
    rows = []
    for g, text in enumerate(base):
        for k in range(4):
            chars = list(text)
            for _ in range(3 * (k > 0)):
                chars[rng.randrange(len(chars))] = "#"
            rows.append((10 * g + k, "".join(chars), "en", "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, base[0], "en", "s"), (None, base[0], "en", "s")]
    got = {r["doc_id"]: r["component_id"] for r in near_documents(documents(rows, "key a b")).collect()}
    assert all(got[10 * g + k] == 10 * g for g in range(8) for k in range(4))
    assert got[900] == 900 and got[901] == 901 and got[902] == 0
