import random

import pytest
from llm_cases import EDGES, SF01
from tokenizers import Tokenizer, models, pre_tokenizers

from tidehaul.llm.queries import queries
from tidehaul.llm.tokens import Counter, read_vocabulary, token_counts


def tokenizer(vocabulary, unk, byte_fallback):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=unk, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


def lengths(t, texts):
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary()


def test_query_over_the_whole_table_equals_the_tokenizer(spark, table, vocabulary):
    rows = table("documents", SF01).collect()
    want = lengths(tokenizer(vocabulary, 0, True), [r["text"] for r in rows])
    got = {r["doc_id"]: (r["n_chars"], r["n_tokens"]) for r in queries()["op6_token_counts"](spark, SF01).collect()}
    assert got == {r["doc_id"]: (len(r["text"]), n) for r, n in zip(rows, want, strict=True)}


def test_random_and_odd_texts(vocabulary):
    rng = random.Random(9)
    texts = ["", " ", "  ", " a", "a  b", "▁x▁▁", "<0x0A>", "<s></s><unk>", "\U0001f600\U0001f600é\n\n\tx", "中文 字符", "\0"]
    texts += ["".join(rng.choice("abetr \n.,<0x>éß中\U0001f600") for _ in range(rng.randrange(60))) for _ in range(400)]
    counter = Counter(vocabulary)
    assert [counter.text(t)[1] for t in texts] == lengths(tokenizer(vocabulary, 0, True), texts)


def test_ties_take_the_longest_last_piece():
    """Many equal sums: small whole scores over two letters, with and without unknown characters."""
    rng = random.Random(1)
    for _ in range(30):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 5))) for _ in range(12)} | {"▁"}
        vocabulary = [("<unk>", 0.0)] + [(p, -float(rng.randrange(1, 4))) for p in sorted(pieces)]
        texts = ["".join(rng.choice("ab ?") for _ in range(rng.randrange(1, 25))) for _ in range(40)]
        counter = Counter(vocabulary)
        assert [counter.text(t)[1] for t in texts] == lengths(tokenizer(vocabulary, 0, False), texts)


def test_edges(documents, vocabulary):
    out = token_counts(documents(EDGES, "n_tokens score id"), vocabulary).collect()
    want = lengths(tokenizer(vocabulary, 0, True), [t or "" for _, t, *_ in EDGES])
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r["doc_id"], r["n_chars"], r["n_tokens"]) for r in out], key=key) == sorted(
        [(i, len(t or ""), n) for (i, t, *_), n in zip(EDGES, want, strict=True)], key=key
    )
    assert token_counts(documents([]), vocabulary).collect() == []
