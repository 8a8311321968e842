"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import free_name, ready_for_python, replace_columns
from tidehaul.llm.minhash import shingle_hashes
from tidehaul.session import written

# Labelled documents that are learned from at most, and sequences of tokens that the field is fitted on.
TRAINING_DOCUMENTS = 20_000
TRAINING_SEQUENCES = 4_000
SEQUENCE = 32
BUCKETS = 1 << 19
REJECT_FROM = 0.7
SEGMENT = 64
KNOWN_WORDS = 100_000
# Tokens whose marginals are computed together: bounds a task's memory, not what is read.
TOGETHER = 250_000

TOKEN = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """Buckets of a lower-case word and of its beginnings of three to six letters."""
    parts = [word, *[f"{word[:k]}*{k}" for k in (3, 4, 5, 6) if len(word) >= k]]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class _Features(dict):
    def __missing__(self, word: str) -> list[int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        out = self[word] = word_features(word)
        return out


@dataclass
class Field:
    """Weights of the field, and of the logistic curve over what it finds in a document."""

    weights: np.ndarray
    bias: float
    transition: np.ndarray
    start: np.ndarray
    curve: np.ndarray
    base: float


class _Emissions(dict):
    """Score of label 1 over label 0 for each word seen so far."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        f = self.field
        out = self[word] = float(f.weights[word_features(word)].sum()) + f.bias
        return out


def marginals(e: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """P(label 1) of each token of chains that lie one after the other in ``e``; exact, by forward-backward.

    Chains are cut into segments. The product of each segment's step matrices
    is computed for all segments side by side, the products are carried along
    each chain, and with the values at its borders known each segment is done
    on its own.
    """
    if not len(e):
        return np.zeros(0)
    a = np.exp(np.clip(e, -25, 25))
    k, s = np.exp(transition), np.exp(start)
    segments = -(-lengths // SEGMENT)
    chain = np.repeat(np.arange(len(lengths)), segments)
    ordinal = np.arange(len(chain)) - np.repeat(np.cumsum(segments) - segments, segments)
    token_chain = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(e)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = (np.cumsum(segments) - segments)[token_chain] + at // SEGMENT
    n = len(chain)
    grid = np.full((SEGMENT, n), -1.0)
    grid[at % SEGMENT, row] = a
    first = ordinal == 0

    def step(j):
        """The four entries of the step matrices of place j; identity where there is no token."""
        x = grid[j]
        have = x >= 0
        m = [np.full(n, k[0, 0]), np.full(n, k[0, 1]), np.full(n, k[1, 0]), np.full(n, k[1, 1])]
        if j == 0:
            for i, v in enumerate((s[0], s[1], s[0], s[1])):
                m[i] = np.where(first, v, m[i])
        return (
            np.where(have, m[0], 1.0),
            np.where(have, m[1] * x, 0.0),
            np.where(have, m[2], 0.0),
            np.where(have, m[3] * x, 1.0),
        )

    p = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
    for j in range(SEGMENT):
        m = step(j)
        p = [p[0] * m[0] + p[1] * m[2], p[0] * m[1] + p[1] * m[3], p[2] * m[0] + p[3] * m[2], p[2] * m[1] + p[3] * m[3]]
        total = p[0] + p[1] + p[2] + p[3]
        p = [x / total for x in p]
    left, right = np.full((2, n), 0.5), np.full((2, n), 0.5)
    by_ordinal = np.argsort(ordinal, kind="stable")
    bounds = np.searchsorted(ordinal[by_ordinal], np.arange(int(segments.max()) + 1))
    for o in range(1, len(bounds) - 1):
        i = by_ordinal[bounds[o] : bounds[o + 1]]
        x, y = left[0, i - 1], left[1, i - 1]
        u, v = x * p[0][i - 1] + y * p[2][i - 1], x * p[1][i - 1] + y * p[3][i - 1]
        left[0, i], left[1, i] = u / (u + v), v / (u + v)
    for o in range(len(bounds) - 2, 0, -1):
        i = by_ordinal[bounds[o] : bounds[o + 1]]
        x, y = right[0, i], right[1, i]
        u, v = p[0][i] * x + p[1][i] * y, p[2][i] * x + p[3][i] * y
        right[0, i - 1], right[1, i - 1] = u / (u + v), v / (u + v)
    ahead = np.empty((SEGMENT, 2, n))
    x, y = left
    for j in range(SEGMENT):
        m = step(j)
        u, v = x * m[0] + y * m[2], x * m[1] + y * m[3]
        total = u + v
        x, y = u / total, v / total
        ahead[j, 0], ahead[j, 1] = x, y
    out = np.empty((SEGMENT, n))
    x, y = right
    for j in range(SEGMENT - 1, -1, -1):
        one, other = ahead[j, 1] * y, ahead[j, 0] * x
        out[j] = one / (one + other)
        m = step(j)
        u, v = m[0] * x + m[1] * y, m[2] * x + m[3] * y
        total = u + v
        x, y = u / total, v / total
    return out[at % SEGMENT, row]


def fit_field(features: list[list[list[int]]], labels: list[list[int]], rounds: int = 80) -> Field:
    """Weights by full-batch Adam on the negative log-likelihood of labelled sequences, with a small L2 term."""
    width = 5
    n_seq, longest = len(features), max(len(f) for f in features)
    index = np.zeros((n_seq, longest, width), np.int64)
    count = np.zeros((n_seq, longest, width))
    y, have = np.zeros((n_seq, longest), np.int64), np.zeros((n_seq, longest), bool)
    for i, (f, ls) in enumerate(zip(features, labels, strict=True)):
        for j, (buckets, label) in enumerate(zip(f, ls, strict=True)):
            index[i, j, : len(buckets)] = buckets
            count[i, j, : len(buckets)] = 1
            y[i, j], have[i, j] = label, True
    used, compact = np.unique(index, return_inverse=True)
    compact = compact.reshape(index.shape)
    lengths = have.sum(1)
    w, rest = np.zeros(len(used)), np.zeros(7)  # rest: bias, transitions (4), start (2)
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, rest)]
    flat = have.reshape(-1)
    pairs = have[:, 1:]
    seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)], float)
    begun = np.array([(y[:, 0] == a).sum() for a in (0, 1)], float)
    for t in range(1, rounds + 1):
        e = (w[compact] * count).sum(2) + rest[0]
        trans, start = rest[1:5].reshape(2, 2), rest[5:]
        m = np.zeros(n_seq * longest)
        m[flat] = marginals(e.reshape(-1)[flat], lengths, trans, start)
        m = m.reshape(n_seq, longest)
        expected = _pair_counts(e, have, trans, start)
        miss = np.where(have, m - y, 0.0)
        gradient = (
            np.bincount(compact.reshape(-1), (miss[:, :, None] * count).reshape(-1), len(used)) / n_seq + 1e-4 * w,
            np.concatenate(
                [
                    [miss.sum()],
                    (expected - seen).reshape(-1),
                    [(1 - m[:, 0]).sum() - begun[0], m[:, 0].sum() - begun[1]],
                ]
            )
            / n_seq
            + 1e-4 * rest,
        )
        for v, g, (one, two) in zip((w, rest), gradient, state, strict=True):
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            v -= 0.2 * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.99**t)) + 1e-9)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return Field(weights, float(rest[0]), rest[1:5].reshape(2, 2).copy(), rest[5:].copy(), np.zeros(4), 0.0)


def _pair_counts(e: np.ndarray, have: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Expected number of each pair of neighbouring labels, over all sequences of a batch."""
    n, longest = e.shape
    a = np.stack([np.ones_like(e), np.exp(np.clip(e, -25, 25))], 2)
    k = np.exp(transition)
    alpha = np.empty((longest, n, 2))
    x = np.exp(start) * a[:, 0]
    for j in range(longest):
        if j:
            x = np.where(have[:, j, None], (x @ k) * a[:, j], x)
        x = x / x.sum(1, keepdims=True)
        alpha[j] = x
    out, beta = np.zeros((2, 2)), np.ones((n, 2))
    for j in range(longest - 1, 0, -1):
        on = have[:, j, None]
        ahead = beta * a[:, j]
        pair = alpha[j - 1][:, :, None] * k[None] * ahead[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        out += (pair * on[:, :, None]).sum(0)
        beta = np.where(on, ahead @ k.T, beta)
        beta /= beta.sum(1, keepdims=True)
    return out


def _summary(m: np.ndarray) -> list[float]:
    total = float(m.sum())
    return [1.0, float(np.log1p(total)), float(m.max(initial=0.0)), total / (len(m) + 10)]


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small L2 term."""
    c = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(c)), x.T @ (y - p) - 0.05 * c)
        c += np.clip(step, -4, 4)
    return c


def _chains(texts: Iterator[str | None], emissions: _Emissions) -> Iterator[tuple[str, np.ndarray]]:
    """(lower-case text, marginals of its tokens), in order."""
    held: list[tuple[str, np.ndarray]] = []
    n = 0

    def done():
        lengths = np.array([len(e) for _, e in held], np.int64)
        live = lengths > 0
        f = emissions.field
        m = marginals(
            np.concatenate([e for _, e in held]) if live.any() else np.zeros(0), lengths[live], f.transition, f.start
        )
        parts = iter(np.split(m, np.cumsum(lengths[live])[:-1])) if live.any() else iter(())
        for (low, _), some in zip(held, live, strict=True):
            yield low, next(parts) if some else np.zeros(0)

    for text in texts:
        low = (text or "").lower()
        words = TOKEN.findall(low)
        held.append((low, np.fromiter(map(emissions.__getitem__, words), np.float64, len(words))))
        n += len(words) + SEGMENT
        if n >= TOGETHER:
            yield from done()
            held, n = [], 0
    if held:
        yield from done()


def _spans(low: str, m: np.ndarray) -> list[dict]:
    """Runs of tokens that are more likely toxic than not, as code point offsets."""
    out: list[dict] = []
    if (m > 0.5).any():
        last = -2
        for j, token in enumerate(TOKEN.finditer(low)):
            if m[j] > 0.5:
                if last == j - 1:
                    out[-1]["stop"] = token.end()
                else:
                    out.append({"start": token.start(), "stop": token.end()})
                last = j
    return out


SCORED = "score double, spans array<struct<start:int,stop:int>>"


def toxicity(df: DataFrame, field: Field | None, text_column: str = "text", name: str = "toxicity") -> DataFrame:
    """``df`` with a struct column of ``score`` (0 to 1) and ``spans``; a row stays where it is.

    ``spans`` are offsets in the lower-cased text, which has the length of the
    text but for a few letters that lower-case to two. Empty and NULL texts
    get the score of a document in which nothing is found. Without a field
    (nothing to learn from) the score is 0.
    """
    df = replace_columns(df, [name])
    ready_for_python(df.sparkSession)
    if field is None:
        return df.withColumn(name, F.expr("named_struct('score', 0D, 'spans', cast(array() as array<struct<start:int,stop:int>>))"))
    shared = df.sparkSession.sparkContext.broadcast(field)  # BUCKETS floats, whatever the data

    @F.pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emissions = _Emissions(shared.value)
        curve = shared.value.curve
        for texts in batches:
            scores, spans = [], []
            for low, m in _chains(iter(texts), emissions):
                scores.append(1 / (1 + np.exp(-np.clip(np.dot(_summary(m), curve), -30, 30))))
                spans.append(_spans(low, m))
            yield pd.DataFrame({"score": pd.Series(scores, dtype="float64"), "spans": pd.Series(spans, dtype="object")})

    # So that a filter on the column does not run the function once more.
    return df.withColumn(name, score.asNondeterministic()(F.col(text_column)))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    training_documents: int = TRAINING_DOCUMENTS,
    training_sequences: int = TRAINING_SEQUENCES,
) -> Field | None:
    """Fits the field on labelled documents whose crc32(doc_id) mod 3 is not 1.

    At most about ``training_documents`` of them are used, chosen by hash of
    the id, one of each group of texts with the same least shingle hash. Token
    labels come from document labels: a token of a toxic document is toxic if
    the word, or a beginning of it, is found in toxic documents so much more
    often than chance that no such feature is expected by luck (log-likelihood
    ratio over the logarithm of the number of features) and almost never in
    others. The field is fitted on one window of tokens from each of at most
    ``training_sequences`` documents; it generalises over the features.
    Document scores are a logistic curve over its marginals. Ids that have
    several labels count as toxic if any says so. Without both labels among
    them there is nothing to learn, and the result is None.
    """
    spark = documents.sparkSession
    ready_for_python(spark)
    told = labels.where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    told = told.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = told.count()
    if not n:
        return None
    part = min(1.0, training_documents / n)
    some = told.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20)) + (part == 1.0))
    texts = documents.select("doc_id", "text").where("text is not null").join(
        F.broadcast(some), "doc_id"  # about training_documents pairs of numbers
    )

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [int(s.min()) >> 1 if len(s) else 0 for s in (shingle_hashes(t.as_py(), 5) for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), batch.column("toxic"), pa.array(keys, pa.int64())],
                names=["doc_id", "text", "toxic", "key"],
            )

    keyed = texts.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        least, "doc_id bigint, text string, toxic int, key bigint"
    )
    sample = written(
        keyed.groupBy("key", "toxic").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id")),
        "labelled",
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts, docs = _Features(), np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                found = {b for w in set(TOKEN.findall(text.as_py().lower())) for b in features[w]}
                counts[1 if toxic else 0, np.fromiter(found, np.int64, len(found))] += 1
                docs[1 if toxic else 0] += 1
        at = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[0, at], docs[0])), pa.array(np.append(counts[1, at], docs[1]))],
            names=["bucket", "clean", "toxic"],
        )

    sums = sample.select("text", "toxic").mapInArrow(counted, "bucket bigint, clean bigint, toxic bigint")
    sums = written(
        sums.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "feature-counts"
    )
    whole = sums.where("bucket = -1").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return None
    rate = whole["toxic"] / (whole["toxic"] + whole["clean"])
    features = sums.where("bucket >= 0").withColumn("share", F.expr("toxic / (toxic + clean)"))
    # The features that tell of toxic documents beyond chance; only these come to the driver.
    ratio = F.expr(f"toxic * ln(share / {rate!r}D) + if(clean > 0, clean * ln((1 - share) / {1 - rate!r}D), 0)")
    telling = features.where("share > 0.8").where(ratio > math.log(features.count() + 1.0))
    tells = np.zeros(BUCKETS, bool)
    tells[[r["bucket"] for r in telling.select("bucket").collect()]] = True
    seeds = spark.sparkContext.broadcast(np.packbits(tells))

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, features = np.unpackbits(seeds.value).astype(bool), _Features()
        for batch in batches:
            out: list[tuple] = []
            for i, text, toxic in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("toxic").to_pylist(), strict=True
            ):
                words = TOKEN.findall(text.as_py().lower())
                if not words:
                    continue
                hit = [int(bool(flags[features[w]].any())) for w in words]
                where = np.flatnonzero(hit)
                draw = zlib.crc32(str(i).encode())
                at = int(where[draw % len(where)]) - draw % SEQUENCE if len(where) else draw % len(words)
                at = max(0, min(at, len(words) - SEQUENCE))
                window = slice(at, at + SEQUENCE)
                out.append((draw, int(bool(toxic)), words[window], hit[window] if toxic else [0] * len(words[window])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(
                    zip(*out, strict=True) if out else [[], [], [], []],
                    [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32())], strict=True)],
                names=["draw", "toxic", "words", "labels"],
            )

    drawn = written(
        sample.select("doc_id", "text", "toxic").mapInArrow(
            sequences, "draw bigint, toxic int, words array<string>, labels array<int>"
        ),
        "sequences",
    )
    seeds.destroy()
    classes = [drawn.where(F.col("toxic") == t).orderBy("draw", "words").limit(training_sequences // 2) for t in (1, 0)]

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (-r["toxic"], r["draw"], r["words"]))
        found = []
        if any(any(r["labels"]) for r in rows):
            found = [pickle.dumps(fit_field([[word_features(w) for w in r["words"]] for r in rows], [r["labels"] for r in rows]))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["field"])

    # One task has the bounded sample; the driver gets the field alone.
    model = classes[0].unionAll(classes[1]).coalesce(1).mapInArrow(fitted, "field binary").first()
    if model is None:
        return None
    field = pickle.loads(model["field"])
    held = spark.sparkContext.broadcast(field)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(held.value)
        for batch in batches:
            rows = [_summary(m) for _, m in _chains((t.as_py() for t in batch.column("text")), emissions)]
            columns = [pa.array([r[k] for r in rows], pa.float64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], names=["a", "b", "c", "d", "toxic"])

    def curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # About training_documents rows of five numbers.
        rows = np.array(sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(_fit_curve(rows[:, :4], (rows[:, 4] > 0).astype(float)))], names=["c"])

    x = sample.select("text", "toxic").mapInArrow(summaries, "a double, b double, c double, d double, toxic int")
    field.curve = np.array([r["c"] for r in x.repartition(1).mapInArrow(curve, "c double").collect()])
    held.destroy()
    field.base = rate
    return field


def document_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``op4``: a score and a verdict for each document, with the offsets that it rests on.

    NULL ids are never held out. Repeated rows are each scored. Other columns take
    no part, and an empty table gives no rows.
    """
    scored = toxicity(documents.select("doc_id", "text"), learn(documents, labels))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= REJECT_FROM).cast("int").alias("predicted"), F.col("toxicity.spans").alias("spans"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A stage: ``documents`` without those that are rejected. All columns are kept.

    NULL and empty texts have the score of a document in which nothing is found
    and stay; repeated rows are each judged; an empty table, or labels that say
    nothing, reject nothing.
    """
    name = free_name(documents, "_toxicity")
    scored = toxicity(documents, learn(documents, labels), name=name)
    return scored.where(F.col(f"{name}.score") < REJECT_FROM).drop(name)
