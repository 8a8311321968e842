"""Near-duplicates by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import components, free_name, ready_for_python
from tidehaul.session import written

COORDINATES = 256
WIDE = 2048
BAND_ROWS = 6
BANDS = 42
SEED = 0x9E3779B97F4A7C15
# Shingles that are sketched together: bounds a task's memory, not what is read.
TOGETHER = 250_000
KNOWN_WORDS = 100_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers whose outputs look independent of small changes."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of each word seen so far; starts anew when it holds very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = _Words()


def _forgetting(run):
    """``run`` over a task's batches, whose words are forgotten at its end: a worker goes on to other work."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _known.clear()

    return whole


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, sorted: A-Z lowered, words split at ASCII white space.

    With fewer words than a shingle takes, the whole sequence is the one
    shingle; without words there is none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_known.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix64(out * _M2 + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def sketch(sets: list[np.ndarray], coordinates: int = COORDINATES, seed: int = SEED) -> np.ndarray:
    """One row of ``coordinates`` for each set: the fast similarity sketch of Dahlgaard, Knudsen and Thorup (2017).

    In round i < t every element is thrown into a random one of t bins; in
    round t + b every element goes to bin b. A bin keeps its least hash of the
    first round that reaches it. So all bins are full after 2t rounds at most,
    sets of over t log t elements need about one round, and two sets agree in a
    coordinate with the probability of their Jaccard similarity, with
    concentration as for independent draws. Rows of empty sets stay 0.
    """
    t = coordinates
    out = np.zeros((len(sets), t), np.uint64)
    filled = np.zeros((len(sets), t), bool)
    flat = out.reshape(-1)
    lengths = np.array([len(s) for s in sets], np.int64)
    live = np.flatnonzero(lengths)
    if not len(live):
        return out
    elements = np.concatenate([sets[i] for i in live])
    owner = np.repeat(live, lengths[live])
    salts = mix64(np.arange(1, 2 * t + 1, dtype=np.uint64) * np.uint64(seed | 1))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i in range(2 * t):
        h = mix64(elements ^ salts[i])
        place = owner * t + ((h & np.uint64(t - 1)).astype(np.int64) if i < t else i - t)
        open_ = ~filled.reshape(-1)[place]
        if open_.any():
            place, h = place[open_], h[open_]
            touched = np.unique(place)
            flat[touched] = top
            np.minimum.at(flat, place, h)
            filled.reshape(-1)[touched] = True
            # The same element can win a bin in two rounds of two sets; the round is part of the value.
            flat[touched] = mix64(flat[touched] + np.uint64(i))
        full = filled[live].all(1)
        if full.any():
            live = live[~full]
            if not len(live):
                break
            keep = np.isin(owner, live, kind="table")
            elements, owner = elements[keep], owner[keep]
    return out


def band_keys(rows: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    keys = np.empty((len(rows), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(rows), b + 1, np.uint64)
        for c in range(b * band_rows, (b + 1) * band_rows):
            key = mix64(key * _M1 + rows[:, c])
        keys[:, b] = key
    return keys


SKETCHED = "id bigint, n bigint, d0 bigint, d1 bigint, keys array<bigint>, b0 bigint, b1 bigint, b2 bigint, b3 bigint"
_TYPES = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()), ("keys", pa.list_(pa.int64()))]
    + [(f"b{k}", pa.int64()) for k in range(4)]
)


def _sketched(words: int, bands: int, band_rows: int):
    def finish(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        rows = sketch(sets)
        keys = band_keys(rows, bands, band_rows).view(np.int64)
        bits = np.packbits((rows >> np.uint64(40)).astype(np.uint8) & 1, axis=1).view(np.int64)
        digests = np.frombuffer(
            b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64
        ).reshape(-1, 2)
        ends = np.arange(0, len(ids) * bands + 1, bands, dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1))),
                *[pa.array(bits[:, k]) for k in range(4)],
            ],
            schema=_TYPES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_hashes(text.as_py(), words)
                ids.append(i)
                sets.append(s)
                held += len(s) + 64
                if held >= TOGETHER:
                    yield finish(ids, sets)
                    ids, sets, held = [], [], 0
        if ids:
            yield finish(ids, sets)

    return _forgetting(run)


def _verified(words: int, part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            left, right = [], []
            for a, b, x, y in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if last[0] != a:
                    last = (a, shingle_hashes(x, words))
                p, q = last[1], shingle_hashes(y, words)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if whole * both >= part * (len(p) + len(q) - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return _forgetting(run)


def _wide(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py(), words) for t in batch.column("text")]
            bits = np.empty((len(sets), WIDE // 64), np.int64)
            at = 0
            while at < len(sets):
                stop, held = at, 0
                while stop < len(sets) and (held == 0 or held + len(sets[stop]) + WIDE <= TOGETHER):
                    held += len(sets[stop]) + WIDE
                    stop += 1
                rows = sketch(sets[at:stop], WIDE, SEED ^ 0x5BD1E995)
                bits[at:stop] = np.packbits((rows >> np.uint64(40)).astype(np.uint8) & 1, axis=1).view(np.int64)
                at = stop
            ends = np.arange(0, len(sets) * (WIDE // 64) + 1, WIDE // 64, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.reshape(-1))),
                ],
                names=["rep", "n", "w"],
            )

    return _forgetting(run)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    part: int = 80,
    whole: int = 100,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row: links where ``whole * |A & B| >= part * |A | B|``.

    1. Each text's set of shingles is sketched. Rows with equal sets (128-bit
       digest of the sorted set) are one class, stood for by its least id.
    2. Class representatives fall into ``bands`` buckets each. In a bucket each
       member is paired with the least one, never all with all. At similarity
       0.8 a pair misses all of 42 bands of 6 rows with probability 3e-6, at
       0.85 with 2e-9.
    3. Pairs whose sizes rule the similarity out, or that differ in more of 256
       sketch bits than such a pair can (six standard deviations), are left
       out; the rest is compared on full sets, computed again from both texts.
    4. Links give components. In buckets whose members are still in several
       components, members get a sketch of 2048 bits from their texts, and each
       member outside the bucket's largest component is held against those of
       other components: pairs within five standard deviations of a link are
       compared on full sets. So no candidate pair of two components is left
       out, however large its bucket, and pairs inside a component are not made.

    Rows without words are linked with nothing; so are rows with a NULL id,
    whose component is NULL. Rows that share an id are one document to the
    links, and each is returned. An empty table gives an empty result. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sk = written(texts.mapInArrow(_sketched(words, bands, band_rows), SKETCHED), "sketches")
    sets = sk.where("id is not null and n > 0")
    fields = ["n", "keys", "b0", "b1", "b2", "b3"]
    reps = written(
        sets.groupBy("d0", "d1").agg(F.min("id").alias("rep"), *[F.any_value(c).alias(c) for c in fields]), "classes"
    )
    buckets = reps.select("rep", F.explode("keys").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c")
    crowded = written(buckets.join(leaders, "key").select("key", "a", F.col("rep").alias("b")), "buckets")
    bits = reps.select("rep", "n", "b0", "b1", "b2", "b3")
    similar = part / whole
    apart = (1 - similar) / 2 * COORDINATES
    most = math.ceil(apart + 6 * math.sqrt(apart * (1 - (1 - similar) / 2)))

    def plausible(x: str, y: str) -> str:
        differ = " + ".join(f"bit_count({x}.b{k} ^ {y}.b{k})" for k in range(4))
        return f"{whole} * least({x}.n, {y}.n) >= {part} * greatest({x}.n, {y}.n) and {differ} <= {most}"

    def texts_of(ids: DataFrame) -> DataFrame:
        # The ids grow with the data, so they are not broadcast.
        wanted = texts.join(ids.hint("merge"), "id", "left_semi")
        # Rows of an id are one document, so each of their texts may be what links it.
        return written(wanted.dropDuplicates(["id", "text"]), "texts")

    def links(pairs: DataFrame, have: DataFrame) -> DataFrame:
        """Those of the candidate pairs (a, b) that are links on full sets."""
        side = lambda name: have.select(F.col("id").alias(name), F.col("text").alias(f"{name}_text"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_text", "b_text")
        return written(both.mapInArrow(_verified(words, part, whole), "a bigint, b bigint"), "links")

    stars = crowded.where("a <> b").select("a", "b").distinct().alias("p")
    first = stars.join(bits.alias("x"), F.expr("p.a = x.rep")).join(bits.alias("y"), F.expr("p.b = y.rep"))
    first = written(first.where(F.expr(plausible("x", "y"))).select("p.a", "p.b"), "pairs")
    ends = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = links(first, texts_of(ends))
    known = components(found)

    member = crowded.select("key", F.col("b").alias("rep")).join(known, F.col("rep") == F.col("node"), "left")
    member = written(member.select("key", "rep", F.coalesce("component", "rep").alias("comp")), "members")
    spread = member.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.count("*").alias("comps"), F.sum("c").alias("all"), F.max_by("comp", F.struct("c", "comp")).alias("main")
    ).where("comps > 1 and all > 2").select("key", "main")
    rest = written(member.join(spread, "key"), "unsettled")
    if not rest.isEmpty():
        have = texts_of(rest.select(F.col("rep").alias("id")).distinct())
        wide = written(have.mapInArrow(_wide(words), "rep bigint, n bigint, w array<bigint>"), "wide")
        rest = rest.join(wide, "rep").join(reps.select("rep", "keys"), "rep")
        apart = (1 - similar) / 2 * WIDE
        most = math.ceil(apart + 5 * math.sqrt(apart * (1 - (1 - similar) / 2)))
        differ = " + ".join(f"bit_count(x.w[{k}] ^ y.w[{k}])" for k in range(WIDE // 64))
        test = F.expr(
            "x.key = y.key and x.comp <> y.comp and (y.comp = y.main or x.rep < y.rep) "
            f"and {whole} * least(x.n, y.n) >= {part} * greatest(x.n, y.n) and {differ} <= {most} "
            # Of the buckets that two members share, one gives the pair.
            "and array_min(array_intersect(x.keys, y.keys)) = x.key"
        )
        x, y = rest.where("comp <> main").alias("x"), rest.alias("y")
        more = x.join(y, test).select(
            F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")
        ).distinct()
        more = written(more.join(first, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            known = components(found.unionAll(links(more, have)))

    named = reps.select("d0", "d1", "rep").join(known, F.col("rep") == F.col("node"), "left").select(
        "d0", "d1", F.coalesce("component", "rep").alias("component")
    )
    linked = sk.select("id", "n", "d0", "d1").join(
        named.withColumn("some", F.lit(True)), ["d0", "d1"], "left"
    )
    own = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("id"))
    return linked.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        (F.col("id").isNull() | (own == F.col("id"))).alias("kept"),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: that of the least id. Of several rows with that id, one stays.

    All columns are kept. Rows with a NULL id stay, and so do NULL and empty
    texts, which are linked with nothing. An empty table stays empty.
    """
    name = free_name(docs, "_id")
    times = free_name(docs, "_times")
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias(name))
    ids = written(kept.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias(times)), "kept-ids")
    once, often = ids.where(F.col(times) == 1).select(name), ids.where(F.col(times) > 1).select(name)
    single = docs.join(once, docs["doc_id"] == once[name], "left_semi").unionAll(docs.where("doc_id is null"))
    if often.isEmpty():
        return single
    return single.unionAll(docs.join(often, docs["doc_id"] == often[name], "left_semi").dropDuplicates(["doc_id"]))
