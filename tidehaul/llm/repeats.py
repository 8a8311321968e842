"""Passages that stand in several documents, found by anchors at the positions of a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import ready_for_python
from tidehaul.session import written

WINDOW = 50
# A perfect difference set. Each distance between two texts, modulo the period, is
# the difference of two of its members, so two equal passages have a member at the same place in
# both within their first PERIOD words.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
# Words whose digests a task remembers, and rows that it hands on together.
WORDS_HELD = 1 << 18
ROWS_TOGETHER = 1 << 17
# NULL ids come after all others.
NO_ID = (1 << 63) - 1
# Odd, so that powers have inverses modulo 2**64. Two bases for two independent hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Digests(dict):
    """16 bytes for each word; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = hashlib.blake2b(word, digest_size=16).digest()
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        """Two numbers of 64 bits for each word."""
        if len(self) > WORDS_HELD:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)


class Rolling:
    """Hashes of all runs of so many words, by sums of word numbers times powers of a base modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.back = np.ones(0, np.uint64)

    def runs(self, numbers: np.ndarray, length: int) -> np.ndarray:
        n = len(numbers)
        if n > len(self.powers):
            self.powers, self.back = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, b, np.uint64)]), dtype=np.uint64)
                for b in (self.base, self.inverse)
            )
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(numbers * self.powers[:n], out=sums[1:])
        return (sums[length:] - sums[: n + 1 - length]) * self.back[: n + 1 - length]


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than ASCII white space."""
    return text.split()


def covered(starts: Iterable[int], window: int, n: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    starts = np.asarray(starts, np.int64)
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + window, minlength=n + 1)[: n + 1]
    return np.cumsum(steps)[:n] > 0


def _grouped(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples of equally long arrays, put together to batches of moderate size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= ROWS_TOGETHER:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=schema)


def _anchors(window: int):
    """(anchor, text_key, at) for each position of the cover that a window can hold an anchor at."""
    length = window - PERIOD + 1
    schema = pa.schema([("anchor", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, rolling = Digests(), Rolling(BASES[0])
        in_cover = np.isin(np.arange(PERIOD), COVER)

        def rows():
            for batch in batches:
                for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text"), strict=True):
                    words = words_of(text.as_py())
                    if len(words) < window:
                        continue
                    hashes = rolling.runs(digests.of(words)[:, 0], length)
                    at = np.flatnonzero(np.resize(in_cover, len(hashes))).astype(np.int32)
                    yield hashes[at].view(np.int64), np.full(len(at), key, np.int64), at

        yield from _grouped(rows(), schema)

    return run


def _windows(window: int):
    """(one, two, id, text_key, at) for each window that holds a shared anchor; the two hashes have 128 bits."""
    names = ("one", "two", "id", "text_key")
    schema = pa.schema([*[(n, pa.int64()) for n in names], ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, lanes = Digests(), [Rolling(b) for b in BASES]

        def rows():
            for batch in batches:
                keys, ids = (batch.column(c).to_pylist() for c in ("text_key", "id"))
                for key, i, text, anchors in zip(
                    keys, ids, batch.column("text"), batch.column("anchors"), strict=True
                ):
                    words = words_of(text.as_py())
                    last = len(words) - window
                    if last < 0:
                        continue
                    # Windows with an anchor in them begin up to PERIOD - 1 words before it.
                    begins = np.asarray(anchors.values.to_numpy(zero_copy_only=False), np.int64)
                    first = np.maximum(begins - PERIOD + 1, 0)
                    steps = np.bincount(first, minlength=last + 2)[: last + 2] - np.bincount(
                        begins + 1, minlength=last + 2
                    )[: last + 2]
                    at = np.flatnonzero(np.cumsum(steps)[: last + 1] > 0).astype(np.int32)
                    numbers = digests.of(words)
                    one, two = (
                        lane.runs(np.ascontiguousarray(numbers[:, k]), window)[at].view(np.int64)
                        for k, lane in enumerate(lanes)
                    )
                    yield one, two, np.full(len(at), i, np.int64), np.full(len(at), key, np.int64), at

        yield from _grouped(rows(), schema)

    return run


def _kept(window: int):
    """Each row's words that stay, and the spans that go."""
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", spans), ("kept", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids, copies = (batch.column(c).to_pylist() for c in ("doc_id", "is_copy"))
            for i, copy, text, starts in zip(ids, copies, batch.column("text"), batch.column("starts"), strict=True):
                words = words_of(text.as_py())
                n = len(words)
                if copy and n >= window:
                    gone = np.ones(n, bool)
                elif starts.is_valid and n:
                    gone = covered(starts.values.to_numpy(zero_copy_only=False), window, n)
                else:
                    out.append((i, n, 0, [], b" ".join(words)))
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                pieces = [{"begin": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                out.append((i, n, int(gone.sum()), pieces, b" ".join(compress(words, ~gone))))
            columns = list(zip(*out, strict=True)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the words of windows that begin in a document of a smaller id, too.

    Returns doc_id, n_words, n_removed, removed (spans of word numbers) and
    kept (the other words with one space between, as bytes). Words are runs of
    bytes other than ASCII white space, a window is ``window`` of them in a row.

    1. Runs of ``window - PERIOD + 1`` words are hashed at the positions of the
       cover only. Two equal windows hold an equal run at such a position in
       both, at the same distance from their beginnings. So a window without
       an anchor that another text has, too, stands in one text only.
    2. From shared anchors matches are extended: the windows around them are
       hashed whole (128 bits), and the least id is found for each.
    3. Windows whose least id is smaller than their document's are taken out.

    Equal texts are handled once: all but those of the least id are covered whole,
    if they have a window at all. Hashes are joined back by tables in the
    shared folder, so a join with a hot passage can be split, and least and largest
    values are taken before rows are exchanged.

    NULL text is empty. NULL ids come after all other ids. Rows of the same id are
    each a document, neither before the other. Equal rows have equal results.
    An empty table gives no rows, other columns of the table take no part.
    """
    if window <= PERIOD:
        raise ValueError(f"a window has to have more than {PERIOD} words")
    ready_for_python(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("text_key"),
        F.xxhash64(F.lit(1), text).alias("text_key_2"),
    )
    anchors = rows.select("text_key", "text").mapInArrow(_anchors(window), "anchor long, text_key long, at int")
    extent = [F.min("text_key").alias("least"), F.max("text_key").alias("largest")]
    shared = written(
        anchors.groupBy("anchor").agg(*extent).where("least <> largest").select("anchor"), "shared-anchors"
    )
    # Few distinct positions for each text, however many rows have it.
    found = anchors.join(shared, "anchor", "left_semi").groupBy("text_key").agg(F.collect_set("at").alias("anchors"))
    texts = rows.groupBy("text_key", "text_key_2").agg(F.min("id").alias("first_id"))
    texts = written(texts.join(written(found, "anchors"), "text_key", "left"), "texts")

    same_text = ["text_key", "text_key_2"]
    active = texts.where("anchors is not null").withColumnRenamed("first_id", "id")
    windows = written(
        rows.drop("doc_id")
        .join(active, [*same_text, "id"])
        .select("text_key", "id", "text", "anchors")
        .mapInArrow(_windows(window), "one long, two long, id long, text_key long, at int"),
        "windows",
    )
    least = windows.groupBy("one", "two").agg(F.min("id").alias("least"), F.max("id").alias("largest"))
    least = written(least.where("least < largest").select("one", "two", "least"), "shared-windows")
    later = windows.join(least, ["one", "two"]).where("id > least")
    starts = later.groupBy("text_key", F.col("id").alias("first_id")).agg(F.collect_set("at").alias("starts"))
    known = texts.drop("anchors").join(written(starts, "starts"), ["text_key", "first_id"], "left")
    judged = rows.join(known, same_text).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("id") > F.col("first_id")).alias("is_copy"), "text", "starts"
    )
    return judged.mapInArrow(
        _kept(window),
        "doc_id long, n_words long, n_removed long, removed array<struct<begin: int, end: int>>, kept binary",
    )


def repeated_passages(documents: DataFrame) -> DataFrame:
    """``op13``: doc_id, n_words, n_removed and the digest of the words that stay, for every row."""
    out = without_repeats(documents)
    kept: Column = F.sha2("kept", 256)
    return out.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def oracle() -> str:
    """The same in SQL: every window of every document, as text."""
    return f"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS r,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
            FROM documents
        ), windows AS (
            SELECT r, doc_id, i AS begins, sha256(array_to_string(words[i : i + {WINDOW - 1}], ' ')) AS digest
            FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)
        ), least AS (
            SELECT digest, min(coalesce(doc_id, {NO_ID})) AS least FROM windows GROUP BY digest
        ), gone AS (
            SELECT DISTINCT r, unnest(range(begins, begins + {WINDOW})) AS word
            FROM windows JOIN least USING (digest) WHERE coalesce(doc_id, {NO_ID}) > least
        ), lists AS (SELECT r, list(word) AS gone, count(*) AS n FROM gone GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(coalesce(array_to_string(
                   list_filter(words, lambda w, i: gone IS NULL OR NOT list_contains(gone, i)), ' '), '')) AS kept_sha256
        FROM split LEFT JOIN lists USING (r)
    """
