"""Benchmark decontamination: latent semantic retrieval of passages, then longest common subsequence and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import free_name, ready_for_python
from tidehaul.llm.minhash import mix64
from tidehaul.session import written

# Terms are hashed into so many numbers, and those of them that tell of a benchmark are the dimensions of a space.
TERMS = 1 << 17
DIMENSIONS = 1 << 13
# A passage is two neighbouring blocks of words.
RANK = 256
BLOCK = 16
# What the items of a pass weigh together in the decomposition, as a share of all passages of the documents.
BENCHMARK_SHARE = 1.0
# Rows of a matrix that are multiplied at a time, and slices in which the tasks' products are added up.
ROWS_AT_ONCE = 16
SLICES = 32
# The matrix of what columns have in common is held in squares of so many columns.
TILE = 128
PASSAGES_IN_PIECE = 128
PIECES_AT_ONCE = 16
# Bytes of texts that are numbered at a time, whole texts only.
BYTES_AT_ONCE = 1 << 16
# A term that stands in more than this share of documents has no weight, unless an item has it.
STOP_SHARE = 0.2
# Passages that are as near to an item are tried first.
LEAST_COSINE = 0.3
LEAST_COMMON = 0.7
# From this share on a copy is one, whether or not its answer stands beside it.
COPIED = 0.95
# An item of fewer words says too little to be found inside of a text; it matches a text that is these words and no others.
SHORT_ITEM = 4
# Benchmark items that one pass over the documents looks for at most.
ITEMS_IN_PASS = RANK
SEED = 11

# By byte: 0 between tokens (ASCII white space), 1 left out (other ASCII but letters and digits), 2 kept.
_KIND = np.array([0 if c in b" \t\n\r\x0b\x0c" else 2 if c > 127 or chr(c).isalnum() else 1 for c in range(256)], np.uint8)
_LEFT_OUT = bytes(c for c in range(256) if _KIND[c] == 1)
_LOW = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64) * (_KIND == 2)
_NOT_KEPT = bytes(c for c in range(256) if _KIND[c] < 2)
# Odd powers for the places of a token's bytes, over and over in a very long one.
_ODD = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(1024, _ODD, np.uint64))


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def tokens_of(text: str | None) -> list[bytes]:
    """The tokens of a text, split at ASCII white space: A-Z lowered, other ASCII but letters and digits left out."""
    found = bytes_of(text).lower().split()
    # All at once; tokens of marks alone stay, as empty ones.
    return b"\n".join(found).translate(None, _LEFT_OUT).split(b"\n") if found else []


def terms_of(text: str | None) -> list[bytes]:
    """The tokens with something left in them."""
    return [t for t in tokens_of(text) if t]


def numbers_of(text: str | None) -> np.ndarray:
    """The number of the term of each token; tokens of marks alone have the one after the last.

    A term is hashed as the sum of its bytes times powers by place, for all
    tokens of a text at once.
    """
    return _numbers(np.frombuffer(bytes_of(text), np.uint8))


def _numbers(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.empty(0, np.int64)
    kind = _KIND[data]
    inside = kind > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.int64)
    kept = kind == 2
    place = np.cumsum(kept)
    place[starts[0] :] -= np.repeat(place[starts] - kept[starts], np.diff(np.append(starts, len(data))))
    h = np.add.reduceat(_LOW[data] * _POWERS[(place - 1) & 1023], starts)
    return np.where(h == 0, TERMS, (mix64(h) % np.uint64(TERMS)).astype(np.int64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the odd number from 1 on, and of its inverse from 0 on."""
    back = np.full(n + 1, pow(_ODD, -1, 1 << 64), np.uint64)
    back[0] = 1
    return np.cumprod(np.full(n, _ODD, np.uint64)), np.cumprod(back)


def numbered(column: pa.Array) -> Iterator[np.ndarray]:
    """``numbers_of`` each text of a column, many texts at a time.

    The bytes that are kept follow each other, times powers by place in all of
    them; a token's sum is a difference of running sums, taken back to the
    power of its start.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    powers, back = _powers(BYTES_AT_ONCE)
    k = 0
    while k < len(column):
        # At least one text, be it as long as it may.
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + BYTES_AT_ONCE, "right")) - 1)
        raw, ends = data[offsets[k] : offsets[stop]], offsets[k : stop + 1] - offsets[k]
        kind = _KIND[raw]
        inside = kind > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        own = ends[:-1][ends[:-1] < len(raw)]
        first[own] = inside[own]
        starts = np.flatnonzero(first)
        kept = kind == 2
        bounds = np.append(0, np.cumsum(kept))[np.append(starts, len(raw))]
        lengths = np.diff(bounds)
        cuts = np.searchsorted(starts, ends)
        if lengths.max(initial=0) > len(_POWERS):
            # A very long token has its powers over again.
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield _numbers(raw[a:b])
            k = stop
            continue
        low = np.frombuffer(raw.tobytes().lower().translate(None, _NOT_KEPT), np.uint8)
        if len(low) > len(powers):
            powers, back = _powers(len(low))
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(low * powers[: len(low)], out=sums[1:])
        sums = sums[bounds]
        h = (sums[1:] - sums[:-1]) * back[bounds[:-1]]
        numbers = np.where(h == 0, TERMS, (mix64(h) % np.uint64(TERMS)).astype(np.int64))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield numbers[a:b]
        k = stop


def common_subsequence(item: list[bytes], region: list[bytes]) -> int:
    """Length of the longest common subsequence of words, by bit-parallel rows of the table."""
    where: dict[bytes, int] = {}
    for k, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        match = where.get(w)
        if match is not None:
            hit = row & match
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def holds(words: list[bytes], part: list[bytes]) -> bool:
    """Whether ``part`` stands in ``words`` as a run."""
    n = len(part)
    return any(words[k : k + n] == part for k in range(len(words) - n + 1)) if n else True


def item_terms(items: DataFrame, text_column: str = "text") -> np.ndarray:
    """The numbers of all terms of the items, at most TERMS of them."""
    ready_for_python(items.sparkSession)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(TERMS + 1, bool)
        for batch in batches:
            for text in batch.column(0):
                held[numbers_of(text.as_py())] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(held[:TERMS]))], names=["term"])

    found = items.select(text_column).mapInArrow(terms, "term bigint").distinct()
    return np.flatnonzero(_packed(found.withColumn("n", F.lit(1).cast("bigint")))[:TERMS])


def _packed(counts: DataFrame) -> np.ndarray:
    """``counts`` (term, n) as one array of TERMS + 1 numbers, put together in a task; term -1 is the last one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            np.add.at(held, np.asarray(batch.column("term")), np.asarray(batch.column("n")))
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["held"])

    row = counts.repartition(1).mapInArrow(pack, "held binary").first()
    return np.frombuffer(row["held"], np.int64).copy() if row else np.zeros(TERMS + 1, np.int64)


def document_weights(
    documents: DataFrame, text_column: str = "text", kept: np.ndarray | None = None
) -> tuple[np.ndarray, int]:
    """Inverse document frequencies of the numbered terms over all documents, and the number of documents.

    Common terms have 0, but those in ``kept`` have 1 at least, however common
    they are: a passage that stands in most documents is still to be found.
    """
    ready_for_python(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = np.zeros(TERMS + 1, np.int64), 0
        last = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for numbers in numbered(batch.column(0)):
                # Each term once, where it stands last.
                places = np.arange(len(numbers))
                last[numbers] = places
                held[numbers[last[numbers] == places]] += 1
                docs += 1
        at = np.flatnonzero(held[:TERMS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(held[at], docs))], names=["term", "n"]
        )

    rows = documents.select(text_column).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = _packed(rows)  # at most TERMS + 1 rows
    total, found = int(found[-1]), found[:TERMS].astype(float)
    idf = np.log((total + 1) / (found + 1)) + 1
    common = found > STOP_SHARE * max(total, 5)
    if kept is not None:
        common[kept] = False
    idf[common] = 0.0
    return np.append(idf, 0.0).astype(np.float32), total


def weighted(numbers: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TF-IDF vector of a passage: its terms' numbers and weights, of length 1."""
    at, times = np.unique(numbers, return_counts=True)
    x = times * idf[at]
    keep = x > 0
    x = x[keep]
    return at[keep], (x / np.linalg.norm(x) if len(x) else x).astype(np.float32)


def passage_matrix(texts: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The TF-IDF vectors, of length 1, of all passages of texts given as numbers: (row, at, x), in order of rows.

    Passages of two blocks follow each other, so every word is in one; those without weight have no entries.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    if not lengths.sum():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    passages = -(-lengths // (2 * BLOCK))
    # A row of the grid is a passage, filled up with the number of no term, which is greater than all others.
    grid = np.full(2 * BLOCK * int(passages.sum()), TERMS, np.int32)
    shift = 2 * BLOCK * (np.cumsum(passages) - passages) - (np.cumsum(lengths) - lengths)
    grid[np.arange(lengths.sum()) + np.repeat(shift, lengths)] = np.concatenate(texts)
    grid[idf[grid] <= 0] = TERMS
    grid = grid.reshape(-1, 2 * BLOCK)
    grid.sort(axis=1)
    first = np.ones(grid.shape, bool)
    first[:, 1:] = grid[:, 1:] != grid[:, :-1]
    found = np.flatnonzero(first)
    at, times = grid.reshape(-1)[found].astype(np.int64), np.diff(np.append(found, grid.size))
    keep = at < TERMS
    row, at = found[keep] // (2 * BLOCK), at[keep]
    x = times[keep] * idf[at].astype(np.float64)
    return row, at, (x / np.sqrt(np.bincount(row, x * x))[row]).astype(np.float32)


def add_product(out: np.ndarray, row: np.ndarray, at: np.ndarray, x: np.ndarray, q: np.ndarray) -> None:
    """Adds ``A'(A q)`` to ``out`` for the rows (row, at, x) of ``A``, which are in order."""
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    place = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(row)))) % ROWS_AT_ONCE
    cuts = [*starts[::ROWS_AT_ONCE].tolist(), len(row)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        # Only the columns that these rows have.
        columns, where = np.unique(at[low:high], return_inverse=True)
        part = np.zeros((place[high - 1] + 1, len(columns)), np.float32)
        part[place[low:high], where] = x[low:high]
        out[columns] += part.T @ (part @ q[columns])


def add_gram(held: np.ndarray, row: np.ndarray, at: np.ndarray, x: np.ndarray, side: int) -> None:
    """Adds ``A'A`` to ``held`` for the rows (row, at, x) of ``A``, which are in order: squares of TILE columns, ``side`` a
    side, on the diagonal and above."""
    at = at.astype(np.int64)
    key = row.astype(np.int64) * (side * TILE) + at
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        row, at, x = row[order], at[order], x[order]
    square, inner = np.divmod(at, TILE)
    above = (square * side - square * (square + 1) // 2) * TILE**2 + inner * TILE
    beside = square * TILE**2 + inner
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(row))
    ends = np.repeat(ends, ends - starts)
    # Each entry with itself, with the next one of its row, and so on.
    k, d = np.arange(len(row)), 0
    while len(k):
        np.add.at(held, above[k] + beside[k + d], x[k] * x[k + d])
        d += 1
        k = k[k + d < ends[k]]


def add_tile(out: np.ndarray, i: int, j: int, tile: np.ndarray, q: np.ndarray) -> None:
    """Adds to ``out`` what a square of ``A'A``, and the same square below the diagonal, have in ``A'A q``."""
    i, j = i * TILE, j * TILE
    tile = tile[: len(q) - i, : len(q) - j]
    out[i : i + TILE] += tile @ q[j : j + TILE]
    out[j : j + TILE] += (np.triu(tile, 1) if i == j else tile).T @ q[i : i + TILE]


def _gram(passages: DataFrame, dimensions: int, rows: Callable) -> DataFrame:
    """``A'A`` for the matrix of ``passages``, as a table of its squares: (tile, held, x), a bit for each entry that is not 0."""
    side = -(-dimensions // TILE)
    count = side * (side + 1) // 2
    names = "tile int, held binary, x binary"

    def packed(tiles: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        columns = [[], [], []]
        for k, tile in tiles:
            full = tile != 0
            for column, value in zip(columns, (k, np.packbits(full).tobytes(), tile[full].tobytes()), strict=True):
                column.append(value)
        kinds = pa.int32(), pa.binary(), pa.binary()
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["tile", "held", "x"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((count, TILE**2), np.float32)
        for batch in batches:
            for part in rows(batch):
                add_gram(held.reshape(-1), *part, side)
        # The first one is always there.
        full = [k for k in range(count) if not k or held[k].any()]
        for k in range(0, len(full), 64):
            yield packed([(n, held[n]) for n in full[k : k + 64]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, tile in _unpacked(batch):
                sums[k] = sums[k] + tile if k in sums else tile
        for k in sums:
            yield packed([(k, sums[k])])

    tasks = max(8, 2 * passages.sparkSession.sparkContext.defaultParallelism)
    parts = passages.coalesce(tasks).mapInArrow(gather, names)
    # As many tasks add up, so that none gets more than the whole of one part.
    return written(parts.repartition(min(tasks, count), "tile").mapInArrow(add, names), "gram")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers and entries of a batch of such squares."""
    for k, held, x in zip(batch.column("tile").to_pylist(), batch.column("held"), batch.column("x"), strict=True):
        tile = np.zeros(TILE**2, np.float32)
        tile[np.unpackbits(np.frombuffer(held.as_py(), np.uint8)).astype(bool)] = np.frombuffer(x.as_py(), np.float32)
        yield k, tile


def _tiles(dimensions: int) -> Callable[[pa.RecordBatch], Iterator[tuple[int, int, np.ndarray]]]:
    """What reads the squares of a batch, each with its place."""
    i, j = np.triu_indices(-(-dimensions // TILE))

    def read(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for k, tile in _unpacked(batch):
            yield int(i[k]), int(j[k]), tile.reshape(TILE, TILE)

    return read


def _listed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of a batch of (at, x), a passage each."""
    at = batch.column("at")
    lengths = np.diff(np.asarray(at.offsets))
    yield np.repeat(np.arange(len(lengths)), lengths), np.asarray(at.flatten()), np.asarray(batch.column("x").flatten())


def fit_space(
    passages: DataFrame,
    rank: int = RANK,
    rounds: int = 3,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    rows: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]] = _listed,
    more: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Right singular vectors (dimensions x rank) of the matrix of ``passages`` (at, x), by randomised subspace iteration.

    Halko, Martinsson and Tropp, "Finding structure with randomness" (2011).
    All rows are read once, for ``A'A``, which has a fixed size and is kept as a table of squares; of more
    than DIMENSIONS columns it would be too large, so all rows are then read in each round. Each round every task adds up its
    squares' or rows' part of ``A'A Q``, of random columns at first; the parts are added up in slices, and one
    task makes the columns orthonormal. There are at most
    as many parts as the cluster has use for, not as the table has partitions. The driver hands the
    matrix of one round to the next as it comes, of the fixed size of
    dimensions x rank, and does not compute with it. ``rows`` reads the rows (row, at, x) of a batch,
    some at a time, that holds them in another form, and ``more`` are a few rows beside the table's.
    """
    context = passages.sparkSession.sparkContext
    shape = (dimensions, rank)
    cuts = [dimensions * k // SLICES for k in range(SLICES + 1)]
    q = None
    if dimensions <= DIMENSIONS:
        # Of fixed size, however many rows there were.
        source, read, add_part, tasks = _gram(passages, dimensions, rows), _tiles(dimensions), add_tile, 8
    else:
        source, read, add_part, tasks = passages, rows, add_product, max(8, 2 * context.defaultParallelism)
    for k in range(rounds):
        held = context.broadcast(q)
        # Half precision is enough for a direction that is made orthonormal anew.
        kind = np.float32 if k == rounds - 1 else np.float16

        def current(held=held) -> np.ndarray:
            if held.value is not None:
                return np.frombuffer(held.value, np.float16).reshape(shape).astype(np.float32)
            return np.random.default_rng(seed).standard_normal(shape, np.float32)

        def multiply(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            now, out = current(), np.zeros(shape, np.float32)
            for batch in batches:
                for part in read(batch):
                    add_part(out, *part, now)
            for k in range(SLICES):
                part = pa.array([out[cuts[k] : cuts[k + 1]].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), part], names=["slice", "part"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    part = np.frombuffer(part.as_py(), np.float32)
                    sums[k] = sums[k] + part if k in sums else part
            for k, part in sums.items():
                part = pa.array([part.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), part], names=["slice", "part"])

        def turn(batches: Iterator[pa.RecordBatch], current=current, kind=kind, first=k == 0) -> Iterator[pa.RecordBatch]:
            g = np.zeros(shape, np.float32)
            for batch in batches:
                for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    g[cuts[k] : cuts[k + 1]] += np.frombuffer(part.as_py(), np.float32).reshape(-1, rank)
            if more is not None:
                add_product(g, *more, current())
            g *= 1 / max(1e-30, float(np.abs(g).max()))
            if not first:
                # Rotate to singular vectors: the small matrix Q'A'AQ has their squares as eigenvalues.
                turned = np.linalg.eigh((current().T @ g).astype(np.float64))[1]
                g = g @ turned[:, ::-1].astype(np.float32)
            q = np.linalg.qr(g)[0]
            yield pa.RecordBatch.from_arrays([pa.array([q.astype(kind).tobytes()], pa.binary())], names=["part"])

        parts = source.coalesce(tasks).mapInArrow(multiply, "slice int, part binary")
        sums = parts.repartition(8, "slice").mapInArrow(add, "slice int, part binary")
        q = bytes(sums.repartition(1).mapInArrow(turn, "part binary").first()["part"])
        held.destroy()
    return np.frombuffer(q, np.float32).reshape(shape)


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    least_cosine: float = LEAST_COSINE,
    least_common: float = LEAST_COMMON,
    rank: int = RANK,
    items_in_pass: int = ITEMS_IN_PASS,
) -> DataFrame:
    """(doc_id, item_id, cosine, common, first_word): documents that hold a benchmark item or a paraphrase of it.

    1. Document frequencies of hashed words are counted over all documents. Very
       common words have no weight, except those of items.
    2. The terms of the items, and those that most documents share, are
       dimensions. A randomised SVD is fitted on TF-IDF vectors of all benchmark items
       that are looked for and of all passages of all documents.
    3. Each document, whole, is read as passages of two neighbouring blocks of
       16 words, each item as pieces of as many words. The cosine of a passage
       and an item is that of the passage and the nearest piece's projection to
       the space; the best of the document is given.
    4. The longest common subsequence of the item's words and the words around
       a passage must cover ``least_common`` of the item. If the benchmark has
       a column ``answer``, the answer must stand beside a paraphrase as a run
       of words as well; a copy (``COPIED`` of the item) needs none. The nearest passage is tried first if it reaches ``least_cosine``,
       then all others. Those are left out only where no passage can match:
       where the item's words that stand there weigh less than the lightest
       ``least_common`` of the item, or where a wider stretch has no more in
       common than what is found. So no length or wording of an item is lost.

    One row for each pair of document row and item, with the largest common share. Items
    are looked for in passes of at most ``items_in_pass`` that have at most
    DIMENSIONS terms together, each with a space of its own, which is widened
    for a single item with more terms. NULL or empty texts match nothing,
    neither do items without words. An item of fewer than SHORT_ITEM words
    matches only a text that has these words and no others; a NULL answer is no condition. Repeated rows of either table each count; other columns are
    ignored.
    """
    spark = documents.sparkSession
    ready_for_python(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer"))
    items = items.where("text is not null")
    nothing = spark.createDataFrame([], "doc_id long, item_id long, cosine double, common double, first_word long")
    if items.isEmpty():
        return nothing
    idf, total = document_weights(docs, kept=item_terms(items))
    if not total:
        return nothing

    out = None
    for asked in _passes(items, idf, items_in_pass):
        place, size = _dimensions(asked, idf, total)
        corpus, passages = _placed(docs, idf, place, size)
        own = _item_rows(asked, idf, place, passages)
        space = fit_space(corpus, rank, dimensions=size, rows=_stored, more=own)
        found = _search(docs, asked, idf, place, space, least_cosine, least_common)
        out = found if out is None else out.unionAll(found)
    return nothing if out is None else out


def _passes(items: DataFrame, idf: np.ndarray, items_in_pass: int) -> Iterator[list[tuple]]:
    """Items for each pass, short ones first: so many at most, and no more terms together than DIMENSIONS.

    An item with more terms than that has a pass of its own. Items without terms match nothing.
    """
    held, terms = [], set()
    for item in items.orderBy(F.length("text"), "item_id", "text", "answer").toLocalIterator():
        own = set(weighted(numbers_of(item["text"]), idf)[0].tolist())
        if not own:
            continue
        if held and (len(held) >= items_in_pass or len(terms | own) > DIMENSIONS):
            yield held
            held, terms = [], set()
        held.append(tuple(item))
        terms |= own
    if held:
        yield held


def _dimensions(items: list[tuple], idf: np.ndarray, total: int) -> tuple[np.ndarray, int]:
    """The dimension of each term's number, and how many there are, which is also that of a term without one.

    All terms of the items are dimensions. Up to DIMENSIONS are filled up with
    those that stand in most documents, in two at least: a term of one
    document brings no two together.
    """
    own = list(dict.fromkeys(n for _, text, _ in items for n in weighted(numbers_of(text), idf)[0].tolist()))
    # The weight falls as the number of documents grows.
    shared = np.flatnonzero((idf > 0) & (idf < np.log((total + 1) / 2.5) + 1))
    others = shared[np.argsort(idf[shared], kind="stable")].tolist()
    size = max(DIMENSIONS, len(own))
    place = np.full(TERMS + 1, size, np.int64)
    chosen = list(dict.fromkeys([*own, *others]))[:size]
    place[chosen] = np.arange(len(chosen))
    return place, size


def _placed(docs: DataFrame, idf: np.ndarray, place: np.ndarray, size: int) -> tuple[DataFrame, int]:
    """The matrix of all passages of all documents in these dimensions, stored in pieces, and how many passages there are."""
    kind = np.uint16 if size <= 1 << 16 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, x = passage_matrix(list(numbered(batch.column(0))), idf)
            at = place[at]
            kept = at < size
            row, at, x = row[kept], at[kept].astype(kind), x[kept]
            # Pieces are small, as many of them come to a task at a time.
            cuts = np.searchsorted(row, np.arange(0, (int(row[-1]) if len(row) else 0) + 1 + PASSAGES_IN_PIECE, PASSAGES_IN_PIECE))
            pieces = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
            sizes = [np.unique(row[p], return_counts=True)[1].astype(np.int32) for p in pieces]
            columns = [[n.tobytes() for n in sizes], *([c[p].tobytes() for p in pieces] for c in (at, x))]
            arrays = [pa.array([len(n) for n in sizes], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["n", "sizes", "at", "x"])

    pieces = docs.select("text").mapInArrow(run, "n bigint, sizes binary, at binary, x binary")
    corpus = written(pieces, "passages")
    return corpus.drop("n"), corpus.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _stored(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of a batch of such pieces."""
    for k in range(0, batch.num_rows, PIECES_AT_ONCE):
        sizes, at, x = (b"".join(batch.column(c).slice(k, PIECES_AT_ONCE).to_pylist()) for c in ("sizes", "at", "x"))
        sizes, x = np.frombuffer(sizes, np.int32), np.frombuffer(x, np.float32)
        yield np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(at, np.uint16 if len(at) == 2 * len(x) else np.int32), x


def _item_rows(items: list[tuple], idf: np.ndarray, place: np.ndarray, passages: int) -> tuple:
    """A row for each item, whole; together they weigh BENCHMARK_SHARE of so many passages."""
    own = [weighted(numbers_of(text), idf) for _, text, _ in items]
    share = np.float32(np.sqrt(BENCHMARK_SHARE * max(1, passages) / len(own)))
    row = np.repeat(np.arange(len(own)), [len(at) for at, _ in own])
    return row, place[np.concatenate([at for at, _ in own])], share * np.concatenate([x for _, x in own])


def _search(docs, items, idf, place, space, least_cosine, least_common) -> DataFrame:
    words = [terms_of(t) for _, t, _ in items]
    answers = [terms_of(a) for *_, a in items]
    # Each item is compared in pieces as long as a passage. All its terms have a place in the space.
    targets = []
    for _, text, _ in items:
        numbers = numbers_of(text)
        pieces = [weighted(numbers[k : k + 2 * BLOCK], idf) for k in range(0, len(numbers), 2 * BLOCK)]
        targets.append(np.array([x @ space[place[at]] for at, x in pieces if len(at)], np.float32))
    ids = [i for i, *_ in items]
    spelled = [n[n < TERMS] for n in (numbers_of(t) for _, t, _ in items)]
    held = docs.sparkSession.sparkContext.broadcast(
        (ids, words, answers, targets, spelled, idf, place.astype(np.int32), space.astype(np.float16))
    )
    longest = max(len(w) for w in words) if words else 0
    # Any region lies in one of the stretches of two strides that begin at each stride.
    stride = max(256, -(-2 * longest // BLOCK) * BLOCK + 2 * BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, answers, targets, spelled, idf, place, space = held.value
        # Each dimension times the weight of its term, and nothing for terms without one.
        scale = np.zeros(len(space) + 1, np.float32)
        scale[place] = idf
        whole = np.concatenate([space, np.zeros((1, space.shape[1]), space.dtype)]) * scale[:, None]
        square = idf.astype(np.float64) ** 2
        # What the words of each item weigh, and the least weight that a match of least_common of them has.
        known = np.unique(np.concatenate(spelled))
        row = np.full(TERMS + 1, len(known))
        row[known] = np.arange(len(known))
        cover = np.zeros((len(known) + 1, len(items)), np.float32)
        needed = [_needed(len(w), least_common) for w in words]
        least = np.zeros(len(items), np.float32)
        for k, own in enumerate(spelled):
            np.add.at(cover[:, k], row[own], idf[own])
            least[k] = np.sort(idf[own])[: needed[k]].sum() * 0.999
        last = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for doc, text, numbers in zip(batch.column(0).to_pylist(), batch.column(1), numbered(batch.column(1)), strict=True):
                if not len(numbers):
                    continue
                rows, blocks = row[numbers], -(-len(numbers) // BLOCK)
                stretches: dict[int, list[tuple[int, int]]] = {}
                starts = range(0, max(1, len(rows) - stride), stride)
                for start in starts:
                    here = rows[start : start + 2 * stride]
                    places = np.arange(len(here))
                    last[here] = places
                    there = cover[here[last[here] == places]].sum(0)
                    for item in np.flatnonzero(there >= least).tolist():
                        n = len(words[item])
                        # The blocks whose regions begin here, in the last stretch all that follow.
                        low = 0 if start == 0 else -(-(start + n) // BLOCK)
                        high = blocks if start == starts[-1] else min(blocks, -(-(start + stride + n) // BLOCK))
                        if low < high:
                            stretches.setdefault(item, []).append((low, high - 1))
                if not stretches:
                    continue
                said = tokens_of(text.as_py())
                z, e = _projected(numbers, place, whole, square)
                for item, ranges in stretches.items():
                    cosine = ((z @ targets[item].T).max(1) if len(targets[item]) else np.zeros(len(z))) / e
                    n = len(words[item])
                    if n < SHORT_ITEM:
                        if [w for w in said if w] == words[item]:
                            out.append((doc, ids[item], float(cosine.max()), 1.0, 0))
                        continue

                    def common(low, high, item=item, n=n):
                        return common_subsequence(words[item], said[max(0, low * BLOCK - n) : (high + 2) * BLOCK + n])

                    def answered(k, item=item):
                        wide = said[max(0, k * BLOCK - longest) : (k + 2) * BLOCK + longest]
                        return not answers[item] or holds([w for w in wide if w], answers[item])

                    best, at = needed[item] - 1, -1
                    # The nearest passage first, then all others that can have more in common.
                    near = int(cosine.argmax())
                    if cosine[near] >= least_cosine:
                        ranges = [(near, near), *ranges]
                    ranges = ranges[::-1]
                    while ranges:
                        low, high = ranges.pop()
                        got = common(low, high)
                        if got <= best:
                            continue
                        if low < high:
                            middle = (low + high) // 2
                            ranges += [(middle + 1, high), (low, middle)]
                        elif got >= COPIED * n or answered(low):
                            best, at = got, low
                    if at >= 0:
                        out.append((doc, ids[item], float(cosine[near]), best / n, max(0, at * BLOCK - n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, _FOUND.types, strict=True)],
                schema=_FOUND,
            )

    return docs.mapInArrow(run, "doc_id bigint, item_id bigint, cosine double, common double, first_word bigint")


def _needed(n: int, share: float) -> int:
    """The least number of words that is ``share`` of ``n`` words, one at least."""
    k = max(1, int(share * n) - 1)
    while k / n < share:
        k += 1
    return k


def _projected(numbers, place, whole, square) -> tuple[np.ndarray, np.ndarray]:
    """The projections of the passages of a document, one from each block of words on, and their lengths before."""
    # Filled up to whole blocks with the number of no term.
    at = np.full(-(-len(numbers) // BLOCK) * BLOCK, TERMS)
    at[: len(numbers)] = numbers
    at = at.reshape(-1, BLOCK)
    e = square[at].sum(1)
    e[:-1] += e[1:]
    z = np.empty((len(at), whole.shape[1]), np.float32)
    for k in range(0, len(at), 64):
        z[k : k + 64] = whole[place[at[k : k + 64]]].sum(1)
    z[:-1] += z[1:].copy()
    return z, np.sqrt(np.maximum(e, 1e-9)).astype(np.float32)


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("common", pa.float64()), ("first_word", pa.int64())]
)


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """A stage: ``documents`` without those that hold a benchmark item. All columns are kept, rows with a NULL id stay.

    All rows of an id go if one of them holds an item. NULL and empty texts
    stay, as all do without items. An empty table stays empty.
    """
    hit = free_name(documents, "_hit")
    hits = written(contaminated(documents, benchmark, **options).select(F.col("doc_id").alias(hit)).distinct(), "hits")
    return documents.join(hits, documents["doc_id"] == hits[hit], "left_anti")
