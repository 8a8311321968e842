"""Sharding along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import bin_of, cuts_of, numbered, replace_columns, text_or_empty


def _turns(n: int) -> tuple[list[tuple[int, int]], int]:
    """How a Hilbert curve of ``n`` axes goes on: (digit, next state) at ``state * 2**n + corner``, and the bits of a state.

    A corner has a bit for each axis, that of the first axis highest. It says in
    which order the bits below are seen, which of them are flipped, and whether
    the digits that follow are flipped: that is a state, 0 the first. These are
    the steps of J. Skilling, "Programming the Hilbert curve" (2004), a level at a time.
    """
    states = [([(a, 0) for a in range(n)], 0)]
    table = []
    for seen, flip in states:
        for corner in range(1 << n):
            bits = [(corner >> (n - 1 - a) & 1) ^ f for a, f in seen]
            below = list(seen)
            for i in range(n):
                if bits[i]:
                    below[0] = (below[0][0], 1 - below[0][1])
                else:
                    below[0], below[i] = below[i], below[0]
            for i in range(1, n):
                bits[i] ^= bits[i - 1]
            after = (below, flip ^ bits[-1])
            if after not in states:
                states.append(after)
            table.append((sum((x ^ flip) << (n - 1 - i) for i, x in enumerate(bits)), states.index(after)))
    return table, (len(states) - 1).bit_length()


def hilbert_index(df: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Adds the place of integer ``axes`` (0 to 2**bits - 1) on a Hilbert curve, and drops the axes.

    A table of states is followed from the highest bit to the lowest, so the plan
    has one projection for it, however many bits there are.
    """
    n = len(axes)
    turns, width = _turns(n)
    table = F.expr(f"array({', '.join(str((digit << width) + state) for digit, state in turns)})")

    def follow(at: Column, k: Column) -> Column:
        """``at`` holds the index of the bits above, and in its last ``width`` bits the state."""
        corner: Column = at.bitwiseAND((1 << width) - 1)
        for a in axes:
            corner = corner * 2 + F.call_function("shiftright", F.col(a).cast("long"), k).bitwiseAND(1)
        return F.shiftleft(F.shiftright(at, width), n + width) + F.get(table, corner.cast("int"))

    levels = F.sequence(F.lit(bits - 1), F.lit(0))
    index = F.aggregate(levels, F.lit(0).cast("long"), follow, lambda at: F.shiftright(at, width))
    return df.withColumn(name, index).drop(*[a for a in axes if a != name])


def hilbert_shards(
    df: DataFrame,
    dimensions: list[Column],
    tie: list[Column],
    shards: int = 40,
    bits: int = 5,
) -> DataFrame:
    """Every row with ``curve`` (place of its cell), ``shard`` and ``slot``; counts of shards differ by one at most.

    Each dimension is cut into ``2**bits`` bins of near equal row counts by
    exact quantiles (equal values share a bin, NULL lies in bin 0); one with a
    single bin is left out. Rows are
    ordered by the Hilbert index of their cell, then by ``tie``; the row at
    rank r of n goes to shard ``r * shards // n``. So a shard is a run of the
    curve and its files have narrow ranges in every dimension. A cell that
    holds very many rows is split by ``tie``, which should tell rows apart;
    rows that it cannot tell apart are equal and may take each other's slots.

    An empty table gives an empty result. Own columns replace columns of ``df``
    with the same names.
    """
    df = replace_columns(df, ["curve", "shard", "slot"])
    kept = df.select(
        F.struct("*").alias("row"),
        *[d.alias(f"_d{i}") for i, d in enumerate(dimensions)],
        *[t.alias(f"_t{i}") for i, t in enumerate(tie)],
    )
    names = [f"_d{i}" for i in range(len(dimensions))]
    found = cuts_of(df, dimensions, 1 << bits)
    # A dimension that lies in one bin says nothing; it is no axis of the curve.
    axes = {n: bin_of(F.col(n), c) for n, c in zip(names, found, strict=True) if c}
    celled = kept.drop(*[n for n in names if n not in axes])
    if axes:
        celled = hilbert_index(celled.withColumns(axes), list(axes), bits, "curve")
    else:
        celled = celled.withColumn("curve", F.lit(0).cast("long"))
    placed = numbered(
        celled, F.col("curve"), *[F.col(f"_t{i}") for i in range(len(tie))],
        label="shards",
    )
    shard = F.expr(f"(_rank * {shards}) div _rows")
    first = F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("_rank") - first)
        .select("row.*", "curve", F.col("shard").cast("int").alias("shard"), "slot")
    )


def write_shards(sharded: DataFrame, path: str, shards: int = 40) -> None:
    """One folder a shard, its rows in curve order, by partition number and not by hash."""
    (
        sharded.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def document_shards(documents: DataFrame, shards: int = 40, bits: int = 5) -> DataFrame:
    """``op3``: documents by size, source and language; the law is ``rows``.

    NULL text counts as empty (size 16, checksum 0). Equal texts of one cell
    lie next to each other; equal rows may take each other's slots. Any other
    column is ignored.
    """
    text = text_or_empty("text")
    narrow = documents.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_same"),
        "source",
        "lang",
    )
    placed = hilbert_shards(
        narrow, [F.col("size"), F.col("source"), F.col("lang")], [F.col("_same"), F.col("doc_id")], shards, bits
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
