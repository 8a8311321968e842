"""Which batches differ: digests that do not depend on order, added up in a tree of blocks of batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehaul.functions.typemap import is_nested, ref, sql_name, to_target, whole_div
from tidehaul.session import written

# Children of a node. Three levels over the batches reach past 16 million of them.
FANOUT = 256
SUMS = ("rows", "one", "two")


def _value(name: str, data_type: T.DataType) -> str:
    """SQL for a column as a value that has a hash; maps have none, so nested values are hashed as JSON."""
    return to_target(name, data_type) if is_nested(data_type) or isinstance(data_type, T.VariantType) else sql_name(name)


def batch_digests(df: DataFrame, batch: str = "batch_id", columns: Sequence[str] | None = None) -> DataFrame:
    """``batch_id, rows, one, two``: each batch's rows as a multiset, in two sums of independent 64-bit hashes.

    Equal batches have equal sums whatever the order of their rows and however
    they are spread; a row that is there twice counts twice. NULL is told from
    every value, and every column from the next. Each task sends one row of sums
    per batch that it saw.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [n for n in kinds if n != batch] if columns is None else list(columns)
    # A hash skips NULL, so its place is marked.
    parts = [p for n in names for p in (f"{sql_name(n)} IS NULL", _value(n, kinds[n]))]
    wide = "decimal(38,0)"
    hashes = [F.expr(f"xxhash64({', '.join([str(seed), *parts])})").cast(wide) for seed in (1, 2)]
    rows = df.select(ref(batch).cast("long").alias("batch_id"), hashes[0].alias("one"), hashes[1].alias("two"))
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("one").alias("one"), F.sum("two").alias("two")
    )


@dataclass(frozen=True)
class DigestTree:
    """``levels[0]`` has the batches, each further level the blocks of ``fanout`` nodes below, the last one a single node.

    All are tables in the shared folder, (node, rows, one, two).
    """

    levels: list[DataFrame]
    fanout: int


def digest_tree(digests: DataFrame, height: int, fanout: int = FANOUT) -> DigestTree:
    """``height`` levels of blocks over ``digests``. A block's digest is the sum of its children's, as for one large batch."""
    levels = [written(digests.select(F.col("batch_id").alias("node"), *SUMS), "digests-0")]
    for level in range(1, height + 1):
        sums = [F.sum(c).alias(c) for c in SUMS]
        above = levels[-1].groupBy(whole_div("node", fanout).alias("node")).agg(*sums)
        levels.append(written(above, f"digests-{level}"))
    return DigestTree(levels, fanout)


def _height(*sides: DataFrame, fanout: int) -> int:
    top = max((s.agg(F.max("batch_id")).first()[0] or 0) for s in sides)
    height = 0
    while top > 0:
        height, top = height + 1, top // fanout
    return height


def _differing(source: DataFrame, target: DataFrame) -> DataFrame:
    """Nodes whose digests differ, with the rows of both sides; 0 where a side has no such node."""
    a, b = (s.select("node", *[F.col(c).alias(f"{side}_{c}") for c in SUMS]) for side, s in (("source", source), ("target", target)))
    both = a.join(b, "node", "full_outer")
    same: Column = F.lit(True)
    for c in SUMS:
        same = same & F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}"))
    return both.where(~same).select(
        "node", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows")
    )


def differing_batches(source: DataFrame, target: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``batch_id, source_rows, target_rows`` of the batches whose content differs, from ``batch_digests`` of both sides.

    The trees are compared from the top. Only children of blocks that differ are
    looked at, and where the two top nodes agree nothing else is read. Equal row
    counts do not hide a changed value, as counts do.
    """
    stored = [written(s, "digests") for s in (source, target)]
    height = _height(*stored, fanout=fanout)
    a, b = (digest_tree(s, height, fanout) for s in stored)
    found = written(_differing(a.levels[height], b.levels[height]), "differing")
    for level in reversed(range(height)):
        if found.isEmpty():
            break
        parents = found.select(F.col("node").alias("parent"))
        left, right = (
            t.levels[level].join(parents, whole_div("node", fanout) == F.col("parent"), "left_semi") for t in (a, b)
        )
        found = written(_differing(left, right), "differing")
    return found.withColumnRenamed("node", "batch_id")
