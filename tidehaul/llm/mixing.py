"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidehaul.llm.common import WORD, replace_columns, text_or_empty
from tidehaul.session import written

# Words in a block, words in a cell (a shard of a source), and cells that are apportioned together.
BLOCK_WORDS = 64
CELL_WORDS = 250_000
CELLS_IN_GROUP = 1024
SEED = 17
# Primes over any number of blocks in a cell, for the order in which blocks are taken.
STRIDES = [1073741827, 1073741831, 1073741833, 1073741839, 1073741843, 1073741857, 1073741891, 1073741909]


def sainte_lague(parties: DataFrame, group: list[str], tie: list[str], weight: str, seats: str) -> DataFrame:
    """Adds ``quota``: the seats of each party, by highest quotients ``weight / (2k + 1)`` within its group.

    ``seats`` holds the number of seats of the group on each of its rows.
    With n parties of total weight W the last quotient that gets a seat lies
    so that a party of weight w has between ``q - d`` and ``q + d`` seats, where
    q is its exact share and ``d = (w * n / W + 1) / 2``. Seats below that are
    given at once, and only the quotients in between (about 2n) are ranked.
    Ties go to the party that comes first in ``tie``. Without any weight a
    group gives no seats.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    share = F.col(weight) / F.col("_weight") * F.col(seats)
    slack = F.col(weight) / F.col("_weight") * F.col("_parties") / 2 + 0.5
    able = parties.withColumns(
        {"_weight": F.sum(weight).over(w).cast("double"), "_parties": F.count("*").over(w)}
    ).withColumns(
        {
            "_low": F.when(F.col("_weight") > 0, F.greatest(F.lit(0), F.floor(share - slack).cast("long"))).otherwise(0),
            "_high": F.when(
                (F.col("_weight") > 0) & (F.col(weight) > 0), F.ceil(share + slack).cast("long") + 1
            ).otherwise(0),
        }
    )
    able = able.withColumn("_left", F.col(seats) - F.sum("_low").over(w))
    asked = able.select(
        *parties.columns, "_low", "_left",
        F.explode_outer(F.expr("case when _high > _low then sequence(_low, _high - 1) end")).alias("_k"),
    )
    order = Window.partitionBy(*(group or [F.lit(0)])).orderBy(
        F.col("_k").isNull(), (F.col(weight) / (2 * F.col("_k") + 1)).desc(),
        *[F.col(c).asc_nulls_last() for c in tie], "_k",
    )
    won = F.col("_k").isNotNull() & (F.row_number().over(order) <= F.col("_left"))
    return (
        asked.withColumn("_won", won)
        .groupBy(*parties.columns, "_low")
        .agg(F.count_if("_won").alias("_more"))
        .select(*parties.columns, (F.col("_low") + F.col("_more")).alias("quota"))
    )


def source_targets(sizes: DataFrame, weights: list[float], limit: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): shares by weight, none above ``limit`` times its size.

    Sources in code point order, NULL last, take the weights in turn. The
    sources that end at their limit are those with the least limit per weight;
    with k of them the rest share what is left by weight, and the least k for
    which nobody is above is the end of the resharing. One row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(x)) for x in weights])
    parts = sizes.withColumn(
        "_weight", F.element_at(listed, (F.row_number().over(order) - 1) % len(weights) + 1)
    ).withColumn("_limit", F.col("source_size") * F.lit(float(limit)))
    ratio = [(F.col("_limit") / F.col("_weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*ratio).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = parts.withColumn(
        "_level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        / F.sum("_weight").over(after),
    )
    # The first source that stays under its limit sets the level of all that follow.
    under = F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.col("_level"))
    return level.withColumn("_set", F.first(under, ignorenulls=True).over(
        Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )).select(
        "source", "source_size",
        F.when(F.col("_set").isNull(), F.col("_limit")).otherwise(F.col("_set") * F.col("_weight")).alias("target"),
    )


def mix(
    df: DataFrame,
    size: Column,
    key: Column,
    source: str = "source",
    weights: list[float] = (1.0, 2.0, 3.0),
    limit: int = 3,
    block_words: int = BLOCK_WORDS,
    cell_words: int = CELL_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix takes of it.

    All sizes together are cut into blocks of ``block_words``; sources get
    whole blocks by highest quotients of their targets. A source is dealt by
    hash of ``key`` into cells of about ``cell_words`` words, which share its
    blocks by the same rule, in groups of cells first and then within groups,
    so no task holds more than one cell or one group of cells. A cell lays its
    rows in a line by seeded hash; as often as its quota goes round, all its
    rows are taken, and of the last round whole blocks in a seeded order and a
    part of one more, so a cell gives exactly its quota, at most ``limit`` times
    its words.

    NULL size counts as 0. A NULL source is a source of its own. Repeated rows
    each count. Own columns replace those of ``df`` with the same names.
    """
    df = replace_columns(df, ["size", "source_size", "target", "taken"])
    picked = _picked(df, size, key, source, weights, limit, block_words, cell_words, seed)
    return picked.select("row.*", "size", "source_size", "target", "taken")


def _picked(df, size, key, source, weights, limit, block_words, cell_words, seed) -> DataFrame:
    """The rows of ``mix`` as ``row``, with its columns and ``_cell`` and ``_order``, the place in the cell."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    rows = df.select(
        F.struct("*").alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.col(source).alias("source"), digest.alias("_order"),
    )
    rows = rows.withColumn("_draw", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long"))
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = source_targets(sizes, list(weights), limit)
    whole = Window.partitionBy(F.lit(0))
    seats = F.round(F.sum("source_size").over(whole) / block_words).cast("long")
    by_source = written(
        sainte_lague(targets.withColumn("_seats", seats), [], ["source"], "target", "_seats")
        .withColumn("_cells", F.greatest(F.ceil(F.col("source_size") / cell_words).cast("long"), F.lit(1)))
        .withColumnRenamed("quota", "_quota")
        .select("source", "source_size", "target", "_cells", "_quota"),
        "source-quotas",
    )
    placed = rows.alias("r").join(
        by_source.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
    ).select("r.*", "s.source_size", "s.target", "_cells", "_quota", (F.col("_draw") % F.col("_cells")).alias("_cell"))
    cells = placed.groupBy("source", "_cell", "_quota").agg(F.sum("size").alias("_words"))
    cells = written(cells.withColumn("_group", F.expr(f"_cell div {CELLS_IN_GROUP}")), "cells")
    groups = cells.groupBy("source", "_group", "_quota").agg(F.sum("_words").alias("_words"))
    groups = sainte_lague(groups, ["source"], ["_group"], "_words", "_quota")
    grouped = cells.alias("c").join(
        groups.alias("g"),
        F.col("c.source").eqNullSafe(F.col("g.source")) & (F.col("c._group") == F.col("g._group")),
    ).select("c.source", "c._group", "c._cell", "c._words", F.col("g.quota").alias("_seats"))
    quotas = written(
        sainte_lague(grouped, ["source", "_group"], ["_cell"], "_words", "_seats").select(
            F.col("source").alias("_source"), F.col("_cell").alias("_c"), F.col("_words").alias("_have"),
            F.least(F.col("quota") * block_words, F.col("_words") * limit).alias("_want"),
        ),
        "cell-quotas",
    )
    line = Window.partitionBy("source", "_cell").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_from", F.coalesce(F.sum("size").over(line), F.lit(0)))
    picked = placed.join(
        quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_c"))
    )
    b = block_words
    strides = ", ".join(f"{s}L" for s in STRIDES)
    steps = {
        "_rounds": "case when _have = 0 then 0 else _want div _have end",
        "_rest": "case when _have = 0 then 0 else _want % _have end",
        "_full": f"_have div {b}",
        "_stride": f"element_at(array({strides}), cast(_cell % {len(STRIDES)} as int) + 1)",
        "_shift": f"({seed} + _cell) * 7919",
    }
    picked = picked.withColumns({k: F.expr(v) for k, v in steps.items()})
    # Words of block j that lie in the row, of a block taken whole, in part, or not at all.
    whole_blocks = f"(_rest div {b})"
    place = "((j * _stride + _shift) % _full)"
    until = (
        f"case when j = _full then (case when {whole_blocks} = _full then _rest % {b} else 0 end) "
        f"when {place} < {whole_blocks} then {b} when {place} = {whole_blocks} then _rest % {b} else 0 end"
    )
    overlap = f"greatest(0, least(_from + size, j * {b} + {until}) - greatest(_from, j * {b}))"
    last = (
        f"case when size = 0 or _rest = 0 then 0L else aggregate(sequence(_from div {b}, (_from + size - 1) div {b}), "
        f"0L, (got, j) -> got + {overlap}) end"
    )
    picked = picked.withColumn("taken", F.expr(f"_rounds * size + {last}"))
    return picked.select("row", "source", "_cell", "_order", "size", "source_size", "target", "taken")


def document_key() -> Column:
    """A document's id, or without one a hash of its text, as ``_key``."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.xxhash64("text"))).alias("_key")


def document_mix(documents: DataFrame) -> DataFrame:
    """``op5``: all documents with the words that the mix takes of each; NULL or empty text has size 0.

    Documents are dealt by id, those without one by their text, so NULL ids do
    not share a cell; rows of one id do. An empty table gives no rows, other
    columns take no part.
    """
    narrow = documents.select(
        "doc_id", "source", F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("_size"), document_key()
    )
    mixed = mix(narrow, F.col("_size"), F.col("_key"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def mixed_documents(
    documents: DataFrame,
    weights: list[float] = (1.0, 2.0, 3.0),
    limit: int = 3,
    cell_words: int = CELL_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """A stage: whole documents, as many words of each cell as the mix takes of it.

    A document comes ``taken / size`` times, rounded down or up. In each cell the
    parts that are left of a copy are added up from the longest document to the
    shortest, from a seeded start, and the document in which the sum passes a
    whole number gets the copy; so long documents come as often as short ones.
    As sizes only fall, a cell is off by no more than two of its longest
    documents. What it is off is then made up by rounding short documents,
    none longer than half of it, the other way, in seeded order. A document
    without words stays once. All columns are kept as they are.
    """
    size = F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long")
    packed = documents.select(
        F.struct("*").alias("_doc"), "source", size.alias("_size"), F.xxhash64("text").alias("_tie"), document_key()
    )
    picked = _picked(packed, F.col("_size"), F.col("_key"), "source", list(weights), limit, BLOCK_WORDS, cell_words, seed)
    cell = Window.partitionBy("source", "_cell")
    one = 1 << 30
    parts = picked.select(
        F.col("row._doc").alias("_doc"), "source", "_cell", "_order", "size", F.col("row._tie").alias("_tie"),
        F.expr("case when size = 0 then 1 else taken div size end").alias("_whole"),
        F.expr("case when size = 0 then 0 else taken % size end").alias("_words"),
    ).withColumns(
        {
            "_part": F.expr(f"case when _words = 0 then 0 else _words * {one} div size end"),
            "_start": F.pmod(F.xxhash64("source", "_cell", F.lit(seed)), F.lit(one)),
        }
    )
    falling = cell.orderBy(F.desc("size"), "_order", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_part").over(falling), F.lit(0)))
    parts = parts.withColumn("_up", F.expr(f"(_before + _part) div {one} - _before div {one}"))
    parts = parts.withColumn("_short", F.sum(F.col("_words") - F.col("_up") * F.col("size")).over(cell))
    able = F.expr("_words > 0 and 2 * size <= abs(_short) and _up = case when _short > 0 then 0 else 1 end")
    seeded = cell.orderBy(F.desc("_able"), "_order", "size", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_able", able).withColumn("_turned", F.sum(F.expr("if(_able, size, 0)")).over(seeded))
    turn = F.expr("_able and 2 * _turned - size <= 2 * abs(_short)")
    times = (F.col("_whole") + F.when(turn, 1 - F.col("_up")).otherwise(F.col("_up"))).cast("int")
    copies = parts.select("_doc", times.alias("_times")).where("_times > 0")
    return copies.withColumn("_copy", F.explode(F.expr("sequence(1, _times)"))).select("_doc.*")
