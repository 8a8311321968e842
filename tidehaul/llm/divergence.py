"""How far the sources of a language differ in their words: hash-consed segment trees, priced in pairs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidehaul.llm.common import numbered, ready_for_python, text_or_empty
from tidehaul.session import written

# Documents of its language that a term has to be in.
LEAST_DOCUMENTS = 30
# Shares are whole numbers of this; each count has this much added.
SCALE, ADDED = 1_000_000_000, 5
TERM_RANKS = 50
# Term ids under one tree, and sources whose trees a task holds from either side of its pairs.
BLOCK = 1024
TILE = 32
# Counts that a task holds before it hands them on.
COUNTS_HELD = 1 << 18

# A-Z become a-z; all other bytes of ASCII that are no letters part terms.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and characters beyond ASCII, letters A-Z lowered."""
    return text.translate(_TERM_BYTES).split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the rows so far; each group also gives an empty term."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = [b"", *n]
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()),
                pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in n)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms = terms_of(text.as_py())
            before = len(n)
            n.update(terms)
            docs.update(set(terms))
            size += 1 + len(n) - before
            if size > COUNTS_HELD:
                yield from out()
                size = 0
    yield from out()


class Trees:
    """Segment trees over the counts of a block of term ids. Equal subtrees are one node.

    A node is a number; ``parts`` has its two halves, or its count for a leaf.
    """

    def __init__(self):
        self.parts: list = []
        self.known: dict = {}

    def node(self, *key: int) -> int:
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.parts)
            self.parts.append(key)
        return found

    def tree(self, counts: dict[int, int], size: int) -> int | None:
        """The root over places 0 to ``size`` - 1, where places without a count have none."""
        level = [self.node(0)] * size
        for place, n in counts.items():
            level[place] = self.node(n)
        while len(level) > 1:
            odd = level[-1:] if len(level) % 2 else []
            level = [self.node(a, b) for a, b in zip(level[::2], level[1::2], strict=False)] + odd
        return level[0] if level else None

    def price(self, a: int | None, b: int | None, total_a: int, total_b: int) -> int:
        """Sum of the differences of both trees' shares; each pair of nodes is priced once."""
        if a is None or (a == b and total_a == total_b):
            return 0
        parts, seen = self.parts, {}

        def walk(x: int, y: int) -> int:
            found = seen.get((x, y))
            if found is None:
                px, py = parts[x], parts[y]
                if len(px) == 1:
                    found = abs(share(px[0], total_a) - share(py[0], total_b))
                else:
                    found = walk(px[0], py[0]) + walk(px[1], py[1])
                seen[x, y] = found
            return found

        return walk(a, b)


def share(count: int, total: int) -> int:
    return 1 + SCALE * (count + ADDED) // total


def _price_block(rows: pa.Table) -> pa.Table:
    """Partial prices of all pairs between two tiles of sources, over one block of term ids."""
    trees, counts, totals, sides = Trees(), {}, {}, {}
    size = rows.column("size")[0].as_py()
    names = ("number", "side", "total", "place", "n")
    for number, side, total, place, n in zip(*[rows.column(c).to_pylist() for c in names], strict=True):
        totals[number] = total
        sides.setdefault(side, set()).add(number)
        of = counts.setdefault(number, {})
        if place is not None:
            of[place] = n
    roots = {number: trees.tree(of, size) for number, of in counts.items()}
    one_tile = len(sides) == 1
    left = sorted(sides[min(sides)])
    right = sorted(sides[max(sides)])
    out = [
        (a, b, trees.price(roots[a], roots[b], totals[a], totals[b]))
        for a in left
        for b in right
        if not one_tile or a < b
    ]
    lang = rows.column("lang")[0].as_py()
    a, b, value = zip(*out, strict=True) if out else ((), (), ())
    return pa.table(
        {
            "lang": pa.array([lang] * len(out), pa.string()),
            "a": pa.array(a, pa.int64()),
            "b": pa.array(b, pa.int64()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _share(count: str, total: str) -> Column:
    """``share`` in SQL, exact beyond 64 bits."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + {ADDED} as decimal(20,0))) "
        f"div cast({total} as decimal(20,0))"
    ).cast("long")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.where(F.col("rank") <= most)


def source_divergence(
    documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, term_ranks: int = TERM_RANKS
) -> DataFrame:
    """``op11``: for each language and source, how far each other source is from it, and its most typical terms.

    Part ``pair`` has each other source of the language, with the sum of the
    differences of all kept terms' shares. Part ``term`` has the source's terms
    whose share is above that in the whole language, up to ``term_ranks``.
    Ranks go by value downwards, then by item.

    Terms are counted in the tasks that read them, then by group. Kept terms
    (in at least ``least_documents`` documents of their language) get
    consecutive ids. Ids are cut into blocks and a language's sources into tiles,
    and a task gets the counts of two tiles in one block, so neither a common
    language nor many sources make one task large. There the counts of each source
    become a segment tree whose equal subtrees are shared by all trees, and two
    trees are walked side by side, each pair of nodes priced once.

    NULL text, lang and source are empty ones, and equal to these. Groups
    without any term and languages without kept terms have pairs, of value 0 in
    the latter. Repeated rows count each; a language with one source has no
    pairs; an empty table gives no rows. Other columns take no part.
    """
    ready_for_python(documents.sparkSession)
    rows = documents.select(
        text_or_empty("lang").alias("lang"),
        text_or_empty("source").alias("source"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    seen = rows.mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    seen = seen.withColumn("term", F.col("term").cast("string"))
    counts = written(
        seen.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts"
    )
    terms = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
    placed = numbered(terms.where(F.col("docs") >= least_documents), F.col("lang"), F.col("term"), label="terms")
    placed = placed.select("lang", "term", "of_lang", "_rank")
    kinds = placed.groupBy("lang").agg(
        F.count("*").alias("kinds"), F.min("_rank").alias("first_term"), F.sum("of_lang").alias("lang_sum")
    )
    kept = written(
        counts.where("term <> ''").select("lang", "source", "term", "n").join(placed, ["lang", "term"]), "kept-terms"
    )
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_sum"))
    groups = numbered(counts.select("lang", "source").distinct(), F.col("lang"), F.col("source"), label="groups")
    starts = groups.groupBy("lang").agg(F.min("_rank").alias("first_group"), F.count("*").alias("groups"))
    groups = (
        groups.select("lang", "source", "_rank")
        .join(starts, "lang")
        .join(sums, ["lang", "source"], "left")
        .join(kinds, "lang", "left")
    )
    added = F.lit(ADDED) * F.coalesce("kinds", F.lit(0))
    groups = written(
        groups.select(
            "lang",
            "source",
            (F.col("_rank") - F.col("first_group")).alias("number"),
            F.expr(f"(groups - 1) div {TILE}").alias("last_tile"),
            (F.coalesce("group_sum", F.lit(0)) + added).alias("total"),
            (F.coalesce("lang_sum", F.lit(0)) + added).alias("lang_total"),
            F.coalesce("kinds", F.lit(0)).alias("kinds"),
            F.coalesce("first_term", F.lit(0)).alias("first_term"),
        ),
        "groups",
    )

    of_groups = kept.join(groups, ["lang", "source"])
    shares = of_groups.select(
        "lang", "source", F.col("term").alias("item"), _share("n", "total").alias("p"), _share("of_lang", "lang_total").alias("q")
    )
    typical = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", F.expr("p - q").alias("value"))

    # Every source is in every block of its language, with or without counts there.
    whole = ["lang", "number", "last_tile", "total", "kinds"]
    present = groups.select(
        *whole,
        F.explode(F.expr(f"sequence(0L, greatest(kinds - 1, 0) div {BLOCK})")).alias("block"),
        F.lit(None).cast("long").alias("place"),
        F.lit(0).cast("long").alias("n"),
    )
    place = F.expr("_rank - first_term")
    counted = of_groups.select(
        *whole, F.expr(f"(_rank - first_term) div {BLOCK}").alias("block"), (place % BLOCK).alias("place"), "n"
    )
    own = f"(number div {TILE})"
    dealt = present.unionAll(counted).select(
        "lang",
        "block",
        "number",
        F.expr(own).alias("side"),
        "total",
        F.least(F.lit(BLOCK), F.col("kinds") - F.col("block") * BLOCK).alias("size"),
        "place",
        "n",
        F.explode(F.expr("sequence(0L, last_tile)")).alias("other"),
    )
    dealt = dealt.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")}).drop("other")
    prices = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        _price_block, "lang string, a long, b long, value long"
    )
    prices = prices.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = prices.select("lang", F.explode(F.expr("array(struct(a, b), struct(b AS a, a AS b))")).alias("p"), "value")
    names = groups.select("lang", "number", "source")
    pairs = (
        both.select("lang", "p.a", "p.b", "value")
        .join(names.withColumnRenamed("number", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    return _ranked(pairs).unionAll(_ranked(typical, term_ranks))


def oracle() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text
            FROM documents
        ), words AS (
            SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS of_lang FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}
        ), kinds AS (SELECT lang, count(*) AS v, sum(of_lang) AS n FROM kept GROUP BY lang),
        counts AS (
            SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), groups AS (SELECT DISTINCT lang, source FROM docs),
        sums AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL
        ), shares AS (
            SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                   1 + CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {ADDED}) // (s.n + {ADDED} * v.v) AS p,
                   1 + CAST({SCALE} AS HUGEINT) * (k.of_lang + {ADDED}) // (v.n + {ADDED} * v.v) AS q
            FROM sums s JOIN kinds v USING (lang) JOIN kept k USING (lang)
            LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), listed AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM listed
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
    """
