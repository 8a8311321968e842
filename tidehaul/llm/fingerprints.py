"""Document fingerprints: a randomised edit embedding, sampled, banded and verified."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import components, numbered, ready_for_python
from tidehaul.llm.minhash import mix64
from tidehaul.session import written

SEED = 20160619
SLOTS = 128
# Characters from which one walk starts, and the steps that it takes: twice as many pass them on average,
# and the rest is over six standard deviations.
STRETCH = 1024
STEPS = 2 * STRETCH + 300
# Code points that are embedded together: bounds a task's memory, not what is read.
TOGETHER = 1 << 20


class Walks:
    """The randomness that all texts share, drawn from a seed.

    ``moves[j, c]``: whether a walk goes on to the next character after it has
    written a character of class c in step j. ``records[s]``: the positions that
    slot s samples, each for texts whose embedding is longer than it and not
    longer than the next; the position is the one of least priority among all
    that the text has, so it is uniform, and texts of lengths m < n share it
    with probability m / n.
    """

    def __init__(self, seed: int = SEED, slots: int = SLOTS):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (STEPS, 256), np.uint8)
        self.moves[:, 0] = 0  # class 0 is the end of a text
        self.salts = rng.integers(1, 2**63, slots, np.uint64)
        self.records = []
        for _ in range(slots):
            at, found = 0, [0]
            while at < 1 << 40:
                # The next position with a smaller priority lies beyond x with probability (at + 1) / x.
                at = int((at + 1) / (1.0 - rng.random()))
                found.append(at)
            self.records.append(np.unique(np.array(found, np.int64)))

    def fingerprints(self, texts: list[str]) -> list[str]:
        """One lower-case hex digit for each slot of each text.

        Each stretch of a text is embedded by a walk (Chakraborty, Goldenberg
        and Koucky, "Streaming algorithms for embedding and computing edit
        distance", 2016): it writes the character it stands on and then moves
        on or not, as a random bit of the step and the character says. Walks
        over texts that differ by few edits meet again soon, so a few edits
        change few of the written characters. A slot takes four bits of a hash
        of two neighbouring written characters at its position. An empty text
        has the digit 0 in every slot.
        """
        out: list[str | None] = [None] * len(texts)
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (held == 0 or held + len(texts[stop]) + STRETCH <= TOGETHER):
                held += len(texts[stop]) + STRETCH
                stop += 1
            out[start:stop] = self._together(texts[start:stop])
            start = stop
        return out

    def _together(self, texts: list[str]) -> list[str]:
        lengths = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        ends = np.zeros(len(points), bool)
        ends[starts + lengths] = True
        classes = ((points * np.uint32(2654435761)) >> np.uint32(7)) % np.uint32(255) + np.uint32(1)
        classes = np.where(ends, 0, classes).astype(np.uint8)
        stretches = np.maximum(1, -(-lengths // STRETCH))
        doc = np.repeat(np.arange(len(texts)), stretches)
        first = np.cumsum(stretches) - stretches
        at = starts[doc] + (np.arange(len(doc)) - first[doc]) * STRETCH
        path = np.empty((STEPS, len(at)), np.int32)
        place = at.astype(np.int64)
        for j in range(STEPS):
            path[j] = place
            place += self.moves[j][classes[place]]
        # Written characters of a text: all steps of its whole stretches, and of the last those before its end.
        last = first + stretches - 1
        tail = (path[:, last] < (starts + lengths)[None, :]).sum(0)
        written_ = (stretches - 1) * STEPS + tail
        digits = np.zeros((len(texts), len(self.records)), np.uint8)
        live = np.flatnonzero(written_ > 0)
        n = written_[live]
        for s, record in enumerate(self.records):
            p = record[np.searchsorted(record, n, side="left") - 1]
            q = np.minimum(p + 1, n - 1)
            one = points[path[p % STEPS, first[live] + p // STEPS]].astype(np.uint64)
            two = points[path[q % STEPS, first[live] + q // STEPS]].astype(np.uint64)
            digits[live, s] = mix64((one << np.uint64(32) | two) ^ self.salts[s]) >> np.uint64(60)
        text = np.frombuffer(b"0123456789abcdef", np.uint8)[digits].tobytes().decode()
        k = len(self.records)
        return [text[i * k : (i + 1) * k] for i in range(len(texts))]


_walks: dict[tuple[int, int], Walks] = {}


def walks(seed: int = SEED, slots: int = SLOTS) -> Walks:
    if (seed, slots) not in _walks:
        _walks[seed, slots] = Walks(seed, slots)
    return _walks[seed, slots]


def likeness(a: str, b: str) -> float:
    """Share of slots in which two fingerprints agree."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    return float((x == y).mean())


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n_chars, fingerprint) for each row; NULL text counts as empty. Nothing is shuffled."""
    ready_for_python(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(walks(seed).fingerprints(texts), pa.string())],
                names=["id", "n_chars", "fingerprint"],
            )

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "id bigint, n_chars bigint, fingerprint string").withColumnRenamed("id", id_column)


def edit_distance_within(a: str, b: str, most: int) -> int | None:
    """Edit distance if it is at most ``most``, by furthest-reaching diagonals in time about n + most squared."""
    if abs(len(a) - len(b)) > most:
        return None
    x = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    y = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.uint32)

    def slide(i: int, j: int) -> int:
        width = 64
        while i < len(x) and j < len(y):
            n = min(width, len(x) - i, len(y) - j)
            differ = np.flatnonzero(x[i : i + n] != y[j : j + n])
            if len(differ):
                return i + int(differ[0])
            i, j, width = i + n, j + n, width * 4
        return i

    reach = {0: slide(0, 0)}
    goal = len(x) - len(y)
    for d in range(most + 1):
        if d:
            now = {}
            for k in range(-d, d + 1):
                options = [reach.get(k, -2) + 1, reach.get(k - 1, -2) + 1, reach.get(k + 1, -2)]
                i = min(max(options), len(x), len(y) + k)
                if i >= 0 and i - k >= 0:
                    now[k] = slide(i, i - k)
            reach = now
        if reach.get(goal, -1) >= len(x):
            return d
    return None


def near_documents(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_edits: int = 40,
    least_likeness: float = 0.6,
    band_slots: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """(id, component_id): texts joined by links of at most ``most_edits`` edits, found by bands of sampled digits.

    Equal texts are one class. Fingerprints are cut into bands of
    ``band_slots`` digits; in each bucket every class is paired with the least
    one, pairs whose fingerprints agree in fewer than ``least_likeness`` of the
    slots are left out, and the others are verified by their edit distance.
    The buckets' other pairs are not tried, so texts of one component may be
    missed where neither is near the bucket's least. Empty texts and rows with
    a NULL id are linked with nothing.
    """
    ready_for_python(df.sparkSession)
    texts = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).where(
        "id is not null and text <> ''"
    )
    classes = written(
        texts.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("same")).agg(
            F.min("id").alias("id"), F.any_value("text").alias("text")
        ),
        "classes",
    )
    prints = written(fingerprints(classes, "id", "text", seed), "fingerprints")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS // band_slots - 1)),
        lambda b: F.xxhash64(b, F.substr(F.col("fingerprint"), b * band_slots + 1, F.lit(band_slots))),
    )
    buckets = prints.select("id", F.explode(bands).alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("c")).where("c > 1")
    pairs = buckets.join(leaders, "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    side = lambda name: prints.select(F.col("id").alias(name), F.col("fingerprint").alias(f"f{name}"))
    agree = F.expr(f"size(filter(sequence(1, {SLOTS}), i -> substr(fa, i, 1) = substr(fb, i, 1)))")
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(agree >= least_likeness * SLOTS).select("a", "b")
    text = lambda name: classes.select(F.col("id").alias(name), F.col("text").alias(f"t{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                edit_distance_within(x, y, most_edits) is not None
                for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    asked = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
    known = components(written(asked.mapInArrow(run, "a bigint, b bigint"), "links"))
    named = classes.select("same", "id").join(known, F.col("id") == F.col("node"), "left").select(
        "same", F.coalesce("component", "id").alias("component_id")
    )
    all_ids = df.select(F.col(id_column).alias("id"), F.sha2(F.col(text_column).cast("binary"), 256).alias("same"))
    return all_ids.join(named, "same", "left").select(
        F.col("id").alias(id_column), F.coalesce("component_id", F.col("id").cast("long")).alias("component_id")
    )


def _place(key: Column, cut: list[int]) -> Column:
    """Which of the ranges that begin at the descending ids ``cut`` a key lies in, in two steps of about a root of their number."""
    step = max(1, math.isqrt(len(cut)))
    blocks = [cut[k : k + step] for k in range(0, len(cut), step)]
    numbers = lambda ids: F.array(*[F.lit(int(h)).cast("long") for h in ids])
    block = F.greatest(F.size(F.filter(numbers([b[0] for b in blocks]), lambda h: key <= h)), F.lit(1))
    inside = F.filter(F.element_at(F.array(*[numbers(b) for b in blocks]), block), lambda h: key <= h)
    return (block - 1) * step + F.greatest(F.size(inside), F.lit(1)) - 1


def edited_fingerprints(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """``op1``: each document's fingerprint, that of its edited text, and how alike they are.

    Documents are dealt by ranges of descending id whose borders are cut from
    the ids alone; the first row of each range is sent to the range before it
    too (that of the first range to the last), so every row finds the next one
    in its own partition and the texts are shuffled once. Equal ids are
    ordered by text. NULL ids come last, NULL text is empty.
    """
    spark = documents.sparkSession
    ready_for_python(spark)
    narrow = documents.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").desc_nulls_last()
    # Ranges of near equal bytes; their first ids, one for each range.
    placed = numbered(narrow, order, label="order", sums={"before": F.col("bytes") + 1})
    part = F.expr(f"(before * {parts}) div before_all").cast("int")
    heads = placed.groupBy(part.alias("part")).agg(F.max("doc_id").alias("head")).where("head is not null")
    found = sorted(((r["part"], r["head"]) for r in heads.collect()), key=lambda x: -x[1])
    cut = [h for k, h in enumerate(h for _, h in found) if k == 0 or h != found[k - 1][1]]
    if not cut:
        cut = [0]
    last = len(cut) - 1
    here = _place(F.coalesce(F.col("doc_id"), F.lit(cut[-1])).cast("long"), cut)
    is_head = F.col("doc_id").isin(cut)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), here.cast("int").alias("part"))
    targets = F.when(is_head, F.array(F.col("part"), F.pmod(F.col("part") - 1, F.lit(last + 1)))).otherwise(
        F.array(F.col("part"))
    )
    dealt = rows.select("doc_id", "text", F.posexplode(targets).alias("ghost", "part"))
    dealt = dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions("ghost", order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = walks(seed)
        held: list[tuple] = []
        size = 0
        before: tuple | None = None

        def finish() -> pa.RecordBatch:
            ids = [i for i, *_ in held]
            # The next text of a row is the own text of the row after it.
            chain = shared.fingerprints([*[t for _, t, *_ in held], held[-1][3]])
            own, following = chain[:-1], chain[1:]
            edited = shared.fingerprints([e for _, _, e, _ in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for _, t, *_ in held], pa.int64()),
                    pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for _, _, e, _ in held]),
                    pa.array(own, pa.string()),
                    pa.array(edited, pa.string()),
                    pa.array(list(map(likeness, own, edited)), pa.float64()),
                    pa.array(list(map(likeness, own, following)), pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        def follow(text: str) -> None:
            nonlocal size
            i, own = before
            half = len(own) // 2
            held.append((i, own, own[: len(own) - half] + text[:half], text))
            size += 3 * len(own) + STRETCH

        opening, ended = None, False
        for batch in batches:
            for i, text, ghost in zip(*[batch.column(c) for c in ("doc_id", "text", "ghost")], strict=True):
                if ended:
                    break  # equal ids: the first of them is the next
                i, text = i.as_py(), text.as_py()
                opening = text if opening is None else opening
                if before is not None:
                    follow(text)
                before, ended = (i, text), bool(ghost.as_py())
                if size >= TOGETHER:
                    yield finish()
                    held, size = [], 0
        if before is not None and not ended:  # a table of NULL ids
            follow(opening)
        if held:
            yield finish()

    return dealt.select("doc_id", "text", "ghost").mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
