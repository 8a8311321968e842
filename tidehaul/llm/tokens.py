"""Token counts of a unigram tokenizer, by Viterbi over Aho-Corasick matches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehaul.llm.common import ready_for_python
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN_UNITS = 600_000


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, in the order of ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Best segmentation of a text into vocabulary pieces: its score and number of pieces, without the pieces.

    The rules are those of a unigram model with byte fallback behind a
    metaspace pre-tokenizer that prepends always and splits: a unit is a mark
    and the characters up to the next space. The best sum of scores wins; of
    equal sums at a position the one whose last piece is longest. A character
    that is no piece by itself may stand as unknown, ten below the least
    score, and counts as its UTF-8 bytes if all 256 byte pieces exist; else a
    run of unknown characters counts as one piece.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        pieces = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        # No piece of several characters holds these, so a text can be cut around them.
        joined = {c for p in pieces if len(p) > 1 for c in p}
        alone = [c for c in "\n\r\t" if c not in joined]
        self.cut = re.compile(f"([{''.join(alone)}])") if alone and self.bytes else None
        self.known: dict[str, tuple[float, int]] = {}

    def viterbi(self, unit: str) -> tuple[float, int]:
        n = len(unit)
        none = float("-inf")
        best, count, run = [none] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        matched = self.automaton.iter(unit)
        end, value = next(matched, (n, None))
        for at in range(n):
            stop, single = at + 1, False
            # Matches that end here come longest first.
            while end == at:
                length, score = value
                total = best[stop - length] + score
                if total > best[stop]:
                    best[stop], count[stop], run[stop] = total, count[stop - length] + 1, False
                single = single or length == 1
                end, value = next(matched, (n, None))
            if not single:
                total = best[at] + self.unknown
                if total > best[stop]:
                    more = len(unit[at].encode("utf-8", "surrogatepass")) if self.bytes else 0 if run[at] else 1
                    best[stop], count[stop], run[stop] = total, count[at] + more, True
        return best[n], count[n]

    def unit(self, unit: str) -> tuple[float, int]:
        found = self.known.get(unit)
        if found is None:
            parts = [p for p in self.cut.split(unit) if p] if self.cut else [unit]
            if len(parts) > 1:
                each = [self.unit(p) for p in parts]
                found = (sum(s for s, _ in each), sum(k for _, k in each))
            else:
                found = self.viterbi(unit)
            if len(self.known) >= KNOWN_UNITS:
                self.known.clear()
            self.known[unit] = found
        return found

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        parts = text.replace(SPACE, " ").split(" ")
        if parts[0] == "":
            del parts[0]
        score, count, known, one = 0.0, 0, self.known, self.unit
        for part in parts:
            unit = SPACE + part
            s, k = known.get(unit) or one(unit)
            score += s
            count += k
        return score, count


_counters: dict[int, Counter] = {}


def token_counts(
    df: DataFrame, vocabulary: list[tuple[str, float]], id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_chars, n_tokens, score) for each row, in place; NULL and empty texts have no tokens.

    The vocabulary (a fixed file, tens of thousands of pieces) is broadcast.
    Results of units are kept in each worker, up to ``KNOWN_UNITS`` of them.
    Scores of this vocabulary are whole numbers, so sums are exact in any
    order and cutting a text into units changes no tie.
    """
    ready_for_python(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = hash(tuple(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(shared.value)
        counter = _counters[key]
        for batch in batches:
            ids, chars, counts, scores = batch.column(0), [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                score, count = counter.text(text)
                chars.append(len(text))
                counts.append(count)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(chars, pa.int64()), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                names=["id", "n_chars", "n_tokens", "score"],
            )

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    counted = rows.mapInArrow(run, "id bigint, n_chars bigint, n_tokens bigint, score double")
    return counted.withColumnRenamed("id", id_column)
