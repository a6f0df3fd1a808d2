"""Token counts of a unigram vocabulary without building the tokens: count-only Viterbi."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import WordCache, table

#: What an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


class UnigramCounter:
    """Counts pieces as a unigram tokenizer with byte fallback and SPACE before each word makes them.

    An Aho-Corasick automaton lists the pieces that end at each character. best[e] is the best score of a
    split up to e; the earlier start, so the longer piece, wins equal scores. A character that is no piece by
    itself may be unknown; neighbouring unknown characters are fused and then counted as their bytes, or as
    one unknown piece where the vocabulary lacks one of these bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        self.ids = {}
        for piece, score in pieces:
            if piece and piece not in self.ids:
                self.ids[piece] = score
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = [f"<0x{b:02X}>" in self.ids for b in range(256)]
        self.line_ends_apart = self.bytes[10] and not any("\n" in p for p in self.ids)
        self.units = WordCache(lambda word: self.count_unit(SPACE + word), 150_000)

    def count_unit(self, unit: str) -> int:
        """Pieces of one SPACE-led word."""
        n = len(unit)
        if not n:
            return 0
        best, start, known = [None] * (n + 1), [0] * (n + 1), [True] * (n + 1)
        best[0] = 0.0
        ends: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(unit):
            ends[end].append(found)
        for e in range(1, n + 1):
            for length, score in sorted(ends[e - 1], reverse=True):
                value = best[e - length] + score
                if best[e] is None or value > best[e]:
                    best[e], start[e], known[e] = value, e - length, True
            if unit[e - 1] not in self.ids:
                value = best[e - 1] + self.unknown
                if best[e] is None or value > best[e]:
                    best[e], start[e], known[e] = value, e - 1, False
        count, e, open_ = 0, n, ""
        while e > 0:
            if known[e]:
                count += self._fallback(open_) + 1
                open_ = ""
            else:
                open_ = unit[start[e] : e] + open_
            e = start[e]
        return count + self._fallback(open_)

    def _fallback(self, run: str) -> int:
        if not run:
            return 0
        if run in self.ids:
            return 1
        raw = run.encode("utf-8", "surrogatepass")
        return len(raw) if all(self.bytes[b] for b in raw) else 1

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if text[0] != SPACE:
            text = SPACE + text
        if not self.line_ends_apart:
            return sum(map(self.units.__getitem__, text[1:].split(SPACE)))
        # No piece holds a line end, so each is a byte of its own and what follows has no SPACE before it.
        first, *lines = text.split("\n")
        total = len(lines) + sum(map(self.units.__getitem__, first[1:].split(SPACE) if first else ()))
        for line in lines:
            if line:
                bare, *words = line.split(SPACE)
                total += self.count_unit(bare) + sum(map(self.units.__getitem__, words))
        return total


@functools.cache
def _counter(path: str) -> UnigramCounter:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return UnigramCounter([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())])


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and n_tokens of every whole text of docs (doc_id, text), row by row without a shuffle.

    Null and empty texts have 0 tokens; null and repeated doc_ids and rows are kept as they are; other columns are not
    read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            n = [counter.count(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of pieces of every document; null and empty texts have none."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
