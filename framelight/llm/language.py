"""Language of a text: known words by their frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelight.llm.common import bounded_sample, cut, held_out, table, uncut

#: Labelled documents to learn from, the longest n-gram of the backoff, and the weight from which an n-gram is known.
SAMPLE_ROWS, LONGEST_GRAM, LEAST_WEIGHT = 20_000, 4, 3.0
#: Log probability lost with each step down to shorter n-grams.
BACKOFF = math.log(0.4)
UNDETERMINED = "und"
#: A letter and the letters and marks after it, in fit and prediction; texts of ASCII only need no more than A to Z.
WORD, PLAIN_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*"), regex.compile(r"[A-Za-z]+")
#: Documents scored together, and words that a worker remembers before it forgets them.
CHUNK, REMEMBERED = 256, 150_000
#: Stand for the begin and the end of a word in n-grams.
BEGIN, END = "^", "$"


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case."""
    if not text:
        return []
    return [w.lower() for w in WORD.findall(text)] if not text.isascii() else PLAIN_WORD.findall(text.lower())


def gram_codes(points: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for each `size` neighbouring code points."""
    out = np.zeros(max(0, len(points) - size + 1), np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + points[k : k + len(out)].astype(np.uint64)
    return out


@dataclass
class LanguageModel:
    """Log frequencies by language. words: word to row of `table`; by n-gram size the sorted codes and their rows."""

    languages: list[str]
    words: dict[str, int]
    codes: list[np.ndarray]
    rows: list[np.ndarray]
    table: np.ndarray
    floor: float = math.log(1e-7)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row for each word: its log frequencies if known, else the mean over its places of the longest known
        n-gram that begins there; each step down to shorter ones costs BACKOFF."""
        out = np.zeros((len(words), len(self.languages)))
        unseen = []
        for i, w in enumerate(words):
            row = self.words.get(w)
            if row is None:
                unseen.append(i)
            else:
                out[i] = self.table[row]
        if unseen:
            lengths = np.fromiter((len(words[i]) + 2 for i in unseen), np.int64, len(unseen))
            points = np.frombuffer("".join([BEGIN + words[i] + END for i in unseen]).encode("utf-32-le", "surrogatepass"), "<u4")
            word = np.repeat(np.arange(len(unseen)), lengths)
            score = np.full((len(points), len(self.languages)), self.floor + BACKOFF * (LONGEST_GRAM - 1))
            open_ = np.ones(len(points), bool)
            for size in range(LONGEST_GRAM, 0, -1):
                code, known = gram_codes(points, size), self.codes[size - 1]
                if len(known) and len(code):
                    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                    hit = (known[at] == code) & (word[: len(code)] == word[size - 1 :]) & open_[: len(code)]
                    where = np.flatnonzero(hit)
                    score[where] = self.table[self.rows[size - 1][at[where]]] + BACKOFF * (LONGEST_GRAM - size)
                    open_[where] = False
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            out[unseen] = np.add.reduceat(score, starts, axis=0) / lengths[:, None]
        return out


class Identifier:
    """(language, posterior) of texts; remembers words within a worker."""

    def __init__(self, model: LanguageModel):
        self.model, self.known, self.scores = model, {}, np.empty((0, len(model.languages)))

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        if not self.model.languages:
            yield from ((UNDETERMINED, 0.0) for _ in texts)
            return
        for at in range(0, len(texts), CHUNK):
            lists = [words_of(x) for x in texts[at : at + CHUNK]]
            if len(self.known) > REMEMBERED:
                self.known, self.scores = {}, self.scores[:0]
            new = list({w for words in lists for w in words}.difference(self.known))
            if new:
                self.known |= zip(new, range(len(self.known), len(self.known) + len(new)), strict=True)
                self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            for words in lists:
                if not words:
                    yield UNDETERMINED, 0.0
                    continue
                rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                # Neighbouring words aren't independent, so the sum is tempered.
                total = self.scores[rows].sum(0) / math.sqrt(len(words))
                best = int(total.argmax())
                yield self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from docs (doc_id, text, lang) with text and lang, a bounded sample of at most about `sample_rows` rows.

    Spark counts all words of the sample and the n-grams of all its distinct words; to the driver come the words
    seen twice or more in a language and the n-grams of LEAST_WEIGHT or more. Documents that held_out() marks are
    never read.
    """
    known = docs.where("text is not null and lang is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    known = bounded_sample(known, F.col("doc_id"), sample_rows)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = defaultdict(int)
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(0), strict=True):
                for word in words_of(text.as_py()):
                    counts[lang, word] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])

    counted = known.select("text", "lang").mapInArrow(words, "lang string, word string, n long")
    counted = cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    padded = F.concat(F.lit(BEGIN), F.col("word"), F.lit(END))
    grams = counted.select("lang", padded.alias("p"), F.log1p(F.col("n") - 1).alias("w"), F.explode(F.sequence(F.lit(1), F.lit(LONGEST_GRAM))).alias("size"))
    grams = grams.where(F.length("p") >= F.col("size")).select("lang", "w", F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - F.col("size") + 1), lambda i: F.col("p").substr(i, F.col("size")))).alias("gram"))
    grams = grams.groupBy("gram", "lang").agg(F.sum(F.col("w") + 1).alias("w"))
    heavy = grams.groupBy("gram").agg(F.collect_list(F.struct("lang", "w")).alias("by"), F.sum("w").alias("total")).where(F.col("total") >= LEAST_WEIGHT)
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    # As Arrow tables: rows as Python objects take many times their size of the driver's memory.
    words_, grams_ = counted.where("n > 1").select("word", "lang", F.col("n").cast("double")).toArrow(), heavy.select("gram", F.explode("by").alias("x")).select("gram", "x.lang", "x.w").toArrow()
    model = build(languages, words_, grams_)
    uncut(counted)
    return model


def _rows(entries: pa.Table, languages: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The distinct first column in order, and a row for each with the third column by language."""
    coded = pa.concat_arrays(entries.column(0).chunks).dictionary_encode() if len(entries) else pa.array([], pa.string()).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out = np.zeros((len(order), len(languages)))
    if len(entries):
        np.add.at(out, (place[coded.indices.to_numpy()], pc.index_in(entries.column(1), value_set=pa.array(languages, entries.schema.types[1])).to_numpy()), entries.column(2).to_numpy())
    return coded.dictionary.take(pa.array(order)), out


def build(languages: list[str], words: pa.Table, grams: pa.Table) -> LanguageModel:
    """The model of (word, language, count) and (n-gram, language, weight); an n-gram weighs for each distinct word
    that holds it, 1 + log of the word's count."""
    k = len(languages)
    (names, counts), (keys, weights) = _rows(words, languages), _rows(grams, languages)
    table = [np.log((counts + 0.01) / (counts.sum(0) + 1))]
    codes, rows, n = [], [], len(counts)
    lengths = pc.utf8_length(keys).to_numpy()
    for size in range(1, LONGEST_GRAM + 1):
        own = np.flatnonzero(lengths == size)
        points = np.frombuffer("".join(keys.take(pa.array(own)).to_pylist()).encode("utf-32-le"), "<u4")
        code = gram_codes(points, size)[::size] if len(own) else np.empty(0, np.uint64)
        order = np.argsort(code, kind="stable")
        codes.append(code[order])
        rows.append(n + order)
        table.append(np.log((weights[own] + 0.5) / (weights[own].sum(0) + 50)))
        n += len(own)
    return LanguageModel(languages, dict(zip(names.to_pylist(), range(len(names)))), codes, rows, np.concatenate(table).reshape(n, k))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred and score, row by row on whole texts; reads no column but text.

    Null texts and texts without a letter get UNDETERMINED and score 0; so does any text if nothing was learned.
    Columns of docs named lang_pred or score are replaced; of equal languages the first by name is said. Repeated rows
    and null keys stay as they are, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for batch in batches:
            said = list(identifier(batch.column(at).to_pylist()))
            new = [pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of the rows that aren't held out; null and letterless texts are und."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
