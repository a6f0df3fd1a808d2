"""Toxic texts: a support vector machine on a gappy subsequence kernel with Nystroem landmarks."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import bounded_sample, cut, held_out, table

#: Labelled documents to learn from, and landmarks.
SAMPLE_ROWS, LANDMARKS = 20_000, 96
#: Subsequences of three letters over at most five places; each place beyond three costs this factor.
STEPS, DECAY = ((1, 1), (1, 2), (2, 1), (1, 3), (3, 1), (2, 2)), 0.6
#: Windows less like every landmark than this are not projected: they have the margin of a window like none.
FLOOR = 0.45
THRESHOLD = 0.3
#: Documents whose words are looked up together, and windows that a worker remembers before it forgets them.
CHUNK, SEEN = 256, 200_000
SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")
#: Stands before each word, so that words that begin alike are more alike.
BEGIN = "\x01"
#: Digits and signs that stand for letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _folded(point: int) -> int:
    """The code point that stands for this one: a letter's own, or 0 for what words lose."""
    sign = LOOKALIKE.get(chr(point), chr(point).lower()[0])
    return ord(sign) if sign.isalpha() or sign == BEGIN else 0


FOLDED = np.array([_folded(c) for c in range(0x250)], np.int64)


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all words in a row, without what is no letter, and where each word begins and the last ends."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    points = np.frombuffer("".join([BEGIN + w for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = FOLDED[np.minimum(points, 0x24F)]
    far = np.flatnonzero(points >= 0x250)
    if len(far):
        found, which = np.unique(points[far], return_inverse=True)
        codes[far] = np.array([_folded(int(c)) for c in found])[which]
    kept = codes != 0
    ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(lengths)])]
    return codes[kept], ends


def occurrences(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every occurrence of a subsequence, which is three code points of 21 bits."""
    word = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    out = [[], [], []]
    for a, b in STEPS:
        n = len(codes) - a - b
        if n > 0:
            same = word[:n] == word[a + b :]
            out[0].append(word[:n][same])
            out[1].append((codes[:n] << 42 | codes[a : a + n] << 21 | codes[a + b :])[same])
            out[2].append(np.full(int(same.sum()), DECAY ** (a + b - 2)))
    if not out[0]:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in out)


def feature_rows(words: list[str]) -> list[dict[int, float]]:
    """The unit feature vector of each word's subsequences; empty for words of fewer than two letters."""
    rows: list[dict[int, float]] = [defaultdict(float) for _ in words]
    for w, u, x in zip(*(x.tolist() for x in occurrences(*encode(words))), strict=True):
        rows[w][u] += x
    out = []
    for row in rows:
        norm = math.sqrt(sum(x * x for x in row.values()))
        out.append({u: x / norm for u, x in row.items()})
    return out


def kernel(one: dict[int, float], two: dict[int, float]) -> float:
    return sum(x * two[u] for u, x in one.items() if u in two)


@dataclass
class Landmarks:
    """Landmark words and, by subsequence, their features."""

    words: list[str]
    used: np.ndarray  # the landmarks' subsequences, sorted
    features: np.ndarray  # subsequence by landmark
    peak: np.ndarray  # the largest feature of any landmark, by subsequence
    whiten: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> Landmarks:
        rows = feature_rows(words)
        used = np.array(sorted({u for row in rows for u in row}), np.int64)
        at = {u: i for i, u in enumerate(used.tolist())}
        features = np.zeros((len(used), len(words)))
        for j, row in enumerate(rows):
            for u, x in row.items():
                features[at[u], j] = x
        values, vectors = np.linalg.eigh(features.T @ features) if words else (np.empty(0), np.empty((0, 0)))
        whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0) + 1e-3)) @ vectors.T if words else np.empty((0, 0))
        return cls(words, used, features, features.max(1, initial=0), whiten)

    def like(self, words: list[str]) -> dict[str, np.ndarray]:
        """Kernel values with all landmarks of the words that reach FLOOR with any; words without a letter reach none.

        A first pass drops words by an upper bound: with each subsequence's largest feature, over the root of
        the sum of squared weights, which the norm isn't below.
        """
        words = [w for w in words if LETTER.search(w)]
        if not words or not len(self.used):
            return {}
        word, sub, weight = occurrences(*encode(words))
        place = np.minimum(np.searchsorted(self.used, sub), len(self.used) - 1)
        shared = self.used[place] == sub
        bound = np.bincount(word[shared], weight[shared] * self.peak[place[shared]], len(words))
        square = np.bincount(word, weight * weight, len(words))
        some = [words[i] for i in np.flatnonzero((bound > 0) & (bound >= FLOOR * np.sqrt(square)))]
        known = {u: i for i, u in enumerate(self.used.tolist())}
        out = {}
        for text, row in zip(some, feature_rows(some), strict=True):
            at = [(known[u], x) for u, x in row.items() if u in known]
            if at:
                values = np.array([x for _, x in at]) @ self.features[[i for i, _ in at]]
                if values.max() >= FLOOR:
                    out[text] = values
        return out


LETTER = re.compile(r"[^\W\d_]")


def spaced(tokens: list[str]) -> list[str]:
    """Words written in pieces: runs of three or more tokens of one character, and of one or two, joined."""
    lengths = bytes([n if n < 255 else 255 for n in map(len, tokens)])
    return ["".join(tokens[m.start() : m.end()]) for runs in (rb"\x01{3,}", rb"[\x01\x02]{3,}") for m in re.finditer(runs, lengths)]


def windows(text: str) -> list[str]:
    """The windows of a lower-case text or sentence: its words, and neighbouring pieces joined."""
    tokens = text.split()
    return tokens + spaced(tokens)


class Reader:
    """Sentences of texts as their windows like a landmark; remembers windows within a worker.

    `value` gives what to keep of the kernel values of a window.
    """

    def __init__(self, landmarks: Landmarks, value=lambda row: row):
        self.landmarks, self.value, self.seen, self.active = landmarks, value, set(), {}

    def sentences(self, texts: list[str | None]) -> Iterator[list[list[str]]]:
        """For each text its sentences with such windows, and of each these windows, once each.

        A window across the end of a sentence counts as a sentence of its own.
        """
        for at in range(0, len(texts), CHUNK):
            lowered = [(x or "").lower() for x in texts[at : at + CHUNK]]
            if len(self.seen) > SEEN:
                self.seen, self.active = set(), {}
            whole = [set(windows(x)) for x in lowered]
            new = set().union(*whole) - self.seen
            self.active |= {w: self.value(row) for w, row in self.landmarks.like(list(new)).items()}
            self.seen |= new
            for x, own in zip(lowered, whole, strict=True):
                found = own & self.active.keys()
                out, left = [], set(found)
                for sentence in SENTENCE.split(x) if found else ():
                    # The end mark is cut off a sentence's last word, which is looked up with it.
                    hits = {w for t in windows(sentence) for w in (t, *(t + mark for mark in ".!?")) if w in found}
                    if hits:
                        out.append(sorted(hits))
                        left -= hits
                yield out + [[w] for w in sorted(left)]


@dataclass
class ToxicityModel:
    landmarks: Landmarks
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -1.0
    curve: tuple[float, ...] = (1.0, 0.5, 0.5, 0.0)

    def margin(self, row: np.ndarray) -> float:
        """Of a window, from its kernel values: projected on the landmarks' span, then the machine."""
        return max(self.bias, float(row @ self.landmarks.whiten @ self.weights + self.bias)) if len(self.weights) else self.bias

    def margins(self, sentences: list[list[float]]) -> list[float]:
        """The three largest margins of sentences, from those of their windows; other sentences have the bias."""
        return [*sorted((max(x) for x in sentences), reverse=True)[:3], self.bias, self.bias, self.bias][:3]

    def score(self, sentences: list[list[float]]) -> float:
        z = sum(a * b for a, b in zip(self.margins(sentences), self.curve)) + self.curve[3]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps; the bias isn't penalised."""
    z = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(z.shape[1])
    for _ in range(30):
        gap = 1 - y * (z @ w)
        on = gap > 0
        slope = ridge * w - 2 * (z[on] * (cost * y * gap)[on, None]).sum(0)
        step = np.linalg.solve(np.diag(ridge) + 2 * (z[on] * cost[on, None]).T @ z[on], slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def choose_landmarks(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> list[str]:
    """Landmarks from (word, toxic documents, other documents): telling words that aren't nearly alike."""
    tell = lambda a, b: math.sqrt(a) * math.log(((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1)))
    ranked = sorted(((w, tell(a, b)) for w, a, b in counts), key=lambda x: (-x[1], x[0]))
    chosen: list[str] = []
    features: list[dict] = []
    for (w, value), row in zip(ranked, feature_rows([w for w, _ in ranked]), strict=True):
        if len(chosen) >= LANDMARKS or value < 0.1 * ranked[0][1]:
            break
        if row and all(kernel(row, f) < 0.85 for f in features):
            chosen.append(w)
            features.append(row)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from the labelled documents that held_out() doesn't mark, a bounded sample of about `sample_rows` rows.

    Spark counts words and looks for windows like a landmark; to the driver come the telling words and the sampled
    documents' sentences as lists of such windows. A label counts for the whole document: the window with the
    largest margin stands for a toxic one, every window of the others counts against, and machine and choice are fitted
    in turn. A logistic curve over a document's three largest sentence margins gives the score. Of several labels
    of a document the largest counts; documents without a text or a label aren't read.
    """
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = bounded_sample(marks.where(~held_out(F.col("doc_id"))), F.col("doc_id"), sample_rows)
    known = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(marks), "doc_id")  # bounded by sample_rows
    words = F.array_distinct(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\s]", ""), r"\s+"))
    counted = known.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("b"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)
    if not toxic or not clean:
        return ToxicityModel(Landmarks.of([]), bias=1.0 if toxic else -1.0)
    least = max(2, toxic // 400)
    telling = F.sqrt("a") * F.log(((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1)))
    ranked = cut(counted.where((F.col("a") >= least) & F.length("word").between(3, 24)).withColumn("t", telling))
    most = ranked.agg(F.max("t")).first()[0] or 0.0
    # What tells a tenth as much as the best word, each in a 400th of the toxic documents or more.
    top = ranked.where(F.col("t") >= 0.1 * most).collect() if most > 0 else []
    landmarks = Landmarks.of(choose_landmarks([(r["word"], r["a"], r["b"]) for r in top], toxic, clean))
    shared = docs.sparkSession.sparkContext.broadcast(landmarks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = pa.array(list(reader.sentences(batch.column(1).to_pylist())), pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found], names=["doc_id", "toxic", "found"])

    got = known.select("doc_id", "text", "toxic").mapInArrow(read, "doc_id long, toxic int, found array<array<string>>").select("toxic", "found").collect()
    bags = sorted(([list(x) for x in r["found"]], r["toxic"]) for r in got)
    rows = landmarks.like(sorted({w for found, _ in bags for x in found for w in x}))
    model = ToxicityModel(landmarks)
    against = Counter(w for found, y in bags if y != 1 for w in sorted({w for x in found for w in x}))
    chosen = [max((w for x in found for w in x), key=lambda w: (rows[w].max(), w)) for found, y in bags if y == 1 and found]
    if chosen:
        flat = [w for w in sorted(rows)]
        # The zero row stands for all clean documents without a window like a landmark.
        none = max(1.0, sum(1 for found, y in bags if y != 1 and not found) ** 0.5)
        for _ in range(3):
            up = Counter(chosen)
            x = np.vstack([rows[w] for w in (*up, *against)] + [np.zeros((1, len(landmarks.words)))]) @ landmarks.whiten
            y = np.concatenate([np.ones(len(up)), -np.ones(len(against) + 1)])
            model.weights, model.bias = _svm(x, y, np.array([*up.values(), *against.values(), none], float))
            margin = dict(zip(flat, np.array([rows[w] for w in flat]) @ landmarks.whiten @ model.weights, strict=True))
            chosen = [max((w for x in found for w in x), key=lambda w: (margin[w], w)) for found, z in bags if z == 1 and found]
    margin = {w: model.margin(row) for w, row in rows.items()}
    model.curve = _logistic(np.array([model.margins([[margin[w] for w in x] for x in found]) for found, _ in bags]), np.array([float(y == 1) for _, y in bags]))
    return model


def _logistic(margins: np.ndarray, truth: np.ndarray) -> tuple[float, ...]:
    """Slopes and shift of the logistic curve over the margins, by damped Newton steps with smoothed targets."""
    up, down = truth.sum(), len(truth) - truth.sum()
    t = np.where(truth == 1, (up + 1) / (up + 2), 1 / (down + 2))
    z = np.column_stack([margins, np.ones(len(margins))])
    w, ridge = np.array([1.0, 0.0, 0.0, 0.0]), np.array([1.0, 1.0, 1.0, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - t) + ridge * w)
        w = w - np.clip(step, -1, 1)
        w[:3] = np.maximum(w[:3], 0)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every whole text of docs (doc_id, text), row by row; null texts count as empty.

    Rows alike get equal scores, null and repeated doc_ids stay as they are, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = Reader(model.landmarks, model.margin)
        for batch in batches:
            said = [model.score([[reader.active[w] for w in x] for x in found]) for found in reader.sentences(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document by a model of the labelled rows that aren't held out; null texts count as empty."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
