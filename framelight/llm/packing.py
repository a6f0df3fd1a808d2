"""Packing documents into sequences: a configuration linear program over the length histogram."""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelight.llm.common import WordCache, cut, table

CAPACITY = 2048
#: How steeply a covered length's price falls, how much dearer than by its tokens a long piece is at first, and how
#: far below the dearest a configuration may be that is still used at a round's prices.
STEEP, LONG, NEAR = 0.3, 0.005, 0.005
#: Pieces of one length that are numbered within one task.
RUN_ROWS = 50_000

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


#: Parts of words whose ids a worker remembers, twice over; it keeps them from task to task.
REMEMBERED = 180_000
#: Signs that end words: they are tokenized apart from the letter or digit before them.
TAIL = ".,;:!?*&#%$|"
#: Characters of texts that are looked up at once.
TOGETHER = 4_000_000
#: The tokenizer's own pieces in lower-case Latin-1.
LETTERS, DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\t-\r \x85\xa0{LETTERS}{DIGITS}]+")
PLAIN, LOWER = re.compile(f"[{LETTERS}]+"), re.compile("[^A-Z\xc0-\xd6\xd8-\xde\u0100-\U0010ffff]+")
#: A byte's sign in a byte-level vocabulary: itself where it can be seen, else the next from U+0100 on.
SEEN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = dict(zip(sorted(set(range(256)) - set(SEEN)), range(0x100, 0x200)))


@functools.lru_cache(4096)
def _stays_a_letter(sign: str) -> bool:
    """Whether a letter is only letters after the tokenizer's NFC and lower-casing; a few become letter and mark."""
    return sign.isalpha() and unicodedata.normalize("NFC", sign).lower().isalpha()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTokenizer:
    """A text's ids as little-endian unsigned 32-bit numbers, without the closing 0, put together word by word.

    The tokenizer drops white space and splits letters, digits and signs apart, so what stands between spaces,
    tabs and line ends is tokenized by itself. A word in lower-case Latin-1 is put together from its pieces, and
    pieces of letters go to the merges at once; of others the signs at the end are tokenized apart if the word ends in
    a letter that gains no mark (a mark belongs to the signs after it). The tokenizer lower-cases, so texts are
    lower-cased before the look-up, where both agree for certain: in Latin-1 without the mark of special tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.parts = WordCache(self._ids, REMEMBERED)

    def _ids(self, part: str) -> bytes:
        if PLAIN.fullmatch(part):
            plain = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_SIGNS)
            return array("I", [t.id for t in self.merges(plain)]).tobytes()
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word):
            return self.parts[word]
        if LOWER.fullmatch(word) and "<|" not in word:
            return b"".join([self.parts[x] for x in PIECE.findall(word)])
        core = word.rstrip(TAIL)
        if core and core != word and _stays_a_letter(core[-1]):
            return self.parts[core] + self.parts[word[len(core) :]]
        return self.parts[word]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a word that several hold is looked up once."""
        texts = [x.lower() if "<|" not in x and _latin(x) else x for x in texts]
        spaced = [x.replace("\n", " ").replace("\t", " ").replace("\r", " ") for x in texts]
        split = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        found = split.flatten().dictionary_encode()
        ids = pa.array(list(map(self._word, found.dictionary.to_numpy(False))), pa.large_binary()).take(found.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1)[split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data else b""
        return [bytes(data[a:b]) for a, b in itertools.pairwise(ends)]


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _together(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, some at once: TOGETHER characters, or one longer text."""
    some, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        if some and size + len(text) > TOGETHER:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every row of docs (doc_id, text); null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            found = itertools.chain.from_iterable(map(tokenizer.many, _together(batch.column(1))))
            for doc, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, PIECES.types, strict=True)], schema=PIECES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _worth(price: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: the worth of the dearest multiset of lengths for every room up to the capacity."""
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max(best[c - 1], (price[1 : c + 1] + best[c - 1 :: -1]).max())
    return best


def _config(price: np.ndarray, best: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """A dear configuration of pieces that are left: the knapsack's way back, around lengths that it has used up.

    Of equal ways it takes the longest piece. It ends when no piece that is left fits.
    """
    config: dict[int, int] = defaultdict(int)
    price, room = price.copy(), capacity
    while room:
        value = price[room:0:-1] + best[:room]
        k = room - int(value.argmax())
        if price[k] == -np.inf:
            break
        config[k] += 1
        room -= k
        if config[k] == left[k]:
            price[k] = -np.inf
    return dict(config)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: (configuration, times), one run for bins that are filled alike."""
    left, out = dict(counts), []
    while left:
        config, room, times = defaultdict(int), capacity, None
        for length in sorted(left, reverse=True):
            n = min(left[length], room // length)
            if n:
                config[length] = n
                room -= n * length
        times = max(1, min(left[x] // n for x, n in config.items()))
        for x, n in config.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((dict(config), times))
    return out


def _gap(config: dict[int, int], capacity: int) -> int:
    return capacity - sum(x * n for x, n in config.items())


def program(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) that cover every piece of the histogram {length: count}, by multiplicative weights.

    The covering program is "as few configurations as hold every piece". A length's price falls as it is covered,
    from a start a little above its tokens for long pieces, and the knapsack gives the dearest configuration. A
    round's knapsack serves as long as configurations within NEAR of its dearest come out at the prices as they
    fall. Uses are whole numbers, half of what is left of the scarcest length, and no length is used beyond its
    count, so rounding loses nothing; rounds go on until every length is covered, as each covers a piece at least.
    """
    need = np.zeros(capacity + 1)
    for x, n in histogram.items():
        need[x] = max(n, 0)
    left = need.astype(np.int64)
    start = (np.arange(capacity + 1) / capacity) ** (1 + LONG)
    out = []
    while left.any():
        gap = 1 - left / np.maximum(need, 1)
        low = gap[left > 0].min()
        price = np.where(left > 0, start * np.exp(-STEEP * (gap - low)), -np.inf)
        best = _worth(price, capacity)
        fresh = True
        while left.any():
            config = _config(price, best, left, capacity)
            if not fresh and sum(price[x] * n for x, n in config.items()) < (1 - NEAR) * best[capacity]:
                break
            fresh = False
            times = max(1, min(int(left[x]) // n for x, n in config.items()) // 2)
            out.append((config, times))
            for x, n in config.items():
                left[x] -= n * times
                price[x] = start[x] * np.exp(-STEEP * (1 - left[x] / need[x] - low)) if left[x] else -np.inf
    return out


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) whose sum is the histogram {length: count}; each configuration fits the capacity.

    The program's configurations, whole ones and ones with a gap. The remainder is what it puts into sequences that
    leave more than NEAR of the capacity empty; best fit packs these pieces anew where it needs fewer sequences.
    Should best fit of all pieces need less than 1 - NEAR of these sequences, as it may for a handful of lengths, its
    packing is returned.
    Depends on the histogram only, which has no more entries than the capacity.
    """
    found = program(histogram, capacity)
    loose = [(c, n) for c, n in found if _gap(c, capacity) > NEAR * capacity]
    rest: dict[int, int] = defaultdict(int)
    for config, times in loose:
        for x, n in config.items():
            rest[x] += n * times
    anew = _best_fit(rest, capacity)
    if sum(n for _, n in anew) < sum(n for _, n in loose):
        found = [(c, n) for c, n in found if _gap(c, capacity) <= NEAR * capacity] + anew
    plain = _best_fit({x: n for x, n in histogram.items() if n > 0}, capacity)
    return plain if sum(n for _, n in plain) < (1 - NEAR) * sum(n for _, n in found) else found


def _slots(configs: list[tuple[dict[int, int], int]], capacity: int) -> dict[str, np.ndarray]:
    """For each length the runs of its pieces, by number from 0: first, times, sequence and offset."""
    seen: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for config, times in configs:
        at = 0
        for length in sorted(config, reverse=True):
            rows.append((length, seen[length], times, base, at))
            seen[length] += config[length] * times
            at += config[length] * length
        base += times
    rows.sort()
    return dict(zip(("length", "first", "times", "base", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all rows of docs with sequence_id and offset.

    Every document's ids end with 0; only longer ones than `capacity` are cut. Rows that are alike are packed each. To the driver goes the histogram
    of lengths (`capacity` rows at most); back goes the plan, a row for each configuration and length in it.
    Null or empty texts are one piece of length 1; rows with a null or repeated doc_id are packed like others.
    """
    spark = docs.sparkSession
    pieces = cut(pieces_of(docs, tokenizer_path, capacity))
    per_length = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.sparkContext.broadcast(_slots(configurations(per_length, capacity), capacity))
    runs = max(1, -(-max(per_length.values(), default=1) // RUN_ROWS))
    dealt = pieces.withColumn("run", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(runs)).cast("int"))
    earlier = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "run").count().select("length", "run", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "run").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = dealt.withColumn("inside", F.row_number().over(inside)).join(firsts, ["length", "run"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("inside") - 1).alias("number"))

    def place(batches):
        p = plan.value
        key = p["length"] * (1 << 40) + p["first"]
        for x in batches:
            if len(x):
                length, number = x["length"].to_numpy(), x["number"].to_numpy()
                k = np.searchsorted(key, length * (1 << 40) + number, "right") - 1
                rank = number - p["first"][k]
                x["sequence_id"] = p["base"][k] + rank % p["times"][k]
                x["offset"] = p["offset"][k] + rank // p["times"][k] * length
                yield x.drop(columns="number")

    return numbered.mapInPandas(place, PLACED)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens; null and empty texts are the closing 0 alone."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
