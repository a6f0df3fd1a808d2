"""Near-duplicate texts by MinHash with banding, confirmed on full shingle sets, joined to components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import CACHE, cut, join_skewed, table, uncut
from framelight.llm.components import connected_components

#: Two texts of similarity 0.8 miss every one of the bands once in 300,000 times.
BANDS, BAND_ROWS = 32, 5
HASHES = BANDS * BAND_ROWS
#: A pair goes to the exact check if so many of its minima agree; at similarity 0.8 that is five deviations below.
LEAST_AGREEING = 0.62
#: Texts that meet in one task of the exact check, and of the comparison of signatures.
SETS_PER_TASK, BLOCK = 64, 2_000
#: Shingles of a block's texts, about: 8 MB. Texts whose sets a worker makes at once.
SHINGLES_PER_BLOCK, SLICE = 1_000_000, 500
#: Bits of the bitmap that tells texts to be compared from others before they are shuffled.
SLOTS_PER_ID, MOST_SLOTS = 16, 1 << 26

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_BAND_SALTS = _random.integers(1, 2**63, BANDS, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int, hashes: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's `width`-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than `width` are one shingle as a
    whole; no word gives the empty set.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([hashes[w] for w in words], np.uint64)
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64) + np.uint64(min(len(words), width))
    for k in range(min(width, len(words))):
        out = out * _BASE + h[k : k + n]
    return np.unique(_mixed(out))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of HASHES universal hash functions over the set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = np.multiply.outer(_FACTORS, shingles[at : at + 512])
        part += _OFFSETS[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return best


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = _mixed(signature).reshape(BANDS, BAND_ROWS)
    key = _BAND_SALTS.copy()
    for k in range(BAND_ROWS):
        key = _mixed(key * _BASE + rows[:, k])
    return key.view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time, so that a worker holds the sets of few texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    name = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(name[0]), int(name[1])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set1, set2 (128 bits that name the set), keys (of the bands), minima (16 bits of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in _slices(batches):
            n, one, two, keys, low = [], [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), width, hashes)
                n.append(len(found))
                name = _name(found)
                one.append(name[0])
                two.append(name[1])
                m = minima(found) if len(found) else None
                keys.append(None if m is None else band_keys(m))
                low.append(None if m is None else _mixed(m).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary())], names=["doc_id", "n_shingles", "set1", "set2", "keys", "minima"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set1 long, set2 long, keys array<long>, minima binary")


def _agreeing(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many of the minima of each row agree: truth bytes are added eight at a time (20 at most in a byte)."""
    lanes = (one == two).view(np.uint64).sum(axis=1, dtype=np.uint64)
    return ((lanes * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def _minima_of(raw: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint16).reshape(-1, HASHES)


def _agree(one: pd.Series, two: pd.Series) -> pd.Series:
    if not len(one):
        return pd.Series(dtype="bool")
    return pd.Series(_agreeing(_minima_of(one), _minima_of(two)) >= LEAST_AGREEING * HASHES)


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _stars(edges: DataFrame, per: int) -> tuple[DataFrame, DataFrame]:
    """(center, doc_id, part) rows and the (center, part) pairs: no more than about `per` rows share both."""
    n = edges.count()
    degrees = edges.groupBy("center").agg(F.count("*").alias("degree")).withColumn("parts", F.ceil(F.col("degree") / per).cast("int"))
    rows = join_skewed(edges, degrees, "center", n).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")).drop("parts")
    return rows, degrees.select("center", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))


def _plausible(edges: DataFrame, marks: DataFrame) -> DataFrame:
    """The edges whose signatures agree enough. marks: doc_id, minima."""
    rows, centers = _stars(edges, BLOCK)
    members = rows.join(marks, "doc_id")
    middle = centers.join(marks.select(F.col("doc_id").alias("center"), F.col("minima").alias("middle")), "center")
    met = members.join(middle, ["center", "part"])
    return met.where(F.pandas_udf(_agree, "boolean")("minima", "middle")).select("center", "doc_id")


def _confirmed(edges: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges whose full sets have a similarity of `percent` or more. sets: set1, set2, shingles."""
    rows, centers = _stars(edges, SETS_PER_TASK)
    tickets = rows.select("doc_id", "center", "part", F.lit(False).alias("middle")).unionByName(centers.select(F.col("center").alias("doc_id"), "center", "part", F.lit(True).alias("middle")))
    met = sets.join(tickets.join(marks.select("doc_id", "set1", "set2"), "doc_id"), ["set1", "set2"])

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        got = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        out = []
        middles = [a for a, m in zip(got, pdf["middle"], strict=True) if m]
        for doc, a, m in zip(pdf["doc_id"], got, pdf["middle"], strict=True):
            for b in middles if not m else ():
                if _similar(a, b, percent):
                    out.append(doc)
                    break
        return pd.DataFrame({"center": pdf["center"].iloc[:1].repeat(len(out)).to_numpy(), "doc_id": np.array(out, np.int64)})

    return met.groupBy("center", "part").applyInPandas(check, "center long, doc_id long")


def _rest(members: DataFrame, marks: DataFrame, sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """(center, doc_id) links between bucket partners that are in different components still.

    Signatures pick the pairs and full sets confirm them where they meet, so only links leave a task, fewer than it
    has texts: a pair whose components a link before it has joined needs no look. Buckets of many texts, or of
    long ones, meet block by block, so no task holds one whole.
    """
    known = members.join(marks.select("doc_id", "n_shingles", "set1", "set2"), "doc_id").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    known = cut(known)
    mixed = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("degree"), F.sum("n_shingles").alias("load")).where("low <> high")
    mixed = mixed.withColumn("blocks", F.ceil(F.greatest(F.col("degree") / BLOCK, F.col("load") / SHINGLES_PER_BLOCK)).cast("int"))
    rows = join_skewed(known, mixed.select("key", "blocks", "degree"), "key", known.count())
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", "doc_id", "set1", "set2", "component", "own", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    met = dealt.join(marks.select("set1", "set2", "minima"), ["set1", "set2"]).join(sets, ["set1", "set2"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        ids, own = pdf["doc_id"].to_numpy(), pdf["own"].to_numpy()
        one, two = pdf["one"].iloc[0], pdf["two"].iloc[0]
        label = np.unique(pdf["component"], return_inverse=True)[1]
        texts = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        size, low = np.array([len(x) for x in texts]), _minima_of(pdf["minima"])
        right, found = np.flatnonzero(own == two), []
        for a in np.flatnonzero(own == one):
            near = right[(label[right] != label[a]) & (100 * np.minimum(size[right], size[a]) >= percent * np.maximum(size[right], size[a]))]
            if one == two:
                near = near[near > a]
            agreeing = _agreeing(low[near], low[a])
            likely = np.flatnonzero(agreeing >= LEAST_AGREEING * HASHES)
            for b in near[likely[np.argsort(-agreeing[likely], kind="stable")]]:
                if label[a] != label[b] and _similar(texts[a], texts[b], percent):
                    found.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
                    label[label == label[b]] = label[a]
        return pd.DataFrame(found, columns=["center", "doc_id"]).astype("int64")

    return met.groupBy("key", "one", "two").applyInPandas(compare, "center long, doc_id long").distinct()


def _perhaps_among(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of docs whose doc_id has its hash in a bitmap of the n `ids`: all that are among them, and few others.

    The bitmap has SLOTS_PER_ID bits for each id and MOST_SLOTS in all (8 MB), so it may be broadcast at any size of
    input. Where it is too full to tell rows apart they all go on, and the join after it decides.
    """
    slots = min(MOST_SLOTS, max(1 << 15, 1 << (SLOTS_PER_ID * n).bit_length()))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots)) + 1
    bits = ids.select(F.bitmap_bucket_number(slot).alias("bucket_"), F.bitmap_bit_position(slot).alias("bit_")).repartition("bucket_")
    bits = bits.groupBy("bucket_").agg(F.bitmap_construct_agg("bit_").alias("bits_"))
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring("bits_", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.lit(1) == F.call_function("getbit", byte, F.pmod(at, F.lit(8)))
    return docs.join(F.broadcast(bits), (F.bitmap_bucket_number(slot) == F.col("bucket_")) & is_set, "left_semi")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text); other columns are not read.

    Texts link if their sets of `width`-word shingles have a Jaccard similarity of percent / 100 or more;
    component_id is the least doc_id that links reach, kept tells whether it is the row's own. Texts with equal
    sets form a class first, and one text of each class is compared. Bands propose pairs: every class with the
    least one of its bucket, and after these are confirmed, whatever bucket partners are in another component
    still; so no proposed link between components is lost and no bucket makes rows of all its pairs. Rows
    that share a doc_id are one document, which ties the classes of its texts. Null or blank texts have no shingles
    and link with nothing, whatever else their doc_id holds; a null doc_id takes no part, component_id is null and
    kept false.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = cut(signatures(docs, width))
    usable = marked.where("doc_id is not null and n_shingles > 0")
    same = [F.any_value(c).alias(c) for c in ("n_shingles", "keys", "minima")]
    classes = usable.groupBy("set1", "set2").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), *same)
    # A class goes by its least doc_id, so a bucket's middle is its oldest text; one whose least doc_id has several
    # texts goes by a number beyond all of them, which is fixed by being written.
    names = F.struct("set1", "set2")
    several = cut(usable.groupBy("doc_id").agg(F.min(names).alias("one"), F.max(names).alias("two")).where("one <> two").select("doc_id"))
    beyond = marked.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0] + 1
    number = F.when(F.col("many"), F.lit(beyond) + F.monotonically_increasing_id()).otherwise(F.col("first"))
    classes = cut(classes.join(several.select(F.col("doc_id").alias("first"), F.lit(True).alias("many")), "first", "left").withColumn("class", number).drop("many"))
    # From here on doc_id is the number of a class.
    spread = classes.select(F.explode("keys").alias("key"), F.col("class").alias("doc_id"))
    buckets = cut(spread.groupBy("key").agg(F.min("doc_id").alias("center"), F.count("*").alias("degree")).where("degree > 1"))
    met = buckets.agg(F.coalesce(F.sum("degree"), F.lit(0))).first()[0]
    members = cut(join_skewed(spread, buckets, "key", met))
    edges = members.where("center <> doc_id").select("center", "doc_id").distinct()
    hit = members.select("doc_id").distinct()
    marks = cut(classes.select(F.col("class").alias("doc_id"), "first", "set1", "set2", "n_shingles", "minima").join(hit, "doc_id", "left_semi"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in _slices(batches):
            got = [shingle_set(x.as_py(), width, hashes) for x in batch.column(1)]
            names = np.array([_name(x) for x in got], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([x.tobytes() for x in got], pa.binary())], names=["set1", "set2", "shingles"])

    wanted = marks.select(F.col("first").alias("doc_id")).distinct()
    texts = _perhaps_among(docs, wanted, marks.count()).join(wanted, "doc_id", "left_semi")
    sets = cut(texts.mapInArrow(sets_of, "set1 long, set2 long, shingles binary"))

    found = cut(_confirmed(cut(_plausible(edges, marks.select("doc_id", "minima"))), marks, sets, percent))
    tied = usable.join(several, "doc_id").select("doc_id", "set1", "set2").join(classes.select("set1", "set2", "class"), ["set1", "set2"])
    tied = tied.groupBy("doc_id").agg(F.min("class").alias("u"), F.collect_set("class").alias("all")).select("u", F.explode("all").alias("v"))
    components = cut(connected_components(found.select(F.col("center").alias("u"), F.col("doc_id").alias("v")).unionByName(tied)))
    rest = cut(_rest(members.select("key", "doc_id").distinct(), marks, sets, components, percent))
    if not rest.isEmpty():
        # The links so far count as one from each class to its component.
        found = components.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        ends = rest.select(F.col("center").alias("u"), F.col("doc_id").alias("v"))
        components = cut(connected_components(found.unionByName(ends)))
    for table_ in (sets, buckets, members):
        uncut(table_)
    placed = cut(classes.select("set1", "set2", "first", "copies", F.col("class").alias("node")).join(components, "node", "left").withColumn("component", F.coalesce("component", "node")))
    roots = placed.groupBy("component").agg(F.min("first").alias("root"), F.count("*").alias("degree"))
    rooted = join_skewed(placed, roots, "component", placed.count()).select(names.alias("key"), "root", F.col("copies").alias("degree"))
    known = join_skewed(usable.select("doc_id", "n_shingles", names.alias("key")), rooted, "key", usable.count())
    alone = marked.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("root"))
    out = known.select("doc_id", "n_shingles", "root").unionByName(alone)
    return out.select("doc_id", "n_shingles", F.col("root").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("root"), F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs of which one document of each component stays: the one with the least doc_id.

    Rows without a doc_id stay as they are, and so do texts without words unless other texts of their doc_id go.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), width, percent).where("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents by four-word shingles; texts without words link with nothing."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM r JOIN links l ON l.u = r.other)
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id)
"""
