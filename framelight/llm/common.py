"""What the operators share: reading a table, cutting lineage, and folds by a checksum."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries that a worker's word cache holds before it is emptied. Bounds memory only; results don't depend on it.
CACHE = 100_000


class WordCache(dict):
    """word -> make(word), holding up to 2 * size entries: full, the older half gives way. Only bounds memory."""

    def __init__(self, make, size: int = CACHE):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a temporary one, on one machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='framelight-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and go on from the written copy, which survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def uncut(df: DataFrame) -> None:
    """Delete what cut() wrote, once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.cut_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def words_in(text: Column) -> Column:
    """Number of runs without ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Documents that no model here learns from; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About `rows` rows at most, picked by a hash of `key`; all rows while there are no more. For fitting only."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * rows / n))


#: Keys that a skewed join broadcasts at most.
MAX_HUBS = 10_000


def join_skewed(rows: DataFrame, side: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Inner join of rows with side, which has one row per key and in `degree` how many of rows have the key.

    Keys that hold a MAX_HUBS-th of all rows or more, and 1,000 at least, are joined by broadcast, so that no task
    collects their rows; there are MAX_HUBS of them at most. The others go by shuffle.
    """
    from_degree = max(1_000, n_rows // MAX_HUBS + 1)
    names = [c for c in side.columns if c not in (key, "degree")]
    hubs = side.where(F.col("degree") >= from_degree).select(key, F.struct(*names).alias("hub_"))
    marked = rows.join(F.broadcast(hubs), key, "left")
    near = marked.where("hub_ is not null").select(*rows.columns, *[F.col(f"hub_.{c}").alias(c) for c in names])
    rest = marked.where("hub_ is null").select(*rows.columns)
    return near.unionByName(rest.join(side.where(F.col("degree") < from_degree).select(key, *names), key).select(*rows.columns, *names))
