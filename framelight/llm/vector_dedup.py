"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them, one vector of a group kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import bounded_sample, cut, join_skewed, table
from framelight.llm.components import connected_components

LEAST_COSINE = 0.93
#: Vectors that the centres are fitted on at most, rounds, vectors aimed at for a cell, vectors of a label from which on
#: it has two cells at least, and bytes of all centres at most, the bound of what is broadcast.
SAMPLE_ROWS, ROUNDS, CELL_ROWS, TWO_CELLS, CENTRE_BYTES = 20_000, 8, 4_096, 64, 32 << 20
#: Vectors of one side of a block of products.
BLOCK = 4_096


def _unit(column) -> np.ndarray:
    x = np.array(column.tolist() if isinstance(column, pd.Series) else column, dtype=np.float64).reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k distinct unit centres of the unit vectors x: each round puts them into the middle of their vectors."""
    centre = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        cell = (x @ centre.T).argmax(1)
        for c in range(len(centre)):
            total = x[cell == c].sum(0)
            norm = np.sqrt(total @ total)
            if norm > 0:
                centre[c] = total / norm
    return np.unique(centre, axis=0)


def fit_centres(vectors: DataFrame, cell_rows: int = CELL_ROWS) -> dict[tuple[int, int], np.ndarray]:
    """Unit centres by (label, vector length) from spherical k-means on a bounded sample.

    There are as many as the label needs for cells of `cell_rows` vectors, two at least from TWO_CELLS vectors on,
    and CENTRE_BYTES of them in all; what has no centre here is one cell.
    """
    sized = vectors.withColumn("width", F.size("v"))
    counts = {(r["label"], r["width"]): r["count"] for r in sized.groupBy("label", "width").count().orderBy(F.desc("count")).limit(SAMPLE_ROWS).collect()}
    got = bounded_sample(sized, F.col("vec_id"), SAMPLE_ROWS).select("label", "width", "vec_id", "v").toPandas()
    share = min(1.0, CENTRE_BYTES / max(1.0, sum(8 * w * n / cell_rows for (_, w), n in counts.items())))
    out = {}
    for key, part in got.groupby(["label", "width"]):
        n = counts.get(key, 0)
        k = max(2, round(share * n / cell_rows)) if n >= TWO_CELLS else 1
        if k > 1:
            out[int(key[0]), int(key[1])] = spherical_kmeans(_unit(part.sort_values("vec_id")["v"]), k)
    return out


def cells_of(x: np.ndarray, centre: np.ndarray, chord: float) -> list[np.ndarray]:
    """For each unit vector its own cell first, then every cell that may hold a vector within `chord` of it.

    A vector y of cell c is no farther from c than from any other centre; the distance of x from the plane
    between c and x's own centre is a bound of its distance from all of cell c.
    """
    dot = x @ centre.T
    own = dot.argmax(1)
    apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
    away = (dot[np.arange(len(x)), own][:, None] - dot) / np.where(apart[own] > 0, apart[own], 1)
    near = away <= chord + 1e-9
    near[np.arange(len(x)), own] = False
    return [np.concatenate([[o], np.flatnonzero(n)]).astype(int) for o, n in zip(own, near, strict=True)]


def near_vectors(embeddings: DataFrame, least: float = LEAST_COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of embeddings (vec_id, embedding, label).

    Vectors of equal, non-null label link if their cosine, in doubles, is `least` or more; null or zero vectors
    and those with null or non-finite components link with nothing, nor do vectors of different lengths or with
    a null vec_id (component_id null, kept false). Rows alike in vec_id, label and vector are one vector; rows that
    share only a vec_id are several, which have one component_id. Equal vectors of a label form a class, and one
    of each class is compared. Each of these goes to its k-means cell and, as a visitor, to every other cell that may
    hold a partner, so none is lost. A cell's vectors meet in blocks, which return counts of links and a spanning
    tree of the links instead of all pairs.
    """
    spark = embeddings.sparkSession
    at = F.col("embedding").cast("array<double>")
    finite = F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(at, lambda x: x != 0)
    ids = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), at.alias("v"), F.coalesce(finite & some & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)).alias("usable"))
    ids = ids.withColumn("hash", F.sha2(F.array_join(F.transform(F.col("v"), lambda x: (x + 0.0).cast("string")), ","), 256))
    usable = ids.where("usable")
    once = cut(usable.select("label", "hash", "vec_id").distinct())
    copies = once.groupBy("label", "hash").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = usable.groupBy("label", "hash").agg(F.first("v").alias("v")).join(copies, ["label", "hash"])
    classes = cut(classes.withColumn("vec_id", F.monotonically_increasing_id()))  # being written fixes these numbers
    centres = spark.sparkContext.broadcast(fit_centres(classes, cell_rows))  # CENTRE_BYTES
    chord = float(np.sqrt(2 - 2 * least))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pdf = b.to_pandas()
            for (label, width), same in pdf.groupby(["label", pdf["v"].map(len)]):
                centre = centres.value.get((int(label), int(width)))
                cells = cells_of(_unit(same["v"]), centre, chord) if centre is not None else [np.zeros(1, int)] * len(same)
                out = pd.DataFrame({"label": label, "vec_id": same["vec_id"].to_numpy(), "copies": same["copies"].to_numpy(), "v": same["v"].to_numpy(), "cell": cells})
                out["home"] = [[True] + [False] * (len(c) - 1) for c in cells]
                out = out.explode(["cell", "home"]).astype({"cell": "int64", "home": "bool"})
                out["cell"] += int(width) << 32
                yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    schema = "label long, vec_id long, copies long, v array<double>, cell long, home boolean"
    placed = cut(classes.select("label", "vec_id", "copies", "v").mapInArrow(spread, schema))
    sizes = placed.groupBy("label", "cell").agg(F.count("*").alias("rows"))
    sizes = sizes.select("label", "cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"), F.col("rows").alias("degree"))
    keyed = placed.withColumn("key", F.xxhash64("label", "cell"))
    dealt = join_skewed(keyed, sizes.select(F.xxhash64("label", "cell").alias("key"), "blocks", "degree"), "key", placed.count())
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Block (one, two): the homes of block one meet everyone of block two.
    ones = dealt.where("home").select("label", "cell", "vec_id", "copies", "v", F.col("own").alias("one"), F.col("other").alias("two"), F.lit(True).alias("asks"))
    twos = dealt.select("label", "cell", "vec_id", "copies", "v", F.col("other").alias("one"), F.col("own").alias("two"), F.lit(False).alias("asks"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, has = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        out = []
        if len(asks) and len(has):
            y, ids, copies = _unit(has["v"]), has["vec_id"].to_numpy(), has["copies"].to_numpy()
            tree = np.arange(len(has))
            for at in range(0, len(asks), 512):
                part = asks.iloc[at : at + 512]
                link = _unit(part["v"]) @ y.T >= least
                link &= part["vec_id"].to_numpy()[:, None] != ids[None]
                counts = link @ copies
                for i in np.flatnonzero(link.any(1)):
                    hit = np.flatnonzero(link[i])
                    joined, first = np.unique(tree[hit], return_index=True)
                    doc = int(part["vec_id"].iloc[i])
                    out += [(doc, int(counts[i]) if k == 0 else 0, int(e)) for k, e in enumerate(ids[hit[first]])]
                    if len(joined) > 1:
                        tree[np.isin(tree, joined)] = joined[0]
        return pd.DataFrame(out, columns=["vec_id", "links", "other"]).astype("int64")

    met = cut(ones.unionByName(twos).groupBy("label", "cell", "one", "two").applyInPandas(meet, "vec_id long, links long, other long"))
    links = met.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = met.select(F.col("vec_id").alias("u"), F.col("other").alias("v"))
    # Rows of one vec_id with several vectors tie their classes together.
    several = once.groupBy("vec_id").count().where("count > 1").select("vec_id")
    tied = once.join(several, "vec_id").join(classes.select("label", "hash", F.col("vec_id").alias("class")), ["label", "hash"])
    tied = tied.groupBy("vec_id").agg(F.min("class").alias("u"), F.collect_set("class").alias("all"))
    components = cut(connected_components(edges.unionByName(tied.select("u", F.explode("all").alias("v")))))
    summed = classes.select("label", "hash", "least_id", F.col("vec_id").alias("node"), "copies").join(links.withColumnRenamed("vec_id", "node"), "node", "left").join(components, "node", "left")
    summed = cut(summed.select("label", "hash", "least_id", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.col("copies").alias("degree")))
    roots = summed.groupBy("component").agg(F.min("least_id").alias("root"), F.count("*").alias("degree"))
    rooted = join_skewed(summed, roots, "component", summed.count()).select(F.struct("label", "hash").alias("key"), "n", "root", "degree")
    known = join_skewed(usable.select("vec_id", F.struct("label", "hash").alias("key")), rooted, "key", usable.count())
    rest = ids.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("root"))
    both = known.select("vec_id", "n", "root").unionByName(rest)
    return both.select("vec_id", F.col("n").alias("n_links"), F.col("root").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("root"), F.lit(False)).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  WITH RECURSIVE r(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM r JOIN links l ON l.u = r.other)
  SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u) USING (vec_id) LEFT JOIN reach USING (vec_id)
"""
