"""Exact top-k by inner product: a Voronoi join of queries and data with bounds from summaries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelight.llm.common import cut, table

#: Bytes of pivots at most, the bound of what is broadcast; queries of a group; data rows that meet a group in one task.
PIVOT_BYTES, GROUP_QUERIES, CHUNK_ROWS = 16 << 20, 256, 16_384
SCORED = "query_id long, vec_id long, score long"


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column as a float64 matrix; rows shorter than `width` end with zeros."""
    rows = column.tolist() if isinstance(column, pd.Series) else column
    if any(len(r) != width for r in rows):
        out = np.zeros((len(rows), width))
        for k, r in enumerate(rows):
            out[k, : len(r)] = r
        return out
    return np.array(rows, dtype=np.float64).reshape(len(rows), width)


def pivots_of(vectors: DataFrame) -> np.ndarray:
    """Vectors picked by a hash: as many as half the root of the rows, PIVOT_BYTES at most, padded to the longest."""
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    k = int(max(1, min(PIVOT_BYTES // (8 * max(1, width)), n**0.5 / 2)))
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(k).select("v").collect()
    return np.unique(_matrix([r["v"] for r in picked], width), axis=0)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and its distance."""
    square = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    cell = square.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def _whole(x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers are exact in doubles below 2 ** 53; else whole numbers of any size are used."""
    return x if x.size == 0 or x.shape[1] * float(np.abs(x).max()) ** 2 < 2**52 else x.astype(object)


def _chain(pivots: np.ndarray) -> list[int]:
    """An order of the pivots in which each is followed by the nearest one that is left, so neighbours are alike."""
    left, order = np.ones(len(pivots), bool), [0]
    left[0] = False
    while left.any():
        away = np.where(left, ((pivots - pivots[order[-1]]) ** 2).sum(1), np.inf)
        order.append(int(away.argmin()))
        left[order[-1]] = False
    return order


def _dealt(counts: dict[int, int], order: list[int], per: int) -> dict[int, tuple[int, int]]:
    """(first, parts) by cell: cells in order share a number until it holds `per` rows; a larger cell has several."""
    out, number, held = {}, 0, 0
    for c in order:
        n = counts.get(c, 0)
        if n > per:
            number += held > 0
            out[c] = (number, -(-n // per))
            number, held = number + out[c][1], 0
        elif n:
            if held + n > per:
                number, held = number + 1, 0
            out[c] = (number, 1)
            held += n
    return out


@dataclass
class Summary:
    """What the bounds need of the data's cells: pivots and, by cell, least and largest distance and largest norm."""

    pivots: np.ndarray
    near: np.ndarray
    far: np.ndarray
    norm: np.ndarray

    def ranges(self, q: np.ndarray, home: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and cell the distances from the pivot between which a row may score `floor` or more.

        With q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 the row lies within a radius around q; the triangle inequality
        gives the ring, Cauchy's inequality on q.(x - p) a second lower end, and the plane between the
        cell's pivot and the query's own may rule the cell out. Ruled out: an empty range.
        """
        p = self.pivots
        q2, p2 = (q * q).sum(1), (p * p).sum(1)
        size = 1 + q2.max(initial=0) + (self.norm[np.isfinite(self.norm)] ** 2).max(initial=0)
        products = q @ p.T
        away2 = np.maximum(q2[:, None] - 2 * products + p2[None], 0)
        away = np.sqrt(away2)
        radius = np.sqrt(np.maximum(q2[:, None] + self.norm[None] ** 2 - 2 * floor[:, None], 0) + 1e-9 * size)
        slack = 1e-9 * np.sqrt(size)
        with np.errstate(divide="ignore", invalid="ignore"):
            steep = np.where(q2[:, None] > 0, (floor[:, None] - products) / np.sqrt(q2)[:, None], -np.inf)
            between = np.sqrt(np.maximum(p2[home][:, None] - 2 * p[home] @ p.T + p2[None], 0))
            plane = np.where(between > slack, (away2 - away2[np.arange(len(q)), home][:, None]) / (2 * between), -np.inf)
        low = np.maximum(away - radius, steep - 1e-9 * np.abs(steep)) - slack
        high = away + radius + slack
        out = (plane > radius + 1e-6 * np.sqrt(size)) | (low > self.far[None]) | (high < self.near[None])
        return np.where(out, np.inf, low), np.where(out, -np.inf, high)


class VoronoiJoin:
    """The steps of top_k(), apart for tests: what is sent is home_pairs and then needed_rows()."""

    def __init__(self, vectors: DataFrame, queries: DataFrame, k: int, group_queries: int = GROUP_QUERIES, chunk_rows: int = CHUNK_ROWS):
        self.spark, self.k = vectors.sparkSession, k
        self.pivots = pivots_of(vectors)
        self.width = self.pivots.shape[1]
        shared, width = self.spark.sparkContext.broadcast(self.pivots), self.width

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(1).to_pylist(), width)
                    cell, distance = _nearest(x, shared.value)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(distance), pa.array(np.sqrt((x * x).sum(1)))], names=["vec_id", "v", "cell", "distance", "norm"])

        schema = "vec_id long, v array<double>, cell int, distance double, norm double"
        placed = cut(vectors.select("vec_id", "v").mapInArrow(assign, schema)) if len(self.pivots) else vectors.select("vec_id", "v").mapInArrow(lambda batches: iter(()), schema)
        asked = cut(queries.select("vec_id", "v").mapInArrow(assign, schema)) if len(self.pivots) else placed
        # A row for each pivot at most.
        stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far"), F.max("norm").alias("norm")).collect()
        n_asked = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
        m = len(self.pivots)
        self.summary = Summary(self.pivots, np.full(m, np.inf), np.full(m, -np.inf), np.zeros(m))
        for r in stats:
            self.summary.near[r["cell"]], self.summary.far[r["cell"]], self.summary.norm[r["cell"]] = r["near"], r["far"], r["norm"]
        order = _chain(self.pivots) if m else []
        chunks, groups = _dealt({r["cell"]: r["n"] for r in stats}, order, chunk_rows), _dealt(n_asked, order, group_queries)
        number = lambda dealt: self.spark.createDataFrame([(c, a, n) for c, (a, n) in dealt.items()], "cell int, first int, parts int")
        mine = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int")
        self.chunks = number(chunks)
        self.data = placed.join(F.broadcast(self.chunks), "cell").select("vec_id", "v", "cell", "distance", mine.alias("chunk"))
        self.grouped = asked.join(F.broadcast(number(groups)), "cell").select(F.col("vec_id").alias("query_id"), "v", F.col("cell").alias("home"), mine.alias("group"))

    def home_routes(self) -> DataFrame:
        """Every group goes to the cells of its own queries."""
        routes = self.grouped.select("group", F.col("home").alias("cell")).distinct()
        return routes.withColumn("low", F.lit(float("-inf"))).withColumn("high", F.lit(float("inf")))

    def other_routes(self, floors: DataFrame) -> DataFrame:
        """group, cell, low, high: the ring of each further cell that holds all rows that the group may need."""
        shared, width = self.spark.sparkContext.broadcast(self.summary), self.width

        def route(pdf: pd.DataFrame) -> pd.DataFrame:
            s = shared.value
            low, high = s.ranges(_matrix(pdf["v"], width), pdf["home"].to_numpy(), pdf["floor"].to_numpy())
            out = pd.DataFrame({"group": pdf["group"].iloc[0], "cell": np.arange(len(s.pivots), dtype=np.int32), "low": low.min(0), "high": high.max(0)})
            return out[(out["low"] <= out["high"]) & ~out["cell"].isin(pdf["home"])]

        known = self.grouped.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        return known.groupBy("group").applyInPandas(route, "group int, cell int, low double, high double")

    def needed_rows(self, routes: DataFrame) -> DataFrame:
        """group, chunk, vec_id, v: the rows within a group's rings. Rows and routes meet by chunk, so no cell is one task's."""
        parts = routes.join(F.broadcast(self.chunks), "cell").withColumn("chunk", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)))
        met = self.data.join(parts.select("group", "cell", "chunk", "low", "high"), ["chunk", "cell"])
        return met.where(F.col("distance").between(F.col("low"), F.col("high"))).select("group", "chunk", "vec_id", "v")

    def solve(self, rows: DataFrame) -> DataFrame:
        """Each query's k best of the rows of its group: chunk by chunk, a group only where rows of the chunk reach it."""
        width, k = self.width, self.k
        rows = cut(rows)
        sent = cut(rows.select("group", "chunk").distinct()).join(self.grouped.select("group", "query_id", "v"), "group")

        def best(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
            if not len(ask) or not len(have):
                return pd.DataFrame(columns=["query_id", "vec_id", "score"]).astype("int64")
            have = have.sort_values("vec_id", kind="stable")
            ids, both = have["vec_id"].to_numpy(), _whole(np.concatenate([_matrix(ask["v"], width), _matrix(have["v"], width)]))
            scores = both[: len(ask)] @ both[len(ask) :].T
            out = []
            for query, row in zip(ask["query_id"], scores, strict=True):
                ok = np.flatnonzero(ids != query)
                row = row[ok]
                at = np.arange(len(ok))
                if len(ok) > k:
                    at = np.flatnonzero(row >= np.partition(row, len(ok) - k)[len(ok) - k])
                at = at[np.argsort(-row[at], kind="stable")][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[ok[at]], "score": row[at].astype(np.int64)}))
            return pd.concat(out)

        return sent.groupBy("group", "chunk").cogroup(rows.groupBy("group", "chunk")).applyInPandas(best, SCORED)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of vectors with the highest inner product for each query.

    vectors and queries hold vec_id and v, a non-null array of whole numbers (as doubles); a component that one of
    two vectors lacks counts as 0. A row with the query's own vec_id is no candidate; equal scores go to the
    smaller vec_id; repeated rows count as often as they occur, and queries with one vec_id are one query of which
    any row may stand; fewer candidates than k are all returned, and empty tables give no rows.

    Both sides go to their nearest pivot, and queries of neighbouring cells make a group. First each group meets the
    cells of its own queries, exactly; a query's k-th score there is a floor. Of every other cell only the rows
    within the ring that some query's floor allows are sent to the group, and the best of both passes are merged.
    """
    join = VoronoiJoin(vectors, queries.dropDuplicates(["vec_id"]), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    home = cut(ranked(join.solve(join.needed_rows(join.home_routes()))))
    floors = home.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
    rows = join.needed_rows(cut(join.other_routes(floors)))
    both = home.select("query_id", "vec_id", "score").unionByName(join.solve(rows))
    return ranked(both).select("query_id", "rank", "vec_id", "score")


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and v = floor(256 * x) of each component; vectors that are null or hold null or non-finite ones go.

    So do rows with a null vec_id; an empty vector stays and scores 0 with all.
    """
    at = F.col("embedding").cast("array<double>")
    good = F.coalesce(F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    return embeddings.where(good & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(at, lambda x: F.floor(x * 256).cast("double")).alias("v"))


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for every vec_id divisible by 50; null and non-finite vectors and null ids take no part."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s) WHERE rank <= 5
"""
