"""Held against ground truth: joins, confusion, accuracy, purity, mapping, disagreement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """truth, predicted, n, support: counts of each pair and of each true label."""
    counted = rows.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    return counted.join(rows.groupBy(F.col(truth).alias("truth")).agg(F.count("*").alias("support")), "truth")


def accuracy(rows: DataFrame, keys: list[str], truth: str, predicted: str, noise: Column) -> DataFrame:
    right = F.coalesce((F.col(truth) == F.col(predicted)).cast("double"), F.lit(0.0))
    return rows.groupBy(*keys).agg(F.count("*").alias("support"), F.avg(right).alias("accuracy"), F.avg(noise.cast("double")).alias("noise_rate"))


def purity(rows: DataFrame, cluster: str, truth: str) -> DataFrame:
    """One row: the share of all rows that their cluster's largest true label holds; noise holds none."""
    pairs = rows.groupBy(cluster, truth).agg(F.count("*").alias("n_"))
    tops = pairs.groupBy(cluster).agg(F.max("n_").alias("top_"), F.sum("n_").alias("all_"))
    return tops.agg((F.coalesce(F.sum(F.when(F.col(cluster) >= 0, F.col("top_"))), F.lit(0)) / F.sum("all_")).alias("purity"))


def singleton_rate(rows: DataFrame, camera: str, scene: str) -> DataFrame:
    per = rows.groupBy(camera).agg(F.count_distinct(scene).alias("n_"))
    return per.agg(F.count("*").alias("n_cameras"), F.count_if(F.col("n_") == 1).alias("n_singletons"), F.avg((F.col("n_") == 1).cast("double")).alias("singleton_rate"))


def binned(rows: DataFrame, value: str, edges: list[float], right: Column) -> DataFrame:
    """bin, n, accuracy: bins closed on the right, the first one on the left too; values outside are left out."""
    x, ladder = F.col(value), F.when(F.lit(False), 0)
    for k in range(len(edges) - 1):
        above = x >= edges[k] if k == 0 else x > edges[k]
        ladder = ladder.when(above & (x <= edges[k + 1]), k)
    return rows.withColumn("bin", ladder).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), F.avg(right.cast("double")).alias("accuracy"))


def disagreement(rows: DataFrame, key: str, label: str) -> DataFrame:
    """key, n_labels, unanimous, share of the most common label."""
    counted = rows.groupBy(key, label).agg(F.count("*").alias("n_"))
    return counted.groupBy(key).agg(F.count("*").alias("n_labels"), (F.count("*") == 1).alias("unanimous"), (F.max("n_") / F.sum("n_")).alias("share"))


def pair_indices(rows: DataFrame, truth: str, cluster: str) -> DataFrame:
    """One row: adjusted Rand index, homogeneity, completeness and V-measure, from the contingency table."""
    pairs = rows.groupBy(truth, cluster).agg(F.count("*").cast("double").alias("n"))
    two = lambda c: c * (c - 1) / 2
    side = lambda c, name: pairs.groupBy(c).agg(F.sum("n").alias("m")).agg(F.sum(two(F.col("m"))).alias(f"pairs_{name}"), F.sum(F.col("m") * F.log("m")).alias(f"log_{name}"))
    cell = pairs.agg(F.sum("n").alias("n"), F.sum(two(F.col("n"))).alias("pairs_cell"), F.sum(F.col("n") * F.log("n")).alias("log_cell"))
    one = cell.crossJoin(side(truth, "truth")).crossJoin(side(cluster, "cluster"))  # one row each
    expected = F.col("pairs_truth") * F.col("pairs_cluster") / two(F.col("n"))
    highest = (F.col("pairs_truth") + F.col("pairs_cluster")) / 2
    h_truth, h_cluster = F.log("n") - F.col("log_truth") / F.col("n"), F.log("n") - F.col("log_cluster") / F.col("n")
    h_both = F.log("n") - F.col("log_cell") / F.col("n")
    homogeneity = F.when(h_truth > 0, 1 - (h_both - h_cluster) / h_truth).otherwise(1.0)
    completeness = F.when(h_cluster > 0, 1 - (h_both - h_truth) / h_cluster).otherwise(1.0)
    named = one.select(F.when(highest == expected, 1.0).otherwise((F.col("pairs_cell") - expected) / (highest - expected)).alias("adjusted_rand"), homogeneity.alias("homogeneity"), completeness.alias("completeness"))
    total = F.col("homogeneity") + F.col("completeness")
    return named.withColumn("v_measure", F.when(total > 0, 2 * F.col("homogeneity") * F.col("completeness") / total).otherwise(0.0))


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, by shortest augmenting paths; the smaller side is matched whole."""
    cost = np.asarray(cost, float)
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assignment(cost.T))
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            reduced = cost[i0 - 1] - u[i0] - v[1:]
            better = ~used[1:] & (reduced < least[1:])
            least[1:][better] = reduced[better]
            way[1:][better] = j0
            j1 = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[1:][~used[1:]] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return sorted((int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j])


def mapped_labels(rows: DataFrame, cluster: str, truth: str) -> dict[int, str]:
    """cluster -> true label that makes most rows right, one to one; noise and clusters left over map to unknown.

    The contingency table has a row for each pair of cluster and label, which are few.
    """
    got = rows.groupBy(cluster, truth).count().collect()
    clusters, labels = sorted({r[0] for r in got}), sorted({r[1] for r in got})
    right = np.zeros((len(clusters), len(labels)))
    for c, t, n in got:
        right[clusters.index(c), labels.index(t)] = n
    size = right.sum(1, keepdims=True)
    out = {int(c): "unknown" for c in clusters}
    for i, j in assignment(size - right):
        if clusters[i] >= 0:
            out[int(clusters[i])] = str(labels[j])
    return out
