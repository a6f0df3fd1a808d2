"""Work on all pairs of vectors, block by block: a task holds two blocks of one group, never the group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and how many of them are compared with the other block at once.
BLOCK, SLICE = 8192, 256


def dealt(rows: DataFrame, keys: list[str], by: Column, block: int = BLOCK) -> DataFrame:
    """rows with own_ and blocks_: the row's block of its group, picked by a hash of `by`, and how many there are."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks_"))
    if not keys:
        joined = rows.crossJoin(F.broadcast(counts))
    else:
        joined = rows.alias("r").join(counts.alias("c"), [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]).select("r.*", "c.blocks_")
    return joined.withColumn("own_", F.pmod(F.xxhash64(by), F.col("blocks_")).cast("int"))


def paired(rows: DataFrame, keys: list[str], kernel: Callable[[pa.Table, pa.Table, bool], dict], schema: str) -> DataFrame:
    """keys and what the kernel returns for each pair of blocks of a group, each unordered pair once.

    rows: keys, own_, blocks_ and what the kernel reads. A row is sent to as many tasks as its group has blocks. The
    kernel(one, two, same) gives columns of equal length; one of its tables may be empty.
    """
    others = F.sequence(F.lit(0), F.col("blocks_") - 1)
    sent = rows.select("*", F.explode(others).alias("other_"))
    sent = sent.withColumn("low_", F.least("own_", "other_")).withColumn("high_", F.greatest("own_", "other_")).drop("other_", "blocks_")

    def run(table: pa.Table) -> pa.Table:
        own, low, high = (table.column(c).to_numpy() for c in ("own_", "low_", "high_"))
        one = table.filter(pa.array(own == low))
        same = bool(low[0] == high[0])
        out = {c: pa.array(v) for c, v in kernel(one, one if same else table.filter(pa.array(own == high)), same).items()}
        n = len(next(iter(out.values())))
        return pa.table({k: table.column(k).slice(0, 1).take(pa.array(np.zeros(n, np.int64))) for k in keys} | out)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return sent.groupBy(*keys, "low_", "high_").applyInArrow(run, ", ".join([f"{k} {types[k]}" for k in keys] + [schema]))


def slices(n: int) -> Iterator[slice]:
    return (slice(at, min(n, at + SLICE)) for at in range(0, n, SLICE))


def matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a column in double precision, and their lengths; shorter ones end in zeros, and those that are null
    or hold nulls are zeros."""
    lists = column.combine_chunks() if len(column) else pa.array([], column.type)
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    flat, width = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    x = np.zeros((len(width), width.max(initial=0)))
    x[np.arange(x.shape[1]) < width[:, None]] = flat.fill_null(0).to_numpy(zero_copy_only=False)
    if flat.null_count:
        x[np.repeat(np.arange(len(width)), width)[flat.is_null().to_numpy(zero_copy_only=False)]] = 0
    return x, width


def wide(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns as the wider one."""
    d = max(x.shape[1], y.shape[1])
    return tuple(a if a.shape[1] == d else np.hstack([a, np.zeros((len(a), d - a.shape[1]))]) for a in (x, y))


def crossed(x: np.ndarray, y: np.ndarray, metric: str = "euclidean", same: bool = False) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of the rows of x with their distances to all rows of y; `same`: x is y, a row is 0 from itself. A row without
    length has cosine distance 1 from others."""
    if metric == "cosine":
        x, y = (a / np.where((norm := np.sqrt((a * a).sum(1))) > 0, norm, 1)[:, None] for a in (x, y))
    else:
        middle = y.mean(0)  # distances stay, and near ones of vectors far from 0 keep their digits
        x, y = x - middle, y - middle
        x, y = np.column_stack([-2 * x, (x * x).sum(1), np.ones(len(x))]), np.column_stack([y, np.ones(len(y)), (y * y).sum(1)])
    for part in slices(len(x)):
        d = x[part] @ y.T
        if metric == "cosine":
            np.subtract(1, d, out=d)
        np.maximum(d, 0, out=d)
        if metric != "cosine":
            np.sqrt(d, out=d)
        if same:
            d[np.arange(len(d)), np.arange(part.start, part.stop)] = 0
        yield part, d
