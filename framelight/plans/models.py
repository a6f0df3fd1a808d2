"""Where picture models plug in: a callable from pictures to rows, run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class PictureModel(Protocol):
    def __call__(self, content: bytes) -> Iterable[tuple]: ...


def no_model(content: bytes) -> Iterable[tuple]:
    """Reads nothing."""
    return ()


def apply_model(pictures: DataFrame, make: Callable[[], PictureModel], keys: list[str], schema: str) -> DataFrame:
    """keys and what the model returns for each picture (content); the model is made once in each task."""
    types = {f.name: f.dataType.simpleString() for f in pictures.schema}
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            rows = [(*key, *out) for *key, content in b[[*keys, "content"]].itertuples(index=False) for out in model(content)]
            yield pd.DataFrame(rows, columns=[*keys, *names])

    return pictures.select(*keys, "content").mapInPandas(run, ", ".join([f"{k} {types[k]}" for k in keys]) + ", " + schema)
