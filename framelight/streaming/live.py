"""Optional streaming form of the append: rows of new frames go on, keys seen before don't."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from framelight.sources.tables import append_missing


def append_stream(rows: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Writes each batch's unseen keys to the Parquet table at path; a batch run twice adds nothing."""
    each = lambda batch, _: append_missing(batch.dropDuplicates(keys), path, keys)
    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
