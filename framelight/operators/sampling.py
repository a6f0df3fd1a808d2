"""Frames picked from scenes, and frame ranges as text and as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def even_frames(start: Column, end: Column, n: int) -> Column:
    """n frames spread evenly over [start, end - 1], rounded half to even, without repeats; one frame if the range
    is empty or n is 1."""
    last = end - 1
    if n <= 1:
        return F.array(start.cast("long"))
    step = (last - start) / F.lit(float(n - 1))
    picked = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.greatest(start, F.least(last, start + F.bround(step * i).cast("long"))).cast("long"))
    return F.when(last <= start, F.array(start.cast("long"))).otherwise(F.array_distinct(picked))


def rate_frames(start: Column, end: Column, fps: Column, hz: float) -> Column:
    """Every round(fps / hz)-th frame of [start, end); none without a rate."""
    step = F.greatest(F.lit(1).cast("long"), F.bround(fps / F.lit(float(hz) if hz > 0 else 1.0)).cast("long"))
    some = (F.lit(hz) > 0) & (fps > 0) & (end > start)
    return F.when(some, F.sequence(start.cast("long"), (end - 1).cast("long"), step)).otherwise(F.array().cast("array<bigint>"))


def extraction_targets(scenes: DataFrame, n: int, hz: float) -> DataFrame:
    """scene_id, frame_number, sample_role: a row for each frame and role that a scene asks for."""
    start, end = F.col("start_frame"), F.col("end_frame")
    camera = scenes.select("scene_id", F.explode(even_frames(start, end, n)).alias("frame_number"), F.lit("camera").alias("sample_role"))
    ocr = scenes.select("scene_id", F.explode(rate_frames(start, end, F.col("fps"), hz)).alias("frame_number"), F.lit("ocr").alias("sample_role"))
    return camera.unionByName(ocr)


def frame_ranges(rows: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """keys, frame_ranges: neighbouring frames as a-b, single ones as a, joined by ; in order. Repeats count once."""
    order = Window.partitionBy(*keys).orderBy(frame)
    island = rows.where(F.col(frame).isNotNull()).select(*keys, frame).distinct().withColumn("island_", F.col(frame) - F.row_number().over(order))
    spans = island.groupBy(*keys, "island_").agg(F.min(frame).alias("lo_"), F.max(frame).alias("hi_"))
    said = F.when(F.col("lo_") == F.col("hi_"), F.col("lo_").cast("string")).otherwise(F.concat_ws("-", F.col("lo_").cast("string"), F.col("hi_").cast("string")))
    listed = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo_", said.alias("text")))).alias("all_"))
    return listed.select(*keys, F.array_join(F.col("all_.text"), ";").alias("frame_ranges"))


def expanded_ranges(text: Column) -> Column:
    """The sorted distinct frames of a text like 10-12;20; reversed ends are swapped, what is no number is skipped."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.trim(p)), lambda p: p.rlike(r"^\d+(\s*-\s*\d+)?$"))
    one = lambda p: F.regexp_extract(p, r"^(\d+)", 1).cast("long")
    two = lambda p: F.regexp_extract(p, r"(?:^|-)\s*(\d+)$", 1).cast("long")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, lambda p: F.sequence(F.least(one(p), two(p)), F.greatest(one(p), two(p)))))))


def scene_cuts(series: DataFrame, keys: list[str], order: str, metric: str, threshold: float) -> DataFrame:
    """series with scene_no: a new scene begins where the metric jumps by more than the threshold."""
    w = Window.partitionBy(*keys).orderBy(order)
    jump = F.coalesce(F.abs(F.col(metric) - F.lag(metric).over(w)) > threshold, F.lit(False)).cast("int")
    return series.withColumn("jump_", jump).withColumn("scene_no", F.sum("jump_").over(w)).drop("jump_")
