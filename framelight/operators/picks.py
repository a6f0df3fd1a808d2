"""Filters, orders and small picks over frames, scenes and detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions.geometry import iou
from framelight.functions.text import fold


def of_role(frames: DataFrame, role: str) -> DataFrame:
    """The frames sampled for a role: camera or ocr."""
    return frames.where(F.col("sample_role") == role)


def ordinal_in_scene(frames: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """frames with image_idx, the place within the scene from 0."""
    return frames.withColumn("image_idx", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def confident(detections: Column, least: float) -> Column:
    """The detections of an array with `least` confidence or more."""
    return F.filter(detections, lambda d: d["confidence"] >= least)


def scene_filter(scenes: DataFrame, status: str | None = None, scene_type: str | None = None, persons: int | None = None, variance_only: bool = False) -> DataFrame:
    """The scenes that agree with whatever is asked for."""
    for column, value in (("status", status), ("scene_type", scene_type), ("person_count", persons)):
        if value is not None:
            scenes = scenes.where(F.col(column) == value)
    return scenes.where("count_variance") if variance_only else scenes


def camera_search(cameras: DataFrame, needle: str) -> DataFrame:
    """The cameras whose name holds the needle, whatever the case; a blank needle keeps all."""
    return cameras.where(F.lower("camera_id").contains(needle.strip().lower())) if needle.strip() else cameras


def belongs_to_row(text: Column, mapped: Column, row_text: Column, row_raw: Column, row_mapped: Column) -> Column:
    """Whether a detection is one of a timeline row: mapped texts must agree if both are set, then its text equals the
    row's mapped text, text or raw text."""
    given = lambda c: F.coalesce(c != "", F.lit(False))
    clash = given(mapped) & given(row_mapped) & (fold(mapped) != fold(row_mapped))
    same = [F.coalesce(given(text) & (fold(text) == fold(x)), F.lit(False)) for x in (row_mapped, row_text, row_raw)]
    return ~F.coalesce(clash, F.lit(False)) & (same[0] | same[1] | same[2])


def truth_rows(rows: DataFrame, keep: str | None = None, drop: str | None = None) -> DataFrame:
    """Rows of the truth with one scene type, or without one."""
    if keep is not None:
        rows = rows.where(F.col("scene_type") == keep)
    return rows.where(~F.col("scene_type").eqNullSafe(F.lit(drop))) if drop is not None else rows


def middle_samples(samples: DataFrame, mode: str, order: list[str]) -> DataFrame:
    """scene_id, image_path and more: mode all, camera (if there are none: middle), or middle: a scene's row of role
    middle, else its second one, else its first."""
    if mode == "all":
        return samples
    if mode == "camera":
        camera = of_role(samples, "camera")
        if not camera.isEmpty():
            return camera
    place = F.row_number().over(Window.partitionBy("scene_id").orderBy(*order))
    ranked = samples.withColumn("r_", place).withColumn("rank_", F.when(F.col("sample_role") == "middle", 0).when(F.col("r_") == 2, 1).otherwise(1 + F.col("r_")))
    first = Window.partitionBy("scene_id").orderBy("rank_", "r_")
    return ranked.withColumn("f_", F.row_number().over(first)).where("f_ = 1").drop("r_", "rank_", "f_")


def best_per_text(detections: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each exact text in a frame the detection with the highest confidence, of equals the first by `order`."""
    w = Window.partitionBy(*keys, "text").orderBy(F.desc("confidence"), order)
    return detections.withColumn("r_", F.row_number().over(w)).where("r_ = 1").drop("r_")


def matched_detection(boxes: DataFrame, detections: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """boxes (keys, box_id, bbox) with the text and confidence of the detection of their frame that overlaps by
    `least` or more: that with the highest confidence, then overlap, then the first by det; null for none."""
    d = detections.select(*keys, "det", F.col("bbox").alias("other_"), "text", "confidence")
    met = boxes.join(d, keys).withColumn("iou", iou(F.col("bbox"), F.col("other_"))).where(F.col("iou") >= least)
    best = F.max_by(F.struct("text", "confidence", "iou", "det"), F.struct("confidence", "iou", -F.col("det")))
    found = met.groupBy(*keys, "box_id").agg(best.alias("b_")).select(*keys, "box_id", "b_.*")
    return boxes.join(found, [*keys, "box_id"], "left")


def latency(samples: DataFrame, seconds: str, keys: list[str]) -> DataFrame:
    """keys, n, fps, p50, p95: rows a second, the median, and the value of rank round(0.95 (n - 1)), from 0."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(seconds))
    n = F.count("*").over(Window.partitionBy(*keys))
    ranked = samples.withColumn("r_", place - 1).withColumn("n_", n)
    at = F.bround(F.lit(0.95) * (F.col("n_") - 1)).cast("long")
    out = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(seconds).alias("s_"), F.median(seconds).alias("p50"), F.max(F.when(F.col("r_") == at, F.col(seconds))).alias("p95"))
    return out.select(*keys, "n", F.when(F.col("s_") > 0, F.col("n") / F.col("s_")).otherwise(0.0).alias("fps"), "p50", "p95")


def error_summary(rows: DataFrame, error: str, success: str) -> DataFrame:
    """n, success_rate, mean_error, median_error; infinite errors are left out of mean and median."""
    finite = F.when(F.abs(F.col(error)) < F.lit(float("inf")), F.col(error))
    return rows.agg(F.count("*").alias("n"), F.avg(F.col(success).cast("double")).alias("success_rate"), F.avg(finite).alias("mean_error"), F.median(finite).alias("median_error"))


def in_order(frames: DataFrame) -> DataFrame:
    """By scene, role and frame, by code point."""
    return frames.orderBy("scene_id", "sample_role", "frame_number")


def by_duration(lines: DataFrame) -> DataFrame:
    return lines.orderBy(F.desc("total_duration_sec"), "camera_id", "mapped_complete_text", "text")


def leaderboard(metrics: DataFrame, value: str, name: str) -> DataFrame:
    """The best first, methods without the value last."""
    return metrics.orderBy(F.col(value).desc_nulls_last(), name)


def seeded_split(ids: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """ids with tuning: a share of the ids, drawn without replacement by a hash of id and seed, one id at least.

    The draw is the same for the same ids and seed; it isn't that of any other generator.
    """
    n = ids.select(key).distinct().count()
    take = max(1, int(n * share)) if n else 0
    chosen = ids.select(key).distinct().orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(take).withColumn("tuning", F.lit(True))
    return ids.join(chosen, key, "left").withColumn("tuning", F.coalesce("tuning", F.lit(False)))


def noise_rates(rows: DataFrame, cluster: str, camera: str) -> DataFrame:
    """n, n_clusters, n_noise, noise_rate, unknown_rate."""
    bad, lost = F.col(cluster) < 0, F.coalesce(F.col(camera), F.lit("unknown")) == "unknown"
    return rows.agg(F.count("*").alias("n"), F.count_distinct(F.when(~bad, F.col(cluster))).alias("n_clusters"), F.count_if(bad).alias("n_noise"), F.coalesce(F.avg(bad.cast("double")), F.lit(0.0)).alias("noise_rate"), F.coalesce(F.avg(lost.cast("double")), F.lit(0.0)).alias("unknown_rate"))


def metric_delta(now: DataFrame, before: DataFrame, name: str, value: str) -> DataFrame:
    """name, before, now, delta of the metrics in either table."""
    both = now.select(name, F.col(value).alias("now")).join(before.select(name, F.col(value).alias("before")), name, "full")
    return both.select(name, "before", "now", (F.col("now") - F.col("before")).alias("delta"))
