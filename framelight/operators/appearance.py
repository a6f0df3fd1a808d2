"""Appearance of persons in scenes: roll-up, issues, summary, reconciliation of cameras."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions.colors import PALETTE, TOLERANCE
from framelight.functions.text import normalized_signature


def frame_status(count: Column, confidence: Column, least: float = 0.5) -> Column:
    return F.when(count <= 0, "no_person").when(confidence < least, "low_conf").otherwise("ok")


def scene_rollup(frames: DataFrame, order: list[str] | None = None) -> DataFrame:
    """scene_id, person_count (mode, the smallest of equals), confidence over frames with persons, variance, status.

    A mean at the bound of a status depends on the order in which its frames are summed: with `order` they are summed in
    that order, however the frames are dealt out.
    """
    sure = F.when(F.col("person_count") > 0, F.col("confidence"))
    own = frames.where("scene_id is not null")
    if order:
        whole = Window.partitionBy("scene_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        own = own.withColumn("confidence", F.avg(sure).over(whole))
        mean = F.first("mean_")
    else:
        mean = F.sum("sum_") / F.nullif(F.sum("sure_"), F.lit(0))
    counted = own.groupBy("scene_id", "person_count").agg(F.count("*").alias("n_"), F.first("confidence").alias("mean_"), F.sum(sure).alias("sum_"), F.count(sure).alias("sure_"))
    mode = F.max_by("person_count", F.struct("n_", -F.col("person_count")))
    both = counted.groupBy("scene_id").agg(mode.alias("person_count"), (F.count("*") > 1).alias("count_variance"), mean.alias("confidence"), F.sum("n_").alias("n_frames"))
    return both.withColumn("status", frame_status(F.col("person_count"), F.coalesce("confidence", F.lit(0.0))))


def issues(scenes: DataFrame) -> DataFrame:
    """Scenes whose frames disagree in number, or close-ups without a sure person."""
    return scenes.where(F.col("count_variance") | ((F.col("scene_type") == "closeup") & F.col("status").isin("low_conf", "no_person")))


def eligible(scenes: DataFrame) -> DataFrame:
    return scenes.where((F.col("scene_type") != "full_court") & (F.col("status") == "ok") & (normalized_signature(F.col("appearance_signature")) != ""))


def status_summary(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, n: a histogram of each column in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    return rows.select(pairs).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))


def reconciled(scenes: DataFrame, least: int = 2, tolerance: float = TOLERANCE) -> DataFrame:
    """video_id, scene_id, camera_id: a camera's scenes of other colours split off into cameras of their own.

    scenes: video_id, scene_id, camera_id, color (null: not eligible), before (its modal cluster before merging, null or
    negative: none). In order each scene joins the first group of its camera with all of whose scenes its colour goes
    together; the largest group stays, the first of equals. Of others with `least` scenes or more each scene goes to
    the camera of its own earlier cluster; where none has one the group gets a new camera. Smaller groups stay.
    """
    pairs = {(a, b) for a, x in PALETTE.items() for b, y in PALETTE.items() if sum((p - q) ** 2 for p, q in zip(x, y)) ** 0.5 < tolerance}

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("scene_id").reset_index(drop=True)
        after = 1 + max((int(c[4:]) for c in pdf["camera_id"].dropna() if c.startswith("cam_") and c[4:].isdigit()), default=-1)
        camera = pdf["camera_id"].copy()
        for _, part in pdf[pdf["color"].notna() & (pdf["color"] != "")].groupby("camera_id", sort=True):
            groups: list[tuple[set, list[int]]] = []
            for k, color in part["color"].items():
                for colors, rows in groups:
                    if all(c == color or (c, color) in pairs for c in colors):
                        colors.add(color)
                        rows.append(k)
                        break
                else:
                    groups.append(({color}, [k]))
            for rows in sorted((g for _, g in groups), key=len, reverse=True)[1:]:
                if len(rows) < least:
                    continue
                known = {k: int(pdf["before"][k]) for k in rows if pd.notna(pdf["before"][k]) and pdf["before"][k] >= 0}
                for k in known or rows:
                    camera[k] = f"cam_{known.get(k, after)}"
                after += not known
        return pd.DataFrame({"video_id": pdf["video_id"], "scene_id": pdf["scene_id"], "camera_id": camera})

    types = {f.name: f.dataType.simpleString() for f in scenes.schema}
    return scenes.groupBy("video_id").applyInPandas(split, f"video_id {types['video_id']}, scene_id {types['scene_id']}, camera_id string")
