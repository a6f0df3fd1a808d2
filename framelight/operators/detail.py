"""Joins behind the views: provenance of words, details of timeline rows, scenes of cameras, appearance of scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions.colors import labels_match
from framelight.functions.text import fold, normalized_signature, subsequence_length_udf
from framelight.operators import runs, sampling
from framelight.operators.graph import components

FRAME = ["scene_id", "frame_number"]


def with_detection(words: DataFrame, detections: DataFrame) -> DataFrame:
    """words (frame, raw_text) with readability_label and bbox of the frame's first detection (by det) of the same
    text, whatever the case; without one partial and no box."""
    first = detections.groupBy(*FRAME, fold(F.col("text")).alias("key_")).agg(F.min_by(F.struct("readability_label", "bbox"), "det").alias("d_"))
    out = words.withColumn("key_", fold(F.col("raw_text"))).join(first, [*FRAME, "key_"], "left")
    return out.withColumn("readability_label", F.coalesce("d_.readability_label", F.lit("partial"))).withColumn("bbox", F.col("d_.bbox")).drop("key_", "d_")


def with_provenance(words: DataFrame, raw_words: DataFrame) -> DataFrame:
    """words (frame, raw_text) with enrich_applied and ocr_raw_text, from the words read before (frame, word, ord).

    A word that was read there, whatever the case, is not enriched. Others are, and their raw text is the frame's word
    with the longest common subsequence, the first of equals, null if nothing is common or the frame was not read. Each
    different word of a frame meets the frame's words once.
    """
    raw = raw_words.where(F.trim("word") != "").select(*FRAME, F.trim("word").alias("word"), "ord")
    asked = words.where("raw_text is not null").select(*FRAME, "raw_text").distinct()
    met = asked.join(raw, FRAME).withColumn("same_", fold(F.col("raw_text")) == fold(F.col("word")))
    read = met.groupBy(*FRAME, "raw_text").agg(F.max("same_").alias("same_"))
    other = met.join(read.where("not same_").select(*FRAME, "raw_text"), [*FRAME, "raw_text"]).withColumn("l_", subsequence_length_udf()(fold(F.col("raw_text")), fold(F.col("word"))))
    best = other.where("l_ > 0").groupBy(*FRAME, "raw_text").agg(F.max_by("word", F.struct("l_", -F.col("ord"))).alias("ocr_raw_text"))
    out = words.join(read, [*FRAME, "raw_text"], "left").join(best, [*FRAME, "raw_text"], "left")
    return out.withColumn("enrich_applied", ~F.coalesce("same_", F.lit(False))).drop("same_")


def frame_lookup(frame_index: DataFrame, assignments: DataFrame) -> DataFrame:
    """frame_number, scene_id, seconds, camera_id, has_image: the last row of each frame number (by ord) in both tables."""
    frames = frame_index.groupBy("frame_number").agg(F.max_by(F.struct("scene_id", "seconds", "frame_path"), "ord").alias("f_"))
    cameras = assignments.groupBy("frame_number").agg(F.max_by("camera_id", "ord").alias("camera_id"))
    out = frames.join(cameras, "frame_number", "left")
    return out.select("frame_number", "f_.scene_id", "f_.seconds", "camera_id", (F.coalesce("f_.frame_path", F.lit("")) != "").alias("has_image"))


def row_details(lines: DataFrame, associations: DataFrame, lookup: DataFrame) -> DataFrame:
    """A row for each frame of each timeline row, with provenance and what is known of the frame.

    lines: camera_id, text_kind, text, mapped_complete_text, frame_ranges. A complete row's frames are found under
    its mapped text, so its words are those that equal it; of repeated words of a frame the last (by ord) holds.
    """
    key = ["camera_id", "text_kind", "text", "mapped_complete_text"]
    frames = lines.select(*key, F.explode(sampling.expanded_ranges(F.col("frame_ranges"))).alias("frame_number"))
    said = associations.where("text_kind is not null").select("camera_id", "text_kind", F.col("raw_text").alias("text"), "mapped_complete_text", F.col("frame_number").cast("long").alias("frame_number"), F.struct(F.coalesce("enrich_applied", F.lit(False)).alias("enrich_applied"), F.when(F.col("ocr_raw_text") != "", F.col("ocr_raw_text")).alias("ocr_raw_text"), F.col("raw_text").alias("associated_text")).alias("p_"), "ord")
    last = said.groupBy(*key, "frame_number").agg(F.max_by("p_", "ord").alias("p_"))
    frame = lookup.withColumn("frame_number", F.col("frame_number").cast("long")).withColumnRenamed("camera_id", "frame_camera")
    return frames.join(last, [*key, "frame_number"], "left").join(frame, "frame_number", "left").select(*key, "frame_number", "p_.*", "scene_id", "seconds", "frame_camera", "has_image")


def camera_scenes(assignments: DataFrame, scenes: DataFrame, frames: DataFrame, votes: DataFrame, truth: DataFrame) -> DataFrame:
    """scene_id, camera_id, cluster_id, times, vote share, unanimity, noise, truth and the begin, mid and end frame.

    votes: scene_id, label, n; a scene without votes has share 1. frames: the index, of which the camera role counts.
    """
    slots = runs.begin_mid_end(frames.where("sample_role = 'camera'"), ["scene_id"], ["frame_number"])
    slots = slots.groupBy("scene_id").agg(*[F.max(F.when(F.col("slot") == s, F.col("frame_number"))).alias(f"{s}_frame") for s in ("begin", "mid", "end")])
    counted = votes.join(assignments.select("scene_id", "camera_id"), "scene_id").groupBy("scene_id").agg(F.sum("n").alias("all_"), F.sum(F.when(F.col("label") == F.col("camera_id"), F.col("n")).otherwise(0)).alias("won_"), F.count_distinct("label").alias("labels_"))
    out = assignments.join(scenes.select("scene_id", "start_sec", "end_sec"), "scene_id", "left").join(slots, "scene_id", "left").join(counted, "scene_id", "left").join(truth.select("scene_id", F.col("camera_id").alias("gt_camera")), "scene_id", "left")
    share = F.when(F.col("all_") > 0, F.col("won_") / F.col("all_")).otherwise(1.0)
    return out.select("scene_id", "camera_id", "cluster_id", "start_sec", "end_sec", "begin_frame", "mid_frame", "end_frame", share.alias("winner_share"), (F.coalesce("labels_", F.lit(0)) <= 1).alias("unanimous"), (F.col("cluster_id") < 0).alias("pred_noise"), "gt_camera")


def propagated(frames: DataFrame, scenes: DataFrame, columns: list[str]) -> DataFrame:
    """frames with columns of their scene; raises where a scene is missing."""
    lost = frames.select("scene_id").distinct().join(scenes, "scene_id", "left_anti").first()
    if lost is not None:
        raise ValueError(f"no verdict for scene {lost['scene_id']}")
    return frames.join(scenes.select("scene_id", *columns), "scene_id")


def left_or_raise(rows: DataFrame, others: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """rows with the first of others by `order`; raises where a row has none."""
    w = Window.partitionBy(*on).orderBy(*order)
    firsts = others.withColumn("r_", F.row_number().over(w)).where("r_ = 1").drop("r_")
    lost = rows.join(firsts, on, "left_anti").select(*on).first()
    if lost is not None:
        raise ValueError(f"unmatched: {lost.asDict()}")
    return rows.join(firsts, on)


def by_path(results: DataFrame, index: DataFrame) -> DataFrame:
    """results (frame_path and more) with scene_id and frame_number of the index row of the same path, else of the
    first (by ord) whose path ends with the file name; rows that match none go."""
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    exact = index.groupBy("frame_path").agg(F.min_by(F.struct("scene_id", "frame_number"), "ord").alias("one_"))
    loose = index.groupBy(name(F.col("frame_path")).alias("name_")).agg(F.min_by(F.struct("scene_id", "frame_number"), "ord").alias("two_"))
    out = results.join(exact, "frame_path", "left").withColumn("name_", name(F.col("frame_path"))).join(loose, "name_", "left")
    out = out.withColumn("m_", F.coalesce("one_", "two_")).where("m_ is not null")
    return out.withColumn("scene_id", F.col("m_.scene_id")).withColumn("frame_number", F.col("m_.frame_number")).drop("m_", "one_", "two_", "name_")


def point_labels(points: DataFrame, merged: DataFrame, scenes: DataFrame) -> DataFrame:
    """points (scene_id, frame_number, cluster_id, camera_id) with frame_cluster, frame_camera of the merged frame labels
    and scene_camera of the scene's; where one is missing the earlier label stands."""
    m = merged.select(*FRAME, F.col("cluster_id").alias("c_"), F.col("camera_id").alias("k_"))
    s = scenes.select("scene_id", F.col("camera_id").alias("s_"))
    out = points.join(m, FRAME, "left").join(s, "scene_id", "left")
    return out.withColumn("frame_cluster", F.coalesce("c_", "cluster_id")).withColumn("frame_camera", F.coalesce("k_", "camera_id")).withColumn("scene_camera", F.coalesce("s_", "k_", "camera_id")).drop("c_", "k_", "s_")


def color_components(scenes: DataFrame, tolerance: float) -> DataFrame:
    """scene_id, component from 0 of eligible scenes (scene_id, color): linked by colours that go together.

    Colours are linked instead of scenes, so the graph has a node for each colour; components count by least scene.
    """
    colors = scenes.where("color <> ''").groupBy("color").agg(F.min("scene_id").alias("node"))
    a, b = colors.alias("a"), colors.select(F.col("color").alias("other_"), F.col("node").alias("v")).alias("b")
    edges = a.join(F.broadcast(b), labels_match(F.col("a.color"), F.col("b.other_"), tolerance)).select(F.col("a.node").alias("u"), "v")  # the palette's nine labels
    found = components(colors.select("node"), edges)
    numbered = found.join(found.select("component").distinct().withColumn("n_", F.dense_rank().over(Window.orderBy("component")) - 1), "component")
    return scenes.join(colors, "color").join(numbered.select("node", F.col("n_").alias("component")), "node").select("scene_id", "component")


def appearance_scenes(scenes: DataFrame, frames: DataFrame, cameras: DataFrame, tolerance: float) -> DataFrame:
    """scenes with normalised signature, camera_id, has_count_variance (a frame with another number) and component."""
    named = scenes.withColumn("appearance_signature", normalized_signature(F.col("appearance_signature")))
    other = frames.join(scenes.select("scene_id", F.col("person_count").alias("p_")), "scene_id").where("person_count <> p_").select("scene_id").distinct().withColumn("v_", F.lit(True))
    able = named.where("status = 'ok' and scene_type <> 'full_court' and appearance_signature <> ''").select("scene_id", F.col("appearance_signature").alias("color"))
    out = named.join(cameras.select("scene_id", "camera_id"), "scene_id", "left").join(other, "scene_id", "left").join(color_components(able, tolerance), "scene_id", "left")
    return out.withColumn("has_count_variance", F.coalesce("v_", F.lit(False))).drop("v_")


def cluster_conflicts(members: DataFrame, scenes: DataFrame, tolerance: float) -> DataFrame:
    """one, two (one < two): clusters with a pair of eligible scenes (scene_id, color) whose colours don't go together.

    members: cluster_id, scene_id. Clusters meet by their distinct colours, not by pairs of scenes.
    """
    held = members.where("cluster_id >= 0").join(scenes.where("color <> ''"), "scene_id").select("cluster_id", "color").distinct()
    kinds = held.select("color").distinct()
    clash = kinds.join(F.broadcast(kinds.select(F.col("color").alias("other_"))), ~labels_match(F.col("color"), F.col("other_"), tolerance))  # the palette's nine labels
    one, two = held.select(F.col("cluster_id").alias("one"), "color"), held.select(F.col("cluster_id").alias("two"), F.col("color").alias("other_"))
    return one.join(clash, "color").join(two, "other_").where("one < two").select("one", "two").distinct()
