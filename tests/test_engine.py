"""The engine's operators on small literal tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelight.functions import geometry as G
from framelight.functions import text as X
from framelight.operators import appearance, boxes, catalog, evaluate, graph, runs, sampling, timeline, votes
from framelight.plans.stages import STAGES, stage_range

WORDS = "camera_id string, scene_id int, frame_number int, raw_text string, ord long, readability_label string, enrich_applied boolean"
TEXTS = "complete_text string, approved string, ord long"


def associate(spark, words, texts):
    rows = [("cam_0", 0, f, w, i, "good", False) for i, (f, w) in enumerate(words)]
    return timeline.associated(spark.createDataFrame(rows, WORDS), spark.createDataFrame([(t, a, i) for i, (t, a) in enumerate(texts)], TEXTS))


def test_association(spark):
    got = {r.raw_text: r for r in associate(spark, [(1, "SCAVE"), (1, "CHAMO"), (1, "CHASEO"), (1, "chase"), (1, "UNK"), (1, None), (1, "SI")], [("CHASE", "true")]).collect()}
    assert (got["CHAMO"].mapped_complete_text, round(got["CHAMO"].mapping_confidence, 6)) == ("CHASE", 0.6)
    assert got["CHASEO"].mapping_confidence == 1.0 and got["CHASEO"].text_kind == "partial"
    assert got["chase"].text_kind == "complete"
    assert (got["SCAVE"].reason, got["UNK"].reason, got[None].reason, got["SI"].reason) == ("no_match", "unk_or_empty", "unk_or_empty", "no_match")
    assert associate(spark, [(1, "PLAYER")], [("PLAYER", "false")]).first().reason == "unapproved"
    assert [r.mapped_complete_text for r in associate(spark, [(1, "CHAMPIONSHIP"), (1, "SCAVESPEED")], [("CHASE", "yes")]).collect()] == [None, None]


def test_timeline_pays_each_frame_once(spark):
    rows = associate(spark, [(0, "CHASE"), (0, "CHASEO"), (30, "CHASEO")], [("CHASE", "1")])
    slots = runs.slot_durations(spark.createDataFrame([(0, 0), (0, 30)], "scene_id int, frame_number int"), ["scene_id"], "frame_number", F.lit(60), F.lit(30.0))
    got = {r.text_kind: (r.total_duration_sec, r.n_frames_present, r.frame_ranges) for r in timeline.timeline(rows, slots).collect()}
    assert got == {"complete": (1.0, 1, "0"), "partial": (1.0, 2, "0;30")}
    assert timeline.timeline(rows.limit(0), slots).count() == 0


def test_frames(spark):
    one = spark.range(1)
    got = one.select(sampling.even_frames(F.lit(0), F.lit(10), 5).alias("a"), sampling.rate_frames(F.lit(0), F.lit(120), F.lit(60.0), 2.0).alias("b"), sampling.rate_frames(F.lit(0), F.lit(9), F.lit(60.0), 0).alias("c"), sampling.even_frames(F.lit(3), F.lit(3), 5).alias("d"), sampling.expanded_ranges(F.lit("12-10;20;x")).alias("e")).first()
    assert (got.a, got.b, got.c, got.d, got.e) == ([0, 2, 4, 7, 9], [0, 30, 60, 90], [], [3], [10, 11, 12, 20])
    rows = spark.createDataFrame([(1, f) for f in (10, 11, 12, 20, 11)], "k int, f int")
    assert sampling.frame_ranges(rows, ["k"], "f").first().frame_ranges == "10-12;20"


def test_votes(spark):
    rows = [(0, "cam_1", 1), (0, "cam_1", 2), (1, "cam_2", 1), (1, "cam_1", 2), (2, "cam_3", 1), (2, "cam_1", 2), (2, "cam_3", 3)]
    got = {r.s: (r.winner, r.method) for r in votes.scene_votes(spark.createDataFrame([("v", *r) for r in rows], "v string, s int, l string, f int"), "v", "s", "l", "f").select("s.s", "winner", "method").collect()}
    assert got == {0: ("cam_1", "unanimous"), 1: ("cam_1", "previous"), 2: ("cam_3", "majority")}
    first = votes.first_seen_majority(spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "k int, l string, o int"), ["k"], "l", [F.col("o")]).first()
    assert (first.winner, first.votes, first.total) == ("b", 1, 2)


def test_fill_and_text(spark):
    rows = spark.createDataFrame([(1, "cam_0"), (2, None), (3, "cam_0")], "i int, l string")
    assert [r.filled for r in runs.temporal_fill(rows, [], ["i"], "l", ["unknown"], 1).orderBy("i").collect()] == ["cam_0"] * 3
    got = spark.range(1).select(X.split_country(F.lit("SINNERITA"), ["ITA"]).alias("a"), X.common_block(F.lit("chamo"), F.lit("chase")).alias("b"), X.display_text(F.lit("CHASEO"), F.lit("CHASE")).alias("c"), X.normalized_signature(F.lit("2:Red,black")).alias("d"), X.path_ids(F.lit("x/scene_3_frame_44.jpg")).alias("e"), X.tokenize(F.lit("SET 2, 15-30")).alias("f")).first()
    assert (got.a, tuple(got.b), got.c, got.d, tuple(got.e), got.f) == (["SINNER", "ITA"], (3, 0), "CHASEO → CHASE", "red", (3, 44), ["SET", "2", "15-30"])


def test_catalog(spark):
    old = spark.createDataFrame([("PLAYER", True, 0, 0, 1, "keep")], "complete_text string, approved boolean, first_seen_scene_id int, first_seen_frame int, discovery_count long, notes string")
    tokens = spark.createDataFrame([("player", 0, 1, 1), ("SET", 0, 2, 2), ("UNK", 0, 2, 3), ("--", 0, 2, 4)], "token string, scene int, frame int, i int")
    got = {r.complete_text: r for r in catalog.upserted(old, catalog.discovered(tokens, ["i"], "scene", "frame")).collect()}
    assert set(got) == {"PLAYER", "SET"} and got["SET"].is_new and got["PLAYER"].notes == "keep" and got["PLAYER"].discovery_count == 2


def test_graph(spark):
    labels = spark.createDataFrame([(i, m, y) for m, ys in (("a", [0, 0, 1, 1]), ("b", [0, 0, 1, 1]), ("c", [0, 1, 1, 1])) for i, y in enumerate(ys)], "ord long, member string, label int")
    equal = spark.createDataFrame([(m, 1.0) for m in "abc"], "member string, weight double")
    pairs = graph.coassociation(labels, equal)
    found = graph.consensus(spark.range(4).toDF("ord"), pairs, 2 / 3)
    assert [r.cluster for r in found.orderBy("ord").collect()] == [0, 0, 1, 1]
    assert graph.merged_groups([(1, 2, 0.99), (1, 3, 0.0), (2, 3, 0.1)], 0.85) == {1: 1, 2: 1, 3: 3}
    x = np.random.default_rng(0).normal(0, 0.05, (12, 8)) + np.repeat([[0.0], [5.0]], 6, 0)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(12, [99.0] * 8)], "ord long, vec array<double>")
    assert [r.label for r in graph.density_clusters(vectors, 0.8, 2, block=5).orderBy("ord").collect()] == [0] * 6 + [1] * 6 + [-1]


def test_boxes(spark):
    rows = spark.createDataFrame([(0, 10, 0, "PLAYER", 1.0, [100, 100, 200, 140]), (0, 20, None, None, None, None)], "scene_id int, frame_number int, det int, text string, confidence double, bbox array<int>")
    assert [r.frame_number for r in boxes.enriched(rows, ["scene_id"]).orderBy("frame_number").collect()] == [10, 20]
    two = spark.createDataFrame([(0, 10, 0, "A", 1.0, [0, 0, 100, 40]), (0, 20, 0, "B", 1.0, [500, 500, 600, 540])], rows.schema)
    assert [(r.frame_number, r.text, r.source) for r in boxes.enriched(two, ["scene_id"]).orderBy("frame_number", "region_id").collect()] == [(10, "A", "ocr"), (20, "A", "carried"), (20, "B", "ocr")]
    link = spark.createDataFrame([(0, 1, 0, [20, 20, 80, 120]), (0, 2, 0, [22, 22, 82, 122])], "k int, frame_number int, det int, bbox array<int>")
    assert {r.track_id for r in boxes.linked_tracks(link, ["k"]).collect()} == {0}
    assert spark.range(1).select(G.iou(F.array(F.lit(0), F.lit(0), F.lit(2), F.lit(2)), F.array(F.lit(1), F.lit(0), F.lit(3), F.lit(2))).alias("x")).first().x == pytest.approx(1 / 3)


def test_evaluation_and_stages(spark):
    rows = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b"), (1, "b"), (-1, "b"), (-1, "a")], "c int, t string")
    assert evaluate.mapped_labels(rows, "c", "t") == {-1: "unknown", 0: "a", 1: "b"}
    rng = np.random.default_rng(1)
    for _ in range(20):
        import itertools

        cost = rng.integers(0, 9, (4, 5))
        best = min(sum(cost[i, p[i]] for i in range(4)) for p in itertools.permutations(range(5), 4))
        assert sum(cost[i, j] for i, j in evaluate.assignment(cost)) == best
    assert stage_range() == STAGES and stage_range("cameras", "enrich") == ("cameras", "ocr", "reference", "enrich")
    with pytest.raises(ValueError, match="after to_step"):
        stage_range("aggregate", "meta")
    scenes = spark.createDataFrame([("v", 0, "cam_0", "blue", 0), ("v", 1, "cam_0", "blue", 0), ("v", 2, "cam_0", "red", 1)], "video_id string, scene_id int, camera_id string, color string, before int")
    assert [r.camera_id for r in appearance.reconciled(scenes, 1).orderBy("scene_id").collect()] == ["cam_0", "cam_0", "cam_1"]
    assert [r.camera_id for r in appearance.reconciled(scenes, 2).orderBy("scene_id").collect()] == ["cam_0"] * 3
