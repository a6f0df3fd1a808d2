"""Competing boxes, tracks across empty frames, provenance, payloads, reconciliation, the ensemble and artifacts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelight.functions import colors as K
from framelight.functions import text as X
from framelight.operators import appearance, boxes, detail, ensemble, picks, runs, timeline
from framelight.sources import artifacts

DETS = "scene_id int, frame_number int, det int, text string, confidence double, bbox array<int>"


def test_regions_choose_their_boxes(spark):
    """The first region takes the box that suits it best, though the second would suit that box better."""
    rows = [(0, 1, 0, "A", 1.0, [0, 0, 100, 10]), (0, 1, 1, "B", 1.0, [40, 0, 140, 10]), (0, 2, 0, "C", 1.0, [30, 0, 130, 10])]
    got = {(r.frame_number, r.region_id): (r.source, r.bbox[0]) for r in boxes.enriched(spark.createDataFrame(rows, DETS), ["scene_id"]).collect()}
    assert got == {(1, 0): ("ocr", 0), (1, 1): ("ocr", 40), (2, 0): ("ocr", 30), (2, 1): ("carried", 40)}
    rows += [(0, 3, None, None, None, None)]
    assert sum(r.frame_number == 3 for r in boxes.enriched(spark.createDataFrame(rows, DETS), ["scene_id"]).collect()) == 2


def test_tracks_end_at_an_empty_frame(spark):
    box = [10, 10, 60, 60]
    schema = "k int, frame_number int, det int, bbox array<int>"
    rows = spark.createDataFrame([(0, 1, 0, box), (0, 2, None, None), (0, 3, 0, box), (0, 4, 0, box), (0, 4, 1, box)], schema)
    # Of equal overlaps the later box goes on.
    assert {(r.frame_number, r.det): r.track_id for r in boxes.linked_tracks(rows, ["k"]).collect()} == {(1, 0): 0, (3, 0): 1, (4, 1): 1, (4, 0): 2}


def test_coherence_leaves_noise_out(spark):
    rows = spark.createDataFrame([(i, y) for i, y in enumerate([0, -1, 0, 1, -1, -1, -1, 2])], "i int, y int")
    got = [r.agrees for r in runs.coherence(rows, [], ["i"], "y", 2, [-1]).orderBy("i").collect()]
    assert got == [True, None, True, False, None, None, None, None]


def payload(spark, dets, rows):
    d = spark.createDataFrame([(0, 1, i, t) for i, t in enumerate(dets)], "scene_id int, frame_number int, det long, text string")
    a = spark.createDataFrame([(0, 1, *r) for r in rows], "scene_id int, frame_number int, raw_text string, ocr_raw_text string, mapped_complete_text string, text_kind string, mapping_confidence double, enrich_applied boolean, bbox array<int>")
    return timeline.frame_payload(d, a).orderBy("added", "det", "text").collect()


def test_frame_payload(spark):
    rows = [("CHASE", "SCASE", "CHASE", "complete", 1.0, True, [1, 2, 3, 4]), ("PLAYER", None, "PLAYER", "complete", 1.0, False, None), ("player", None, "P", "partial", 0.5, True, [1, 1, 2, 2]), ("NEW", "X", "NEW", "complete", 1.0, True, [5, 5, 6, 6]), ("new", "Y", "NEW", "complete", 1.0, True, [7, 7, 8, 8])]
    got = payload(spark, ["scase", "Player", "Player", "none", " "], rows)
    assert [(r.text, r.mapped_complete_text, r.added) for r in got] == [("scase", "CHASE", False), ("Player", "PLAYER", False), ("Player", "PLAYER", False), ("none", None, False), ("NEW", "NEW", True)]
    # An OCR text counts only where enrichment applied; a second record of the shown mapped text is added.
    got = payload(spark, ["scase"], [("CHASE", "SCASE", "CHASE", "complete", 1.0, False, None), ("CHASER", "Z", "CHASE", "partial", 0.9, True, [1, 2, 3, 4])])
    assert [(r.text, r.mapped_complete_text, r.added) for r in got] == [("scase", None, False), ("CHASER", "CHASE", True)]


def test_provenance(spark):
    words = spark.createDataFrame([(0, 1, "CHASE"), (0, 1, "Player"), (0, 1, "QQQ"), (0, 2, "X")], "scene_id int, frame_number int, raw_text string")
    raw = spark.createDataFrame([(0, 1, "SCASE", 0), (0, 1, "CHSE", 1), (0, 1, "PLAYER ", 2), (0, 1, " ", 3)], "scene_id int, frame_number int, word string, ord int")
    got = {r.raw_text: (r.enrich_applied, r.ocr_raw_text) for r in detail.with_provenance(words, raw).collect()}
    assert got == {"CHASE": (True, "SCASE"), "Player": (False, None), "QQQ": (True, None), "X": (True, None)}
    dets = spark.createDataFrame([(0, 1, 1, "chase", "good", [1]), (0, 1, 2, "CHASE", "partial", [2])], "scene_id int, frame_number int, det int, text string, readability_label string, bbox array<int>")
    got = {r.raw_text: (r.readability_label, r.bbox) for r in detail.with_detection(words, dets).collect()}
    assert got["CHASE"] == ("good", [1]) and got["QQQ"] == ("partial", None)


def test_reconciled_by_scene(spark):
    rows = [("v", i, "cam_0", c, b) for i, (c, b) in enumerate([("blue", 0), ("blue", 0), ("red", 4), ("red", None), ("green", -1), ("green", None), ("black", 7), (None, 9)])]
    scenes = spark.createDataFrame(rows, "video_id string, scene_id int, camera_id string, color string, before int")
    got = [r.camera_id for r in appearance.reconciled(scenes, 2).orderBy("scene_id").collect()]
    assert got == ["cam_0", "cam_0", "cam_4", "cam_0", "cam_1", "cam_1", "cam_0", "cam_0"]
    close = spark.createDataFrame([("v", i, "cam_0", c, None) for i, c in enumerate(["white", "neutral", "white", "black"])], scenes.schema)
    assert [r.camera_id for r in appearance.reconciled(close, 1, 26.0).orderBy("scene_id").collect()] == ["cam_0"] * 3 + ["cam_1"]


def test_texts_and_colors(spark):
    one = spark.range(1)
    said = lambda x: one.select(X.model_tokens(F.lit(x)).alias("x")).first().x
    assert said('{"tokens": ["A ", "", "B-2"]}') == ["A", "B-2"] and said('Sure: {"words": ["C"]} ok') == ["C"] and said("plain SET 15-30!") == ["plain", "SET", "15-30"] and said(None) == said("  ") == [] and said("{broken SET") == ["broken", "SET"] and said('{"a": 1}') == []
    assert one.select(X.padded_words(F.array(F.lit("A")), F.lit(0), F.lit(True)).alias("x")).first().x == ["A", "UNK"]
    got = one.select(K.nearest_label(F.array(F.lit(50.0), F.lit(70.0), F.lit(60.0))).alias("a"), K.appearance_vector(F.lit(9), F.array(F.lit("red"), F.lit("black"), F.lit("odd"))).alias("b"), K.blended(F.array(F.lit(3.0), F.lit(4.0)), F.lit(None).cast("array<double>"), 0.4, 2).alias("c"), K.blended(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(0.0), F.lit(2.0)), 0.4, 2).alias("d"), K.primary_color(F.array(*[F.array(F.lit(x), F.lit(0.0), F.lit(0.0)) for x in (10.0, 90.0, 12.0, 16.0)])).alias("e")).first()
    assert got.a == "red" and got.b == [0] * 6 + [1] + [0.5] + [0] * 6 + [0.5, 0] and got.e == "black"
    assert got.c == pytest.approx([0.6, 0.8, 0, 0]) and got.d == pytest.approx([0.36, 0.48, 0, 0.4])


def test_ensemble_kernels(spark):
    r = np.random.default_rng(0)
    x = np.vstack([r.normal(0, 0.05, (30, 6)), r.normal(3, 0.05, (30, 6))])
    assert 0 < ensemble.elbow_eps(x) < 1 and ensemble.elbow_eps(x[:1]) == 0.5
    low = ensemble.reduced(x, 2)
    assert low.shape == (60, 2) and np.allclose(low.mean(0), 0) and abs(low[:, 0] @ low[:, 1]) < 1e-8 and ensemble.reduced(x, 9) is x
    labels = spark.createDataFrame([(i, m, (i // 5 if m == "a" else i % 2) if i % 5 < 4 else -1) for i in range(10) for m in "ab"], "ord long, member string, label int")
    truth = spark.createDataFrame([(i, f"t{i // 5}") for i in range(10)], "ord long, truth string")
    scores = {r.member: (round(r.accuracy, 6), round(r.noise_rate, 6)) for r in ensemble.member_scores(labels, truth).collect()}
    assert scores["a"] == (0.8, 0.2) and scores["b"][1] == 0.2 and scores["b"][0] < 0.8
    weights, link, noise, best = ensemble.tuned(spark.range(10).toDF("ord"), labels, truth, [0.55, 0.9], [0.5, 1.1])
    assert sum(weights.values()) == pytest.approx(1) and weights["a"] > weights["b"] and link == 0.55 and best > 0.7


def test_picks(spark):
    rows = spark.createDataFrame([(1, 5, "camera", "p5"), (1, 6, "ocr", "p6"), (1, 7, "ocr", "p7"), (2, 1, "ocr", "q1"), (2, 2, "ocr", "q2"), (3, 1, "middle", "r1")], "scene_id int, frame_number int, sample_role string, image_path string")
    mid = lambda mode: sorted((r.scene_id, r.frame_number) for r in picks.middle_samples(rows, mode, ["frame_number"]).collect())
    assert mid("middle") == [(1, 6), (2, 2), (3, 1)] and mid("camera") == [(1, 5)] and len(mid("all")) == 6
    with pytest.raises(ValueError, match="scene 3"):
        detail.propagated(rows, spark.createDataFrame([(1, "x"), (2, "y")], "scene_id int, verdict string"), ["verdict"])
    with pytest.raises(ValueError, match="unmatched"):
        detail.left_or_raise(rows, rows.where("scene_id < 3").select("scene_id", F.lit(1).alias("v")), ["scene_id"], ["v"])
    split = picks.seeded_split(spark.range(40).toDF("k"), "k", 0.25, 3)
    assert split.where("tuning").count() == 10 and split.exceptAll(picks.seeded_split(spark.range(40).toDF("k"), "k", 0.25, 3)).count() == 0


def test_artifacts(spark, tmp_path):
    (tmp_path / "v.npz").write_bytes(artifacts.npz_bytes(np.eye(3), np.array([0, 1, -1]), ["a", "b", "c"]))
    got = artifacts.npz_scan(spark, str(tmp_path / "v.npz")).orderBy("ord").collect()
    assert [(r.ord, r.label, r.sample_path, r.vec) for r in got][2] == (2, -1, "c", [0.0, 0.0, 1.0])
    (tmp_path / "camera_clustering_hsv_gt.json").write_text('{"accuracy": 0.5}')
    (tmp_path / "camera_clustering_bad_gt.json").write_text("{oops")
    assert [r.method for r in artifacts.metric_files(spark, str(tmp_path / "camera_clustering_*_gt.json")).collect()] == ["hsv"]
    paths = spark.createDataFrame([("/home/x/out/frames/a.jpg",), ("C:\\out\\frames\\b.jpg",), ("/x/frames/../../etc",), ("/x/y.jpg",)], "p string")
    assert [r.x for r in paths.select(artifacts.relocated(F.col("p"), "/run/").alias("x")).collect()] == ["/run/frames/a.jpg", "/run/frames/b.jpg", None, None]
    assert artifacts.guarded("a/../b", "/run") == "/run/b"
    with pytest.raises(ValueError, match="leaves"):
        artifacts.guarded("../etc", "/run")
    n, changed = artifacts.fingerprint(spark, str(tmp_path))
    assert n == 3 and changed > 0 and artifacts.fingerprint(spark, str(tmp_path / "no")) == (0, 0)
    for name, content in (("Closeup/scene_3_frame_9.jpg", b"\xff\xd8\xff\xe0"), ("court/scene_4_frame_1.jpg", b"no")):
        (tmp_path / "pics" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "pics" / name).write_bytes(content)
    top = str(tmp_path / "pics")
    assert {(r.label, r.scene_id) for r in artifacts.labelled_images(spark, top, {"court": "full_court"}).collect()} == {("closeup", 3), ("full_court", 4)}
    assert {(r.scene_id, r.kind) for r in artifacts.checked_images(spark, top).collect()} == {(3, "jpeg"), (4, None)}
    assert {(r.scene_id, r.frame_number) for r in artifacts.scene_samples(spark, None, top).collect()} == {(3, 9), (4, 1)}
    probe = "path string, fps double, frame_count long, width int, height int"
    r = artifacts.reconciled_probe(spark.createDataFrame([("v", 25.0, 100, 10, 20)], probe), spark.createDataFrame([("v", 30.0, 90, 10, 0)], probe)).first()
    assert (r.fps, r.frame_count, r.height, r.fps_differs) == (30.0, 100, 20, True)
    assert artifacts.preflight(("meta", "cameras")) == {}
