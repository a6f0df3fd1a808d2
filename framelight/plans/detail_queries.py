"""Queries of picks, details, the ensemble and what has no query elsewhere; the tables stand in as in queries.py.

An order is a scene, its lines are frames or boxes; the embeddings are camera samples, their labels the true cameras.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions import colors as K
from framelight.functions import geometry as G
from framelight.functions import text as X
from framelight.operators import appearance, boxes, catalog, detail, ensemble, picks, timeline
from framelight.plans.queries import _BOXES, _LABELINGS, _boxes, _catalog, _labelings, _weights, query, six

_DAY = "date_diff('day', DATE '1992-01-01', {0}::DATE)"


def _frames(read) -> DataFrame:
    """Lines as frames of scenes: the ship mode's first letter tells the role."""
    return read("lineitem").select(F.col("l_orderkey").alias("scene_id"), F.col("l_linenumber").alias("frame_number"), F.when(F.col("l_returnflag") == "A", "camera").otherwise("ocr").alias("sample_role"), F.col("l_partkey").alias("p"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("price"), F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("flag"))


# --- picks -----------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey AS scene_id, l_linenumber AS frame_number, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS image_idx FROM lineitem WHERE l_returnflag = 'A'")
def camera_ordinals(spark, read):
    frames = picks.ordinal_in_scene(picks.of_role(_frames(read), "camera"), ["scene_id"], ["frame_number"])
    return frames.select("scene_id", "frame_number", F.col("image_idx").cast("bigint").alias("image_idx"))


@query("SELECT l_orderkey AS scene_id, count(*)::BIGINT AS n FROM lineitem WHERE l_quantity >= 25 GROUP BY 1")
def confident_detections(spark, read):
    d = _frames(read).groupBy("scene_id").agg(F.collect_list(F.struct(F.col("q").alias("confidence"), "frame_number")).alias("d"))
    return d.select("scene_id", F.size(picks.confident(F.col("d"), 25.0)).cast("bigint").alias("n")).where("n > 0")


@query("""WITH c AS (SELECT l_orderkey, (l_partkey % 5) AS t, l_extendedprice AS v, l_linenumber AS n FROM lineitem)
SELECT l_orderkey AS scene_id, 'T' || t AS text, n AS frame_number FROM c QUALIFY row_number() OVER (PARTITION BY l_orderkey, t ORDER BY v DESC, n) = 1""")
def best_per_text(spark, read):
    d = _frames(read).withColumn("text", F.concat(F.lit("T"), (F.col("p") % 5).cast("string"))).withColumn("confidence", F.col("price"))
    return picks.best_per_text(d, ["scene_id"], "frame_number").select("scene_id", "text", "frame_number")


@query("""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, count(*)::BIGINT AS n, round(count(*) / sum(value), 6) AS fps, round(median(value), 6) AS p50, max(value) FILTER (r = round_even(0.95 * (n - 1), 0)::BIGINT) AS p95 FROM r GROUP BY user_id""")
def latency_stats(spark, read):
    out = picks.latency(read("events"), "value", ["user_id"])
    return out.select("user_id", "n", six("fps").alias("fps"), six("p50").alias("p50"), "p95")


@query("SELECT count(*)::BIGINT AS n, round(avg((l_linestatus = 'F')::INT), 6) AS success_rate, round(avg(l_extendedprice) FILTER (l_quantity < 50), 6) AS mean_error, round(median(l_extendedprice) FILTER (l_quantity < 50), 6) AS median_error FROM lineitem")
def homography_summary(spark, read):
    rows = read("lineitem").select((F.col("l_linestatus") == "F").alias("ok"), F.when(F.col("l_quantity") < 50, F.col("l_extendedprice").cast("double")).otherwise(F.lit(float("inf"))).alias("error"))
    out = picks.error_summary(rows, "error", "ok")
    return out.select("n", *[six(c).alias(c) for c in ("success_rate", "mean_error", "median_error")])


@query("SELECT c_custkey, c_mktsegment AS camera_id FROM customer WHERE contains(lower(c_mktsegment), 'build')")
def camera_search(spark, read):
    return picks.camera_search(read("customer").select("c_custkey", F.col("c_mktsegment").alias("camera_id")), " Build ")


@query("SELECT o_orderkey AS scene_id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0")
def scene_filter(spark, read):
    scenes = read("orders").select(F.col("o_orderkey").alias("scene_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("scene_type"), (F.col("o_custkey") % 2 == 0).alias("count_variance"))
    return picks.scene_filter(scenes, status="O", scene_type="1-URGENT", variance_only=True).select("scene_id", "status")


@query("SELECT o_orderkey, o_orderpriority AS scene_type FROM orders WHERE o_orderpriority <> '5-LOW'")
def truth_filter(spark, read):
    return picks.truth_rows(read("orders").select("o_orderkey", F.col("o_orderpriority").alias("scene_type")), drop="5-LOW")


@query("""WITH r AS (SELECT l_orderkey AS scene_id, l_linenumber AS n, l_returnflag = 'A' AS mid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem)
SELECT scene_id, n AS frame_number FROM r QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY CASE WHEN mid THEN 0 WHEN r = 2 THEN 1 ELSE 1 + r END, r) = 1""")
def middle_samples(spark, read):
    samples = _frames(read).withColumn("sample_role", F.when(F.col("sample_role") == "camera", "middle").otherwise("ocr"))
    return picks.middle_samples(samples, "middle", ["frame_number"]).select("scene_id", "frame_number")


@query("""SELECT l_orderkey, l_linenumber, (l_partkey % 3 = 0 OR l_suppkey % 3 = 0 OR l_partkey % 3 = l_suppkey % 3) AND ((l_suppkey % 3 <> 0 AND l_partkey % 4 = l_suppkey % 3) OR l_partkey % 4 = 1 OR l_partkey % 4 = l_suppkey % 2) AS hit FROM lineitem""")
def row_detections(spark, read):
    named = lambda c: F.concat(F.lit("w"), c.cast("string"))
    or_blank = lambda c: F.when(c == 0, "").otherwise(F.upper(named(c)))
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    hit = picks.belongs_to_row(named(p % 4), or_blank(p % 3), F.lit("W1"), named(s % 2), or_blank(s % 3))
    return read("lineitem").select("l_orderkey", "l_linenumber", hit.alias("hit"))


@query("""SELECT count(*)::BIGINT AS n, count(DISTINCT CASE WHEN label <> 4 THEN label END)::BIGINT AS n_clusters, count(*) FILTER (label = 4)::BIGINT AS n_noise, round(avg((label = 4)::INT), 6) AS noise_rate, round(avg((label IN (1, 2))::INT), 6) AS unknown_rate FROM embeddings""")
def noise_rates(spark, read):
    rows = read("embeddings").select(F.when(F.col("label") == 4, -1).otherwise(F.col("label")).alias("c"), F.when(F.col("label") == 1, "unknown").when(F.col("label") != 2, "cam").alias("k"))
    out = picks.noise_rates(rows, "c", "k")
    return out.select("n", "n_clusters", "n_noise", six("noise_rate").alias("noise_rate"), six("unknown_rate").alias("unknown_rate"))


@query("""WITH a AS (SELECT event_type AS name, avg(value) AS v FROM events GROUP BY 1), b AS (SELECT event_type AS name, median(value) AS v FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT name, round(b.v, 6) AS before, round(a.v, 6) AS now, round(a.v - b.v, 6) AS delta FROM a FULL JOIN b USING (name)""")
def metric_delta(spark, read):
    e = read("events")
    by = lambda rows, value: rows.groupBy(F.col("event_type").alias("name")).agg(value.alias("v"))
    out = picks.metric_delta(by(e, F.avg("value")), by(e.where("event_type <> 'error'"), F.median("value")), "name", "v")
    return out.select("name", *[six(c).alias(c) for c in ("before", "now", "delta")])


@query("SELECT event_type AS method, CASE WHEN event_type <> 'error' THEN count(*) END::BIGINT AS n FROM events GROUP BY event_type ORDER BY n DESC NULLS LAST, method")
def leaderboard(spark, read):
    n = read("events").groupBy(F.col("event_type").alias("method")).agg(F.count("*").alias("n"))
    return picks.leaderboard(n.withColumn("n", F.when(F.col("method") != "error", F.col("n"))), "n", "method")


@query("SELECT count(*)::BIGINT AS n, count(*)::BIGINT // 4 AS tuning FROM orders")
def seeded_split(spark, read):
    out = picks.seeded_split(read("orders").select("o_orderkey"), "o_orderkey", 0.25, 7)
    return out.agg(F.count("*").alias("n"), F.count_if("tuning").alias("tuning"))


@query(f"""WITH {_BOXES}, m AS (SELECT a.k, a.n AS box_id, b.n AS det, (greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)) AS i, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS s, b.x1 - b.x0 AS c FROM b a JOIN b ON a.k = b.k),
p AS (SELECT k, box_id, det FROM m WHERE i / (s - i)::DOUBLE >= 0.5 QUALIFY row_number() OVER (PARTITION BY k, box_id ORDER BY c DESC, i / (s - i)::DOUBLE DESC, det) = 1)
SELECT k, box_id, det FROM (SELECT k, n AS box_id FROM b) LEFT JOIN p USING (k, box_id)""")
def matched_detection(spark, read):
    b = _boxes(read)
    d = b.select("k", F.col("n").alias("det"), "bbox", F.lit("t").alias("text"), (F.col("bbox")[2] - F.col("bbox")[0]).alias("confidence"))
    return picks.matched_detection(b.select("k", F.col("n").alias("box_id"), "bbox"), d, ["k"]).select("k", "box_id", "det")


# --- details ---------------------------------------------------------------------------------------------------------


def _said(read) -> tuple[DataFrame, DataFrame]:
    """Words of turns, and the words read before: those at odd places, cut by a letter."""
    words = read("conversations").select(F.col("conv_id").alias("scene_id"), F.col("turn").alias("frame_number"), F.posexplode(X.tokenize(F.col("text"))).alias("ord", "raw_text"))
    raw = words.where("ord % 2 = 1").select("scene_id", "frame_number", F.when(F.col("ord") % 4 == 1, F.col("raw_text")).otherwise(F.expr("substr(raw_text, 2)")).alias("word"), "ord")
    return words, raw


_SAID = """w AS (SELECT conv_id AS scene_id, turn AS frame_number, i - 1 AS ord, w[i] AS raw_text FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(text, '[A-Za-z]+|\\d+(?:-\\d+)+|\\d+') AS w FROM conversations))),
raw AS (SELECT scene_id, frame_number, ord, trim(CASE WHEN ord % 4 = 1 THEN raw_text ELSE substr(raw_text, 2) END) AS word FROM w WHERE ord % 2 = 1)"""


@query(f"WITH {_SAID} SELECT w.scene_id, w.frame_number, w.ord::INTEGER AS ord, NOT EXISTS (SELECT 1 FROM raw r WHERE r.scene_id = w.scene_id AND r.frame_number = w.frame_number AND r.word <> '' AND lower(r.word) = lower(w.raw_text)) AS enrich_applied FROM w")
def word_provenance(spark, read):
    return detail.with_provenance(*_said(read)).select("scene_id", "frame_number", "ord", "enrich_applied")


@query(f"""WITH {_SAID}, d AS (SELECT scene_id, frame_number, lower(raw_text) AS k, arg_min(ord, ord) AS o FROM w WHERE ord % 3 = 0 GROUP BY ALL)
SELECT w.scene_id, w.frame_number, w.ord::INTEGER AS ord, CASE WHEN o IS NULL OR o % 2 = 1 THEN 'partial' ELSE 'good' END AS readability_label, o::INTEGER AS place FROM w LEFT JOIN d ON d.scene_id = w.scene_id AND d.frame_number = w.frame_number AND d.k = lower(w.raw_text)""")
def word_detection(spark, read):
    words, _ = _said(read)
    d = words.where("ord % 3 = 0").select("scene_id", "frame_number", F.col("ord").alias("det"), F.col("raw_text").alias("text"), F.when(F.col("ord") % 2 == 1, "partial").otherwise("good").alias("readability_label"), F.array("ord").alias("bbox"))
    out = detail.with_detection(words, d)
    return out.select("scene_id", "frame_number", "ord", "readability_label", F.col("bbox")[0].alias("place"))


@query("""WITH f AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem),
a AS (SELECT k, n, p % 2 = 0 AS e, 'r' || (p % 7) AS o FROM (SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)),
x AS (SELECT l_linenumber::BIGINT AS n, max(l_orderkey) AS scene_id FROM lineitem GROUP BY 1)
SELECT f.k AS camera, f.n::BIGINT AS frame_number, a.e AS enrich_applied, a.o AS ocr_raw_text, x.scene_id FROM f LEFT JOIN a ON a.k = f.k AND a.n = f.n LEFT JOIN x ON x.n = f.n""")
def row_details(spark, read):
    from framelight.operators import sampling

    f = _frames(read)
    lines = sampling.frame_ranges(f, ["scene_id"], "frame_number").select(F.col("scene_id").cast("string").alias("camera_id"), F.lit("complete").alias("text_kind"), F.lit("A").alias("text"), F.lit("A").alias("mapped_complete_text"), "frame_ranges")
    said = f.where("flag = 'R'").select(F.col("scene_id").cast("string").alias("camera_id"), F.lit("complete").alias("text_kind"), F.lit("A").alias("raw_text"), F.lit("A").alias("mapped_complete_text"), "frame_number", (F.col("p") % 2 == 0).alias("enrich_applied"), F.concat(F.lit("r"), (F.col("p") % 7).cast("string")).alias("ocr_raw_text"), F.col("p").alias("ord"))
    index = f.select("scene_id", "frame_number", F.lit(0.0).alias("seconds"), F.lit("x").alias("frame_path"), F.col("scene_id").alias("ord"))
    lookup = detail.frame_lookup(index, index.select("frame_number", F.lit("cam").alias("camera_id"), "ord"))
    out = detail.row_details(lines, said, lookup)
    return out.select(F.col("camera_id").cast("bigint").alias("camera"), "frame_number", "enrich_applied", "ocr_raw_text", "scene_id")


@query("""WITH s AS (SELECT o_orderkey AS scene_id, o_orderpriority AS camera_id, o_custkey % 5 - 1 AS cluster_id FROM orders),
f AS (SELECT l_orderkey AS scene_id, l_linenumber AS n, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem WHERE l_returnflag = 'A' WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
b AS (SELECT scene_id, max(n) FILTER (i = 0) AS a, max(n) FILTER (i = c // 2 AND i > 0) AS m, max(n) FILTER (i = c - 1 AND i > 0 AND i <> c // 2) AS z FROM f GROUP BY 1),
v AS (SELECT l_orderkey AS scene_id, CASE l_linestatus WHEN 'F' THEN '1-URGENT' ELSE '5-LOW' END AS label, count(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT v.scene_id, sum(n) AS a, coalesce(sum(n) FILTER (label = camera_id), 0) AS w, count(*) AS c FROM v JOIN s USING (scene_id) GROUP BY 1)
SELECT s.scene_id, camera_id, b.a AS begin_frame, m AS mid_frame, z AS end_frame, round(CASE WHEN t.a > 0 THEN w / t.a ELSE 1 END, 6)::DOUBLE AS winner_share, coalesce(t.c, 0) <= 1 AS unanimous, cluster_id < 0 AS pred_noise FROM s LEFT JOIN b USING (scene_id) LEFT JOIN t USING (scene_id)""")
def camera_scenes(spark, read):
    o, f = read("orders"), _frames(read)
    scenes = o.select(F.col("o_orderkey").alias("scene_id"), F.col("o_orderpriority").alias("camera_id"), (F.col("o_custkey") % 5 - 1).alias("cluster_id"))
    votes = read("lineitem").groupBy(F.col("l_orderkey").alias("scene_id"), F.when(F.col("l_linestatus") == "F", "1-URGENT").otherwise("5-LOW").alias("label")).agg(F.count("*").alias("n"))
    times = scenes.select("scene_id", F.lit(0.0).alias("start_sec"), F.lit(1.0).alias("end_sec"))
    out = detail.camera_scenes(scenes, times, f, votes, scenes.select("scene_id", "camera_id"))
    return out.select("scene_id", "camera_id", "begin_frame", "mid_frame", "end_frame", six("winner_share").alias("winner_share"), "unanimous", "pred_noise")


_COLOR = "list_value('red', 'orange', 'blue', 'white', 'neutral', '')[{0} % 6 + 1]"


def _color(c: F.Column) -> F.Column:
    return F.array(*[F.lit(x) for x in ("red", "orange", "blue", "white", "neutral", "")])[(c % 6).cast("int")]


@query(f"""WITH s AS (SELECT o_orderkey AS scene_id, {_COLOR.format('o_custkey')} AS color, o_custkey % 3 AS pc, CASE WHEN o_orderstatus = 'O' THEN 'ok' ELSE 'low_conf' END AS status FROM orders),
e AS (SELECT scene_id, color FROM s WHERE status = 'ok' AND color <> ''),
n AS (SELECT color, min(scene_id) AS m FROM e GROUP BY 1), g AS (SELECT CASE WHEN color IN ('white', 'neutral') THEN 'pale' ELSE color END AS g, min(m) AS m FROM n GROUP BY 1), r AS (SELECT g, dense_rank() OVER (ORDER BY m) - 1 AS component FROM g),
v AS (SELECT DISTINCT l_orderkey AS scene_id FROM lineitem JOIN s ON s.scene_id = l_orderkey WHERE l_suppkey % 3 <> pc)
SELECT s.scene_id, s.color AS appearance_signature, v.scene_id IS NOT NULL AS has_count_variance, r.component::INTEGER AS component FROM s LEFT JOIN v USING (scene_id) LEFT JOIN e USING (scene_id) LEFT JOIN r ON r.g = CASE WHEN e.color IN ('white', 'neutral') THEN 'pale' ELSE e.color END""")
def appearance_scenes(spark, read):
    scenes = read("orders").select(F.col("o_orderkey").alias("scene_id"), F.concat(F.lit("2:"), _color(F.col("o_custkey")), F.lit(",black")).alias("appearance_signature"), (F.col("o_custkey") % 3).alias("person_count"), F.when(F.col("o_orderstatus") == "O", "ok").otherwise("low_conf").alias("status"), F.lit("closeup").alias("scene_type"))
    frames = read("lineitem").select(F.col("l_orderkey").alias("scene_id"), (F.col("l_suppkey") % 3).alias("person_count"))
    out = detail.appearance_scenes(scenes, frames, scenes.select("scene_id", F.lit("cam_0").alias("camera_id")), 26.0)
    return out.select("scene_id", "appearance_signature", "has_count_variance", F.col("component").cast("int").alias("component"))


@query(f"""WITH m AS (SELECT DISTINCT o_custkey % 40 AS c, {_COLOR.format('o_orderkey')} AS k FROM orders WHERE {_COLOR.format('o_orderkey')} <> '')
SELECT DISTINCT a.c AS one, b.c AS two FROM m a JOIN m b ON a.c < b.c AND a.k <> b.k""")
def cluster_conflicts(spark, read):
    o = read("orders")
    return detail.cluster_conflicts(o.select((F.col("o_custkey") % 40).alias("cluster_id"), F.col("o_orderkey").alias("scene_id")), o.select(F.col("o_orderkey").alias("scene_id"), _color(F.col("o_orderkey")).alias("color")), 18.0)


@query("SELECT l_orderkey, l_linenumber, o_orderpriority AS verdict FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def propagated_verdict(spark, read):
    scenes = read("orders").select(F.col("o_orderkey").alias("scene_id"), F.col("o_orderpriority").alias("verdict"))
    out = detail.propagated(_frames(read).select("scene_id", "frame_number"), scenes, ["verdict"])
    return out.select(F.col("scene_id").alias("l_orderkey"), F.col("frame_number").alias("l_linenumber"), "verdict")


@query("""WITH i AS (SELECT o_orderkey AS ord, 'a/' || (o_orderkey % 5) || '/f' || o_custkey AS p, 'f' || o_custkey AS n FROM orders),
x AS (SELECT p, min(ord) AS m FROM i GROUP BY 1), y AS (SELECT n, min(ord) AS m FROM i GROUP BY 1),
r AS (SELECT c_custkey, 'a/1/f' || c_custkey AS p, 'f' || c_custkey AS n FROM customer)
SELECT c_custkey, coalesce(x.m, y.m) AS scene_id FROM r LEFT JOIN x USING (p) LEFT JOIN y ON y.n = r.n WHERE coalesce(x.m, y.m) IS NOT NULL""")
def result_paths(spark, read):
    index = read("orders").select(F.col("o_orderkey").alias("ord"), F.concat(F.lit("a/"), (F.col("o_orderkey") % 5).cast("string"), F.lit("/f"), F.col("o_custkey").cast("string")).alias("frame_path"), F.col("o_orderkey").alias("scene_id"), F.lit(0).alias("frame_number"))
    results = read("customer").select("c_custkey", F.concat(F.lit("a/1/f"), F.col("c_custkey").cast("string")).alias("frame_path"))
    return detail.by_path(results, index).select("c_custkey", "scene_id")


@query("""SELECT e.vec_id, coalesce(m.c, e.label)::INTEGER AS frame_cluster, coalesce(s.k, CASE WHEN m.c IS NOT NULL THEN 'm' END, 'p') AS scene_camera FROM embeddings e LEFT JOIN (SELECT vec_id, vec_id % 4 AS c FROM embeddings WHERE label < 4) m USING (vec_id) LEFT JOIN (SELECT vec_id, 's' AS k FROM embeddings WHERE label = 2 OR label = 7) s USING (vec_id)""")
def point_labels(spark, read):
    e = read("embeddings").select(F.col("vec_id").alias("scene_id"), F.lit(0).alias("frame_number"), F.col("label").cast("int").alias("cluster_id"), F.lit("p").alias("camera_id"))
    merged = e.where("cluster_id < 4").withColumn("cluster_id", (F.col("scene_id") % 4).cast("int")).withColumn("camera_id", F.lit("m"))
    out = detail.point_labels(e, merged, e.where("cluster_id in (2, 7)").withColumn("camera_id", F.lit("s")))
    return out.select(F.col("scene_id").alias("vec_id"), "frame_cluster", "scene_camera")


@query(f"""WITH s AS (SELECT o_orderkey, {_COLOR.format('o_custkey')} AS a, {_COLOR.format('o_orderkey')} AS b FROM orders)
SELECT o_orderkey, a <> '' AND b <> '' AND (a = b OR (a IN ('white', 'neutral') AND b IN ('white', 'neutral'))) AS matching, CASE WHEN o_orderkey % 2 = 0 THEN 'white' ELSE 'black' END AS nearest FROM s""")
def color_labels(spark, read):
    lab = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(90.0), F.lit(1.0), F.lit(-2.0))).otherwise(F.array(F.lit(20.0), F.lit(3.0), F.lit(4.0)))
    return read("orders").select("o_orderkey", K.labels_match(_color(F.col("o_custkey")), _color(F.col("o_orderkey")), 26.0).alias("matching"), K.nearest_label(lab).alias("nearest"))


# --- ensemble and evaluation -----------------------------------------------------------------------------------------


@query(f"""
WITH RECURSIVE {_LABELINGS}, ed AS (SELECT i AS u, j AS v FROM pr WHERE weight >= 0.7 UNION ALL SELECT j, i FROM pr WHERE weight >= 0.7),
r AS (SELECT vec_id AS o, vec_id AS t FROM embeddings UNION SELECT r.o, ed.v FROM r JOIN ed ON ed.u = r.t),
c AS (SELECT o, min(t) AS m FROM r GROUP BY o), k AS (SELECT o, dense_rank() OVER (ORDER BY m) - 1 AS k FROM c),
z AS (SELECT o, sum(CASE WHEN l < 0 THEN w ELSE 0 END) >= 0.25 AS noise FROM l GROUP BY o),
x AS (SELECT k.o, o % 7 AS video, CASE WHEN noise THEN -1 ELSE k END::INTEGER AS cluster FROM k JOIN z USING (o)),
p AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY o) AS i FROM x),
n AS (SELECT a.o, b.cluster AS c, count(*) AS n, min(b.i) AS f FROM p a JOIN p b ON a.video = b.video AND b.i BETWEEN a.i - 2 AND a.i + 2 WHERE a.cluster < 0 AND b.cluster >= 0 GROUP BY ALL),
q AS (SELECT o, c FROM n QUALIFY row_number() OVER (PARTITION BY o ORDER BY n DESC, f) = 1)
SELECT x.o AS ord, cluster, coalesce('cam_' || CASE WHEN cluster >= 0 THEN cluster ELSE q.c END, 'unknown') AS camera_id FROM x LEFT JOIN q USING (o)""")
def ensemble_vote(spark, read):
    samples = read("embeddings").select(F.col("vec_id").alias("ord"), (F.col("vec_id") % 7).alias("video"))
    return ensemble.voted(samples, _labelings(read), _weights(spark), 0.7, 0.25, 2, ["video"]).select("ord", "cluster", "camera_id")


@query("""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label <> 4),
d AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d, list_cosine_similarity(a.v, b.v) AS c, a.vec_id <> b.vec_id AS o FROM e a JOIN e b ON true),
m AS (SELECT i, li, lj, sum(d) / count(*) FILTER (o) AS m, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT i, max(m) FILTER (li = lj) AS a, min(m) FILTER (li <> lj) AS b, max(n) FILTER (li = lj) AS n FROM m GROUP BY i)
SELECT round((SELECT avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) FROM s), 6) AS silhouette, round((SELECT avg(w) FROM (SELECT li, avg(1 - c) AS w FROM d WHERE li = lj AND o GROUP BY li)), 5) AS within_variance""")
def cluster_quality(spark, read):
    rows = read("embeddings").select(F.lit(0).alias("video"), F.col("embedding").alias("vec"), F.when(F.col("label") == 4, -1).otherwise(F.col("label")).alias("cluster"))
    out = ensemble.cluster_quality(rows, ["video"])
    return out.select(six("silhouette").alias("silhouette"), F.round("within_variance", 5).alias("within_variance"))


@query("""WITH p AS (SELECT label AS t, CASE WHEN vec_id % 4 = 0 THEN vec_id % 10 ELSE label END AS p FROM embeddings),
l AS (SELECT t AS label FROM p UNION SELECT p FROM p), h AS (SELECT t AS label, count(*) AS n, count(*) FILTER (t = p) AS h FROM p GROUP BY 1), s AS (SELECT p AS label, count(*) AS n FROM p GROUP BY 1),
x AS (SELECT l.label, coalesce(h.h / s.n, 0) AS pr, coalesce(h.h / h.n, 0) AS re, coalesce(h.n, 0) AS support FROM l LEFT JOIN h USING (label) LEFT JOIN s USING (label))
SELECT label::VARCHAR AS label, round(pr, 6)::DOUBLE AS precision, round(re, 6)::DOUBLE AS recall, round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6)::DOUBLE AS f1, support::BIGINT AS support FROM x""")
def class_scores(spark, read):
    e = read("embeddings")
    rows = e.select("label", F.when(F.col("vec_id") % 4 == 0, F.col("vec_id") % 10).otherwise(F.col("label")).alias("p"))
    out = ensemble.class_scores(rows, "label", "p")
    return out.select("label", *[six(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query()
def member_weights(spark, read):
    truth = read("embeddings").select(F.col("vec_id").alias("ord"), F.col("label").cast("string").alias("truth"))
    return ensemble.weights_of(ensemble.member_scores(_labelings(read), truth)).withColumn("weight", six("weight"))


@query()
def suggested_eps(spark, read):
    rows = read("embeddings").select((F.col("vec_id") % 5).alias("video"), F.col("embedding").alias("vec"))
    return ensemble.suggested_eps(rows, ["video"]).withColumn("eps", six("eps"))


@query()
def reduced_features(spark, read):
    rows = read("embeddings").select((F.col("vec_id") % 5).alias("video"), F.col("vec_id").alias("ord"), F.col("embedding").alias("vec"))
    return ensemble.prepared(rows, ["video"], True, 8).select("ord", F.transform("vec", lambda x: F.round(x, 5)).alias("vec"))


# --- operators without a query before --------------------------------------------------------------------------------


@query("""WITH s AS (SELECT o_orderkey AS scene_id, o_custkey % 3 = 0 AS v, CASE WHEN o_orderpriority = '1-URGENT' THEN 'closeup' ELSE 'full_court' END AS t, CASE o_orderstatus WHEN 'O' THEN 'ok' WHEN 'F' THEN 'low_conf' ELSE 'no_person' END AS st FROM orders)
SELECT scene_id FROM s WHERE v OR (t = 'closeup' AND st IN ('low_conf', 'no_person'))""")
def appearance_issues(spark, read):
    return appearance.issues(_scenes(read)).select("scene_id")


def _scenes(read) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "ok").when(F.col("o_orderstatus") == "F", "low_conf").otherwise("no_person")
    return read("orders").select(F.col("o_orderkey").alias("scene_id"), (F.col("o_custkey") % 3 == 0).alias("count_variance"), F.when(F.col("o_orderpriority") == "1-URGENT", "closeup").otherwise("full_court").alias("scene_type"), status.alias("status"), F.concat(F.lit("1:"), _color(F.col("o_custkey"))).alias("appearance_signature"))


@query(f"SELECT o_orderkey AS scene_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' AND {_COLOR.format('o_custkey')} <> ''")
def appearance_eligible(spark, read):
    return appearance.eligible(_scenes(read)).select("scene_id")


@query("""WITH p AS (SELECT l_orderkey AS k, l_suppkey % 3 AS t, count(*) AS n, median(l_quantity) AS m FROM lineitem GROUP BY ALL)
SELECT k, t::INTEGER AS track_id, n::BIGINT AS frames, m AS median_area FROM p QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, m DESC, t) = 1""")
def dominant_track(spark, read):
    rows = read("lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 3).cast("int").alias("track_id"), "l_quantity")
    return boxes.dominant_track(rows, ["k"], F.col("l_quantity"))


@query("""WITH c AS (SELECT DISTINCT CASE o_custkey % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'cam_' || o_custkey ELSE o_orderpriority END AS camera_id FROM orders)
SELECT camera_id, row_number() OVER (ORDER BY CASE WHEN camera_id = 'unknown' THEN 2 WHEN camera_id LIKE 'cam%' THEN 0 ELSE 1 END, try_cast(substr(camera_id, 5) AS INT) NULLS FIRST, camera_id)::INTEGER AS place FROM c""")
def camera_order(spark, read):
    key = F.col("o_custkey")
    name = F.when(key % 4 == 0, "unknown").when(key % 4 == 1, F.concat(F.lit("cam_"), key.cast("string"))).otherwise(F.col("o_orderpriority"))
    cameras = read("orders").select(name.alias("camera_id")).distinct()
    order = Window.orderBy(*catalog.camera_order(F.col("camera_id")))  # a row for each camera
    return cameras.select("camera_id", F.row_number().over(order).alias("place"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'same_cluster' WHEN l_discount >= 0.07 THEN 'would_link' WHEN abs(l_discount - 0.07) <= 0.025 THEN 'borderline' ELSE 'split' END AS verdict FROM lineitem")
def pair_verdict(spark, read):
    return read("lineitem").select("l_orderkey", "l_linenumber", G.verdict(F.col("l_returnflag") == "A", F.col("l_discount"), 0.07, 0.025).alias("verdict"))


@query("WITH e AS (SELECT event_type AS t, count(*) AS n FROM events GROUP BY 1) SELECT count(*) FILTER (t <> 'error')::BIGINT AS n_complete, count(*) FILTER (t = 'error')::BIGINT AS n_partial, round(sum(n), 6)::DOUBLE AS total_sec, sum(n)::BIGINT AS presence_events, count(DISTINCT t)::BIGINT AS n_cameras FROM e")
def timeline_summary(spark, read):
    lines = read("events").groupBy("event_type").agg(F.count("*").alias("n")).select(F.col("event_type").alias("camera_id"), F.when(F.col("event_type") == "error", "partial").otherwise("complete").alias("text_kind"), F.col("n").cast("double").alias("total_duration_sec"), F.col("n").alias("n_frames_present"))
    return timeline.summary(lines, _catalog(read)).drop("n_approved")


@query("""WITH j AS (SELECT toxic AS t, quality AS p FROM labels) SELECT round(avg((t = p)::INT), 6) AS accuracy, count(*)::BIGINT AS n FROM j""")
def scene_accuracy(spark, read):
    rows = read("labels").select(F.col("toxic").alias("t"), F.col("quality").alias("p"))
    return rows.agg(six(F.avg((F.col("t") == F.col("p")).cast("double"))).alias("accuracy"), F.count("*").alias("n"))

