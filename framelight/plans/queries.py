"""One query for each operator over the given tables, which stand in for scenes, frames and detections.

A user is a scene, a second since 2024 a frame and an event type a camera; an order is a frame and its lines are
boxes; conversations hold read words by turn, and the words of benchmark are the approved catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.functions import geometry as G
from framelight.functions import text as X
from framelight.operators import appearance, boxes, catalog, evaluate, graph, runs, sampling, timeline, votes
from framelight.sources.tables import catalog_scan, undone

FRAME = "date_sub('second', TIMESTAMP '2024-01-01', ts)"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, read), where read(name) is a table, under its name with its SQL twin."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def six(c: str | F.Column) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def events_of(read) -> DataFrame:
    frame = F.timestamp_diff("SECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return read("events").select("event_id", "user_id", "ts", "event_type", "value", frame.cast("bigint").alias("frame"))


# --- windows over frames ---------------------------------------------------------------------------------------


@query(f"""
WITH e AS (SELECT DISTINCT user_id, {FRAME} AS frame FROM events)
SELECT user_id, frame, round(coalesce(lead(frame) OVER w - frame, greatest(1, 2678400 - frame)) / 25.0, 6) AS duration_sec
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY frame)""")
def slot_duration(spark, read):
    e = events_of(read)
    return runs.slot_durations(e, ["user_id"], "frame", F.lit(2678400), F.lit(25.0)).withColumn("duration_sec", six("duration_sec"))


@query("""
WITH m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS t
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(t) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_id FROM m)
SELECT user_id, run_id::BIGINT AS run_id, min(event_type) AS label, count(*)::BIGINT AS n FROM r GROUP BY user_id, run_id""")
def label_runs(spark, read):
    r = runs.label_runs(events_of(read), ["user_id"], ["ts", "event_id"], "event_type")
    return r.groupBy("user_id", "run_id").agg(F.min("event_type").alias("label"), F.count("*").alias("n"))


@query("""
WITH e AS (SELECT user_id, event_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
n AS (SELECT a.user_id, a.event_id, b.event_type AS t, count(*) AS c, min(b.i) AS f
      FROM e a JOIN e b ON a.user_id = b.user_id AND b.i BETWEEN a.i - 2 AND a.i + 2 WHERE a.event_type = 'error' AND b.event_type <> 'error' GROUP BY ALL),
p AS (SELECT user_id, event_id, t FROM n QUALIFY row_number() OVER (PARTITION BY user_id, event_id ORDER BY c DESC, f) = 1)
SELECT e.event_id, coalesce(p.t, e.event_type) AS filled FROM e LEFT JOIN p USING (user_id, event_id)""")
def temporal_fill(spark, read):
    return runs.temporal_fill(events_of(read), ["user_id"], ["ts", "event_id"], "event_type", ["error", "unknown", "None", "nan", ""], 2).select("event_id", "filled")


@query("""
WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
n AS (SELECT a.event_id, b.event_type AS t, count(*) AS c, min(b.i) AS f FROM e a JOIN e b ON a.user_id = b.user_id AND b.i BETWEEN a.i - 2 AND a.i + 2 AND b.i <> a.i WHERE a.event_type <> 'error' AND b.event_type <> 'error' GROUP BY ALL),
p AS (SELECT event_id, t FROM n QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY c DESC, f) = 1)
SELECT user_id, round(coalesce(avg(CASE WHEN p.t = e.event_type THEN 1.0 WHEN p.t IS NOT NULL THEN 0.0 END), CASE WHEN count(*) = 1 THEN 1 ELSE 0 END), 6)::DOUBLE AS coherence FROM e LEFT JOIN p USING (event_id) GROUP BY user_id""")
def temporal_coherence(spark, read):
    c = runs.coherence(events_of(read), ["user_id"], ["ts", "event_id"], "event_type", 2, ["error"])
    none = F.when(F.count("*") == 1, 1.0).otherwise(0.0)
    return c.groupBy("user_id").agg(six(F.coalesce(F.avg(F.col("agrees").cast("double")), none)).alias("coherence"))


@query("""
WITH m AS (SELECT user_id, CASE WHEN event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS s FROM events)
SELECT user_id, sum(s)::BIGINT AS switches, count(*)::BIGINT AS frames FROM m GROUP BY user_id""")
def switch_counts(spark, read):
    return runs.switch_counts(events_of(read), ["user_id"], ["ts", "event_id"], "event_type")


@query("""
WITH e AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT event_id, CASE WHEN i = 0 THEN 'begin' WHEN i = n // 2 THEN 'mid' ELSE 'end' END AS slot FROM e WHERE i = 0 OR i = n // 2 OR i = n - 1""")
def begin_mid_end(spark, read):
    return runs.begin_mid_end(events_of(read), ["user_id"], ["ts", "event_id"]).select("event_id", "slot")


@query("SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 2")
def second_row(spark, read):
    return runs.kth_row(events_of(read), ["user_id"], ["ts", "event_id"], 2).select("event_id", "user_id")


@query("SELECT event_id, first(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_label FROM events")
def group_first(spark, read):
    return runs.first_of_group(events_of(read), ["user_id"], ["ts", "event_id"], "event_type", "first_label").select("event_id", "first_label")


@query("""
WITH m AS (SELECT user_id, event_id, value, CASE WHEN abs(value - lag(value) OVER w) > 50 THEN 1 ELSE 0 END AS j FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id, (sum(j) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS scene_no FROM m""")
def scene_cuts(spark, read):
    return sampling.scene_cuts(events_of(read), ["user_id"], "event_id", "value", 50).select("event_id", "scene_no")


# --- sampling and ranges ---------------------------------------------------------------------------------------


@query("""
WITH d AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS f FROM lineitem),
i AS (SELECT k, f, f - row_number() OVER (PARTITION BY k ORDER BY f) AS g FROM d),
s AS (SELECT k, min(f) AS a, max(f) AS b FROM i GROUP BY k, g)
SELECT k AS l_orderkey, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ';' ORDER BY a) AS frame_ranges FROM s GROUP BY k""")
def frame_ranges(spark, read):
    return sampling.frame_ranges(read("lineitem"), ["l_orderkey"], "l_linenumber")


@query("SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS frame FROM lineitem")
def range_expand(spark, read):
    texts = sampling.frame_ranges(read("lineitem"), ["l_orderkey"], "l_linenumber")
    return texts.select("l_orderkey", F.explode(sampling.expanded_ranges(F.col("frame_ranges"))).alias("frame"))


def _scenes(read) -> DataFrame:
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")
    return read("orders").groupBy(F.col("o_custkey").alias("scene_id")).agg(F.min(day).alias("start_frame"), F.max(day).alias("end_frame"))


_SCENES = "s AS (SELECT o_custkey AS scene_id, min(date_diff('day', DATE '1992-01-01', o_orderdate::DATE))::BIGINT AS a, max(date_diff('day', DATE '1992-01-01', o_orderdate::DATE))::BIGINT AS b FROM orders GROUP BY 1)"


@query(f"""
WITH {_SCENES}, n AS (SELECT unnest(range(5)) AS i)
SELECT DISTINCT scene_id, CASE WHEN b - 1 <= a THEN a ELSE greatest(a, least(b - 1, a + round_even(((b - 1 - a) / 4.0::DOUBLE) * i, 0)::BIGINT)) END AS frame_number, 'camera' AS sample_role FROM s, n
UNION ALL
SELECT scene_id, unnest(range(a, b, 12)) AS frame_number, 'ocr' AS sample_role FROM s""")
def extraction_targets(spark, read):
    return sampling.extraction_targets(_scenes(read).withColumn("fps", F.lit(25.0)), 5, 2.0)


# --- votes -------------------------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS t FROM events GROUP BY ALL)
SELECT user_id, event_type AS winner, n::BIGINT AS votes, (sum(n) OVER (PARTITION BY user_id))::BIGINT AS total FROM c
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, t) = 1""")
def majority_vote_first_seen(spark, read):
    return votes.first_seen_majority(read("events"), ["user_id"], "event_type", [F.col("ts")])


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, o_orderpriority AS winner, n::BIGINT AS votes FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1""")
def majority_vote_smallest(spark, read):
    return votes.smallest_mode(read("orders"), ["o_custkey"], "o_orderpriority")


_VOTES = """
o AS (SELECT o_custkey AS k, o_orderpriority AS l, date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::BIGINT AS f FROM orders),
c AS (SELECT k, l, count(*) AS n FROM o GROUP BY ALL),
t AS (SELECT k, max(n) AS top, sum(n) AS total, count(*) AS labels FROM c GROUP BY k),
w AS (SELECT c.k, string_agg(l, '|' ORDER BY l) AS leaders, count(*) AS nl, min(l) AS one FROM c JOIN t ON c.k = t.k AND c.n = t.top GROUP BY c.k),
d AS (SELECT k, trunc(quantile_cont(f, 0.5))::BIGINT AS med FROM o GROUP BY k),
m AS (SELECT o.k, l AS middle FROM o JOIN d USING (k) QUALIFY row_number() OVER (PARTITION BY o.k ORDER BY abs(f - med), f, l) = 1),
v AS (SELECT k, leaders, nl, one, middle, round_even(top / total::DOUBLE, 4) AS share, top::BIGINT AS top, total::BIGINT AS total, nl = 1 AND labels > 1 AND round_even(top / total::DOUBLE, 4) < 0.6 AS low_share
      FROM t JOIN w USING (k) JOIN m USING (k))"""


def _vote_rows(read) -> DataFrame:
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")
    return read("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("label"), day.alias("f"))


@query(f"WITH {_VOTES} SELECT k, leaders, top, total, share, middle, low_share FROM v")
def vote_share_fallback(spark, read):
    return votes.vote_table(_vote_rows(read), "k", "label", "f", 0.6).withColumn("leaders", F.array_join("leaders", "|"))


@query(f"""
WITH RECURSIVE {_VOTES},
s AS (SELECT c_nationkey AS video, v.*, row_number() OVER (PARTITION BY c_nationkey ORDER BY k) AS i FROM v JOIN customer ON c_custkey = k),
r AS (
  SELECT video, i, k, share, CASE WHEN low_share THEN middle WHEN nl = 1 THEN one ELSE middle END AS winner,
         CASE WHEN low_share THEN 'low_share_middle' WHEN nl = 1 THEN CASE WHEN share = 1 THEN 'unanimous' ELSE 'majority' END ELSE 'middle' END AS method FROM s WHERE i = 1
  UNION ALL
  SELECT s.video, s.i, s.k, s.share,
         CASE WHEN s.low_share THEN s.middle WHEN s.nl = 1 THEN s.one WHEN list_contains(string_split(s.leaders, '|'), r.winner) THEN r.winner ELSE s.middle END,
         CASE WHEN s.low_share THEN 'low_share_middle' WHEN s.nl = 1 THEN CASE WHEN s.share = 1 THEN 'unanimous' ELSE 'majority' END WHEN list_contains(string_split(s.leaders, '|'), r.winner) THEN 'previous' ELSE 'middle' END
  FROM r JOIN s ON s.video = r.video AND s.i = r.i + 1)
SELECT video, k AS scene, winner, method, share FROM r""")
def vote_with_carry(spark, read):
    rows = _vote_rows(read).join(read("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("video")), "k")
    found = votes.scene_votes(rows, "video", "k", "label", "f")
    return found.select("k.video", F.col("k.k").alias("scene"), "winner", "method", "share")


# --- catalog, association, timeline ------------------------------------------------------------------------------

_TOKENS = """
tok AS (SELECT conv_id, turn, role, i, w[i] AS token FROM (SELECT conv_id, turn, role, w, unnest(range(1, len(w) + 1)) AS i FROM
        (SELECT conv_id, turn, role, regexp_extract_all(text, '[A-Za-z]+|\\d+(?:-\\d+)+|\\d+') AS w FROM conversations)))"""
_KEY = "replace(lower({0}), 'ß', 'ss')"
_PLAUSIBLE = "length(token) >= 2"


def _tokens(read) -> DataFrame:
    words = read("conversations").select("conv_id", "turn", "role", F.posexplode(X.tokenize(F.col("text"))).alias("i", "token"))
    return words.withColumn("i", F.col("i") + 1)


@query(f"""
WITH {_TOKENS}
SELECT {_KEY.format('token')} AS key, arg_min(token, (conv_id, turn, i)) AS complete_text, arg_min(conv_id, (conv_id, turn, i)) AS first_seen_scene_id, arg_min(turn, (conv_id, turn, i)) AS first_seen_frame, count(*)::BIGINT AS discovery_count
FROM tok WHERE {_PLAUSIBLE} AND token <> 'UNK' GROUP BY 1""")
def token_discovery(spark, read):
    return catalog.discovered(_tokens(read), ["conv_id", "turn", "i"], "conv_id", "turn")


def _catalog(read) -> DataFrame:
    """The distinct words of benchmark of four letters or more; every fifth letter sum is not approved."""
    words = read("benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"([A-Za-z]{4,})"), 1)).alias("i", "w"))
    once = words.groupBy(F.lower("w").alias("k")).agg(F.min_by("w", F.struct("item_id", "i")).alias("complete_text"))
    named = once.select("complete_text", ((F.length("complete_text") % 5 != 0)).cast("string").alias("approved"), F.row_number().over(_by_key()).cast("bigint").alias("ord"))
    return named


def _by_key():
    from pyspark.sql import Window

    return Window.orderBy("k")  # a small table: the distinct words of the catalog


_CATALOG = """
bw AS (SELECT item_id, i, w[i] AS w FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT item_id, regexp_extract_all(text, '[A-Za-z]{4,}') AS w FROM benchmark))),
cat AS (SELECT k, complete_text, length(complete_text) % 5 <> 0 AS approved, row_number() OVER (ORDER BY k) AS ord FROM (SELECT lower(w) AS k, arg_min(w, (item_id, i)) AS complete_text FROM bw GROUP BY 1))"""


@query(f"""
WITH {_TOKENS}, {_CATALOG},
f AS (SELECT {_KEY.format('token')} AS key, arg_min(token, (conv_id, turn, i)) AS complete_text, arg_min(conv_id, (conv_id, turn, i)) AS sc, arg_min(turn, (conv_id, turn, i)) AS fr, count(*)::BIGINT AS n
      FROM tok WHERE {_PLAUSIBLE} AND token <> 'UNK' GROUP BY 1)
SELECT coalesce(cat.complete_text, f.complete_text) AS complete_text, CASE WHEN cat.k IS NULL THEN true ELSE approved END AS approved,
       CASE WHEN cat.k IS NULL THEN sc END::INTEGER AS first_seen_scene_id, CASE WHEN cat.k IS NULL THEN fr END::INTEGER AS first_seen_frame, coalesce(n, 0)::BIGINT AS discovery_count, cat.k IS NULL AS is_new
FROM cat FULL JOIN f ON cat.k = f.key""")
def catalog_upsert(spark, read):
    found = catalog.discovered(_tokens(read), ["conv_id", "turn", "i"], "conv_id", "turn")
    out = catalog.upserted(catalog_scan(_catalog(read).drop("ord")), found)
    return out.withColumns({c: F.col(c).cast("int") for c in ("first_seen_scene_id", "first_seen_frame")})


_LOOKED = f"""
t3 AS (SELECT DISTINCT token, {_KEY.format('token')} AS t FROM tok),
sub AS (SELECT token, t, i, j, substr(t, i, j - i + 1) AS s FROM (SELECT token, t, i, unnest(range(i + 2, length(t) + 1)) AS j FROM (SELECT token, t, unnest(range(1, length(t) + 1)) AS i FROM t3 WHERE length(t) >= 3))),
hit AS (SELECT token, t, complete_text, ord, k, j - i + 1 AS n, j, instr(k, s) - 1 AS p FROM sub JOIN cat ON approved AND length(k) >= 3 AND contains(k, s)),
best AS (SELECT token, t, complete_text, ord, k, n, p FROM hit QUALIFY row_number() OVER (PARTITION BY token, ord ORDER BY n DESC, j, p) = 1),
part AS (SELECT token, complete_text AS mapped, n / length(k)::DOUBLE AS confidence FROM best
         WHERE n / length(t)::DOUBLE >= 0.5 AND n / length(k)::DOUBLE >= CASE WHEN p = 0 THEN 0.5 ELSE 0.6 END QUALIFY row_number() OVER (PARTITION BY token ORDER BY n / length(k)::DOUBLE DESC, ord) = 1),
ass AS (SELECT tok.*, CASE WHEN a.k IS NOT NULL AND length(tok.token) >= 3 THEN 'complete' WHEN mapped IS NOT NULL THEN 'partial' END AS text_kind,
        CASE WHEN a.k IS NOT NULL AND length(tok.token) >= 3 THEN a.complete_text ELSE mapped END AS mapped_complete_text,
        CASE WHEN a.k IS NOT NULL AND length(tok.token) >= 3 THEN 1.0 ELSE confidence END AS mapping_confidence, c.k IS NOT NULL AS listed
        FROM tok LEFT JOIN cat a ON a.approved AND a.k = {_KEY.format('tok.token')} LEFT JOIN cat c ON c.k = {_KEY.format('tok.token')} LEFT JOIN part USING (token))"""


def _associated(read) -> DataFrame:
    t = _tokens(read)
    words = t.select(F.col("role").alias("camera_id"), F.col("conv_id").alias("scene_id"), F.col("turn").alias("frame_number"), F.col("token").alias("raw_text"), "i")
    words = words.withColumn("ord", F.struct("scene_id", "frame_number", "i"))
    label = F.when(F.length("raw_text") >= 6, "good").otherwise("partial")
    return timeline.associated(words, _catalog(read)).withColumn("readability_label", label).withColumn("enrich_applied", F.col("i") % 7 == 0)


@query(f"""
WITH {_TOKENS}, {_CATALOG}, {_LOOKED}
SELECT conv_id AS scene_id, turn AS frame_number, i::INTEGER AS i, token AS raw_text, text_kind, mapped_complete_text, round(mapping_confidence, 6) AS mapping_confidence,
       CASE WHEN token = 'UNK' THEN 'unk_or_empty' WHEN text_kind IS NOT NULL THEN NULL WHEN listed THEN 'unapproved' ELSE 'no_match' END AS reason FROM ass""")
def associate_text(spark, read):
    a = _associated(read)
    return a.select("scene_id", "frame_number", F.col("i").cast("int").alias("i"), "raw_text", "text_kind", "mapped_complete_text", six("mapping_confidence").alias("mapping_confidence"), "reason")


def _timeline_sql(kind: str) -> str:
    return f"""
WITH {_TOKENS}, {_CATALOG}, {_LOOKED},
fr AS (SELECT DISTINCT conv_id, turn FROM conversations),
dur AS (SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - turn, 1) / 2.0 AS d FROM fr),
pay AS (SELECT role, text_kind, CASE WHEN text_kind = 'complete' THEN mapped_complete_text ELSE token END AS text, mapped_complete_text, ass.turn AS f, token, i,
        CASE WHEN row_number() OVER (PARTITION BY role, mapped_complete_text, ass.conv_id, ass.turn ORDER BY CASE WHEN text_kind = 'complete' THEN 0 ELSE 1 END, ass.conv_id, ass.turn, i) = 1 THEN coalesce(d, 0) ELSE 0 END AS s
        FROM ass LEFT JOIN dur USING (conv_id, turn) WHERE text_kind IS NOT NULL),
isl AS (SELECT *, f - row_number() OVER (PARTITION BY role, text, mapped_complete_text ORDER BY f) AS g FROM (SELECT DISTINCT role, text, mapped_complete_text, f FROM pay WHERE text_kind = '{kind}')),
spn AS (SELECT role, text, mapped_complete_text, min(f) AS a, max(f) AS b FROM isl GROUP BY role, text, mapped_complete_text, g),
rng AS (SELECT role, text, mapped_complete_text, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ';' ORDER BY a) AS frame_ranges FROM spn GROUP BY ALL),
agg AS (SELECT role, text, mapped_complete_text, round(sum(s), 6)::DOUBLE AS total_duration_sec, count(DISTINCT f)::BIGINT AS n_frames_present,
        count(DISTINCT f) FILTER (length(token) >= 6)::BIGINT AS n_frames_good, count(DISTINCT f) FILTER (length(token) < 6)::BIGINT AS n_frames_partial, count(DISTINCT f) FILTER (i % 7 = 0)::BIGINT AS n_frames_enriched
        FROM pay WHERE text_kind = '{kind}' GROUP BY ALL)
SELECT role AS camera_id, text, mapped_complete_text, total_duration_sec, frame_ranges, n_frames_present, n_frames_good, n_frames_partial, n_frames_enriched,
       CASE WHEN n_frames_good >= n_frames_partial THEN 'good' ELSE 'partial' END AS dominant_readability FROM agg JOIN rng USING (role, text, mapped_complete_text)"""


def _timeline(read) -> DataFrame:
    frames = read("conversations").select(F.col("conv_id").alias("scene_id"), F.col("turn").alias("frame_number"))
    durations = runs.slot_durations(frames, ["scene_id"], "frame_number", F.lit(None).cast("bigint"), F.lit(2.0))
    return timeline.timeline(_associated(read), durations).withColumn("total_duration_sec", six("total_duration_sec"))


@query(_timeline_sql("complete"))
def timeline_complete(spark, read):
    return _timeline(read).where("text_kind = 'complete'").drop("text_kind")


@query(_timeline_sql("partial"))
def timeline_partial(spark, read):
    return _timeline(read).where("text_kind = 'partial'").drop("text_kind")


@query(f"""WITH {_TOKENS}, {_CATALOG}, x AS (SELECT DISTINCT token AS text, 0 AS r FROM tok WHERE i = 1 UNION ALL SELECT DISTINCT p_name, 1 FROM part UNION ALL SELECT complete_text, 2 FROM cat WHERE approved)
SELECT arg_min(text, (r, text)) AS text FROM x GROUP BY {_KEY.format('text')}""")
def suggestion_set(spark, read):
    """The first word of each turn stands for a complete row, a part's name for a partial one."""
    complete = _tokens(read).where("i = 1").select(F.col("token").alias("mapped_complete_text")).distinct()
    partial = read("part").select(F.col("p_name").alias("mapped_complete_text")).distinct()
    return catalog.suggestions(complete, partial, _catalog(read)).select("text")


@query(f"""WITH {_CATALOG} SELECT complete_text AS text FROM cat WHERE contains(lower(complete_text), 'th') ORDER BY CASE WHEN starts_with(lower(complete_text), 'th') THEN 0 ELSE 1 END, lower(complete_text), complete_text LIMIT 20""")
def ranked_suggestions(spark, read):
    return catalog.ranked_suggestions(_catalog(read).select(F.col("complete_text").alias("text")), "TH", 20)


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'a')")
def search_rows(spark, read):
    return catalog.search_rows(read("part").select("p_partkey", "p_name", F.col("p_name").alias("mapped_complete_text")), " A ").select("p_partkey", "p_name")


# --- facets ------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND floor(l_extendedprice) BETWEEN 10000 AND 40000")
def faceted_filter(spark, read):
    rows = catalog.faceted(read("lineitem"), {"l_returnflag": ["A", "R"], "l_linestatus": None}, "l_extendedprice", 10000, 40000)
    return rows.select("l_orderkey", "l_linenumber")


@query("SELECT DISTINCT 'l_returnflag' AS facet, trim(l_returnflag) AS value FROM lineitem UNION ALL SELECT DISTINCT 'l_linestatus', trim(l_linestatus) FROM lineitem")
def facet_options(spark, read):
    return catalog.facet_options(read("lineitem"), ["l_returnflag", "l_linestatus"])


@query("SELECT min(l_extendedprice) AS least, max(l_extendedprice) AS most, round(sum(l_extendedprice), 2) AS total, floor(min(l_extendedprice))::BIGINT AS floor_least, floor(max(l_extendedprice))::BIGINT AS floor_most FROM lineitem")
def duration_stats(spark, read):
    return catalog.duration_stats(read("lineitem"), "l_extendedprice").withColumn("total", F.round("total", 2))


@query("SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) <= 3")
def largest_three(spark, read):
    return catalog.top_per_group(read("lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_linenumber")], 3).select("l_orderkey", "l_linenumber")


# --- joins -------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, l_partkey FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1) ON o_orderkey = l_orderkey""")
def first_match_join(spark, read):
    lines = read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return timeline.first_equal(read("orders").select("o_orderkey"), lines, ["o_orderkey"], ["l_linenumber", "l_partkey"], ["l_partkey"])


@query("""SELECT o_orderkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, n_name, 'unknown') AS camera_id FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def fallback_join(spark, read):
    c = read("customer")
    orders = read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(c.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey", "left")
    exact = c.where("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("camera_id"))
    coarse = read("nation").select("n_nationkey", F.col("n_name").alias("camera_id"))
    return timeline.with_fallback(orders, exact, ["c_custkey"], coarse, ["n_nationkey"], "camera_id", "unknown").select("o_orderkey", "camera_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def undone_keys(spark, read):
    return undone(read("documents").select("doc_id"), read("labels"), ["doc_id"])


# --- evaluation --------------------------------------------------------------------------------------------------


@query("""WITH j AS (SELECT toxic, source FROM labels JOIN documents USING (doc_id)) SELECT toxic AS truth, source AS predicted, count(*)::BIGINT AS n, (sum(count(*)) OVER (PARTITION BY toxic))::BIGINT AS support FROM j GROUP BY toxic, source""")
def confusion_table(spark, read):
    return evaluate.confusion(read("labels").join(read("documents"), "doc_id"), "toxic", "source")


@query("""WITH p AS (SELECT vec_id % 10 AS c, label, count(*) AS n FROM embeddings GROUP BY ALL) SELECT round(sum(m) / sum(s), 6)::DOUBLE AS purity FROM (SELECT max(n) AS m, sum(n) AS s FROM p GROUP BY c)""")
def cluster_purity(spark, read):
    return evaluate.purity(read("embeddings").withColumn("c", F.col("vec_id") % 10), "c", "label").select(six("purity").alias("purity"))


@query("""WITH p AS (SELECT o_orderpriority AS cam, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1) SELECT count(*)::BIGINT AS n_cameras, count(*) FILTER (n = 1)::BIGINT AS n_singletons, round(avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS singleton_rate FROM p""")
def singleton_rate(spark, read):
    return evaluate.singleton_rate(read("orders"), "o_orderpriority", "o_custkey").withColumn("singleton_rate", six("singleton_rate"))


@query("""SELECT CASE WHEN l_discount <= 0.03 THEN 0 WHEN l_discount <= 0.06 THEN 1 ELSE 2 END AS bin, count(*)::BIGINT AS n, round(avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy FROM lineitem WHERE l_discount BETWEEN 0 AND 0.1 GROUP BY 1""")
def binned_accuracy(spark, read):
    return evaluate.binned(read("lineitem"), "l_discount", [0.0, 0.03, 0.06, 0.1], F.col("l_returnflag") == "A").withColumn("accuracy", six("accuracy"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, count(*)::BIGINT AS n_labels, count(*) = 1 AS unanimous, round(max(n) / sum(n), 6)::DOUBLE AS share FROM c GROUP BY user_id""")
def vote_disagreement(spark, read):
    return evaluate.disagreement(read("events"), "user_id", "event_type").withColumn("share", six("share"))


@query("""
WITH p AS (SELECT label, vec_id % 7 AS c, count(*)::DOUBLE AS n FROM embeddings GROUP BY ALL),
a AS (SELECT sum(m * (m - 1) / 2) AS s, sum(m * ln(m)) AS l FROM (SELECT sum(n) AS m FROM p GROUP BY label)),
b AS (SELECT sum(m * (m - 1) / 2) AS s, sum(m * ln(m)) AS l FROM (SELECT sum(n) AS m FROM p GROUP BY c)),
x AS (SELECT sum(n) AS n, sum(n * (n - 1) / 2) AS s, sum(n * ln(n)) AS l FROM p),
h AS (SELECT ln(x.n) - a.l / x.n AS ht, ln(x.n) - b.l / x.n AS hc, ln(x.n) - x.l / x.n AS hb, a.s * b.s / (x.n * (x.n - 1) / 2) AS e, (a.s + b.s) / 2 AS top, x.s AS s FROM a, b, x),
y AS (SELECT (s - e) / (top - e) AS r, 1 - (hb - hc) / ht AS ho, 1 - (hb - ht) / hc AS co FROM h)
SELECT round(r, 6) AS adjusted_rand, round(ho, 6) AS homogeneity, round(co, 6) AS completeness, round(2 * ho * co / (ho + co), 6) AS v_measure FROM y""")
def pair_indices(spark, read):
    out = evaluate.pair_indices(read("embeddings").withColumn("c", F.col("vec_id") % 7), "label", "c")
    return out.select(*[six(c).alias(c) for c in out.columns])


# --- clusters ----------------------------------------------------------------------------------------------------


def _labelings(read) -> DataFrame:
    e = read("embeddings")
    sign = F.when(e["embedding"][0] < -0.15, -1).otherwise(F.floor((e["embedding"][0] + 1) * 40)).cast("int")
    members = F.explode(F.array(F.struct(F.lit("a").alias("m"), F.col("label").cast("int").alias("l")), F.struct(F.lit("b").alias("m"), (F.col("vec_id") % 37).cast("int").alias("l")), F.struct(F.lit("c").alias("m"), sign.alias("l")))).alias("x")
    return e.select(F.col("vec_id").alias("ord"), members).select("ord", F.col("x.m").alias("member"), F.col("x.l").alias("label"))


def _weights(spark) -> DataFrame:
    return spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 1.0)], "member string, weight double")


_LABELINGS = """
l AS (SELECT vec_id AS o, 'a' AS m, label::INTEGER AS l, 0.5 AS w FROM embeddings UNION ALL SELECT vec_id, 'b', (vec_id % 37)::INTEGER, 0.25 FROM embeddings
      UNION ALL SELECT vec_id, 'c', CASE WHEN embedding[1]::DOUBLE < -0.15 THEN -1 ELSE floor((embedding[1] + 1::FLOAT) * 40::FLOAT) END::INTEGER, 0.25 FROM embeddings),
pr AS (SELECT a.o AS i, b.o AS j, sum(a.w)::DOUBLE AS weight FROM l a JOIN l b ON a.m = b.m AND a.l = b.l AND a.o < b.o WHERE a.l >= 0 GROUP BY 1, 2)"""


@query(f"WITH {_LABELINGS} SELECT i, j, round(weight, 6) AS weight FROM pr")
def coassociation(spark, read):
    return graph.coassociation(_labelings(read), _weights(spark)).withColumn("weight", six("weight"))


@query(f"""
WITH RECURSIVE {_LABELINGS}, ed AS (SELECT i AS u, j AS v FROM pr WHERE weight >= 0.7 UNION ALL SELECT j, i FROM pr WHERE weight >= 0.7),
r AS (SELECT vec_id AS o, vec_id AS t FROM embeddings UNION SELECT r.o, ed.v FROM r JOIN ed ON ed.u = r.t),
c AS (SELECT o, min(t) AS m FROM r GROUP BY o)
SELECT o AS ord, (dense_rank() OVER (ORDER BY m) - 1)::INTEGER AS cluster FROM c""")
def consensus_components(spark, read):
    pairs = graph.coassociation(_labelings(read), _weights(spark))
    return graph.consensus(read("embeddings").select(F.col("vec_id").alias("ord")), pairs, 0.7)


@query(f"WITH {_LABELINGS} SELECT o AS ord, sum(CASE WHEN l < 0 THEN w ELSE 0 END) >= 0.25 AS noise FROM l GROUP BY o")
def noise_mask(spark, read):
    return graph.noise_mask(_labelings(read), _weights(spark), 0.25)


@query("""WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS place FROM embeddings) SELECT label, place::INTEGER AS place, round(avg(x), 6) AS mean FROM x GROUP BY label, place""")
def centroids(spark, read):
    return graph.centroids(read("embeddings"), "label", "embedding").withColumn("mean", six("mean"))


@query("""SELECT a.label AS one, b.label AS two, round(avg(c), 6) AS mean, round(min(c), 6) AS least, round(max(c), 6) AS most, round(stddev_pop(c), 6) AS deviation
FROM (SELECT a.label AS la, b.label AS lb, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON a.label <= b.label AND a.vec_id <> b.vec_id WHERE a.label IN (2, 5) AND b.label IN (2, 5)) x, (SELECT 0) y, LATERAL (SELECT la AS label) a, LATERAL (SELECT lb AS label) b GROUP BY 1, 2""")
def compare_scenes(spark, read):
    chosen = read("embeddings").where(F.col("label").isin(2, 5))  # the two scenes that the query compares
    out = graph.pair_statistics(chosen, "label", "vec_id", "embedding")
    return out.select("one", "two", *[six(c).alias(c) for c in ("mean", "least", "most", "deviation")])


@query()
def dbscan(spark, read):
    return graph.density_clusters(read("embeddings").select(F.col("vec_id").alias("ord"), F.col("embedding").cast("array<double>").alias("vec")), 0.5, 2)


# --- boxes -------------------------------------------------------------------------------------------------------

_BOXES = """b AS (SELECT l_orderkey AS k, l_linenumber AS n, (l_partkey % 50)::INTEGER AS x0, (l_suppkey % 10 * 5)::INTEGER AS y0, (l_partkey % 50 + l_quantity)::INTEGER AS x1, (l_suppkey % 10 * 5 + 20)::INTEGER AS y1 FROM lineitem)"""


def _boxes(read) -> DataFrame:
    x, y = (F.col("l_partkey") % 50).cast("int"), (F.col("l_suppkey") % 10 * 5).cast("int")
    return read("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.array(x, y, (x + F.col("l_quantity")).cast("int"), y + 20).alias("bbox"), "l_quantity", F.col("l_partkey").alias("p"))


@query(f"""WITH {_BOXES}, p AS (SELECT a.k, a.n AS one, b.n AS two, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i,
(a.x1 - a.x0) * (a.y1 - a.y0) AS s, (b.x1 - b.x0) * (b.y1 - b.y0) AS t FROM b a JOIN b ON a.k = b.k AND a.n < b.n)
SELECT k, one, two, round(i / (s + t - i)::DOUBLE, 6) AS iou FROM p WHERE i > 0 AND i / (s + t - i)::DOUBLE >= 0.3""")
def iou_pairs(spark, read):
    return boxes.iou_pairs(_boxes(read), ["k"], "n", "bbox", 0.3).withColumn("iou", six("iou"))


@query(f"""WITH {_BOXES} SELECT k, n, (x0 + x1) / 2.0 / 100 BETWEEN 0.2 AND 0.6 AND (y0 + y1) / 2.0 / 70 BETWEEN 0.1 AND 0.5 AS hit FROM b""")
def region_hits(spark, read):
    return _boxes(read).select("k", "n", G.in_region(F.col("bbox"), (0.2, 0.1, 0.6, 0.5), 100.0, 70.0).alias("hit"))


@query(f"""WITH {_BOXES} SELECT k, n, CASE WHEN (x1 - x0) * (y1 - y0) >= 1.25 * avg((x1 - x0) * (y1 - y0)) OVER (PARTITION BY k) THEN 'good' ELSE 'partial' END AS readability FROM b""")
def readability_label(spark, read):
    from pyspark.sql import Window

    size = G.area(F.col("bbox"))
    return _boxes(read).select("k", "n", G.readability(size, F.avg(size).over(Window.partitionBy("k"))).alias("readability"))


@query()
def enrich_runs(spark, read):
    """A day's orders of a customer are the frames of a scene; the part's last digit is the text read."""
    orders = read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("scene_id"))
    d = _boxes(read).join(orders, "k").select("scene_id", F.col("k").alias("frame_number"), F.col("n").alias("det"), F.concat(F.lit("T"), (F.col("p") % 5).cast("string")).alias("text"), F.lit(1.0).alias("confidence"), "bbox")
    return boxes.enriched(d, ["scene_id"])


@query()
def track_link(spark, read):
    orders = read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("scene_id"))
    return boxes.linked_tracks(_boxes(read).join(orders, "k").select("scene_id", F.col("k").alias("frame_number"), F.col("n").alias("det"), "bbox"), ["scene_id"])


@query()
def box_suppression(spark, read):
    return boxes.suppressed(_boxes(read).select("k", F.col("n").alias("det"), "bbox", F.col("l_quantity").alias("score")), ["k"], "score", 0.3)


@query()
def tolerance_groups(spark, read):
    return boxes.running_mean_groups(read("lineitem").select("l_orderkey", "l_quantity"), ["l_orderkey"], "l_quantity", 5.0)


# --- appearance --------------------------------------------------------------------------------------------------


@query("""SELECT "column", value, count(*)::BIGINT AS n FROM (SELECT 'lang' AS "column", lang AS value FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 'toxic', toxic::VARCHAR FROM documents JOIN labels USING (doc_id)) GROUP BY ALL""")
def appearance_summary(spark, read):
    return appearance.status_summary(read("documents").join(read("labels"), "doc_id"), ["lang", "toxic"])


def _persons(read) -> DataFrame:
    return read("lineitem").select(F.col("l_orderkey").alias("scene_id"), (F.col("l_suppkey") % 3).alias("person_count"), (1 - F.col("l_discount") * 6).alias("confidence"), F.col("_metadata.file_path").alias("file_"), F.col("_metadata.row_index").alias("row_"))


@query("""
WITH f AS (SELECT l_orderkey AS scene_id, l_suppkey % 3 AS pc, 1 - l_discount * 6 AS conf FROM lineitem),
c AS (SELECT scene_id, pc, count(*) AS n FROM f GROUP BY ALL),
m AS (SELECT scene_id, pc AS person_count, (count(*) OVER (PARTITION BY scene_id)) > 1 AS count_variance FROM c QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY n DESC, pc) = 1),
a AS (SELECT scene_id, avg(conf) FILTER (pc > 0) AS confidence, count(*)::BIGINT AS n_frames FROM f GROUP BY 1)
SELECT scene_id, person_count, count_variance, round(confidence, 6) AS confidence, n_frames, CASE WHEN person_count <= 0 THEN 'no_person' WHEN coalesce(confidence, 0) < 0.5 THEN 'low_conf' ELSE 'ok' END AS status FROM m JOIN a USING (scene_id)""")
def scene_rollup(spark, read):
    return appearance.scene_rollup(_persons(read), ["file_", "row_"]).withColumn("confidence", six("confidence"))


@query("""
WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_returnflag AS t, (l_partkey % 4)::VARCHAR AS key FROM lineitem),
a AS (SELECT o_orderkey AS o, (o_custkey % 4)::VARCHAR AS raw, o_orderpriority AS mapped FROM orders)
SELECT l.o AS scene_id, l.n::BIGINT AS det, CASE WHEN a.raw = l.key THEN mapped END AS mapped_complete_text, false AS added FROM l LEFT JOIN a ON a.o = l.o
UNION ALL
SELECT a.o, NULL, mapped, true FROM a WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.o = a.o AND l.key = a.raw)""")
def ocr_frame_join(spark, read):
    d = read("lineitem").select(F.col("l_orderkey").alias("scene_id"), F.lit(0).alias("frame_number"), F.col("l_linenumber").cast("bigint").alias("det"), (F.col("l_partkey") % 4).cast("string").alias("text"))
    a = read("orders").select(F.col("o_orderkey").alias("scene_id"), F.lit(0).alias("frame_number"), (F.col("o_custkey") % 4).cast("string").alias("raw_text"), F.lit(None).cast("string").alias("ocr_raw_text"), F.col("o_orderpriority").alias("mapped_complete_text"), F.lit("complete").alias("text_kind"), F.lit(1.0).alias("mapping_confidence"), F.lit(True).alias("enrich_applied"), F.array(F.lit(0)).alias("bbox"))
    return timeline.frame_payload(d, a).select("scene_id", "det", "mapped_complete_text", "added")
