"""Association of words with the catalog, and the text timeline of each camera."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions.text import UNKNOWN_TOKEN, fold, plausible, truthy
from framelight.sources.tables import kept

#: Gates of a partial match: letters in common, share of the token, share of the text from its start and elsewhere.
LEAST_BLOCK, TOKEN_SHARE, START_SHARE, INNER_SHARE = 3, 0.5, 0.5, 0.6
#: Places in a token or text are below this.
LONGEST = (1 << 21) - 1


def partial_matches(tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """token, mapped, confidence, from distinct tokens (token) and texts (complete_text, ord), both distinct.

    The best text by the share of it that the longest common block covers; of equals the first by ord. A block
    must hold TOKEN_SHARE of the token, so only the token's longer substrings are looked up among those of the
    texts, by an equi-join on the substring: no token meets the whole catalog. The longest block counts, of equals
    the one that ends first in the token, at its first place in the text.
    """
    # A row becomes hundreds here, so few bytes are much work: small partitions must not be put together.
    n = max(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), tokens.sparkSession.sparkContext.defaultParallelism)
    t = tokens.repartition(n, "token").select("token", fold(F.col("token")).alias("t_")).where(F.length("t_") >= LEAST_BLOCK)
    c = catalog.repartition(n, "complete_text").select("complete_text", "ord", fold(F.col("complete_text")).alias("c_")).where(F.length("c_") >= LEAST_BLOCK)
    need = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.length("t_") * TOKEN_SHARE).cast("int"))
    t = t.withColumn("need_", need).withColumn("i_", F.explode(F.sequence(F.lit(1), F.length("t_") - F.col("need_") + 1)))
    t = t.withColumn("n_", F.explode(F.sequence(F.col("need_"), F.length("t_") - F.col("i_") + 1)))
    t = t.select("token", "n_", (F.col("i_") + F.col("n_")).alias("end_"), F.col("t_").substr(F.col("i_"), F.col("n_")).alias("s_"))
    c = c.withColumn("i_", F.explode(F.sequence(F.lit(1), F.length("c_") - LEAST_BLOCK + 1)))
    c = c.withColumn("n_", F.explode(F.sequence(F.lit(LEAST_BLOCK), F.length("c_") - F.col("i_") + 1)))
    c = c.groupBy("complete_text", "ord", F.length("c_").alias("size_"), F.col("c_").substr(F.col("i_"), F.col("n_")).alias("s_")).agg(F.min("i_").alias("start_"))
    # Length, end and start in one number of 21 bits each, so the largest is found by hash aggregation.
    packed = F.shiftleft(F.col("n_").cast("bigint"), 42) + F.shiftleft(LONGEST - F.col("end_").cast("bigint"), 21) + (LONGEST - F.col("start_"))
    block = t.join(c, "s_").groupBy("token", "complete_text", "ord", "size_").agg(F.max(packed).alias("b_"))
    share = F.shiftright("b_", 42) / F.col("size_")
    at_start = F.col("b_").bitwiseAND(LONGEST) == LONGEST - 1
    ok = share >= F.when(at_start, START_SHARE).otherwise(INNER_SHARE)
    first = F.max_by(F.struct(F.col("complete_text").alias("mapped"), share.alias("confidence")), F.struct(share, -F.col("ord")))
    return block.where(ok).groupBy("token").agg(first.alias("m_")).select("token", "m_.mapped", "m_.confidence")


def associated(words: DataFrame, catalog: DataFrame) -> DataFrame:
    """words (raw_text and any columns) with text_kind, mapped_complete_text, mapping_confidence and reason.

    An approved text of the same letters, three at least and plausible, is complete (1.0); else the best partial
    match holds; what matches nothing has text_kind null and a reason: unk_or_empty, unapproved where the catalog
    has the text, or no_match. Of texts that differ in case only the last one counts. Tokens are matched once each.
    """
    texts = catalog.withColumn("key_", fold(F.col("complete_text")))
    approved = texts.where(truthy(F.col("approved"))).groupBy("key_").agg(F.max_by("complete_text", "ord").alias("exact_"), F.min("ord").alias("ord"))
    listed = texts.select("key_").distinct().withColumn("listed_", F.lit(True))
    raw = F.col("raw_text")
    blank = raw.isNull() | (F.trim(raw) == "") | (raw == UNKNOWN_TOKEN)
    tokens = kept(words.where(~blank).select(raw.alias("token")).distinct())
    partial = partial_matches(tokens, approved.select(F.col("exact_").alias("complete_text"), "ord"))
    looked = tokens.withColumn("key_", fold(F.col("token"))).join(approved.select("key_", "exact_"), "key_", "left").join(listed, "key_", "left").join(partial, "token", "left")
    exact = F.col("exact_").isNotNull() & (F.length("token") >= LEAST_BLOCK) & plausible(F.col("token"))
    looked = looked.select("token", F.when(exact, "complete").when(F.col("mapped").isNotNull(), "partial").alias("text_kind"), F.when(exact, F.col("exact_")).otherwise(F.col("mapped")).alias("mapped_complete_text"), F.when(exact, F.lit(1.0)).otherwise(F.col("confidence")).alias("mapping_confidence"), "listed_")
    looked = kept(looked)  # a row for each distinct token, used below filters of any kind
    out = words.join(looked, words["raw_text"] == looked["token"], "left")
    reason = F.when(blank, "unk_or_empty").when(F.col("text_kind").isNotNull(), None).when(F.col("listed_"), "unapproved").otherwise("no_match")
    return out.withColumn("reason", reason).drop("token", "listed_")


def timeline(rows: DataFrame, durations: DataFrame) -> DataFrame:
    """One row per camera, kind, text and mapped text: durations, frame ranges, counts and dominant readability.

    rows: camera_id, scene_id, frame_number, raw_text, text_kind, mapped_complete_text, readability_label,
    enrich_applied, ord. durations: scene_id, frame_number, duration_sec. Each scene frame pays its seconds once
    to a camera and mapped text, to complete rows before partial ones and to these in their order. Presence
    counts distinct frame numbers; a frame can count as good and as partial.
    """
    said = rows.where("text_kind is not null").withColumn("text", F.when(F.col("text_kind") == "complete", F.col("mapped_complete_text")).otherwise(F.col("raw_text")))
    claim = Window.partitionBy("camera_id", "mapped_complete_text", "scene_id", "frame_number").orderBy(F.when(F.col("text_kind") == "complete", 0).otherwise(1), "ord")
    paid = said.withColumn("claim_", F.row_number().over(claim)).join(durations, ["scene_id", "frame_number"], "left")
    seconds = F.when(F.col("claim_") == 1, F.coalesce("duration_sec", F.lit(0.0))).otherwise(F.lit(0.0))
    keys = ["camera_id", "text_kind", "text", "mapped_complete_text"]
    # One aggregate for each frame first, so a text's ranges are made of distinct frames.
    good = F.coalesce(F.col("readability_label") == "good", F.lit(False))
    per_frame = paid.groupBy(*keys, "frame_number").agg(F.sum(seconds).alias("s_"), F.max(good).alias("g_"), F.max(~good).alias("p_"), F.max(F.coalesce("enrich_applied", F.lit(False))).alias("e_"))
    island = F.col("frame_number") - F.row_number().over(Window.partitionBy(*keys).orderBy("frame_number"))
    spans = per_frame.withColumn("i_", island).groupBy(*keys, "i_").agg(F.min("frame_number").alias("lo_"), F.max("frame_number").alias("hi_"), F.sum("s_").alias("s_"), F.count("*").alias("n_"), F.count_if("g_").alias("g_"), F.count_if("p_").alias("p_"), F.count_if("e_").alias("e_"))
    text = F.when(F.col("lo_") == F.col("hi_"), F.col("lo_").cast("string")).otherwise(F.concat_ws("-", F.col("lo_").cast("string"), F.col("hi_").cast("string")))
    out = spans.groupBy(*keys).agg(F.sum("s_").alias("total_duration_sec"), F.array_sort(F.collect_list(F.struct("lo_", text.alias("t")))).alias("r_"), F.sum("n_").alias("n_frames_present"), F.sum("g_").alias("n_frames_good"), F.sum("p_").alias("n_frames_partial"), F.sum("e_").alias("n_frames_enriched"))
    return out.select(*keys, "total_duration_sec", F.array_join(F.col("r_.t"), ";").alias("frame_ranges"), "n_frames_present", "n_frames_good", "n_frames_partial", "n_frames_enriched", F.when(F.col("n_frames_good") >= F.col("n_frames_partial"), "good").otherwise("partial").alias("dominant_readability"))


def summary(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """Totals over a timeline: rows of each kind, seconds, presence, cameras, approved texts."""
    totals = lines.agg(F.count_if(F.col("text_kind") == "complete").alias("n_complete"), F.count_if(F.col("text_kind") == "partial").alias("n_partial"), F.coalesce(F.sum("total_duration_sec"), F.lit(0.0)).alias("total_sec"), F.coalesce(F.sum("n_frames_present"), F.lit(0)).alias("presence_events"), F.count_distinct("camera_id").alias("n_cameras"))
    return totals.crossJoin(catalog.agg(F.count_if(truthy(F.col("approved"))).alias("n_approved")))  # one row by one row


def first_equal(rows: DataFrame, others: DataFrame, on: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """rows with the columns of the first of others that agree on `on`, else null."""
    w = Window.partitionBy(*on).orderBy(*order)
    firsts = others.withColumn("r_", F.row_number().over(w)).where("r_ = 1").select(*on, *columns)
    return rows.join(firsts, on, "left")


def with_fallback(rows: DataFrame, exact: DataFrame, on: list[str], coarse: DataFrame, by: list[str], column: str, default: str) -> DataFrame:
    """rows with `column` from exact by `on`, else from coarse by `by`, else the default."""
    one = rows.join(exact.select(*on, F.col(column).alias("one_")), on, "left")
    two = one.join(coarse.select(*by, F.col(column).alias("two_")), by, "left")
    return two.withColumn(column, F.coalesce("one_", "two_", F.lit(default))).drop("one_", "two_")


def frame_payload(detections: DataFrame, associations: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Detections of frames with their associations, then enriched associations with a box that no detection shows.

    detections: scene_id, frame_number, det, text; repeated rows stay, blank texts go. associations: scene_id,
    frame_number, raw_text, ocr_raw_text, mapped_complete_text, text_kind, mapping_confidence, enrich_applied, bbox and
    what `order` names. A detection takes an association of its text, else an enriched one whose OCR text it is;
    complete ones, enriched ones and higher confidences come first, then `order`. An enriched association with a box is
    added where the same record was not taken and its text is not shown in the frame; of equal texts the first.
    """
    keys = ["scene_id", "frame_number"]
    record = ["raw_text", "mapped_complete_text", "bbox", "enrich_applied", "ocr_raw_text"]
    a = associations.withColumn("enrich_applied", F.coalesce("enrich_applied", F.lit(False))).where("raw_text is not null")
    rank = F.struct(F.when(F.col("text_kind") == "complete", 0).otherwise(1), F.when(F.col("enrich_applied"), 0).otherwise(1), -F.coalesce("mapping_confidence", F.lit(0.0)), *(order or ["raw_text", "mapped_complete_text"]))
    said = F.struct(*record, "text_kind", "mapping_confidence")
    best = lambda rows, text, name: rows.groupBy(*keys, fold(F.col(text)).alias("key_")).agg(F.min_by(said, rank).alias(name))
    d = detections.where(F.trim("text") != "").withColumn("key_", fold(F.trim("text")))
    shown = d.join(best(a, "raw_text", "one_"), [*keys, "key_"], "left").join(best(a.where("enrich_applied and ocr_raw_text <> ''"), "ocr_raw_text", "two_"), [*keys, "key_"], "left")
    shown = shown.withColumn("m_", F.coalesce("one_", "two_"))
    taken = shown.where("m_ is not null").select(*keys, "m_").distinct()
    # What an enriched record adds: not the record that was taken, not a text that is shown.
    rest = a.where(F.col("enrich_applied") & F.col("bbox").isNotNull()).withColumn("key_", fold(F.col("raw_text"))).alias("r")
    same = [F.col(f"r.{k}") == F.col(f"t.{k}") for k in keys] + [F.col(f"r.{c}").eqNullSafe(F.col(f"t.m_.{c}")) for c in record]
    rest = rest.join(taken.alias("t"), same, "left_anti").join(d.select(*keys, "key_").distinct(), [*keys, "key_"], "left_anti")
    first = F.struct(*(order or ["mapped_complete_text", "ocr_raw_text"]))
    rest = rest.groupBy(*keys, "key_").agg(F.min_by(said, first).alias("m_"))
    values = [F.col("m_.mapped_complete_text"), F.col("m_.text_kind"), F.col("m_.mapping_confidence"), F.col("m_.enrich_applied")]
    out = shown.select(*keys, "det", "text", *values, F.lit(False).alias("added"))
    return out.unionByName(rest.select(*keys, F.lit(None).cast(d.schema["det"].dataType).alias("det"), F.col("m_.raw_text").alias("text"), *values, F.lit(True).alias("added")))
