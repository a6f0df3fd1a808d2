"""The text catalog: discovery, upsert, suggestions and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelight.functions.text import UNKNOWN_TOKEN, fold, plausible, truthy


def discovered(tokens: DataFrame, order: list[str], scene: str, frame: str) -> DataFrame:
    """key, complete_text, first_seen_scene_id, first_seen_frame, discovery_count from tokens (token, order...).

    The first spelling of each folded token stands for it; blank, unknown and implausible ones are left out.
    """
    kept = tokens.where((F.trim("token") != "") & (F.col("token") != UNKNOWN_TOKEN) & plausible(F.col("token")))
    first = lambda c: F.min_by(c, F.struct(*order))
    return kept.groupBy(fold(F.col("token")).alias("key")).agg(first("token").alias("complete_text"), first(scene).alias("first_seen_scene_id"), first(frame).alias("first_seen_frame"), F.count("*").alias("discovery_count"))


def upserted(catalog: DataFrame, found: DataFrame, approve_new: bool = True) -> DataFrame:
    """catalog with the discoveries: counts of known texts grow, new texts come in with defaults.

    catalog: complete_text, approved, first_seen_scene_id, first_seen_frame, discovery_count and columns of the
    user, which stay. is_new tells what came in; run twice, counts grow twice.
    """
    base = ["complete_text", "approved", "first_seen_scene_id", "first_seen_frame", "discovery_count"]
    extra = [c for c in catalog.columns if c not in base]
    old = catalog.withColumn("key", fold(F.col("complete_text"))).alias("o")
    new = found.alias("n")
    joined = old.join(new, F.col("o.key") == F.col("n.key"), "full_outer")
    known = F.col("o.key").isNotNull()
    pick = lambda c: F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    count = F.coalesce("o.discovery_count", F.lit(0)) + F.coalesce("n.discovery_count", F.lit(0))
    approved = F.when(known, truthy(F.col("o.approved"))).otherwise(F.lit(approve_new)).alias("approved")
    return joined.select(pick("complete_text"), approved, pick("first_seen_scene_id"), pick("first_seen_frame"), count.alias("discovery_count"), *[F.col(f"o.{c}") for c in extra], (~known).alias("is_new"))


def suggestions(complete: DataFrame, partial: DataFrame, catalog: DataFrame) -> DataFrame:
    """text: distinct whatever the case, the first spelling from complete, then partial rows, then the approved catalog."""
    said = lambda df, c, rank: df.where(F.col(c).isNotNull() & (F.col(c) != "")).select(F.col(c).alias("text"), F.lit(rank).alias("rank_"))
    both = said(complete, "mapped_complete_text", 0).unionByName(said(partial, "mapped_complete_text", 1)).unionByName(said(catalog.where(truthy(F.col("approved"))), "complete_text", 2))
    return both.groupBy(fold(F.col("text")).alias("key")).agg(F.min_by("text", F.struct("rank_", "text")).alias("text"))


def ranked_suggestions(texts: DataFrame, needle: str, limit: int = 20) -> DataFrame:
    """The first `limit` texts that hold the needle: those that begin with it first, then by text."""
    key, part = fold(F.col("text")), fold(F.lit(needle.strip()))
    hits = texts.where(key.contains(part)) if needle.strip() else texts
    return hits.withColumn("rank_", F.when(key.startswith(part), 0).otherwise(1)).orderBy("rank_", fold(F.col("text")), "text").limit(limit).drop("rank_")


def search_rows(rows: DataFrame, needle: str) -> DataFrame:
    """Rows whose mapped text holds the needle, whatever the case; a blank needle keeps all."""
    return rows if not needle.strip() else rows.where(fold(F.col("mapped_complete_text")).contains(fold(F.lit(needle.strip()))))


def faceted(rows: DataFrame, facets: dict[str, list | None], duration: str | None = None, least: int | None = None, most: int | None = None) -> DataFrame:
    """Rows that match every facet (None: all, no values: none) and whose whole seconds lie within the bounds."""
    keep: Column = F.lit(True)
    for column, values in facets.items():
        if values is not None:
            keep = keep & (F.col(column).isin(values) if values else F.lit(False))
    if duration and (least is not None or most is not None):
        whole = F.floor(duration)
        finite = F.col(duration).isNotNull() & ~F.isnan(F.col(duration).cast("double"))
        keep = keep & finite & (whole >= F.lit(least if least is not None else -(2**53))) & (whole <= F.lit(most if most is not None else 2**53))
    return rows.where(keep)


def facet_options(rows: DataFrame, columns: list[str]) -> DataFrame:
    """facet, value: trimmed, distinct, sorted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.trim(F.col(c).cast("string")).alias("value")) for c in columns])).alias("x")
    return rows.select(pairs).select("x.*").where("value <> ''").distinct().orderBy("facet", "value")


def duration_stats(rows: DataFrame, duration: str) -> DataFrame:
    x = F.col(duration).cast("double")
    some = rows.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return some.agg(F.min(x).alias("least"), F.max(x).alias("most"), F.sum(x).alias("total"), F.floor(F.min(x)).alias("floor_least"), F.floor(F.max(x)).alias("floor_most"))


def found_row(rows: DataFrame, camera: str, mapped: str, text: str | None = None) -> DataFrame:
    """The first row of a camera and mapped text; complete rows come before partial ones."""
    keep = (F.col("camera_id") == camera) & (F.col("mapped_complete_text") == mapped)
    keep = keep & (F.col("text") == text) if text is not None else keep
    return rows.where(keep).orderBy(F.when(F.col("text_kind") == "complete", 0).otherwise(1), "ord").limit(1)


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def camera_order(name: Column) -> list[Column]:
    """Sort keys: cam_N by number, then other names, unknown last."""
    number = F.regexp_extract(name, r"^cam_(\d+)$", 1).try_cast("int")
    return [F.when(number.isNotNull(), 0).when(name == "unknown", 2).otherwise(1), number, name]
