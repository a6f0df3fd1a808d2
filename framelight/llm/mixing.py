"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelight.llm.common import cut, table, words_in

#: Copies of a document that a mix may take at most.
EPOCHS = 3
#: Rows of one source that are put in order within one task.
RUN_ROWS = 100_000


def _shuffle_key(doc_id: Column) -> Column:
    """60 bits of an MD5: the shuffled order, the same in every run and in SQL."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh 1, 2, 3, 1, 2, ...; targets share the sum of the sizes by weight and
    stop at EPOCHS times their source's size. The excess goes to the others by weight, again and again: sources
    in the order of cap over weight fill up one after the other, so one running sum finds the water level.
    The level rises up to the first source that does not fill up and falls after it. The table has a row per
    source, however many documents these hold. Sources without words get target 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * EPOCHS)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = ranked.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    water = F.coalesce(F.max(F.when(~F.col("full"), F.col("level"))).over(whole), F.lit(0.0))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * water)
    return leveled.withColumn("target", target).select("source", F.col("rank").cast("long").alias("rank"), "source_size", "target")


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, source, size, source_size, target, taken.

    size is the number of words, null text has none. Each source's documents stand in an order shuffled by a
    hash of doc_id, EPOCHS times over; a copy's virtual finish time is the source's words up to its end over the
    source's target. Copies are range-sorted by that time, equal ones by source and place, and the order is cut
    when the sum of all sizes is reached; the copy at the cut is taken in part. Null doc_ids, null sources and
    repeated rows are rows like others; without words everything is 0.
    """
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(F.col("text")).alias("size"), _shuffle_key(F.col("doc_id")).alias("h")))
    sizes = cut(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")).select("source", "source_size")))
    most = sized.groupBy("source").count().agg(F.max("count"), F.sum("count"), ).first()
    runs = max(1, -(-(most[0] or 1) // RUN_ROWS))
    # A source is ordered in runs: ranges of the hash, each of which fits into a task.
    sized = sized.withColumn("run", F.floor(F.col("h") / (2**60 / runs)).cast("int"))
    per_run = sized.groupBy("source", "run").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_run.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("run_start"))
    starts = starts.join(sizes.withColumnRenamed("source", "s0"), F.col("s").eqNullSafe(F.col("s0"))).drop("s0")
    inside = Window.partitionBy("source", "run").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("inside", F.sum("size").over(inside))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r")))
    placed = cut(placed.select("doc_id", "source", "size", "source_size", "target", "rank", (F.col("run_start") + F.col("inside")).alias("cum")))

    epochs = F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch")
    copies = placed.where("size > 0 and target > 0").select("size", "rank", "target", "cum", "source_size", epochs)
    copies = copies.select("size", "rank", "target", (F.col("cum") + F.col("epoch") * F.col("source_size")).alias("at"))
    copies = copies.select("size", "rank", "at", (F.col("at") / F.col("target")).alias("finish"))
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    ranges = int(max(64, (most[1] or 0) // RUN_ROWS))  # virtual time spreads words evenly, so equal ranges are even
    copies = copies.withColumn("range", F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)).cast("int"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    cutting = copies.groupBy("range").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    cutting = cutting.where(F.col("upto") >= total).orderBy("range").limit(1).first()
    if not total or cutting is None:
        whole, part = F.lit(0), F.lit(0)
    else:
        left = total - (cutting["upto"] - cutting["words"])
        order = Window.orderBy("finish", "rank", "at").rowsBetween(Window.unboundedPreceding, 0)
        last = copies.where(F.col("range") == cutting["range"]).withColumn("sum", F.sum("size").over(order)).where(F.col("sum") >= left)
        last = last.orderBy("finish", "rank", "at").first()
        whole, part = F.lit(0), F.lit(0)
        for epoch in range(EPOCHS):
            at = F.col("cum") + epoch * F.col("source_size")
            mine = F.struct((at / F.col("target")).alias("finish"), F.col("rank"), at.alias("at"))
            cut_at = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["rank"]).cast("long").alias("rank"), F.lit(last["at"]).cast("long").alias("at"))
            whole = whole + F.when(mine < cut_at, F.col("size")).otherwise(0)
            part = part + F.when(mine == cut_at, F.lit(left - (last["sum"] - last["size"]))).otherwise(0)
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), whole + part).otherwise(0).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the same columns.

    The copy at the budget's end holds its first words only; documents without words are left out. Rows alike in
    doc_id, source and size stand next to each other in the order, so their sum says what each takes: in turn a
    copy each, again and again, the last in part. They are numbered by their text and other columns; rows alike
    in these too are interchangeable.
    """
    taken = mix(docs).groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("alike")).where("taken > 0")
    names = docs.columns
    joined = docs.alias("d").withColumn("size_", words_in(F.col("text"))).join(
        taken.alias("t"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("size_") == F.col("t.size")))
    joined = joined.select(*[F.col(f"d.{c}") for c in names], F.col("size_"), F.col("t.taken").alias("taken_"), F.col("t.alike").alias("alike_"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "source", "size_").orderBy("text", *[c for c in names if c not in ("doc_id", "source", "text")])) - 1
    single = joined.where("alike_ = 1").withColumn("share_", F.col("taken_"))
    several = joined.where("alike_ > 1").withColumn("nth_", nth)
    copies, words = F.expr("taken_ div size_"), F.col("taken_") % F.col("size_")
    turn = copies % F.col("alike_")
    share = F.col("size_") * (F.expr("taken_ div size_ div alike_") + (F.col("nth_") < turn).cast("long")) + F.when(F.col("nth_") == turn, words).otherwise(0)
    rows = single.unionByName(several.withColumn("share_", share).drop("nth_")).where("share_ > 0")
    copy = F.explode(F.sequence(F.lit(1), F.ceil(F.col("share_") / F.col("size_")).cast("int"))).alias("copy_")
    rows = rows.select(*names, "size_", "share_", copy)
    keep = F.col("share_") - (F.col("copy_") - 1) * F.col("size_")
    begun = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1), F.lit(1), keep.cast("int")), " ")
    text = F.when(keep >= F.col("size_"), F.col("text")).otherwise(begun)
    rows = rows.withColumn("text", text)
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*names)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document; a row per row, null texts have size 0 and null sources are one."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sized GROUP BY source),
caps AS (SELECT *, ((rank - 1) % 3 + 1)::BIGINT AS weight, source_size * 3 AS cap FROM ranked),
leveled AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER w, 0)::BIGINT)::DOUBLE
            / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT) AS level
  FROM caps WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, rank, source_size,
         CASE WHEN cap <= weight * level THEN cap::DOUBLE
              ELSE weight * coalesce((SELECT max(level) FROM leveled WHERE cap > weight * level), 0) END AS target
  FROM leveled),
placed AS (
  SELECT s.doc_id, s.source, size, h, source_size, target, rank, row_number() OVER (ORDER BY s.doc_id, h, size) AS row,
         sum(size) OVER (PARTITION BY rank ORDER BY h, s.doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT row, size, rank, target, cum + epoch * source_size AS place, (cum + epoch * source_size) / target AS finish
  FROM placed, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0 AND target > 0),
queue AS (
  SELECT row, size, sum(size) OVER (ORDER BY finish, rank, place ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM copies),
cuts AS (
  SELECT row, sum(greatest(0, least(size, (SELECT sum(size) FROM sized)::BIGINT - (upto - size))))::BIGINT AS taken
  FROM queue GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN cuts USING (row)
"""
