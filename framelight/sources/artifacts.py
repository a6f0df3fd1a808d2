"""Scans of a run's artifacts: enriched or raw words, debug vectors, labelled pictures, truth, metric files, paths."""

from __future__ import annotations

import importlib.util
import io
import posixpath
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelight.operators.picks import middle_samples
from framelight.sources.tables import images, lenient_scan

#: The first bytes of the picture formats that are read.
MAGIC = {"jpeg": b"\xff\xd8\xff", "png": b"\x89PNG\r\n\x1a\n", "gif": b"GIF8", "bmp": b"BM"}
#: Libraries that a stage needs beside the engine's own.
STAGE_NEEDS = {"ocr": ("onnxruntime",), "cameras": ("numpy", "pandas"), "appearance": ("onnxruntime", "numpy")}


def processed_words(enriched: DataFrame | None, raw: DataFrame) -> DataFrame:
    """The enriched table where there is one, else the raw one."""
    return raw if enriched is None else enriched


def npz_scan(spark: SparkSession, path: str) -> DataFrame:
    """path, ord, vec, label, sample_path of every sample of NPZ files (arrays features, labels, paths; the last two may lack)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as data:
                    x = data["features"].astype(float)
                    n = len(x)
                    labels = data["labels"].astype(int).tolist() if "labels" in data else [None] * n
                    paths = [str(p) for p in data["paths"]] if "paths" in data else [None] * n
                yield pd.DataFrame({"path": name, "ord": range(n), "vec": list(x), "label": pd.array(labels, "Int64"), "sample_path": paths})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, "path string, ord long, vec array<double>, label long, sample_path string")


def npz_bytes(features: np.ndarray, labels: np.ndarray, paths: list[str]) -> bytes:
    """One video's debug artifact as the content of an NPZ file."""
    out = io.BytesIO()
    np.savez(out, features=features, labels=labels, paths=np.array(paths))
    return out.getvalue()


def checked_images(spark: SparkSession, path: str) -> DataFrame:
    """images() with kind by the first bytes, null for what is no picture, and empty; pixels are left to models."""
    head = F.substring("content", 1, 8)
    kind = F.coalesce(*[F.when(head.substr(1, len(m)) == F.lit(m), name) for name, m in MAGIC.items()])
    return images(spark, path).withColumn("kind", kind).withColumn("empty", F.length("content") == 0)


def scene_samples(spark: SparkSession, csv: str | None, directory: str, mode: str = "middle") -> DataFrame:
    """scene_id, frame_number, image_path, sample_role: the table where there is one, else the pictures' names."""
    schema = "scene_id int, frame_number int, image_path string, sample_role string"
    listed = lenient_scan(spark, csv, schema) if csv else spark.createDataFrame([], schema)
    if listed.isEmpty():
        listed = images(spark, directory).where("scene_id is not null").select("scene_id", "frame_number", F.col("path").alias("image_path"), F.lit(None).cast("string").alias("sample_role"))
    return middle_samples(listed, mode, ["frame_number", "image_path"])


def labelled_images(spark: SparkSession, path: str, aliases: dict[str, str]) -> DataFrame:
    """path, content, label (by the folder's alias, else its name in lower case) and scene_id of pictures in folders."""
    folder = F.lower(F.element_at(F.split("path", "/"), -2))
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]) if aliases else None
    label = F.coalesce(known[folder], folder) if aliases else folder
    return images(spark, path).select("path", "content", label.alias("label"), "scene_id")


def truth_scan(rows: DataFrame, pictures: DataFrame) -> DataFrame:
    """scene_id, camera_id, scene_type, image_path of the truth: trimmed cameras, a scene's middle row, else its second;
    rows without a camera or whose picture (image_path) is missing go."""
    clean = rows.withColumn("camera_id", F.trim("camera_id")).where("camera_id <> ''")
    middle = middle_samples(clean, "middle", ["image_path"])
    return middle.join(pictures.select("image_path").distinct(), "image_path", "left_semi").select("scene_id", "camera_id", "scene_type", "image_path")


def reconciled_probe(one: DataFrame, two: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """What two decoders say of a video (path, fps, frame_count, width, height): the larger numbers, and whether the rates
    differ by more than the tolerance; one decoder's word holds where the other has none."""
    both = one.alias("a").join(two.alias("b"), "path", "full")
    more = lambda c: F.greatest(F.coalesce(f"a.{c}", F.lit(0)), F.coalesce(f"b.{c}", F.lit(0))).alias(c)
    differs = F.coalesce(F.abs(F.col("a.fps") - F.col("b.fps")) > tolerance, F.lit(False)).alias("fps_differs")
    out = both.select("path", more("fps"), more("frame_count"), more("width"), more("height"), differs)
    return out.withColumn("duration_sec", F.when(F.col("fps") > 0, F.col("frame_count") / F.col("fps")).otherwise(0.0))


def metric_files(spark: SparkSession, pattern: str, name: str = r"camera_clustering_(.+)_gt\.json$") -> DataFrame:
    """method (from the file name), metrics (the JSON text) of every file that holds a JSON object; broken ones are skipped."""
    files = spark.read.text(pattern, wholetext=True).select(F.input_file_name().alias("path"), "value")
    whole = files.where(F.get_json_object("value", "$").isNotNull() & F.col("value").rlike(r"(?s)^\s*\{"))
    return whole.select(F.regexp_extract("path", name, 1).alias("method"), F.col("value").alias("metrics")).where("method <> ''")


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def relocated(path: Column, top: str, below: str = "frames/") -> Column:
    """A path of another host within this run's folder: its last part from `below` on under `top`; null where there is
    none or it climbs with .. parts."""
    tail = F.regexp_extract(F.regexp_replace(path, r"\\", "/"), f"({below}.*)$", 1)
    climbs = F.concat(F.lit("/"), tail, F.lit("/")).contains("/../")
    return F.when((tail != "") & ~climbs, F.concat(F.lit(top.rstrip("/") + "/"), tail))


def guarded(path: str, top: str) -> str:
    """The path as it is below `top`; raises where it leaves it."""
    full = posixpath.normpath(posixpath.join(top, path))
    if full != posixpath.normpath(top) and not full.startswith(posixpath.normpath(top).rstrip("/") + "/"):
        raise ValueError(f"{path} leaves {top}")
    return full


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, latest change in milliseconds) below a path, through the file system that Spark uses: a key for caches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return 0, 0
    listed, n, last = fs.listFiles(place, True), 0, 0
    while listed.hasNext():
        n, last = n + 1, max(last, listed.next().getModificationTime())
    return n, last


def preflight(stages: tuple[str, ...]) -> dict[str, list[str]]:
    """Stage to the libraries that it needs and that can't be found."""
    lost = {s: [m for m in STAGE_NEEDS.get(s, ()) if importlib.util.find_spec(m) is None] for s in stages}
    return {s: found for s, found in lost.items() if found}


def typed_scenes(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Scenes or meta data from a JSON file that holds an array or an object over several lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def montage_tiles(samples: DataFrame, order: str, most: int = 8) -> DataFrame:
    """At most `most` samples of each cluster as tiles (cluster, place, image_path); drawing them is left to the caller."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("cluster").orderBy(order)) - 1
    return samples.where("cluster >= 0").withColumn("place", place).where(F.col("place") < most).select("cluster", "place", "image_path")
