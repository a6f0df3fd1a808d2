"""Scalar expressions on boxes [x0, y0, x1, y1], vectors and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(box: Column) -> Column:
    return F.greatest(box[2] - box[0], F.lit(0)) * F.greatest(box[3] - box[1], F.lit(0))


def center(box: Column) -> Column:
    return F.struct(((box[0] + box[2]) / 2).alias("x"), ((box[1] + box[3]) / 2).alias("y"))


def iou(one: Column, two: Column) -> Column:
    """Intersection over union; disjoint or empty boxes give 0."""
    width = F.least(one[2], two[2]) - F.greatest(one[0], two[0])
    height = F.least(one[3], two[3]) - F.greatest(one[1], two[1])
    both = F.greatest(width, F.lit(0)) * F.greatest(height, F.lit(0))
    union = area(one) + area(two) - both
    return F.when((both > 0) & (union > 0), both / union).otherwise(F.lit(0.0))


def scaled(box: Column, factor: float) -> Column:
    """Every coordinate times the factor, rounded half to even."""
    return F.transform(box, lambda x: F.bround(x * F.lit(factor)).cast("int"))


def padded(box: Column, by: int, width: int, height: int) -> Column:
    """The box grown on every side, within the picture."""
    return F.array(F.greatest(box[0] - by, F.lit(0)), F.greatest(box[1] - by, F.lit(0)), F.least(box[2] + by, F.lit(width)), F.least(box[3] + by, F.lit(height)))


def moved(box: Column, x: Column, y: Column) -> Column:
    return F.array(box[0] + x, box[1] + y, box[2] + x, box[3] + y)


def in_region(box: Column, region: tuple[float, float, float, float], width: float, height: float) -> Column:
    """Whether the box's centre lies in a rectangle given in shares of the picture, edges included."""
    at = center(box)
    return (at["x"] / width).between(region[0], region[2]) & (at["y"] / height).between(region[1], region[3])


def dot(one: Column, two: Column) -> Column:
    return F.aggregate(F.zip_with(one, two, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(one: Column, two: Column) -> Column:
    """Cosine similarity; 0 where a vector has no length."""
    norm = F.sqrt(dot(one, one)) * F.sqrt(dot(two, two))
    return F.when(norm > 0, dot(one, two) / norm).otherwise(F.lit(0.0))


def unit(vector: Column) -> Column:
    norm = F.sqrt(dot(vector, vector))
    return F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def readability(box_area: Column, mean_area: Column, factor: float = 1.25) -> Column:
    """good from `factor` times the frame's mean area on, else partial; a mean of 0 makes all good."""
    return F.when(box_area >= F.lit(factor) * mean_area, "good").otherwise("partial")


def verdict(same_cluster: Column, association: Column, threshold: float, margin: float = 0.1) -> Column:
    """same_cluster, would_link, borderline or split."""
    return F.when(same_cluster, "same_cluster").when(association >= threshold, "would_link").when(F.abs(association - threshold) <= margin, "borderline").otherwise("split")
