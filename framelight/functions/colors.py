"""Colours of the palette: nearest label of a LAB value, whether two labels go together, feature vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The LAB centre of each label of the palette, in order.
PALETTE = {
    "red": (53.0, 80.0, 67.0),
    "orange": (74.0, 48.0, 74.0),
    "yellow": (97.0, -21.0, 94.0),
    "green": (87.0, -86.0, 83.0),
    "blue": (32.0, 79.0, -108.0),
    "purple": (60.0, 98.0, -60.0),
    "white": (95.0, 0.0, 0.0),
    "black": (15.0, 0.0, 0.0),
    "neutral": (70.0, 0.0, 0.0),
}
TOLERANCE = 18.0
#: Persons that a feature vector tells apart; more count as so many.
MOST_PERSONS = 6


def lab_distance(one: Column, two: Column) -> Column:
    """Euclidean distance of two LAB arrays."""
    return F.sqrt(F.aggregate(F.zip_with(one, two, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def nearest_label(lab: Column) -> Column:
    """The palette's label nearest to a LAB array, of equals the first by place."""
    away = [F.struct(lab_distance(lab, F.array(*[F.lit(x) for x in centre])).alias("d"), F.lit(k).alias("k"), F.lit(name).alias("name")) for k, (name, centre) in enumerate(PALETTE.items())]
    return F.when(lab.isNotNull(), F.least(*away)["name"])


def labels_match(one: Column, two: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether two labels are the same or their centres nearer than the tolerance; empty, null and unknown ones match none."""
    pairs = [f"{a}|{b}" for a, x in PALETTE.items() for b, y in PALETTE.items() if sum((p - q) ** 2 for p, q in zip(x, y)) ** 0.5 < tolerance]
    given = F.coalesce(one != "", F.lit(False)) & F.coalesce(two != "", F.lit(False))
    return given & ((one == two) | F.concat_ws("|", one, two).isin(pairs))


def appearance_vector(person_count: Column, colors: Column) -> Column:
    """One-hot of the number of persons, then the shares of the palette's labels among the colours."""
    bucket = F.least(F.greatest(person_count, F.lit(0)), F.lit(MOST_PERSONS))
    known = F.filter(F.coalesce(colors, F.array().cast("array<string>")), lambda c: c.isin(*PALETTE))
    share = lambda name: F.when(F.size(known) > 0, F.size(F.filter(known, lambda c: c == name)) / F.size(known)).otherwise(F.lit(0.0))
    return F.array(*[F.when(bucket == k, F.lit(1.0)).otherwise(F.lit(0.0)) for k in range(MOST_PERSONS + 1)], *[share(name) for name in PALETTE])


def blended(visual: Column, extra: Column, weight: float, width: int) -> Column:
    """Both vectors at unit length, side by side, weighted 1 - weight and weight; without `extra` it is zeros and weighs 0."""
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)) + F.lit(1e-8)
    zeros = F.array_repeat(F.lit(0.0), width)
    if weight <= 0:
        return visual
    part = F.when(extra.isNull(), F.lit(0.0)).otherwise(F.lit(weight))
    left = F.transform(visual, lambda x: x / norm(visual) * (1 - part))
    return F.concat(left, F.coalesce(F.transform(extra, lambda x: x / norm(extra) * part), zeros))


def primary_color(pixels: Column) -> Column:
    """The label of an array of LAB pixels: that nearest to the median of each channel; null for none."""
    middle = lambda k: F.aggregate(F.slice(F.array_sort(F.transform(pixels, lambda p: p[k].cast("double"))), F.expr("1") * F.floor((F.size(pixels) + 1) / 2).cast("int"), F.lit(2) - F.size(pixels) % 2), F.lit(0.0), lambda s, x: s + x) / (2 - F.size(pixels) % 2)
    return F.when(F.size(pixels) > 0, nearest_label(F.array(middle(0), middle(1), middle(2))))
