"""Scalar text expressions: tokens, folding, plausibility, longest common substrings, labels."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_TOKEN = "UNK"


def fold(text: Column) -> Column:
    """Case-insensitive key of a text; sharp s counts as ss."""
    return F.regexp_replace(F.lower(text), "ß", "ss")


def tokenize(line: Column) -> Column:
    """Runs of ASCII letters, digit groups joined by hyphens, and digit runs, in order."""
    return F.regexp_extract_all(line, F.lit(r"([A-Za-z]+|\d+(?:-\d+)+|\d+)"), 1)


def strip_edges(word: Column) -> Column:
    """Takes punctuation off both ends, but keeps hyphens and underscores."""
    return F.regexp_replace(word, r"^[^\p{L}\p{N}_-]+|[^\p{L}\p{N}_-]+$", "")


def split_country(word: Column, codes: list[str]) -> Column:
    """[name, CODE] where a word of letters ends with one of the upper-case codes and leaves two letters, else [word]."""
    tail = F.substring(F.upper(word), -3, 3)
    head = F.substring(word, F.lit(1), F.length(word) - 3)
    hit = word.rlike(r"^\p{L}+$") & (F.length(word) > 4) & tail.isin(codes)
    return F.when(hit, F.array(head, tail)).otherwise(F.array(word))


def plausible(word: Column) -> Column:
    """At least two characters, of which six in ten are letters or digits."""
    kept = F.length(F.regexp_replace(word, r"[^\p{L}\p{N}]", ""))
    return (F.length(word) >= 2) & (kept / F.length(word) >= 0.6)


def truthy(value: Column) -> Column:
    """true, 1, yes and y count as true, whatever the case; null counts as false."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("true", "1", "yes", "y"), F.lit(False))


def common_block(token: Column, whole: Column) -> Column:
    """struct(length, start): the longest substring of token found in whole; start counts from 0 within whole.

    Of equal ones the first by its place in token counts; nothing in common gives (0, 0).
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(token), F.lit(1)))
    pieces = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(i, F.greatest(F.length(token), F.lit(1))), lambda j: F.struct((j - i + 1).alias("length"), (-j).alias("last"), (F.instr(whole, F.substring(token, i, j - i + 1)) - 1).alias("start")))))
    hits = F.filter(pieces, lambda p: p["start"] >= 0)
    best = F.array_max(hits)
    found = (F.length(token) > 0) & best.isNotNull()
    return F.when(found, F.struct(best["length"].cast("int").alias("length"), best["start"].cast("int").alias("start"))).otherwise(F.struct(F.lit(0).alias("length"), F.lit(0).alias("start")))


def subsequence_length(one: pd.Series, two: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of each pair; null counts as empty."""

    def length(a: str, b: str) -> int:
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    return pd.Series([length(a or "", b or "") for a, b in zip(one, two, strict=True)], dtype="int32")


def subsequence_length_udf():
    """The Arrow-batched column function of subsequence_length()."""
    return F.pandas_udf(subsequence_length, "int")


def normalized_signature(signature: Column) -> Column:
    """The primary colour: what stands after a count and before the first comma."""
    return F.lower(F.trim(F.split(F.regexp_replace(F.coalesce(signature, F.lit("")), r"^\s*\d+\s*:", ""), ",")[0]))


def camera_name(cluster: Column) -> Column:
    """cam_N of a cluster; noise has none."""
    return F.when(cluster >= 0, F.concat(F.lit("cam_"), cluster.cast("string")))


def display_text(raw: Column, mapped: Column) -> Column:
    """`raw → mapped`, or one of them where they agree but for case or one is missing."""
    same = fold(raw) == fold(mapped)
    return F.when(mapped.isNull() | (mapped == "") | same, F.coalesce(raw, mapped)).when(raw.isNull() | (raw == ""), mapped).otherwise(F.concat(raw, F.lit(" → "), mapped))


def path_ids(path: Column) -> Column:
    """struct(scene_id, frame_number) of a file name that holds scene_N_frame_M, else nulls."""
    number = lambda k: F.regexp_extract(path, r"(?i)scene_(\d+)_frame_(\d+)", k).try_cast("int")
    return F.struct(number(1).alias("scene_id"), number(2).alias("frame_number"))


def model_tokens(answer: Column) -> Column:
    """The words that a picture model says: a JSON object's tokens or words, alone or within text, else runs of
    letters, digits and hyphens; trimmed, without empty ones."""
    whole = F.trim(F.coalesce(answer, F.lit("")))
    schema = "struct<tokens: array<string>, words: array<string>>"
    inner = F.regexp_extract(whole, r"(?s)(\{.*\})", 1)
    read = lambda text: F.from_json(text, schema, {"mode": "PERMISSIVE"})
    said = lambda x: F.when(F.size(x["tokens"]) > 0, x["tokens"]).when(F.size(x["words"]) > 0, x["words"])
    is_object = F.get_json_object(F.when(inner != "", inner), "$").isNotNull()
    plain = F.regexp_extract_all(whole, F.lit(r"([A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)"), 1)
    found = F.when(is_object, F.coalesce(said(read(inner)), F.array().cast("array<string>"))).otherwise(plain)
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


def said_seconds(seconds: Column) -> Column:
    """A duration for people: ms below a second, s below a minute, else m:ss or h:mm:ss."""
    whole = F.bround(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    minutes, rest = F.floor(whole / 60), whole % 60
    long = F.when(minutes < 60, F.concat_ws(":", minutes.cast("string"), two(rest))).otherwise(F.concat_ws(":", F.floor(minutes / 60).cast("string"), two(minutes % 60), two(rest)))
    return F.when(seconds < 1, F.concat(F.bround(seconds * 1000).cast("long").cast("string"), F.lit(" ms"))).when(seconds < 60, F.concat(F.format_number(seconds, 2), F.lit(" s"))).otherwise(long)


def padded_words(words: Column, unread: Column, needed: Column) -> Column:
    """words, and UNK for each unread crop, one at least, where a reading was needed."""
    return F.when(needed, F.concat(words, F.array_repeat(F.lit(UNKNOWN_TOKEN), F.greatest(unread, F.lit(1))))).otherwise(words)
