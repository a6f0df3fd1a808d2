"""Secrets in texts: fixed patterns, and random strings that a byte-pair vocabulary can't shorten."""

from __future__ import annotations

import base64
import bisect
import functools
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import table

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
#: A random string: so long at least, of so few characters a token.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CHARS_PER_TOKEN = 2.0
#: Digests and identifiers that are random but no secrets: UUIDs, hexadecimal digests, integrity hashes.
KNOWN = re.compile(r"(?:[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}|[0-9a-f]+|[0-9A-F]+|sha(?:1|256|384|512)[-=][A-Za-z0-9+/]+=*|[0-9_=-]+)\Z")


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def find_secrets(text: str, vocabulary: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; ends are exclusive, both in code points.

    Base spans are those of assign, access and hex, leftmost and non-overlapping within each kind. A random span
    is added where a run, without the signs at its ends, overlaps no base span, is no known digest or identifier and
    has fewer than CHARS_PER_TOKEN characters a token. Spans of different kinds may overlap; those that begin at the
    same place stand in the order of KINDS.
    """
    base = []
    if ":" in text or "=" in text:
        base += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    longest = max(map(len, text.split()), default=0)
    if longest >= 16 and "AKIA" in text:
        base += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if longest >= 32:
        base += [(*m.span(), 2) for m in HEX.finditer(text)]
    out = list(base)
    if longest >= 20:
        base.sort()
        starts, ends = [s for s, _, _ in base], [0, *itertools.accumulate((e for _, e, _ in base), max)]
        for m in RUN.finditer(text):
            run = m[0].strip("=-_/+")
            start = m.start() + m[0].find(run)
            end = start + len(run)
            if len(run) >= 20 and not KNOWN.match(run) and ends[bisect.bisect_left(starts, end)] <= start:
                if len(run) < CHARS_PER_TOKEN * len(_encoding(vocabulary).encode_ordinary(run)):
                    out.append((start, end, 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def scan(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and secrets, an array of (start, end, kind), of every whole text of docs (doc_id, text).

    Null and empty texts have no secrets; null and repeated doc_ids and rows are kept as they are, other columns are
    not read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            found = [[{"start": s, "end": e, "kind": k} for s, e, k in find_secrets(x.as_py() or "", vocabulary)] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "secrets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, secrets array<struct<start: long, end: long, kind: string>>")


def redacted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """docs with every secret in text replaced by its kind in angle brackets; overlapping spans become one.

    Keeps all rows and columns; n_chars follows the new text where the text changed. Null texts stay null.
    """
    at, schema = docs.columns.index("text"), docs.schema

    def clean(text: str | None) -> str | None:
        spans = find_secrets(text, vocabulary) if text else []
        out, end = [], 0
        for s, e, kind in spans:
            if s >= end:
                out += [text[end:s], f"<{kind}>"]
            end = max(end, e)
        return "".join(out) + text[end:] if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([clean(x.as_py()) for x in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([new if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest of the base spans and all spans; a row per row, null texts have none."""
    import public_tokenizers

    found = scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    said = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"), number("random"))
