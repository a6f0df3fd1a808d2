"""op2 against a plain scan: characters walked one by one, tokens by another library."""

import hashlib

import duckdb
import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

from framelight.llm import secret_scan

SF = "/root/testdata/sf0.01"
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
VALUE = set(LETTERS + LETTERS.upper() + "0123456789+/_.=-")
RUN = VALUE - {"."}


def run_of(text, at, signs):
    end = at
    while end < len(text) and text[end] in signs:
        end += 1
    return end


def assign_at(text, low, at):
    name = max((n for n in NAMES if low.startswith(n, at)), key=len, default=None)
    if name is None:
        return None
    i = at + len(name)
    spaces = lambda i: run_of(text, i, " ")
    i += i < len(text) and text[i] in "\"'"
    i = spaces(i)
    if i >= len(text) or text[i] not in ":=":
        return None
    for skip in (spaces(i + 1),):
        i = skip + (skip < len(text) and text[skip] in "\"'")
    end = run_of(text, i, VALUE)
    return (end, end - i) if end > i else None


def plain(text, tokenizer):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    spans = []
    at = 0
    while at < len(text):
        hit = assign_at(text, low, at)
        if hit and hit[1] >= 8:
            spans.append((at, 0, hit[0], "assign"))
        at = hit[0] if hit else at + 1
    at = 0
    while at < len(text):
        end = run_of(text, at + 4, set(LETTERS.upper() + "0123456789")) if text.startswith("AKIA", at) else at
        if end > at + 4:
            if end - at >= 16:
                spans.append((at, 1, end, "access"))
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run_of(text, at, set("0123456789abcdef"))
        if end - at >= 32:
            spans.append((at, 2, end, "hex"))
        at = max(end, at + 1)
    base, at = list(spans), 0
    while at < len(text):
        end = run_of(text, at, RUN)
        a, b = at, end
        while a < b and text[a] in "=-_/+":
            a += 1
        while a < b and text[b - 1] in "=-_/+":
            b -= 1
        run = text[a:b]
        if len(run) >= 20 and not secret_scan.KNOWN.match(run) and all(e <= a or s >= b for s, _, e, _ in base):
            if len(run) < 2.0 * len(tokenizer.encode(run, add_special_tokens=False).ids):
                spans.append((a, 3, b, "random"))
        at = max(end, at + 1)
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_whole_table(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = secret_scan.op2_secret_scan(spark, SF).collect()
    assert len(got) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0
    for r in got:
        want = plain(texts[r.doc_id] or "", tokenizer)
        base = [x for x in want if not x.startswith("random")]
        count = lambda kind: sum(x.startswith(kind) for x in base)
        assert (r.spans, r.n_assign, r.n_access, r.n_hex) == (",".join(want), count("assign"), count("access"), count("hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_base_counts_by_sql(spark):
    sql = r"""SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: len(x) >= 8)) AS n_assign,
        len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: len(x) >= 16)) AS n_access,
        len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: len(x) >= 32)) AS n_hex FROM '{}/documents.parquet'"""
    want = sorted(duckdb.sql(sql.format(SF)).fetchall())
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex) for r in secret_scan.op2_secret_scan(spark, SF).collect()) == want


ODD = ["password=password=abcdefgh", "SECRET : 'x' token=\"abcdefgh.\"", "api_key=short apikey==abcdefghij", "AKIAAKIA" * 3 + " AKIA", "0" * 31 + "g" + "f" * 33, "--9f2kq8z7x1m4b6v3n0c5h8j2==", "passwd='9f2kq8z7x1m4b6v3n0c5h8j2'", "tokentoken:  abcdefgh", "é" * 40 + " paſſword=abcdefgh", "", " "]


def test_odd_texts(spark, tokenizer):
    rows = [(i % 9, t, None, None) for i, t in enumerate([*ODD, None, ODD[0]])] + [(None, ODD[5], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string, run string")
    got = secret_scan.scan(docs, P.path("byte_bpe_50k.tiktoken")).collect()
    said = lambda r: (r.doc_id, ",".join(f"{x.kind}:{x.start}:{x.end}" for x in r.secrets))
    assert sorted(map(said, got), key=repr) == sorted(((i, ",".join(plain(t or "", tokenizer))) for i, t, _, _ in rows), key=repr)
    assert secret_scan.scan(docs.limit(0), P.path("byte_bpe_50k.tiktoken")).count() == 0


def test_many_spans_in_one_text():
    import time

    text = "password=abcdefgh123 " * 20_000 + " 9f2kq8z7x1m4b6v3n0c5h8j2 " * 20_000
    began = time.time()
    assert len(secret_scan.find_secrets(text, P.path("byte_bpe_50k.tiktoken"))) == 40_000 and time.time() - began < 20
