"""op8: held-out rows, a plain version of fit and score, and odd texts."""

import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from framelight.llm import language

SF = "/root/testdata/sf0.01"


def plain_words(text):
    out, now = [], ""
    for c in text or "":
        kind = unicodedata.category(c)[0]
        if kind == "L" or kind == "M" and now:
            now += c
        elif now:
            out.append(now.lower())
            now = ""
    return out + ([now.lower()] if now else [])


def plain_model(rows):
    """Word and n-gram tables by language from all rows that aren't held out."""
    words = defaultdict(Counter)
    for doc, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(str("" if doc is None else doc).encode()) % 4 != 2:
            words[lang].update(plain_words(text))
    grams = defaultdict(lambda: defaultdict(float))
    for lang, counts in words.items():
        for w, n in counts.items():
            padded = f"^{w}$"
            for size in (1, 2, 3, 4):
                for i in range(len(padded) - size + 1):
                    grams[padded[i : i + size]][lang] += 1 + math.log(n)
    grams = {g: v for g, v in grams.items() if sum(v.values()) >= 3}
    return sorted(w for w in words if words[w]), words, grams


def plain_scores(text, model):
    langs, words, grams = model
    seen = {x: 1 + sum(n for n in words[x].values() if n > 1) for x in langs}
    mass = {(x, size): 50 + sum(v.get(x, 0) for g, v in grams.items() if len(g) == size) for x in langs for size in (1, 2, 3, 4)}
    known = {w for x in langs for w, n in words[x].items() if n > 1}
    total, found = dict.fromkeys(langs, 0.0), plain_words(text)
    for w in found:
        padded = f"^{w}$"
        for x in langs:
            if w in known:
                n = words[x][w]
                total[x] += math.log(((n if n > 1 else 0) + 0.01) / seen[x])
                continue
            parts = []
            for i in range(len(padded)):
                for size in (4, 3, 2, 1):
                    g = padded[i : i + size]
                    if len(g) == size and g in grams:
                        parts.append(math.log((grams[g].get(x, 0) + 0.5) / mass[x, size]) + math.log(0.4) * (4 - size))
                        break
                else:
                    parts.append(math.log(1e-7) + math.log(0.4) * 3)
            total[x] += sum(parts) / len(parts)
    if not found or not langs:
        return "und", 0.0
    total = {x: v / math.sqrt(len(found)) for x, v in total.items()}
    best = max(langs, key=lambda x: total[x])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = language.op8_language_id(spark, SF).collect()
    assert len(got) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    said = [(langs[r.doc_id], r.lang_pred) for r in got if r.held_out and langs[r.doc_id] is not None]
    assert len(said) > 100 and np.mean([a == b for a, b in said]) > 0.98


def test_against_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text[:400] if r.text else r.text, r.lang) for r in docs.collect()][:60]
    rows += [(1000, "Ünïcode wörter e\u0301te\u0301 naïve", "xx"), (1001, "½ ² Ⅷ ①", "xx"), (1002, None, "xx"), (1003, "\u0301 \u0301x", None), (None, "null doc id text", "yy"), (1004, "日本語 テキスト", "ja"), (1004, "日本語 テキスト", "ja"), (1005, "x", "ja")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, plain = language.fit(table), plain_model(rows)
    assert model.languages == plain[0]
    got = list(language.Identifier(model)([t for _, t, _ in rows]))
    for (_, text, _), (lang, score) in zip(rows, got):
        want = plain_scores(text, plain)
        assert (lang, score) == (want[0], pytest.approx(want[1], abs=1e-6)), text


def test_odd_texts(spark):
    rows = [(1, "the cat and the dog", "en", 5, "x"), (1, "the cat and the dog", "en", 5, "x"), (11, "die Katze und der Hund " * 5, "de", 5, "x"), (2, None, None, 5, "x"), (3, "½ ² Ⅷ ①", "en", 5, "x"), (4, "12 %%", None, 5, "x"), (7, "", None, 5, "x"), (None, "the dog", None, 5, "x"), (8, "der " * 50_000, None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, lang_pred string")
    got = language.identify(docs, language.fit(docs)).collect()
    said = sorted(((r.doc_id, r.lang_pred) for r in got), key=repr)
    assert said == sorted([(1, "en"), (1, "en"), (11, "de"), (2, "und"), (3, "und"), (4, "und"), (7, "und"), (None, "en"), (8, "de")], key=repr)
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in got)
    none = docs.limit(0)
    model = language.fit(none)
    assert language.identify(none, model).count() == 0 and list(language.Identifier(model)(["abc"])) == [("und", 0.0)]
