"""op10: held-out rows, the kernel and the score by enumeration, gapped and foreign words, odd rows."""

import math
from itertools import combinations

import numpy as np
import pytest

from framelight.llm import toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score int, toxic string"


def plain_features(word):
    signs = ["\x01"] + [s for s in (toxicity.LOOKALIKE.get(c, c) for c in word.lower()) if s.isalpha()]
    out = {}
    for i, j, k in combinations(range(len(signs)), 3):
        if k - i <= 4:
            key = (signs[i], signs[j], signs[k])
            out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
    return out


def plain_kernel(one, two):
    a, b = plain_features(one), plain_features(two)
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(u, 0) for u, x in a.items()) / norm if norm else 0.0


WORDS = ["idiot", "i.d.i.o.t", "idi*ot", "1d10t", "stuupid", "$tupid", "sxtxuxpid", "table", "idiom", "2024", "150110", "a", "ab", "привет", "приветы", "日本語テキスト", "été", "ete", "", "..", "e\u0301te\u0301", "😀x😀y😀z"]


def test_kernel_by_enumeration():
    marks = ["idiot", "stupid", "привет"]
    landmarks = toxicity.Landmarks.of(marks)
    got = landmarks.like(WORDS)
    for w in WORDS:
        want = np.array([plain_kernel(w, m) for m in marks])
        if want.max() >= toxicity.FLOOR and any(c.isalpha() for c in w):
            assert got.pop(w) == pytest.approx(want), w
    assert not got
    assert plain_kernel("привет", "日本語テキスト") == 0 and {"i.d.i.o.t", "idi*ot", "1d10t", "stuupid", "приветы"} <= set(landmarks.like(WORDS))


def test_words_in_pieces():
    assert toxicity.spaced("an i d i o t here".split()) == ["idiot", "anidiot"]
    assert toxicity.spaced("say x y z".split()) == ["xyz", "xyz"] and toxicity.spaced("st up id".split()) == ["stupid"] and toxicity.spaced(["one", "a"]) == []


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_score_by_enumeration(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").limit(25).collect()] + [f"Well. You {model.landmarks.words[0]}! So {' '.join(model.landmarks.words[1])} it is. {model.landmarks.words[0][:3]}.{model.landmarks.words[0][3:]}"]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], DOCS)
    for r in toxicity.score(table, model).collect():
        low = (texts[r.doc_id] or "").lower()
        margin = {}
        for w in set(toxicity.windows(low)):
            row = np.array([plain_kernel(w, m) for m in model.landmarks.words])
            if toxicity.LETTER.search(w) and row.max() >= toxicity.FLOOR:
                margin[w] = max(model.bias, float(row @ model.landmarks.whiten @ model.weights + model.bias))
        found, left = [], set(margin)
        for sentence in toxicity.SENTENCE.split(low):
            hits = {w for t in toxicity.windows(sentence) for w in (t, t + ".", t + "!", t + "?") if w in margin}
            left -= hits
            found += [max(margin[w] for w in hits)] if hits else []
        top = [*sorted(found + [margin[w] for w in left], reverse=True)[:3], *[model.bias] * 3][:3]
        z = sum(a * b for a, b in zip(top, model.curve)) + model.curve[3]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.op10_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    hit = [r for r in got if r.predicted == 1]
    assert sum(r.toxic for r in hit) >= 0.6 * sum(r.toxic for r in got) and sum(r.toxic for r in hit) >= 0.9 * len(hit)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, f"you are an idiot number {i}. thanks" if i % 2 else f"you are a fine man number {i}. thanks", 1, "x") for i in range(60)] + [(1, "you are an idiot", 1, "x")], DOCS)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(3, 0, 1), (None, 1, 1), (4, None, 1)], "doc_id long, toxic int, text int")
    model = toxicity.fit(docs, labels)
    rows = [(1, "an idiot", 1, "x"), (1, "an idiot", 1, "x"), (None, "id1ot!", 1, "x"), (2, None, 1, "x"), (3, "", 1, "x"), (4, "fine " * 60_000 + "i d i o t", 1, "x"), (5, "fine", 1, "x")]
    got = {(r.doc_id, round(r.score, 9)) for r in toxicity.score(spark.createDataFrame(rows, DOCS), model).collect()}
    score = dict(got)
    assert len(got) == 6 and all(0 <= s <= 1 for s in score.values())
    assert score[2] == score[3] == score[5] < toxicity.THRESHOLD <= min(score[1], score[None], score[4])
    none = toxicity.fit(docs, labels.limit(0))
    assert len({r.score for r in toxicity.score(spark.createDataFrame(rows, DOCS), none).collect()}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0 and toxicity.fit(docs.limit(0), labels).landmarks.words == []
