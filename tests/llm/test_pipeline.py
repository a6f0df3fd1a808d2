"""The pipeline's stages, each against a plain version on its own input."""

import re
from collections import Counter

import corpus_pipeline as C
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from framelight.llm import secret_scan
from test_mixing import brute as queue
from test_texts import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    found = [docs.collect()]
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF).cache()
        found.append(docs.collect())
        assert docs.count() == len(found[-1])
    return found


def test_language_rejects_texts_without_letters(steps):
    want = {r.doc_id for r in steps[0] if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in steps[1]} == want and all(r.lang for r in steps[1])


def test_one_of_each_near_group_stays(steps):
    rows = sorted(steps[1], key=lambda r: r.doc_id)
    groups = brute_components([r.text for r in rows], 5, 80)
    assert {r.doc_id for r in steps[2]} == {rows[i].doc_id for i, _, _, kept in groups if kept}


def test_secrets_give_way(steps):
    vocabulary, after = P.path("byte_bpe_50k.tiktoken"), {r.doc_id: r for r in steps[3]}
    assert after.keys() == {r.doc_id for r in steps[2]}
    for r in steps[2]:
        want, at = "", 0
        for start, end, kind in secret_scan.find_secrets(r.text, vocabulary):
            want, at = want + r.text[at:start] + f"<{kind}>", end
        assert after[r.doc_id].text == want + r.text[at:]


def test_mix_against_a_queue(steps):
    said = queue([(r.doc_id, r.text, r.source, None) for r in steps[3]])
    took = Counter()
    for r in steps[4]:
        took[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert dict(took) == {doc: taken for doc, _, _, _, taken in said if taken}


def test_packing_holds_every_token(steps):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for r in steps[4]:
        want[r.doc_id] += len(t.encode(r.text, add_special_tokens=False).ids) + 1
    got, used = Counter(), {}
    for r in steps[5]:
        got[r.doc_id] += r.length
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
