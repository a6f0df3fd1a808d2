"""op6: against a plain queue in Python."""

import hashlib
import re
from collections import defaultdict

from framelight.llm.mixing import EPOCHS, mix, mixed_documents

SCHEMA = "doc_id long, text string, source string, size string"


def brute(rows):
    """Targets by resharing the excess again and again; then the queue, copy by copy."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows]
    by_source = defaultdict(int)
    for (_, _, s, _), n in zip(rows, sizes):
        by_source[s] += n
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, open_ = sum(sizes), {}, set(names)
    while open_:
        left, w = total - sum(target.values()), sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * by_source[s] <= weight[s] * left / w}
        if not full:
            target |= {s: weight[s] * left / w for s in open_}
            break
        target |= {s: 3.0 * by_source[s] for s in full}
        open_ -= full
    key = [int(hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16) for r in rows]
    copies = []
    for rank, s in enumerate(names):
        own = sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: (key[i], rows[i][0] is not None, rows[i][0] or 0, sizes[i]))
        cum = 0
        for epoch in range(EPOCHS):
            for i in own:
                cum += sizes[i]
                if sizes[i]:
                    copies.append((cum / target[s], rank, cum, i))
    taken, left = [0] * len(rows), total
    for _, _, _, i in sorted(copies):
        n = min(sizes[i], left)
        taken[i] += n
        left -= n
    return sorted(((r[0], n, by_source[r[2]], round(target[r[2]], 6), t) for r, n, t in zip(rows, sizes, taken)), key=repr)


def result(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=repr)


def test_against_a_queue(spark):
    rows = [(i, "w " * (i * 7 % 23), f"s{i % 5 if i % 3 else 0}", "x") for i in range(150)]
    rows += [(200, None, None, None), (201, "", None, None), (202, "a b c", None, None), (203, "hey " * 400, "s1", None), (203, "hey " * 400, "s1", None)]
    got = result(mix(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert sum(r[4] for r in got) == sum(r[1] for r in got)
    assert all(r[4] <= 3 * r[1] for r in got)


def test_small_source_stops_at_three_times_its_size(spark):
    rows = [(i, "w " * 50, "a", "") for i in range(40)] + [(100, "x y", "b", ""), (101, "z", "c", "")]
    got = {r.doc_id: r for r in mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[100].target, got[100].taken, got[101].target, got[101].taken) == (6.0, 6, 3.0, 3)
    assert result(mix(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_no_words_and_no_rows(spark):
    assert result(mix(spark.createDataFrame([(1, None, "a", ""), (2, " ", "b", "")], SCHEMA))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents_as_often_as_taken(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i % 9)), f"s{i % 4}", "x") for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    words = defaultdict(int)
    for r in mixed_documents(docs).collect():
        words[r.doc_id] += len(r.text.split())
    assert dict(words) == {r.doc_id: r.taken for r in mix(docs).collect() if r.taken}


def test_rows_alike_keep_their_own_copies(spark):
    rows = [(None, f"u{i} v{i} w{i}", "a", "x") for i in range(7)] + [(5, f"p{i}", "a", "x") for i in range(5)] + [(i, "k " * (i % 4 + 1), f"s{i % 3}", "x") for i in range(10, 40)]
    want = sorted(t for doc, n, _, _, taken in brute(rows) if doc in (None, 5) for t in [n] * (taken // n) + [taken % n] * (taken % n > 0))
    got = [r for r in mixed_documents(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id in (None, 5)]
    assert sorted(len(r.text.split()) for r in got) == want
    texts = {t for _, t, _, _ in rows}
    assert sum(r.text not in texts for r in got) <= 1
    assert sum(len(r.text.split()) for r in mixed_documents(spark.createDataFrame(rows, SCHEMA)).collect()) == sum(len(t.split()) for _, t, _, _ in rows)
    # Two rows of which one fits: whole, not both by halves.
    two = [(1, "a b", "a", "x"), (1, "c d", "a", "x"), (2, "e f g h", "b", "x"), (3, "i j", "b", "x")]
    mixed = mixed_documents(spark.createDataFrame(two, SCHEMA)).collect()
    assert sorted(len(r.text.split()) for r in mixed if r.doc_id == 1) == sorted(t for doc, _, _, _, taken in brute(two) if doc == 1 for t in [2] * (taken // 2) + [1] * (taken % 2))
