"""Tables dealt over files and blocks give what one kernel over all rows gives."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from framelight.llm import language
from framelight.operators import boxes, ensemble, graph
from framelight.plans import queries


def test_rollup_sums_in_the_order_of_the_table(spark, tmp_path):
    """Orders whose mean is one half but for rounding: the status is that of the sum in the order of the rows."""
    r = np.random.default_rng(0)
    six = [d for d in r.integers(6, 11, (4000, 6)) if (100 - 6 * d).sum() == 300][:60]
    keys, discounts = np.tile(np.arange(len(six)), 6), np.array(six).T.ravel() / 100
    (tmp_path / "lineitem.parquet").mkdir()
    for i, part in enumerate(np.array_split(np.arange(len(keys)), 6)):
        pq.write_table(pa.table({"l_orderkey": keys[part], "l_suppkey": np.ones(len(part), np.int64), "l_discount": discounts[part]}), tmp_path / f"lineitem.parquet/part-{i}.parquet")
    want = {}
    for k in range(len(six)):
        total = 0.0
        for d in discounts[keys == k]:
            total += 1 - d * 6
        want[k] = "ok" if total / 6 >= 0.5 else "low_conf"
    assert len(set(want.values())) == 2
    assert {x.scene_id: x.status for x in queries.QUERIES["scene_rollup"](spark, str(tmp_path)).collect()} == want


def test_pair_statistics_by_blocks(spark):
    """Several blocks, a repeated ordinal, a vector without length and one with a null give what all pairs give, and no join makes the pairs."""
    r = np.random.default_rng(1)
    vecs = [v.tolist() for v in r.normal(0.2, 1, (90, 5))]
    vecs[7], vecs[8], vecs[9] = [0.0] * 5, [1.0, None, 2.0, 0.0, 0.0], None
    rows = [(i if i != 41 else 40, i % 2, v) for i, v in enumerate(vecs)] + [(90, None, vecs[0]), (None, 1, vecs[0])]
    out = graph.pair_statistics(spark.createDataFrame(rows, "o long, g int, v array<double>"), "g", "o", "v", block=20)
    unit = {i: np.zeros(5) if v is None or None in v or not any(v) else np.array(v) / np.linalg.norm(v) for i, v in enumerate(vecs)}
    for got in out.collect():
        c = [unit[i] @ unit[j] for i in range(90) for j in range(90) if (i % 2, j % 2) == (got.one, got.two) and rows[i][0] != rows[j][0]]
        assert (got["mean"], got.least, got.most, got.deviation) == pytest.approx((np.mean(c), np.min(c), np.max(c), np.std(c)))
    assert out.count() == 3
    assert "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastNestedLoopJoin BuildRight, Cross", "")


def plain_quality(x, label):
    d, n, m = ensemble.distances(x), len(x), max(label) + 1
    own = [d[i][(label == label[i]) & (np.arange(n) != i)] for i in range(n)]
    b = np.array([min(d[i][label == c].mean() for c in range(m) if c != label[i]) for i in range(n)])
    a = np.array([v.mean() if len(v) else 0.0 for v in own])
    silhouette = np.mean([(b[i] - a[i]) / max(a[i], b[i]) if len(own[i]) else 0 for i in range(n)])
    middle = np.array([x[label == c].mean(0) for c in range(m)])
    spread = [np.linalg.norm(x[label == c] - middle[c], axis=1).mean() for c in range(m)]
    bouldin = np.mean([max((spread[c] + spread[e]) / np.linalg.norm(middle[c] - middle[e]) for e in range(m) if e != c) for c in range(m)])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    within = np.mean([np.mean([1 - unit[i] @ unit[j] for i in np.flatnonzero(label == c) for j in np.flatnonzero(label == c) if i != j]) for c in range(m) if (label == c).sum() > 1])
    return silhouette, bouldin, within


@pytest.mark.parametrize("block", [1, 16, 1000])
def test_cluster_quality_by_blocks(spark, block):
    """A cluster over several blocks, small ones in one block, one of a single sample, noise, a video of noise only."""
    r = np.random.default_rng(2)
    label = np.array([0] * 40 + [1] * 9 + [2] * 5 + [3] + [4] * 20)
    x = r.normal(0, 1, (len(label), 4)) + 3 + label[:, None]
    rows = [(0, v.tolist(), int(c)) for v, c in zip(x, label, strict=True)] + [(0, [9.0] * 4, -1), (0, [9.0] * 4, None), (1, [1.0] * 4, -1), (2, [1.0, 0.0, 0.0, 0.0], 3), (2, [0.0, 1.0, 0.0, 0.0], 3), (None, [1.0] * 4, 0)]
    table = spark.createDataFrame(rows, "video int, vec array<double>, cluster int").repartition(3)
    got = {r.video: tuple(r)[1:] for r in ensemble.cluster_quality(table, ["video"], block).collect()}
    assert got[0] == pytest.approx(plain_quality(x, label))
    assert got[1] == got[None] == (None, None, None) and got[2][:2] == (None, None) and got[2][2] == pytest.approx(1)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_eps_by_blocks(spark, metric):
    x = np.random.default_rng(3).normal(1, 1, (80, 4))
    rows = [(0, v.tolist()) for v in x] + [(1, x[0].tolist()), (2, x[0].tolist()), (2, x[1].tolist())]
    for block in (3, 16, 1000):
        got = {r.video: r.eps for r in ensemble.suggested_eps(spark.createDataFrame(rows, "video int, vec array<double>"), ["video"], 5, metric, block).collect()}
        assert got == pytest.approx({0: ensemble.elbow_eps(x, metric=metric), 1: 0.5, 2: ensemble.elbow_eps(x[:2], metric=metric)})


def test_suppression_of_many_frames(spark, monkeypatch):
    """Frames of one, some and many boxes, more than a batch holds, and null keys; no group goes to a kernel of its own."""
    r = np.random.default_rng(4)
    frames = [*np.repeat(range(400), 5).tolist(), *[400] * 150, *[None] * 7, 401]
    rows = []
    for det, k in enumerate(frames):
        a, b = (int(v) for v in r.integers(0, 40, 2))
        rows.append((k, det % 90, [a, b, a + int(r.integers(1, 40)), b + 20], None if det % 50 == 0 else float(r.integers(0, 9))))
    want = []
    for k in set(frames):
        kept = []
        for row in sorted((x for x in rows if x[0] == k), key=lambda x: (x[3] is None, -(x[3] or 0), x[1], x[2])):
            if all(boxes.overlap(row[2], other[2]) <= 0.3 for other in kept):
                kept.append(row)
        want += kept
    monkeypatch.setattr(boxes, "TOGETHER", 30)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        out = boxes.suppressed(spark.createDataFrame(rows, "k int, det int, bbox array<int>, score double"), ["k"], "score", 0.3)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["int", "double"])
def test_suppression_sends_keys_and_sides_only(spark, kind):
    """Python says which rows stay; other columns never leave Spark, filters stay above, and boxes may lack sides or be below 0."""
    r = np.random.default_rng(5)
    number, rows = {"int": int, "double": float}[kind], []
    for det in range(900):
        a, b, w = (int(v) for v in r.integers((-30, -30, 1), (30, 30, 40)))
        rows.append((det % 7 if det < 700 else 99, str(det % 2), det, [number(v) for v in (a, b, a + w, b + 20)], float(r.integers(0, 9)), f"n{det}"))
    want = []
    for frame in {x[:2] for x in rows}:
        kept = []
        for row in sorted((x for x in rows if x[:2] == frame), key=lambda x: (-x[4], x[2])):
            if all(boxes.overlap(row[3], other[3]) <= 0.3 for other in kept):
                kept.append(row)
        want += kept
    odd = [(5_000 + i % 2, None, i, box, 1.0, None) for i, box in enumerate([None, None, [], [number(1)] * 3, [number(0), None, number(9), number(9)]])]
    table = spark.createDataFrame([*rows, *odd], f"k int, camera string, det int, bbox array<{kind}>, score double, note string")
    out = boxes.suppressed(table, ["k", "camera"], "score", 0.3)
    assert out.schema == table.schema and sorted(map(tuple, out.collect()), key=repr) == sorted([*want, *odd], key=repr)
    assert sorted(map(tuple, out.where("score > 2 and det % 3 = 0").collect()), key=repr) == sorted((x for x in want if x[4] > 2 and x[2] % 3 == 0), key=repr)
    sent = next(line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "ArrowEvalPython" in line)
    assert "note" not in sent and "score" not in sent and "det#" not in sent


def test_language_fit_collects_no_vocabulary_as_rows(spark, monkeypatch):
    """Words and n-grams come to the driver as Arrow tables; only the languages come as rows."""
    docs = spark.createDataFrame([(i, " ".join(f"word{chr(97 + j)}{chr(97 + i)}" for j in range(26)) * 2, "en" if i % 2 else "de") for i in range(20)], "doc_id long, text string, lang string")
    seen, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: seen.append(out := collect(self)) or out)
    model = language.fit(docs)
    assert model.languages == ["de", "en"] and len(model.words) > 100 and max(map(len, seen)) <= 2
