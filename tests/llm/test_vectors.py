"""op1 and op9: against plain versions, with several cells, ties, nulls, odd lengths and repeated rows."""

import numpy as np
import pytest

from framelight.llm import knn, vector_dedup

EMBEDDINGS = "vec_id long, embedding array<float>, label int, path string, cell int, chunk int, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if y is None else float(y) for y in x], y, "p", 1, 2, 3) for i, x, y in rows], EMBEDDINGS)


def best(rows, k):
    """Every query against every row."""
    whole = [(i, [int(np.floor(256 * float(np.float32(y)))) for y in x]) for i, x, _ in rows if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)]
    out = set()
    for q, a in {i: a for i, a in whole if i % 50 == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def odd_rows():
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).round(1), i % 3) for i in range(180)]
    rows += [(300 + i, [0.5, 0.5, 0, 0, 0, 0], 1) for i in range(12)]  # ties
    rows += [(400, [0.0] * 6, 0), (401, None, 0), (402, [1.0, None, 0, 0, 0, 0], 0), (403, [float("nan")] * 6, 0), (404, [float("inf"), 0, 0, 0, 0, 0], 0), (405, [], 0), (450, [1.0, 2.0], 0), (500, [0.1] * 9, 0), (None, [1.0] * 6, 0), (10, [0.1] * 6, None)]
    return rows


def test_knn_against_all_pairs(spark):
    rows = odd_rows()
    vectors = knn.whole_vectors(table(spark, rows))
    asked = vectors.where("vec_id % 50 = 0")
    assert {tuple(x) for x in knn.top_k(vectors, asked, 5).collect()} == best(rows, 5)
    few = rows[:3]
    assert {tuple(x) for x in knn.top_k(knn.whole_vectors(table(spark, few)), knn.whole_vectors(table(spark, few)).where("vec_id % 50 = 0"), 5).collect()} == best(few, 5)
    none = knn.whole_vectors(table(spark, rows[:1])).limit(0)
    assert knn.top_k(none, none, 5).count() == 0 and knn.top_k(vectors, none, 5).count() == 0


def test_knn_of_repeated_rows(spark):
    rows = odd_rows()[:120] + [(60, [9.0] * 6, 0)] * 8
    vectors = knn.whole_vectors(table(spark, rows))
    got = knn.top_k(vectors, vectors.where("vec_id = 50"), 5).collect()
    assert [r.vec_id for r in got if r["rank"] <= 5].count(60) in (0, 5)
    whole = [(i, [int(np.floor(256 * float(np.float32(y)))) for y in x]) for i, x, _ in rows]
    mine = next(a for i, a in whole if i == 50)
    assert sorted(-r.score for r in got) == sorted(-sum(x * y for x, y in zip(mine, b)) for i, b in whole if i != 50)[:5]


def test_knn_sends_only_what_is_needed(spark):
    r = np.random.default_rng(6)
    middles = r.normal(size=(16, 24))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    rows = [(i, middles[i % 16] + r.normal(size=24) * 0.03, 0) for i in range(1600)]
    vectors = knn.whole_vectors(table(spark, rows))
    asked = vectors.where("vec_id % 4 = 0")
    join = knn.VoronoiJoin(vectors, asked, 5, group_queries=25, chunk_rows=100)
    home = join.needed_rows(join.home_routes())
    floors = join.solve(home).groupBy("query_id").agg({"score": "min"}).toDF("query_id", "floor")
    # The least of every chunk's five best is a floor too, if a low one.
    sent = home.count() + join.needed_rows(join.other_routes(floors.selectExpr("query_id", "cast(floor as double) floor"))).count()
    groups = join.grouped.select("group").distinct().count()
    assert groups >= 8 and sent < 0.3 * groups * len(rows)
    plain = {(q, k, i, s) for q, k, i, s in map(tuple, knn.top_k(vectors, asked, 5).collect())}
    x = np.floor(256 * np.array([np.float32(v).astype(float) for _, v, _ in rows]))
    scores = x[::4] @ x.T
    scores[np.arange(400), np.arange(0, 1600, 4)] = -np.inf
    order = np.lexsort((np.broadcast_to(np.arange(1600), scores.shape), -scores), axis=1)[:, :5]
    assert plain == {(4 * q, k + 1, int(i), int(scores[q, i])) for q in range(400) for k, i in enumerate(order[q])}


def linked(rows, least=0.93):
    """Every pair; rows alike are one vector, rows of one vec_id are one node."""
    good = lambda x: x is not None and len(x) and all(y is not None and np.isfinite(y) for y in x) and any(x)
    once = {(i, y, tuple(float(np.float32(z)) for z in x)) for i, x, y in rows if i is not None and y is not None and good(x)}
    links, root = {v: 0 for v in once}, {i: i for i, _, _ in rows}
    pairs = []
    for a in once:
        for b in once:
            if a != b and a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2]), np.array(b[2])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    pairs.append((a[0], b[0]))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    out = []
    for i, x, y in rows:
        key = (i, y, tuple(float(np.float32(z)) for z in x)) if i is not None and y is not None and good(x) else None
        out.append((i, links.get(key, 0), root[i], i is not None and root[i] == i))
    return sorted(out, key=repr)


def close_rows():
    r = np.random.default_rng(8)
    middles = r.normal(size=(60, 10))
    rows = [(i, middles[i % 60] + r.normal(size=10) * 0.18, i % 60 % 2) for i in range(420)]
    rows += [(1000 + i, middles[0], 0) for i in range(15)]  # copies
    rows += [(2000, None, 0), (2001, [0.0] * 10, 0), (2002, [float("nan")] * 10, 0), (2003, [None] * 10, 0), (2004, [], 0), (2005, middles[0], None), (2006, [1.0, 0.0], 0), (2007, [1.0, 0.01], 0), (None, middles[0], 0)]
    rows += [(5, rows[5][1], rows[5][2])]  # repeated row
    rows += [(2100, middles[3], 1), (2100, middles[5], 1)]  # one vec_id, two vectors
    return rows


@pytest.mark.parametrize("cell_rows", [8, 4096])
def test_near_vectors_against_all_pairs(spark, cell_rows):
    rows = close_rows()
    got = sorted((tuple(x) for x in vector_dedup.near_vectors(table(spark, rows), cell_rows=cell_rows).collect()), key=repr)
    assert got == linked(rows)


def test_cells_are_several_and_lose_no_link():
    x = vector_dedup._unit([v for _, v, _ in close_rows()[:420]])
    centre = vector_dedup.spherical_kmeans(x, 12)
    assert 6 <= len(centre) <= 12 and np.allclose((centre * centre).sum(1), 1)
    cells = vector_dedup.cells_of(x, centre, float(np.sqrt(2 - 2 * 0.93)))
    for a, b in zip(*np.nonzero(x @ x.T >= 0.93)):
        assert cells[b][0] in cells[a]
    assert sum(len(c) > 1 for c in cells) > 0  # visitors
    assert np.mean([len(c) for c in cells]) < 0.8 * len(centre)


def test_labels_of_64_vectors_have_two_cells(spark):
    found = vector_dedup.fit_centres(table(spark, close_rows()[:420] + [(i, [1.0, i], 7) for i in range(20)]).selectExpr("vec_id", "cast(label as bigint) label", "cast(embedding as array<double>) v"))
    assert {k for k in found} == {(0, 10), (1, 10)} and all(len(c) >= 2 for c in found.values())


def test_near_vectors_of_empty_table(spark):
    assert vector_dedup.near_vectors(table(spark, close_rows()[:1]).limit(0)).count() == 0
