import math
import random

import numpy as np

from meetmart.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def clustered(n, width=16, clusters=6, seed=3):
    random_ = np.random.default_rng(seed)
    centers = random_.normal(size=(clusters, width))
    points = centers[random_.integers(0, clusters, n)] + 0.3 * random_.normal(size=(n, width))
    return points.astype(np.float32)


def brute(rows, k=20):
    valid = [
        (i, np.array(v, np.float64)) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, a in valid:
        if q % 20 == 0:
            scores = sorted((-ann.inner_products(a[None], b[None])[0], i) for i, b in valid if i != q)
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_against_brute_force_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 32)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(clustered(3000))]
    table = spark.createDataFrame(rows, SCHEMA)
    got, want = found(ann.neighbours_of_every_20th(table)), brute(rows)
    assert got.keys() == want.keys()
    hits = 0
    vectors = {i: np.array(v, np.float64) for i, v, _ in rows}
    for q, mine in got.items():
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert sorted(mine, key=lambda m: (-m[2], m[1])) == mine
        for _, i, score in mine:
            assert i != q and score == ann.inner_products(vectors[q][None], vectors[i][None])[0]
        hits += len({i for _, i, _ in mine} & {i for _, i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_a_lower_target_visits_fewer_leaves(spark, monkeypatch):
    points = clustered(2000, clusters=40)
    tree = ann.grow_tree(points, 16)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(points)], "vec_id bigint, vector array<float>")
    queries = rows.where("vec_id % 20 = 0")
    few, many = (ann.calibrate(rows, queries, 16, tree, 20, t) for t in (0.5, 0.99))
    assert 1 <= few < many <= tree.leaves


def test_odd_vectors_ties_and_repeated_vectors(spark):
    same, other = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(k, same, 0) for k in range(0, 60)] + [(k, other, 0) for k in range(60, 90)]
    rows += [(100, None, 0), (120, [], 0), (140, [0.0, 0.0, 0.0], 0), (160, [1.0, None, 2.0], 0), (180, [1.0, float("nan"), 0.0], 0),
             (200, [float("inf"), 0.0, 0.0], 0), (220, [1.0, 2.0], 0), (None, same, 0)]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], f"{SCHEMA}, leaf string, score string")
    want = brute([r for r in rows if r[1] != [1.0, 2.0]])
    assert found(ann.neighbours_of_every_20th(table)) == want
    assert want[0][0] == (1, 1, 14.0) and want[20][:2] == [(1, 0, 14.0), (2, 1, 14.0)]


def test_tiles_do_not_change_the_result(spark, monkeypatch):
    rows = [(k, v.tolist(), 0) for k, v in enumerate(clustered(400))]
    table = spark.createDataFrame(rows, SCHEMA)
    one = found(ann.neighbours_of_every_20th(table, target=1.0))
    monkeypatch.setattr(ann, "TILE_ROWS", 30)
    monkeypatch.setattr(ann, "TILE_QUERIES", 3)
    assert found(ann.neighbours_of_every_20th(table, target=1.0)) == one == brute(rows)


def test_every_query_has_all_its_results(spark, monkeypatch):
    """Also where one leaf is enough for the recall but holds too few rows, and where ids repeat."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 4)
    monkeypatch.setattr(ann, "calibrate", lambda *a: 1)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(clustered(120, clusters=20))]
    rows += [(20, [float(j == i) for j in range(16)], 0) for i in range(16)] + [(40, rows[40][1], 0)] * 30
    got = found(ann.neighbours_of_every_20th(spark.createDataFrame(rows, SCHEMA)))
    assert {q: len(v) for q, v in got.items()} == {q: 20 for q in range(0, 120, 20)}
    assert all(q not in {i for _, i, _ in v} for q, v in got.items())


def test_fewer_candidates_than_wanted_and_empty(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)]
    assert found(ann.neighbours_of_every_20th(spark.createDataFrame(rows, SCHEMA))) == {0: [(1, 1, 0.5), (2, 2, -1.0)]}
    assert ann.neighbours_of_every_20th(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ann.neighbours_of_every_20th(spark.createDataFrame(rows[:1], SCHEMA)).collect() == []


def test_every_point_is_in_the_leaf_of_its_nearest_children():
    points = clustered(500).astype(np.float64)
    tree = ann.grow_tree(points, 20)
    leaf = ann.leaf_of(tree, points)
    for k in range(0, 500, 25):
        node = 0
        while tree.first[node] >= 0:
            children = tree.centroids[tree.first[node] : tree.first[node] + tree.count[node]]
            node = int(tree.first[node] + np.argmin(((children - points[k]) ** 2).sum(axis=1))) + 1
        assert tree.leaf[node - 1] == leaf[k]
    assert sorted(ann.best_bins(tree, points[0], tree.leaves)) == list(range(tree.leaves))


def test_walks_side_by_side_take_leaves_in_the_order_of_the_queue():
    points = clustered(3000, clusters=30).astype(np.float64)
    tree = ann.grow_tree(points, 12, branches=4)
    way = ann.paths(tree)
    assert way.shape[1] > 3
    order = ann.walk_order(tree, points[:60], way)
    for q, mine in zip(points[:60], order):
        assert mine.tolist() == ann.best_bins(tree, q, tree.leaves)


def test_a_tile_gives_the_best_of_the_leaves_wanted():
    random_ = np.random.default_rng(5)
    rows, queries = random_.normal(size=(300, 4)), random_.normal(size=(40, 4))
    leaves, ids = random_.integers(0, 7, 300), random_.permutation(300)
    wanted = [random_.permutation(9)[: random_.integers(0, 9)].tolist() for _ in queries]
    least = np.where(random_.random(40) < 0.5, np.nan, 0.5)
    q, r, score = ann.search_tile(rows, ids, leaves, queries, np.arange(1000, 1040), wanted, least, 5)
    for n in range(40):
        want = [
            (-ann.inner_products(queries[n : n + 1], rows[m : m + 1])[0], ids[m]) for m in range(300) if leaves[m] in wanted[n]
        ]
        want = [w for w in sorted(want) if np.isnan(least[n]) or -w[0] >= least[n]][:5]
        assert [(-s, ids[m]) for m, s in zip(r[q == n], score[q == n])] == want


def test_pairs_grow_with_the_queries_and_not_with_the_leaves(spark, monkeypatch):
    """A query is sent once to a group, however many of its leaves it visits there."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 8)
    monkeypatch.setattr(ann, "GROUPS", 4)
    sent, real = [], ann._visit
    monkeypatch.setattr(ann, "_visit", lambda placed, asking, *a: (sent.append(asking.count()), real(placed, asking, *a))[1])
    rows = [(k, v.tolist(), 0) for k, v in enumerate(clustered(800, clusters=2))]
    got = found(ann.neighbours_of_every_20th(spark.createDataFrame(rows, SCHEMA), target=1.0))
    assert got == brute(rows)
    assert sent[0] == 40 and sent[1] <= 40 * 3


def test_the_target_recall_is_not_lowered():
    assert ann.TARGET_RECALL >= 0.98
    for search in (ann.nearest, ann.neighbours_of_every_20th):
        assert search.__defaults__[-1] == ann.TARGET_RECALL
