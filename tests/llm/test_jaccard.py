import itertools
import random
import re

import pytest
from llm_cases import documents, odd_texts, words

from meetmart.llm import jaccard
from meetmart.llm.components import connected_components


def grams(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    if len(found) < 5:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4))


def brute(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[root(k)] = min(smallest.get(root(k), i), i)
    return sorted(((i, smallest.get(root(k)), links[k]) for k, (i, _) in enumerate(rows)), key=repr)


def near_copies(seed, base, count, first_id):
    pick = random.Random(seed)
    out = []
    for k in range(count):
        mine = list(base)
        for _ in range(pick.randrange(0, 5)):
            mine[pick.randrange(len(mine))] = f"changed{pick.randrange(10**6)}"
        out.append((first_id + k, " ".join(mine)))
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_agrees_with_brute_force(spark, extra):
    rows = odd_texts() + near_copies(1, words(50, 120), 40, 100) + near_copies(2, words(51, 60), 30, 200)
    rows += [(300 + k, " ".join(words(400 + k, 80))) for k in range(40)] + [(k, "short one") for k in (400, 401)]
    got = jaccard.near_duplicates(documents(spark, rows, extra)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == brute(rows)


def test_groups_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_CLASSES", 16)
    monkeypatch.setattr(jaccard, "_CALL_CLASSES", 8)
    rows = near_copies(3, words(60, 100), 90, 0) + [(200 + k, " ".join(words(60, 100))) for k in range(30)]
    got = jaccard.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == brute(rows)


def test_one_of_each_class_stays(spark):
    rows = odd_texts() + near_copies(4, words(70, 100), 20, 100)
    docs = documents(spark, rows, extra=True)
    kept = jaccard.one_of_each_class(docs)
    assert kept.columns == docs.columns
    found = brute(rows)
    want = {c for i, c, _ in found if c is not None}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == want
    texts = [r.text for r in kept.collect()]
    assert texts.count("same text in two rows") == 1 and "no id at all" in texts and None in texts


def test_bands_follow_the_recall():
    for threshold, recall in ((0.8, 0.9995), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = jaccard.choose_bands(threshold, recall, 512)
        assert 1 - (1 - threshold**rows) ** bands >= recall
        assert 1 - (1 - threshold**rows) ** (bands - 1) < recall
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.2, 0.9999, 4)


def test_both_ways_to_intersect_agree():
    import numpy as np

    random_ = np.random.default_rng(1)
    a = [np.unique(random_.integers(0, 200, 60)).astype(np.uint64) for _ in range(30)]
    x, y = np.nonzero(np.ones((30, 30), bool))
    few = jaccard._intersections(a, a, x[:1], y[:1])
    many = jaccard._intersections(a, a, np.tile(x, 200), np.tile(y, 200))[: len(x)]
    want = [len(np.intersect1d(a[i], a[j])) for i, j in zip(x, y)]
    assert many.tolist() == want and few[0] == want[0]


def test_agreement_estimates_the_similarity():
    import numpy as np

    pick = random.Random(4)
    texts = [" ".join(words(500, 400)).encode()]
    texts += [" ".join(w if pick.random() > 0.02 else "new%d" % pick.randrange(10**6) for w in words(500, 400)).encode() for _ in range(20)]
    hashed, sizes = jaccard.gram_hashes(texts)
    _, minima = jaccard.signatures(hashed, sizes, 20, 5)
    shown = jaccard._agreement(minima, minima) / 100
    sets = [grams(t.decode()) for t in texts]
    real = np.array([[len(a & b) / len(a | b) for b in sets] for a in sets])
    assert np.abs(shown - real).max() < 0.25 and (jaccard._agreement(minima[:3], minima) / 100 == shown[:3]).all()


def test_components_of_random_graphs(spark):
    pick = random.Random(9)
    for n, m in ((60, 40), (200, 150), (40, 0)):
        edges = [(pick.randrange(n), pick.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(300, 340)]
        got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
        parent = {v: v for e in edges for v in e}

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in edges:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        want = {v: root(v) for a, b in edges for v in (a, b) if a != b}
        assert got == want


def test_empty_table(spark):
    assert jaccard.near_duplicates(documents(spark, [])).collect() == []
    assert jaccard.one_of_each_class(documents(spark, [])).collect() == []


def test_texts_of_one_template_ship_no_sets(spark, monkeypatch):
    """A third of their words in common: some meet in a band, none is a near copy, and no n-gram set is fetched."""
    head = words(700, 130)
    rows = [(k, " ".join(head + words(1000 + k, 160))) for k in range(1200)]
    rows += [(5000 + k, " ".join(words(4, 200)) + f" end{k}") for k in range(3)]
    fetched, met, real, components = [], [], jaccard._with_sets, jaccard.connected_components
    monkeypatch.setattr(jaccard, "_with_sets", lambda d, m, w: (fetched.append(m.count()), real(d, m, w))[1])
    monkeypatch.setattr(jaccard, "connected_components", lambda e: (met.append(components(e)), met[-1])[1])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(documents(spark, rows)).collect()}
    assert fetched == [3] and met[0].count() > 3
    assert all(got[i] == ((5000, 2) if i >= 5000 else (i, 0)) for i, _ in rows)


def test_recall_by_similarity(spark):
    """Pairs at 0.8 and a little above, each on its own: nearly all are found, and none below."""
    pick, rows, want = random.Random(12), [], set()
    for k in range(400):
        text = words(10_000 + k, 220)
        other = list(text)
        for at in pick.sample(range(220), 4):
            other[at] = f"changed{k}x{at}"
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
        a, b = grams(rows[-2][1]), grams(rows[-1][1])
        if len(a & b) >= 0.8 * len(a | b):
            want.add(2 * k + 1)
    found = {r.doc_id for r in jaccard.near_duplicates(documents(spark, rows)).collect() if r.class_id != r.doc_id}
    assert len(want) > 100 and found <= want and len(found) >= 0.99 * len(want)


def test_the_border_of_hashes_alone():
    from math import comb

    assert jaccard.least_agreement(0.8, 100) == pytest.approx(0.6)
    below = sum(comb(100, k) * 0.8**k * 0.2 ** (100 - k) for k in range(60))
    assert below < 3e-6
    assert jaccard.least_agreement(0.5, 10) == 0.25
