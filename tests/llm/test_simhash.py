import hashlib
import itertools
import random

import pytest
from llm_cases import documents, odd_texts, words

from meetmart.llm import simhash


def edited(rows):
    """(id, text, edited text, next text) in the order of ids, nulls first, then texts."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        ahead = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        out.append((i, t, t[: len(t) - cut] + ahead[:cut], ahead))
    return out


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


@pytest.mark.parametrize("extra, block_rows", [(False, 256), (True, 3)])
def test_edited_texts_and_likeness(spark, monkeypatch, extra, block_rows):
    monkeypatch.setattr(simhash.in_blocks, "__defaults__", (block_rows,))
    rows = odd_texts() + [(50 + 3 * k, " ".join(words(k, 40 + k))) for k in range(60)] + [(300, " ".join(words(3, 43)))]
    got = simhash.edited_digest(documents(spark, rows, extra)).collect()
    want = edited(rows)
    shas = sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want), key=repr)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == shas
    by_id = {r.doc_id: r for r in got}
    text = {i: t for i, t, _, _ in want}
    for a, b in itertools.combinations(by_id, 2):
        if text[a] == text[b]:
            assert by_id[a].fingerprint == by_id[b].fingerprint
    for i, _, _, ahead in want:
        r = by_id[i]
        owner = next(j for j, t in text.items() if t == ahead)
        assert r.near_edited == 1 - distance(r.fingerprint, r.edited_fingerprint) / 64
        assert r.near_next == 1 - distance(r.fingerprint, by_id[owner].fingerprint) / 64
    prints = [r.fingerprint for r in got]
    assert all(r.n_near == sum(distance(r.fingerprint, p) <= simhash.RADIUS for p in prints) - 1 for r in got)


def brute_fingerprint(spark, text):
    """Votes bit by bit from the hashes Spark gives."""
    frame = spark.createDataFrame([(text,)], "text string").select(simhash.words(simhash.F.col("text")).alias("w"))
    found = frame.first().w
    if len(found) < 2:
        found = [*found, "", ""]
    pairs = list(itertools.pairwise(found))
    hashed = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "xxhash64(a, b) h").collect()
    votes = [0] * 64
    for r in hashed:
        weight = min(16, 1 + len(r.a.encode()) + len(r.b.encode()))
        for bit in range(64):
            votes[bit] += weight if r.h >> bit & 1 else -weight
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def test_votes_agree_with_brute_force(spark):
    texts = ["", "one", "a b", "the cat sat on the mat the cat sat", " ".join(words(5, 5000)), "é è ü ß x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.simhash % 2**64 for r in simhash.fingerprints(frame, ["k"]).collect()}
    assert got == {k: brute_fingerprint(spark, t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_search_finds_all_within_the_radius(spark, radius):
    pick = random.Random(radius)
    values = set()
    for _ in range(60):
        base = pick.getrandbits(64)
        values.add(base)
        for _ in range(6):
            near = base
            for _ in range(pick.randrange(8)):
                near ^= 1 << pick.randrange(64)
            values.add(near)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "simhash bigint")
    got = sorted(map(tuple, simhash.near_fingerprints(frame, radius).collect()))
    want = sorted((a, b) for a in signed for b in signed if a != b and ((a ^ b) % 2**64).bit_count() <= radius)
    assert got == want


def test_masks_cover_every_pair_within_the_radius():
    for rows in (10, 10**6, 10**12):
        masks = simhash.block_masks(rows, 3)
        for bits in itertools.combinations(range(0, 64, 5), 3):
            flipped = sum(1 << b for b in bits)
            assert any(m & flipped == 0 for m in masks)


def test_edited_texts_are_nearer_than_others(spark):
    rows = [(k, " ".join(words(k, 200))) for k in range(100)]
    got = simhash.edited_digest(documents(spark, rows)).collect()
    assert sum(r.near_edited > r.near_next for r in got) > 95


def test_no_python_in_the_plan(spark):
    plan = simhash.edited_digest(documents(spark, odd_texts()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_document_and_empty_table(spark):
    (row,) = simhash.edited_digest(documents(spark, [(5, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1 and row.n_near == 0
    assert simhash.edited_digest(documents(spark, [])).collect() == []


def test_equal_and_missing_ids_are_ordered_by_a_hash_of_the_text(spark, monkeypatch):
    """A third of the rows without an id and a third of one id spread over blocks; each row is followed by the next."""
    monkeypatch.setattr(simhash.in_blocks, "__defaults__", (4,))
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else 100 + k, " ".join(words(k, 30))) for k in range(90)]
    rows += [(7, rows[1][1])] * 3 + [(None, None), (None, "")]

    def key(row):
        i, t = row
        digest = hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).digest()
        return (i is not None, i or 0, digest)

    want, ordered = [], sorted(rows, key=key)
    for k, (i, t) in enumerate(ordered):
        t, ahead = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - cut] + ahead[:cut]).encode()).hexdigest()))
    got = simhash.edited_digest(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    frame = spark.createDataFrame([(bytes([k * 37 % 256, k]), None, k) for k in range(200)], "key binary, doc_id long, at int")
    following = {bytes(r.key): bytes(r.next_key) for r in simhash.in_blocks(frame).collect()}
    keys = sorted(following)
    assert len(keys) == 200 and all(following[a] == b for a, b in zip(keys, [*keys[1:], keys[0]]))


def test_classes_are_what_links_connect(spark):
    """Against single linkage over all pairs of fingerprints."""
    rows = []
    for family in range(12):
        base = words(family, 400)
        for copy in range(6):
            changed = list(base)
            for at in range(copy):
                changed[(at * 61 + 7) % 400] = f"other{copy}"
            rows.append((100 * family + 50 - copy, " ".join(changed)))
    rows += [(None, rows[0][1]), (2000, "alone in its class")]
    got = simhash.edited_digest(documents(spark, rows)).collect()
    classes = [{r.fingerprint} for r in got]
    for a, b in itertools.combinations({r.fingerprint for r in got}, 2):
        if distance(a, b) <= simhash.RADIUS:
            joined = [c for c in classes if a in c or b in c]
            classes = [c for c in classes if c not in joined] + [set().union(*joined)]
    for r in got:
        members = next(c for c in classes if r.fingerprint in c)
        assert r.class_id == min(o.doc_id for o in got if o.fingerprint in members and o.doc_id is not None)
    assert len({r.class_id for r in got}) < 40


def test_share_of_near_copies_within_the_radius(spark):
    """Copies with one word in 200 changed are found in more than half of the cases, unlike texts never."""
    rows = []
    for k in range(120):
        base = words(k, 200)
        changed = list(base)
        changed[100] = "changed"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(changed))]
    got = {r.doc_id: r for r in simhash.edited_digest(documents(spark, rows)).collect()}
    assert sum(got[2 * k].class_id == got[2 * k + 1].class_id for k in range(120)) > 60
    assert all(r.class_id // 2 == r.doc_id // 2 for r in got.values())
