import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import CLASHING, N_CLASHING, plain

from meetmart.llm import scan, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    """The trie of rebuilt conversations, with whole sequences as keys."""
    given = {}
    for c, t, role, text in rows:
        if c is not None:
            given.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {}
    for c, turns in given.items():
        content = lambda x: hashlib.sha256(f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()
        own[c] = [x[2:] for x in sorted(turns, key=lambda x: (x[0], x[1], x[2].encode(), content(x)))]
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, below, leaves = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    for key, who in members.items():
        saved = (len(who) - 1) * len(key[-1][1].encode()) if key else 0
        for d in range(len(key) + 1):
            below[key[:d]] += saved
            leaves[key[:d]] += key not in children
    out = []
    for key, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if rebuilt[c] == key)
        out.append((
            min(who), len(key), min(members[key[:-1]]) if key else None, len(who), len(children.get(key, [])), leaves[key],
            below[key], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def some(seed, convs=60, most=14, kinds=3):
    pick = random.Random(seed)
    rows = []
    for c in range(-6, convs):
        if c % 10 == 5:
            continue  # an absent base
        turns = [(c, t, pick.choice(["user", "assistant"]), "é" * pick.randrange(kinds)) for t in range(pick.randrange(1, most))]
        rows += turns
    pick.shuffle(rows)
    return rows


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, *["x"] * N_CLASHING) for r in rows], f"{SCHEMA}, {CLASHING}")
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_brute_force(spark, seed):
    rows = some(seed)
    assert plain(trie.prefix_trie(frame(spark, rows, extra=seed == 1).repartition(5))) == brute_force(rows)


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [
        (None, 1, "user", "no id"), (1, None, "user", "null turn first"), (1, 0, None, "x"), (1, 0, "", "x"), (1, 3, "user", None),
        (2, 1, "user", ""), (2, 1, "user", ""), (3, 1, "use", "r1:"), (4, 1, "user", "1:"), (5, 9, "user", long), (6, 2, "user", long),
        (-7, 1, "a", "b"), (7, 1, "a", "b"), (11, 5, "a\u0000", "😀"), (10, -3, "a", "b"), (10, 2, "a", "c"),
    ]
    assert plain(trie.prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_empty_table_has_no_root(spark):
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


@pytest.fixture
def many_tasks(spark):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "11"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_conversation_with_most_turns_spans_tasks(spark, many_tasks):
    pick = random.Random(4)
    rows = some(9, 30) + [(20, t, "user", f"{pick.randrange(4)}") for t in range(600)] + [(21, t, "user", "y") for t in range(200)]
    assert plain(trie.prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_very_many_equal_conversations(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(trie, "_PIECE_IDS", 50)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 1500) for t in range(9)]
    assert plain(trie.prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_colliding_fingerprints_are_noticed(spark, monkeypatch):
    """With powers of 1 a product is a sum, so turns in another order have the same one."""
    used, real = [], trie._bases
    monkeypatch.setattr(trie, "_bases", lambda seed: (used.append(seed), [1] * trie.LANES if seed == 5 else real(seed))[1])
    rows = [(c, t, "user", x) for c, order in enumerate(("abc", "bca", "acb", "cab") * 3) for t, x in enumerate(order)]
    assert plain(trie.prefix_trie(frame(spark, rows))) == brute_force(rows)
    assert max(used) == 6


def test_products_are_associative_and_runs_agree_with_a_loop():
    random_ = np.random.default_rng(6)
    a, b, c = random_.integers(0, trie.PRIME, (3, 50, 1 + 2 * trie.LANES))
    np.testing.assert_array_equal(trie.compose(trie.compose(a, b), c), trie.compose(a, trie.compose(b, c)))
    starts = np.repeat([0, 1, 20], [1, 19, 30])
    got = scan.running(starts, a, trie.compose)
    for k in range(50):
        want = a[starts[k] : starts[k] + 1]
        for j in range(starts[k] + 1, k + 1):
            want = trie.compose(want, a[j : j + 1])
        np.testing.assert_array_equal(got[k], want[0])
