import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, odd_texts, words

from meetmart.llm import hmm


def brute_base(rows):
    def tokens(t):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]

    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (i, t), h in zip(rows, held):
        found = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in found)
        out.append((i, h, len(found), sum(counts[w] > 0 for w in found), total, base))
    return sorted(out, key=lambda r: repr(r[:4]))


def rows_of_two_kinds(n=80):
    out = []
    for k in range(n):
        pick = random.Random(k)
        pool = words(1000 + k % 2, 60)
        out.append((100 + k, " ".join(pick.choice(pool) for _ in range(pick.randrange(5, 120)))))
    return out


@pytest.mark.parametrize("known", [None, 50])
def test_base_agrees_with_brute_force(spark, monkeypatch, known):
    """Also where most words are joined instead of known to the tasks."""
    if known:
        monkeypatch.setattr(hmm, "KNOWN_WORDS", known)
    rows = odd_texts() + rows_of_two_kinds()
    got = hmm.score_digest(documents(spark, rows, extra=True)).collect()
    want = brute_base(rows)
    got = sorted(got, key=lambda r: repr((r.doc_id, r.held_out, r.n_tokens, r.n_known)))
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert r.base_score == pytest.approx(w[5], rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_scores_do_not_depend_on_what_tasks_know(spark, monkeypatch):
    """Words without a symbol score alike whether their counts are broadcast or joined."""
    pick = random.Random(8)
    rows = [(k, " ".join(f"w{min(pick.randrange(9000), pick.randrange(9000))}" for _ in range(400))) for k in range(60)]
    scores = []
    for known in (hmm.KNOWN_WORDS, 7000):
        monkeypatch.setattr(hmm, "KNOWN_WORDS", known)
        scores.append({r.doc_id: r.score for r in hmm.score_digest(documents(spark, rows)).collect()})
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def small_model(symbols=hmm._FIRST_OWN + 40, seed=4):
    random_ = np.random.default_rng(seed)
    start, move = random_.random(hmm.STATES), random_.random((hmm.STATES, hmm.STATES))
    emit = random_.random((symbols, hmm.STATES))
    return hmm.Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def coded(seed, count, longest=9):
    pick = random.Random(seed)
    out = []
    for _ in range(count):
        body = [pick.choice((pick.randrange(9), hmm._FIRST_OWN + pick.randrange(40))) for _ in range(pick.randrange(longest))]
        out.append(np.array([*body, hmm._END_SYMBOL], hmm._SYMBOL).tobytes())
    return out


def forward_backward(symbols, m):
    n = len(symbols)
    a, b = np.zeros((n, hmm.STATES)), np.ones((n, hmm.STATES))
    a[0] = m.start * m.emit[symbols[0]]
    for t in range(1, n):
        a[t] = (a[t - 1] @ m.move) * m.emit[symbols[t]]
    for t in range(n - 2, -1, -1):
        b[t] = m.move @ (m.emit[symbols[t + 1]] * b[t + 1])
    return a, b, a[-1].sum()


def test_forward_and_expected_counts_agree_with_plain_recursions():
    model, texts = small_model(), coded(1, 60)
    np.testing.assert_allclose(
        hmm.likelihoods(texts, model),
        [math.log10(forward_backward(np.frombuffer(c, hmm._SYMBOL), model)[2]) for c in texts],
    )
    start, move, emit, likelihood = hmm.expected_counts(texts, model)
    assert likelihood == pytest.approx(hmm.likelihoods(texts, model).sum() * math.log(10), rel=1e-5)
    want_start, want_move, want_emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros(model.emit.shape)
    for c in texts:
        symbols = np.frombuffer(c, hmm._SYMBOL)
        a, b, p = forward_backward(symbols, model)
        gamma = a * b / p
        want_start += gamma[0]
        np.add.at(want_emit, symbols, gamma)
        for t in range(len(symbols) - 1):
            want_move += np.outer(a[t], model.emit[symbols[t + 1]] * b[t + 1]) * model.move / p
    np.testing.assert_allclose(start, want_start, rtol=1e-4)
    np.testing.assert_allclose(move, want_move, rtol=1e-4)
    np.testing.assert_allclose(emit, want_emit, rtol=1e-3, atol=1e-6)


def test_lanes_do_not_change_the_result(monkeypatch):
    model, texts = small_model(), coded(2, 50, 30)
    one = hmm.likelihoods(texts, model)
    monkeypatch.setattr(hmm, "_BLOCK_SYMBOLS", 40)
    np.testing.assert_allclose(hmm.likelihoods(texts, model), one)


def test_training_raises_the_likelihood_of_held_out_texts(spark):
    rows = rows_of_two_kinds(300)
    found = [r for r in hmm.score_digest(documents(spark, rows)).collect() if r.held_out]
    assert len(found) > 10
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    """More words get symbols where the corpus holds more; those of a minority language get states of their own."""
    monkeypatch.setattr(hmm, "FEWEST_OWN", 10)
    large, small = words(1, 60), [f"z{w}" for w in words(2, 20)]
    rows = [(k, " ".join(random.Random(k).choices(large, k=100))) for k in range(200)]
    more = [(1000 + k, " ".join(random.Random(k).choices(small, k=60))) for k in range(60)]  # 15 % of all tokens

    def counted(rows, share):
        monkeypatch.setattr(hmm, "OWN_SHARE", share)
        counts = hmm.count_tokens(documents(spark, rows), hmm.F.lit(True))
        return counts, {w.decode() for w, k in counts.known.items() if k < counts.own}

    _, few = counted(rows, 0.9)
    counts, many = counted(rows + more, 0.9)
    assert len(few) > 10 and len(many) > len(few) and many & set(small)
    total = sum(counts.count)
    assert counts.count[: counts.own].sum() >= 0.9 * total > counts.count[: counts.own - 1].sum()
    counts, every = counted(rows + more, 1.0)
    assert every == {*large, *small}
    coded = hmm.encode(documents(spark, rows + more), counts, hmm.F.lit(False))
    model = hmm.train(coded, hmm.first_model(counts), counts.total)
    share = model.emit / model.emit.sum(axis=1, keepdims=True)
    place = {w.decode(): hmm._FIRST_OWN + k for w, k in counts.known.items()}
    mine, others = (np.mean([share[place[w]] for w in pool], axis=0) for pool in (small, large))
    assert np.abs(mine - others).sum() > 1.5  # the states that emit them are others


def test_rounds_end_where_little_is_gained(spark, monkeypatch):
    rows = documents(spark, rows_of_two_kinds(120))
    counts = hmm.count_tokens(rows, hmm.F.lit(True))
    coded = hmm.encode(rows, counts, hmm.F.lit(False))
    seen, plain = [], hmm._next_model

    def noted(table, model):
        model, likelihood = plain(table, model)
        seen.append(likelihood / counts.total)
        return model, likelihood

    monkeypatch.setattr(hmm, "_next_model", noted)
    hmm.train(coded, hmm.first_model(counts), counts.total)
    gains = np.diff(seen)
    assert len(gains) > 1 and (gains[:-1] >= hmm.LEAST_GAIN).all() and gains[-1] < hmm.LEAST_GAIN
    assert (gains > -1e-3).all()
    assert hmm.train(coded, "unchanged", 0) == "unchanged"


def test_no_training_rows_and_empty_table(spark):
    alone = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    (row,) = hmm.score_digest(documents(spark, [(alone, "a b c")])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 4, 0, 0, 0.0)
    assert math.isfinite(row.score)
    assert hmm.score_digest(documents(spark, [])).collect() == []
