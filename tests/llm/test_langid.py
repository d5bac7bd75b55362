import random
import zlib

import numpy as np
import pytest
from conftest import TESTDATA
from llm_cases import documents, odd_texts
from pyspark.sql import functions as F

from meetmart.llm import langid

SYLLABLES = {"aa": "ka lo mi ta ne su ro".split(), "bb": "sch pf tz ung heit ver ge".split(), "cc": "é è ou eau ê ç oi".split()}


def text(lang, seed, n=60):
    pick = random.Random(f"{lang}{seed}")
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(n))


def labelled(n=120):
    langs = sorted(SYLLABLES)
    return [(k, text(langs[k % 3], k), langs[k % 3]) for k in range(n)]


def model_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return langid.train(docs, F.lit(True))


def test_held_out_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    found = langid.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_counts_agree_with_brute_force(spark):
    rows = labelled(30)
    got = model_of(spark, rows)
    counts = np.full((langid.BUCKETS, 3), langid._SMOOTH)
    for _, t, lang in rows:
        raw = f" {t.lower()} ".encode()
        for k in range(len(raw) - 2):
            gram = raw[k] | raw[k + 1] << 8 | raw[k + 2] << 16
            counts[(gram * 2654435761 % 2**32) >> 16, got.languages.index(lang)] += 1
    assert got.languages == ("aa", "bb", "cc")
    np.testing.assert_allclose(got.log_p, np.log(counts / counts.sum(axis=0)), rtol=1e-5)


def test_mixtures_have_the_right_languages_and_shares(spark):
    model = model_of(spark, labelled())
    half = f"{text('aa', 900, 300)} {text('bb', 901, 300)}"
    sizes = [len(text("aa", 900, 300).encode()), len(text("bb", 901, 300).encode())]
    mixed, single, third = langid.mixtures([half, text("cc", 902), half + " " + text("cc", 903, 300)], model)
    assert {lang for lang, _ in mixed} == {"aa", "bb"}
    assert dict(mixed)["aa"] == pytest.approx(sizes[0] / sum(sizes), abs=0.05)
    assert [lang for lang, _ in single] == ["cc"] and single[0][1] == pytest.approx(1)
    assert {lang for lang, _ in third} == {"aa", "bb", "cc"}


def test_em_agrees_with_a_plain_loop():
    random_ = np.random.default_rng(3)
    units = random_.normal(0, 2, (50, 3))
    sizes, starts = np.array([20, 30]), np.array([0, 20])
    share, value = langid._mix(units, starts, sizes, np.ones((2, 3)))
    for k, (a, b) in enumerate(((0, 20), (20, 50))):
        pi = np.ones(3) / 3
        for _ in range(langid.ROUNDS):
            r = np.exp(units[a:b]) * pi
            pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        np.testing.assert_allclose(share[k], pi)
        assert value[k] == pytest.approx(np.log((np.exp(units[a:b]) * pi).sum(axis=1)).sum())


@pytest.mark.parametrize("extra", [False, True])
def test_odd_texts(spark, extra):
    rows = odd_texts() + [(100 + k, f"plain words number {k} of the text") for k in range(20)]
    got = langid.language_digest(documents(spark, rows, extra)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (0, 1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[7].lang_pred == by_id[9].lang_pred == by_id[8].lang_pred == "en"
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_determined_keeps_rows_whole(spark):
    docs = documents(spark, odd_texts(), extra=True)
    kept = langid.determined(docs, model_of(spark, labelled()))
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, t in odd_texts() if langid.has_letter(t)), key=repr)


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "some text")]).withColumn("lang", F.lit(None).cast("string"))
    assert [(r.lang_pred, r.score) for r in langid.language_digest(docs).collect()] == [("und", 0.0)]
    assert langid.language_digest(documents(spark, [])).collect() == []
    nothing = langid.train(docs, F.lit(True))
    assert langid.determined(docs, nothing).count() == 1


def test_six_languages_of_one_text():
    letters = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx", "yz01"]

    def words(k, seed, n):
        pick = random.Random(f"{k}{seed}")
        return " ".join("".join(pick.choice(letters[k]) for _ in range(5)) for _ in range(n))

    counts = np.stack([langid._count([words(k, s, 400) for s in range(5)]) for k in range(7)], axis=1) + langid._SMOOTH
    model = langid.Model(tuple("abcdefg"), np.log(counts / counts.sum(axis=0)).astype(np.float32))
    sizes = [600, 500, 400, 300, 200, 150]
    ((*six,),) = langid.mixtures([" ".join(words(k, "new", n) for k, n in enumerate(sizes))], model)
    assert [lang for lang, _ in six] == list("abcdef")
    assert [share for _, share in six] == pytest.approx([n / sum(sizes) for n in sizes], abs=0.02)
    ((*one,),) = langid.mixtures([words(6, "new", 600)], model)
    assert one == [("g", 1.0)]
