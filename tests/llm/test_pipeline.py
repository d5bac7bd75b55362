import corpus_pipeline
import public_tokenizers
from conftest import TESTDATA
from llm_cases import documents, odd_texts
from test_jaccard import brute, near_copies
from test_packing import check_sequences
from tokenizers import Tokenizer

import __spark_entry__ as entry
from meetmart.llm import langid, pii
from meetmart.llm.queries import PII_KEY, QUERIES

SF = f"{TESTDATA}/sf0.001"


def test_stages_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    (_, language), (_, near), (_, private), (_, pack) = corpus_pipeline.STAGES
    kept = language(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = [(i, t) for i, t in rows if langid.has_letter(t)]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows)
    single = near(spark, kept, SF)
    assert single.columns == docs.columns
    stay = {c for _, c, _ in brute(rows)}
    rows = [(i, t) for i, t in rows if i in stay]
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted(rows) and len(rows) < 200
    clean = private(spark, single, SF)
    assert clean.columns == docs.columns
    made = {r.doc_id: r.text for r in pii.pii_digest(single, PII_KEY).collect()}
    rows = [(i, made[i]) for i, _ in rows]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in clean.collect()) == sorted((i, t, len(t)) for i, t in rows)
    packed = pack(spark, clean, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    assert {r.doc_id: r.doc_tokens for r in packed} == sizes
    assert sum(r.length for r in packed) == sum(sizes.values())
    check_sequences(packed, 0.05)
    run = corpus_pipeline.run(spark, SF)
    columns = [c for c in run.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(tuple, run.select(columns).collect())) == sorted(tuple(r[c] for c in columns) for r in packed)


def test_odd_rows_pass_all_stages(spark):
    docs = documents(spark, odd_texts() + near_copies(1, ["w%d" % k for k in range(60)], 6, 100), extra=True)
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == names
    assert {r.doc_id for r in docs.collect()} >= {None, 4, 5, 7, 8, 9, 10}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_empty_table_passes_all_stages(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_every_operator_is_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
