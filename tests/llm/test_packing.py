import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import documents, odd_texts, words
from tokenizers import Tokenizer

from meetmart.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_tokenizers_library(tokenizer):
    encoder = packing.ByteLevel(PATH)
    texts = [t or "" for _, t in odd_texts()] + ["a<|endoftext|>b <|endoftext|>", " " * 700 + "x", "don't  WE'LL\n\n\n x "]
    texts += [f"a{c}b {c} c1{c} {c}{c}" for c in map(chr, [*range(1, 0x500), *range(0x2000, 0x2070)])]
    for text in texts:
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:40])


@pytest.mark.parametrize("extra", [False, True])
def test_every_id_lies_in_exactly_one_place(spark, tokenizer, extra):
    rows = odd_texts() + [(100 + k, " ".join(words(k, random.Random(k).randrange(1, 900)))) for k in range(120)]
    got = packing.pack_documents(documents(spark, rows, extra), PATH).collect()
    want = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for s in range(0, len(ids), 1024):
            part = np.array(ids[s : s + 1024], "<u4")
            want[i, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    check_sequences(got, 0.05)


def check_sequences(rows, most_padding):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    used = padded = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        used += end
        padded += 0 if end & (end - 1) == 0 else 1024 - end
    assert padded <= most_padding * (used + padded)


def test_lengths_that_most_pieces_share(spark):
    rows = [(k, 0, 300 if k % 3 else 724, 0) for k in range(3000)]
    parts = spark.createDataFrame(rows, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint")
    got = packing.pack(parts).collect()
    assert len(got) == 3000
    check_sequences(got, 0.2)
    assert len({(r.sequence_id, r.offset) for r in got}) == 3000


def test_plan_uses_up_the_histogram():
    pick = random.Random(5)
    for scale in (1, 40):
        histogram = Counter(pick.randrange(1, 1025) for _ in range(2000))
        histogram = {k: v * scale for k, v in histogram.items()}
        used = Counter()
        for lengths, times in packing.plan(histogram):
            assert sum(lengths) <= 1024 and times > 0
            for n in lengths:
                used[n] += times
        assert used == Counter(histogram)
    assert packing.plan({}) == []


def test_nnls_agrees_with_projected_gradient():
    lengths = np.array([2, 3, 5, 6, 8, 10, 11, 13])
    columns = packing.combinations(lengths, 16)
    target = np.zeros(17)
    target[lengths] = [4, 9, 7, 3, 8, 2, 5, 6]
    matrix = np.zeros((17, len(columns)))
    for j, column in enumerate(columns):
        np.add.at(matrix[:, j], column[column > 0], 1)
    x = packing.nnls(columns, target, 500)
    y = np.zeros(len(columns))
    step = 1 / np.linalg.norm(matrix, 2) ** 2
    for _ in range(50_000):
        y = np.maximum(0, y - step * (matrix.T @ (matrix @ y - target)))
    assert (x >= 0).all()
    assert np.linalg.norm(matrix @ x - target) <= np.linalg.norm(matrix @ y - target) + 0.05


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []
