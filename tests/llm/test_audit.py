import re
from itertools import permutations

import numpy as np
from llm_cases import documents, odd_texts, plain, words
from pyspark.sql import functions as F

from meetmart.llm import audit

LABELS = "doc_id bigint, quality int, toxic int"


def fails(rows):
    """Sets of failed filters, straight from their definitions."""
    out = []
    for i, text in rows:
        t = text or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(found) < 100:
            bad.add("A")
        if 100 * len(set(found)) < 80 * len(found):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u in rows):
            bad.add("E")
        out.append(bad)
    return out


def brute_force(rows, parts, good, toxic):
    out = []
    bad = fails(rows)
    for part in {p or "" for p in parts}:
        mine = [k for k, p in enumerate(parts) if (p or "") == part]
        found = []
        for order in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(order, 1):
                gone = {k for k in left if f in bad[k]}
                left -= gone
                failing = {k for k in mine if f in bad[k]}
                alone = sum(bad[k] == {f} for k in mine)
                lost = [sum(rows[k][0] in marks for k in gone) for marks in (good, toxic)]
                found.append([part, "".join(order), step, len(left), len(gone), len(failing - gone), alone, *lost, f])
        for row in found:
            f = row.pop()
            out.append((*row, sum(r[4] for r in found if r[1][r[2] - 1] == f)))
    return sorted(out, key=repr)


def cases():
    loud = " ".join(words(4, 120)).upper()
    return [
        *odd_texts(), (20, " ".join(words(2, 150))), (21, loud), (22, loud), (19, loud), (23, "a & b " * 60),
        (24, " ".join(f"w{k}" for k in range(130))), (25, " ".join(f"w{k}" for k in range(130)) + " |"), (None, "no id at all"),
    ]


def test_agrees_with_brute_force(spark):
    rows = cases()
    docs = documents(spark, rows, extra=True).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").when(F.col("doc_id") % 3 == 1, "yy"))
    parts = [None if i is None or i % 3 == 2 else "xx" if i % 3 == 0 else "yy" for i, _ in rows]
    labels = spark.createDataFrame(
        [(20, 1, 0), (21, 0, 1), (22, None, 1), (24, 1, None), (24, 0, 0), (5, 1, 1), (None, 1, 1), (99, 1, 1)], LABELS
    )
    got = plain(audit.interaction_audit(docs, labels))
    assert got == brute_force(rows, parts, {20, 24, 5}, {21, 22, 5})


def test_empty_table_gives_no_rows(spark):
    assert audit.interaction_audit(documents(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_walk_agrees_with_counting_each_subset():
    counts = np.random.default_rng(1).integers(0, 9, (32, 3))
    states = audit.gray_walk(counts)
    for subset in range(32):
        np.testing.assert_array_equal(states[subset], counts[[m for m in range(32) if not m & subset]].sum(axis=0))


def test_a_text_with_very_many_copies_is_added_up_before_the_shuffle(spark):
    """Copies in all languages: only the smallest id stays, whatever its language; rows of one id count alike."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("the very same").alias("text"), F.concat(F.lit("l"), F.col("id") % 4).alias("lang")
    )
    found = audit.cells(docs.union(docs.where("doc_id = 0")), spark.createDataFrame([], LABELS), F.col("lang"))
    got = {(r.part, r["mask"]): r.n for r in found.collect() if r.n}
    assert got == {("l0", 1): 2, ("l0", 17): 4999, ("l1", 17): 5000, ("l2", 17): 5000, ("l3", 17): 5000}
