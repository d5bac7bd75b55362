"""Audit of how text filters interact: what each one removes in every order in which they can be applied.

Each document gets a mask of the filters it fails; documents are counted by part and mask. A walk over all subsets
of the filters in Gray-code order toggles one filter at a time: each mask's number of active failures goes up or
down, and the running survivors change by the masks that meet or leave zero. The 32 states it stores hold every
order: what a step removes is the difference of two of them.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import map_batches, ship, utf8
from meetmart.sources.scratch import materialized

FILTERS = "ABCDE"
LEAST_WORDS = 100
#: In percent of the words, and of the characters.
LEAST_DISTINCT, MOST_CAPITALS = 80, 10
_SYMBOL = re.compile(rb"[#$%&*|]")
_NOT_CAPITAL = bytes(sorted(set(range(256)) - set(range(0x41, 0x5B))))
_CONTINUATION = bytes(range(0x80, 0xC0))
_COPY = 1 << FILTERS.index("E")
_FIELDS = ("n", "good", "toxic")


def own_failures(raw: bytes) -> int:
    """Mask of the filters A to D that a text (UTF-8) fails; words lie between ASCII white space."""
    words = raw.split()
    points = len(raw.translate(None, _CONTINUATION))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * len(raw.translate(None, _NOT_CAPITAL)) > MOST_CAPITALS * points) << 2
        | bool(_SYMBOL.search(raw)) << 3
    )


def failures(docs: DataFrame, part: Column) -> DataFrame:
    """(doc_id, part, mask, digest) of each row: the failures of its own text, and the text's SHA-256."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        masks = pa.array([own_failures(t) for t in texts], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), masks, digests], names=["doc_id", "part", "mask", "digest"]
        )

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    return map_batches(given, rows, "doc_id bigint, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters, E (a copy) among them.

    Texts stay where they are read; only digests are shuffled. Rows of one digest are added up on the map side, by
    part and labels, before their smallest id is sought, so a text with very many copies takes no single task. A null id is
    smaller than none and larger than none: such a row is no copy. Of several labels of one id any 1 counts.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))))
        .withColumn("_spread", F.lit(0).cast("long"))
    )
    rows = failures(docs, part).groupBy("doc_id", "digest", "mask", "part").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("_spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    marked = rows.join(marks, ["doc_id", "_spread"], "left").fillna(0, ["good", "toxic"])
    by_text = marked.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    by_text = materialized(by_text, "audit")  # one row per text and labels
    least = by_text.groupBy("digest").agg(F.min("first").alias("least"))
    first = F.col("first").isNotNull() & (F.col("first") == F.col("least"))
    kept = F.col("n_null") + F.when(first, F.col("n_first")).otherwise(F.lit(0))
    split = by_text.join(least, "digest").select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), kept.alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("n") - kept).alias("n")),
            )
        ).alias("c"),
    )
    n = F.col("c.n")
    return split.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    )


def gray_walk(counts: np.ndarray) -> np.ndarray:
    """Survivors (subsets x fields) for each subset of active filters, from counts by mask (masks x fields).

    Subsets are met in Gray-code order. `active` holds for each mask how many of its filters are on.
    """
    size = len(counts)
    masks = np.arange(size)
    active, running = np.zeros(size, np.int64), counts.sum(axis=0)
    states = np.zeros_like(counts)
    states[0] = running
    subset = 0
    for step in range(1, size):
        bit = step & -step
        subset ^= bit
        touched = (masks & bit) > 0
        if subset & bit:
            active[touched] += 1
            running = running - counts[touched & (active == 1)].sum(axis=0)
        else:
            active[touched] -= 1
            running = running + counts[touched & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def orders(states: np.ndarray) -> dict[str, list]:
    """One entry per order of the filters and step, as differences of the stored states."""
    out: dict[str, list] = {k: [] for k in ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "letter")}
    everything = len(states) - 1
    shapley = dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            after = before | bit
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            shapley[letter] += removed
            row = (
                "".join(order), step, int(states[after][0]), removed, int(states[0][0] - states[bit][0]) - removed,
                int(states[everything ^ bit][0] - states[everything][0]), good, toxic, letter,
            )
            for name, value in zip(out, row):
                out[name].append(value)
            before = after
    out["shapley"] = [shapley[letter] for letter in out.pop("letter")]
    return out


def interaction_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per value of `part`, order of the five filters and step; zeros are included.

    A null part counts as the empty text, a null text is empty, and a document without labels is neither good nor
    toxic. An empty table gives no rows. A group holds at most one row per mask, whatever its documents.
    """
    ship(docs.sparkSession)

    def audit(table: pa.Table) -> pa.Table:
        counts = np.zeros((1 << len(FILTERS), len(_FIELDS)), np.int64)
        counts[table.column("mask").to_numpy()] = np.stack([table.column(f).to_numpy() for f in _FIELDS], axis=1)
        found = orders(gray_walk(counts))
        n = len(found["step"])
        kinds = {"filter_order": pa.string(), "step": pa.int32()}
        part_value = pa.array([table.column("part")[0].as_py()] * n, pa.string())
        return pa.table({"part": part_value} | {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in found.items()})

    numbers = ", ".join(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return (
        cells(docs, labels, F.col(part))
        .groupBy("part")
        .applyInArrow(audit, f"part string, filter_order string, step int, {numbers}")
    )
