"""Packing token pieces into fixed windows by non-negative least squares over their length histogram.

A document is cut into whole windows and one shorter rest. Combinations of up to three lengths that fill a
window exactly are the columns of a non-negative least squares problem whose right side is the histogram of
the rests; the solution, rounded, says how often each combination is used. What is left is packed greedily,
the longest first. The histogram has one entry per length, so the driver's work does not grow with the data;
pieces find their place by their rank within their length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meetmart.llm.lexicon import _byte_letters
from meetmart.llm.texts import id_and_text, in_tasks
from meetmart.sources.scratch import materialized

WINDOW = 1024
END_ID = 0
#: Pieces of one length that are ranked together, about.
_RANKED_TOGETHER = 100_000
#: Rounds of the solver for each length of the window.
_SOLVER_ROUNDS = 2

# Tokens


class ByteLevel:
    """Ids of a byte-level BPE file, as the tokenizers library gives them without special tokens added.

    Ordinary texts take the faster of two libraries that give the same ids. Texts with letters beyond the
    Latin, Greek and Cyrillic blocks, control characters or very long runs without a space take the other.
    """

    _PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    _UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-ͳΑ-Ωα-ωА-я‐-‧€]")
    _RUN = 500

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = {letter: b for b, letter in enumerate(_byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(byte[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in special
        }
        self.fast = tiktoken.Encoding("byte level", pat_str=self._PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.path = path

    @cached_property
    def full(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _plain(self, text: str) -> bool:
        if not text.isascii() or not text.isprintable():
            if self._UNUSUAL.search(text):
                return False
        step = self._RUN
        return all(
            " " in (part := text[k : k + step]) and part.strip() for k in range(0, len(text) - step, step)
        )

    def ids(self, text: str) -> list[int]:
        if self._plain(text):
            return self.fast.encode(text, allowed_special="all")
        return self.full.encode(text, add_special_tokens=False).ids


@cache
def _byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) per piece: whole windows, then the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _byte_level(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4").tobytes()
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return in_tasks(docs, run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    )


# The plan, on the driver: one row per length and combination


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of up to three lengths, zero-filled, that fill a window or stand alone at a power of two."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    alone = [n for n in lengths if n & (n - 1) == 0]
    out = [np.array([[n, 0, 0] for n in alone], np.int64).reshape(-1, 3)]
    half = lengths[(2 * lengths <= window) & there[window - lengths]]
    out.append(np.c_[window - half, half, np.zeros_like(half)])
    for low in lengths[3 * lengths <= window]:
        middle = lengths[(lengths >= low) & (2 * lengths <= window - low)]
        middle = middle[there[window - low - middle]]
        out.append(np.c_[window - low - middle, middle, np.full_like(middle, low)])
    return np.concatenate(out)


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative x of least |A x - target| by the active-set method.

    A column of A counts the lengths in a row of `columns`. The inverse of the normal matrix is kept up to date
    as columns come and go. Starts from the disjoint columns; stops early when the rest is below 1 in 1000.
    """
    count, bins = len(columns), len(target)
    x = np.zeros(count)
    if not count:
        return x
    weight = (columns > 0).astype(float)

    def dense(j: int) -> np.ndarray:
        column = np.zeros(bins)
        np.add.at(column, columns[j], weight[j])
        return column

    taken, start = np.zeros(bins, bool), []
    for j in range(count):
        parts = columns[j][columns[j] > 0]
        if len(parts) > 2:
            break
        if not taken[parts].any():
            taken[parts] = True
            start.append(j)
    room = min(bins, count) + 1
    matrix, inverse = np.zeros((bins, room)), np.zeros((room, room))
    used = list(start)
    for k, j in enumerate(used):
        matrix[:, k] = dense(j)
        inverse[k, k] = 1 / (matrix[:, k] @ matrix[:, k])
    p = len(used)
    goal = np.zeros(room)
    goal[:p] = matrix[:, :p].T @ target
    now = inverse[:p, :p] @ goal[:p]
    inside = np.zeros(count, bool)
    inside[used] = True
    scale = max(1.0, float(np.abs(target).sum()))
    for _ in range(rounds):
        rest = target - matrix[:, :p] @ now
        if np.abs(rest).sum() <= 1e-3 * scale or p + 1 >= room:
            break
        slope = (rest[columns] * weight).sum(axis=1)
        slope[inside] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-6 * scale / bins:
            break
        new = dense(j)
        cross = matrix[:, :p].T @ new
        moved = inverse[:p, :p] @ cross
        pivot = new @ new - cross @ moved
        inside[j] = True
        if pivot < 1e-8:  # depends on the columns that are in
            continue
        inverse[:p, :p] += np.outer(moved, moved / pivot)
        inverse[:p, p] = inverse[p, :p] = -moved / pivot
        inverse[p, p] = 1 / pivot
        matrix[:, p], goal[p] = new, new @ target
        used.append(j)
        now = np.r_[now, 0.0]
        p += 1
        while True:
            best = inverse[:p, :p] @ goal[:p]
            below = best <= 1e-9
            if not below.any():
                now = best
                break
            share = np.min(now[below] / np.maximum(now[below] - best[below], 1e-12))
            now = now + share * (best - now)
            for k in sorted(np.flatnonzero(now <= 1e-9), reverse=True):
                last = p - 1
                swap = [last if i == k else k if i == last else i for i in range(p)] if k != last else None
                if swap:
                    inverse[:p, :p] = inverse[np.ix_(swap, swap)]
                    matrix[:, [k, last]] = matrix[:, [last, k]]
                    goal[[k, last]], now[[k, last]] = goal[[last, k]], now[[last, k]]
                    used[k], used[last] = used[last], used[k]
                inside[used.pop()] = False
                edge = inverse[:last, last].copy()
                inverse[:last, :last] -= np.outer(edge, edge / inverse[last, last])
                now = now[:last]
                p = last
            if not p:
                break
    x[used] = np.maximum(now, 0)
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences); together they use up the histogram."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    columns = combinations(np.flatnonzero(left), window)
    repeats = nnls(columns, left.astype(float), _SOLVER_ROUNDS * window)
    for j in np.argsort(-repeats, kind="stable"):
        wanted = int(repeats[j] + 0.5)
        if not wanted:
            break
        need = Counter(int(n) for n in columns[j] if n)
        times = min(wanted, *(left[n] // k for n, k in need.items()))
        if times > 0:
            out.append((tuple(sorted(need.elements(), reverse=True)), int(times)))
            for n, k in need.items():
                left[n] -= k * times
    while left.any():
        spare, room, need = left.copy(), window, Counter()
        while room > 0 and len(fits := np.flatnonzero(spare[: room + 1])):
            need[int(fits[-1])] += 1
            spare[fits[-1]] -= 1
            room -= int(fits[-1])
        times = min(int(left[n]) // k for n, k in need.items())
        out.append((tuple(sorted(need.elements(), reverse=True)), times))
        for n, k in need.items():
            left[n] -= k * times
    return out


def _plan_rows(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, ...]]:
    """(length, first rank, rank after the last, per sequence, first sequence, first offset)."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, taken[length], taken[length] + each * times, each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    return rows


# On Spark


def pack(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most `window` tokens (columns doc_id, start, length).

    Repeated rows are separate pieces. A length that most pieces share is ranked in many groups. Only the
    histogram (one row per length) goes to the driver, and only the plan, bounded by the window, comes back.
    """
    spark = parts.sparkSession
    parts = materialized(parts, "pieces")
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = max(256, sum(histogram.values()) // _RANKED_TOGETHER)
    group = F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(groups))
    parts = parts.withColumn("_group", group)
    before = parts.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before",
        F.sum("_n").over(Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)),
    )
    order = Window.partitionBy("length", "_group").orderBy("doc_id", "start", "ids_crc32")
    ranked = parts.join(before.drop("_n"), ["length", "_group"]).withColumn(
        "_rank", F.row_number().over(order) - 1 + F.coalesce("_before", F.lit(0))
    )
    places = spark.createDataFrame(
        _plan_rows(plan(histogram, window)),
        "length bigint, _low bigint, _high bigint, _each bigint, _sequence bigint, _offset bigint",
    )
    at = F.col("_rank") - F.col("_low")
    return (
        ranked.join(F.broadcast(places), "length")
        .where((F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
        .select(
            *[c for c in parts.columns if c != "_group"],
            (F.col("_sequence") + F.expr("(_rank - _low) div _each")).alias("sequence_id"),
            (F.col("_offset") + at % F.col("_each") * F.col("length")).alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Every token of every row of `docs` in exactly one place of one sequence.

    Null and empty texts are the end id alone. Repeated rows are packed once each. An empty table gives no rows.
    """
    return pack(pieces(id_and_text(docs, "doc_id", "text"), tokenizer, window, end_id), window)
