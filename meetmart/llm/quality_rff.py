"""Quality classifier: ridge regression on random Fourier features of document statistics, isotonic calibration.

The features cos(w x + b), with w drawn from a normal distribution, approximate a Gaussian kernel over the
standardised statistics. Partitions add up their normal equations per fold; the driver solves them (their size is a
parameter), picks the penalty by the error on folds left out, which follows from the same sums, and fits an
isotonic curve to the scores that rows got while their fold was left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import in_share, in_tasks, map_batches, ship, utf8
from meetmart.sources.scratch import materialized

FEATURES = 256
FOLDS = 4
#: Penalties tried, as shares of the number of rows.
PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2)
#: Steps of the score that calibration counts in.
BINS = 2048
THRESHOLD = 0.7
#: Standardised statistics end here, so that an extreme text stays near the others.
_CLIP = 4.0
#: First sums of partitions' equations, before the last.
_SALTS = 128
_LOW, _HIGH = -0.5, 1.5

_CLASS = np.zeros(256, np.int64)
_CLASSES = (
    b"\t\v\f\r ", b"\n", bytes(range(0x30, 0x3A)), bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)), b".,;:", b"!?",
    b"#$%&*", b"|", b"'\"()-/", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)),
)
for _k, _members in enumerate(_CLASSES, 1):
    _CLASS[list(_members)] = _k
N_STATS = 11 + len(_CLASSES) + 1


def statistics(raw: bytes) -> list[float]:
    """Numbers that describe a text (UTF-8) without saying what it is about; all 0 for an empty one."""
    if not raw:
        return [0.0] * N_STATS
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=counts, minlength=len(_CLASSES) + 1) / len(raw)
    used = counts[counts > 0] / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = len(words)
    if n:
        kinds = Counter(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        often = np.fromiter(kinds.values(), np.int64, len(kinds)) / n
        spread = -(often * np.log(often)).sum() / max(np.log(n), 1.0)
        pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
        about_words = [len(kinds) / n, often.max(), spread, pairs, sizes.mean(), sizes.std()]
    else:
        about_words = [0.0] * 6
    return [
        np.log1p(len(raw)), np.log1p(n), *about_words, len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)),
        -(used * np.log(used)).sum(), *classes,
    ]


class Model(NamedTuple):
    """What a score needs; `knots` and `heights` are the calibration curve, empty where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x features
    phases: np.ndarray
    ridge: np.ndarray  # features + 1, the last the constant
    knots: np.ndarray
    heights: np.ndarray


def _projection(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions for a Gaussian kernel whose width is the root of the number of statistics."""
    random = np.random.default_rng(seed)
    return random.normal(0, 1 / np.sqrt(N_STATS), (N_STATS, FEATURES)), random.uniform(0, 2 * np.pi, FEATURES)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, N_STATS)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, phases: np.ndarray) -> np.ndarray:
    x = np.clip((stats - mean) / scale, -_CLIP, _CLIP)
    z = np.sqrt(2 / FEATURES) * np.cos(x @ weights + phases)
    return np.hstack([z, np.ones((len(z), 1))])


def fold_of(stats: np.ndarray) -> np.ndarray:
    """Equal statistics share a fold, so copies of a text are never on both sides."""
    return np.fromiter((zlib.crc32(row.tobytes()) % FOLDS for row in np.ascontiguousarray(stats)), np.int64, len(stats))


def described(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, stats) of each row of `docs`, whole texts."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = pa.array([statistics(t) for t in utf8(batch.column("text"))], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), stats], names=["doc_id", "held_out", "stats"]
        )

    given = docs.select(F.col("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return map_batches(given, rows, f"doc_id {kind}, held_out boolean, stats array<double>")


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean and deviation of each statistic, and the number of rows; partitions add up, one row comes back."""
    stat = [F.col("stats")[k] for k in range(N_STATS)]
    got = rows.agg(
        F.count(F.lit(1)), *(F.avg(s) for s in stat), *(F.stddev_pop(s) for s in stat)
    ).first()
    if not got[0]:
        return np.zeros(N_STATS), np.ones(N_STATS), 0
    mean, scale = np.array(got[1 : 1 + N_STATS], float), np.array(got[1 + N_STATS :], float)
    return mean, np.where(scale > 1e-9, scale, 1.0), got[0]


def _add_up(table: pa.Table) -> pa.Table:
    values = np.asarray(table.column("values").combine_chunks().flatten().to_numpy(), np.float64)
    summed = values.reshape(table.num_rows, -1).sum(axis=0)
    keys = [name for name in table.column_names if name not in ("values", "salt")]
    out = {k: table.column(k)[:1] for k in keys}
    return pa.table(out | {"salt": pa.array([0], pa.int32()), "values": pa.array([summed], pa.list_(pa.float64()))})


def equations(rows: DataFrame, parts: tuple) -> np.ndarray:
    """Per fold, the sums of z z', z y, and y y (in the corner): folds x (features + 2) x (features + 2).

    Partitions add up their rows, then tasks add up the partitions in two steps, one matrix row at a time. The
    driver gets folds x (features + 2) rows.
    """
    ship(rows.sparkSession)
    size = FEATURES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, size, size))
        for batch in batches:
            stats = _matrix(batch.column("stats"))
            z = np.hstack([features(stats, *parts), batch.column("label").to_numpy()[:, None]])
            fold = fold_of(stats)
            for f in range(FOLDS):
                mine = z[fold == f]
                sums[f] += mine.T @ mine
        salt = TaskContext.get().partitionId() % _SALTS
        if sums.any():
            f, k = np.divmod(np.arange(FOLDS * size), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (f, k, np.full(len(f), salt))]
                + [pa.array(list(sums.reshape(-1, size)), pa.list_(pa.float64()))],
                names=["fold", "k", "salt", "values"],
            )

    schema = "fold int, k int, salt int, values array<double>"
    added = in_tasks(rows, run, schema).groupBy("fold", "k", "salt").applyInArrow(_add_up, schema)
    added = added.groupBy("fold", "k").applyInArrow(_add_up, schema)
    out = np.zeros((FOLDS, size, size))
    for r in added.collect():
        out[r.fold, r.k] = r["values"]
    return out


def solve(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights from one matrix of sums; the constant is not penalised."""
    size = len(sums) - 1
    n = sums[size - 1, size - 1]
    ridge = np.eye(size) * penalty * max(n, 1)
    ridge[-1, -1] = 1e-9 * max(n, 1)
    return np.linalg.solve(sums[:size, :size] + ridge, sums[:size, size])


def squared_error(sums: np.ndarray, w: np.ndarray) -> float:
    size = len(sums) - 1
    return sums[size, size] - 2 * w @ sums[:size, size] + w @ sums[:size, :size] @ w


def isotonic(n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising means of groups with `n` rows and label sum `y`; (block of each, means)."""
    blocks: list[list[float]] = []  # rows, labels, groups
    for rows, labels in zip(n, y):
        blocks.append([rows, labels, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    means = np.array([b[1] / b[0] for b in blocks])
    return np.repeat(np.arange(len(blocks)), [int(b[2]) for b in blocks]), means


def _calibration(rows: DataFrame, parts: tuple, by_fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and heights of the isotonic curve over scores of rows whose fold was left out; BINS rows come back."""
    width = (_HIGH - _LOW) / BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, labels = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            stats = _matrix(batch.column("stats"))
            raw = (features(stats, *parts) * by_fold[fold_of(stats)]).sum(axis=1)
            place = np.clip((raw - _LOW) / width, 0, BINS - 1).astype(np.int64)
            n += np.bincount(place, minlength=BINS)
            total += np.bincount(place, np.clip(raw, _LOW, _HIGH), BINS)
            labels += np.bincount(place, batch.column("label").to_numpy(), BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *(pa.array(x[at]) for x in (n, total, labels))], names=["bin", "n", "total", "labels"]
        )

    counted = in_tasks(rows, run, "bin int, n double, total double, labels double")
    got = sorted(counted.groupBy("bin").agg(*(F.sum(c).alias(c) for c in ("n", "total", "labels"))).collect())
    n, total, labels = (np.array([r[c] for r in got]) for c in ("n", "total", "labels"))
    block, means = isotonic(n, labels)
    rows_of = np.bincount(block, n)
    return np.bincount(block, total) / rows_of, means


def fit(rows: DataFrame, seed: int = 11) -> Model:
    """Learns from rows (stats, label). Without rows, or with labels all alike, scores are that label (0.5 without)."""
    parts = (*moments(rows)[:2], *_projection(seed))
    sums = equations(rows, parts)
    whole = sums.sum(axis=0)
    n, positive = whole[FEATURES, FEATURES], whole[FEATURES, FEATURES + 1]
    if n == 0 or positive in (0, n):
        constant = positive / n if n else 0.5
        return Model(*parts, np.zeros(FEATURES + 1), np.zeros(1), np.array([constant]))

    def left_out(penalty: float) -> np.ndarray:
        return np.array([solve(whole - sums[f], penalty) for f in range(FOLDS)])

    tried = {p: left_out(p) for p in PENALTIES}
    best = min(PENALTIES, key=lambda p: sum(squared_error(sums[f], tried[p][f]) for f in range(FOLDS)))
    return Model(*parts, solve(whole, best), *_calibration(rows, parts, tried[best]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of rows (doc_id, held_out, stats)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = features(_matrix(batch.column("stats")), *model[:4]) @ model.ridge
        score = np.clip(np.interp(raw, model.knots, model.heights), 0.0, 1.0)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"]
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, score double")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, learned from the labelled ones outside the quarter held out.

    Null and empty texts have the statistics 0 and are scored like any other. Several labels of an id count by their
    mean; labels that are null, and documents with a null id, teach nothing. Equal texts have equal scores.
    """
    rows = materialized(described(docs, in_share(F.col("doc_id"), 4, 2)), "statistics")
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg((F.col("quality") == 1).cast("double")).alias("label"))
    )
    learned = rows.where(~F.col("held_out")).join(marks, "doc_id").select("stats", "label")
    found = scored(rows, fit(materialized(learned, "labelled")))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
