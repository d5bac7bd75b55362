"""Language identification as inference of a mixture: which languages a text is made of, and in what shares.

Each language has a distribution over hashed byte trigrams, counted over all training texts. A text is cut into
short units; expectation-maximisation estimates the share of each language from the units' likelihoods. The set
of languages grows by share up to all that were learned; the set with the best likelihood less a penalty per
language is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import id_and_text, in_share, in_tasks, map_batches

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: Trigrams of a unit.
UNIT = 32
ROUNDS = 12
#: What each further language of a text must gain in log likelihood per log of the units.
PENALTY = 4.0
_SMOOTH = 0.05
#: Numbers that a task works on at a time (trigrams times languages).
_BLOCK_NUMBERS = 8_000_000
#: Languages that a task counts before it hands on what it has.
_FLUSH = 64


class Model(NamedTuple):
    languages: tuple[str, ...]
    log_p: np.ndarray  # buckets x languages


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts, one after the other, and how many each text has (one at least)."""
    parts = [f" {t.lower()} ".encode() for t in texts]
    sizes = np.fromiter((max(len(p) - 2, 1) for p in parts), np.int64, len(parts))
    raw = np.frombuffer(b"".join(p if len(p) > 2 else p.ljust(3) for p in parts), np.uint8).astype(np.uint32)
    grams = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    hashed = (grams * np.uint32(2654435761)) >> np.uint32(16)
    ends = np.cumsum(sizes + 2)
    inside = np.ones(len(hashed) + 2, bool)  # trigrams across two texts do not count
    inside[ends - 1] = inside[ends - 2] = False
    return hashed[inside[: len(hashed)]], sizes


def _count(texts: list[str]) -> np.ndarray:
    return np.bincount(_buffer(texts)[0], minlength=BUCKETS)


def train(docs: DataFrame, learn: Column) -> Model:
    """Trigram counts by language of all rows that `learn` selects and whose language and text are there.

    Tasks count before the shuffle. The driver gets the model: one number per language and trigram bucket.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                    names=["lang", "bucket", "n"],
                )
            counts.clear()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, mine in texts.items():
                counts[lang] = counts.get(lang, 0) + _count(mine)
                if len(counts) > _FLUSH:
                    yield from counted()
        yield from counted()

    added = in_tasks(rows, run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = added.toArrow()
    names = table.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    number = {lang: k for k, lang in enumerate(languages)}
    counts = np.full((BUCKETS, len(languages)), _SMOOTH)
    where = np.fromiter((number[n] for n in names), np.int64, len(names))
    np.add.at(counts, (table.column("bucket").to_numpy(), where), table.column("n").to_numpy())
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def _mix(units: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages per text by EM, and the log likelihoods."""
    top = units.max(axis=1, keepdims=True)
    likelihood = np.exp(units - top)
    text = np.repeat(np.arange(len(sizes)), sizes)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        weighted = likelihood * share[text]
        weighted /= np.maximum(weighted.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(weighted, starts, axis=0) / sizes[:, None]
    total = np.log(np.maximum((likelihood * share[text]).sum(axis=1), 1e-300)) + top[:, 0]
    return share, np.add.reduceat(total, starts)


def mixtures(texts: list[str], model: Model) -> list[list[tuple[str, float]]]:
    """Languages and shares of each text, the largest first; ties by name. Texts must have a letter."""
    if not texts or not model.languages:
        return [[] for _ in texts]
    grams, sizes = _buffer(texts)
    spans = -(-sizes // UNIT)  # units of each text
    begin = np.cumsum(sizes) - sizes
    first = np.repeat(begin, spans) + UNIT * (np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans))
    units = np.add.reduceat(model.log_p[grams], first, axis=0).astype(np.float64)
    starts = np.cumsum(spans) - spans
    count = len(model.languages)
    full, _ = _mix(units, starts, spans, np.ones((len(texts), count)))
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    single = np.add.reduceat(units, starts, axis=0)
    best_share = np.zeros_like(full)
    winner = np.argmax(single, axis=1)
    best_share[np.arange(len(texts)), winner] = 1.0
    best = single.max(axis=1)
    penalty = PENALTY * np.log(spans + 1.0)
    bound = np.add.reduceat(units.max(axis=1), starts)
    # The best language of each unit bounds what any set can reach: a text is left alone as soon as the penalty
    # keeps all larger sets behind the best so far.
    for k in range(2, count + 1):
        at = np.flatnonzero(bound - (k - 1) * penalty > best)
        if not len(at):
            break
        sizes_k = spans[at]
        starts_k = np.cumsum(sizes_k) - sizes_k
        rows = np.repeat(starts[at] - starts_k, sizes_k) + np.arange(sizes_k.sum())
        share, value = _mix(units[rows], starts_k, sizes_k, (rank[at] < k).astype(np.float64))
        value = value - (k - 1) * penalty[at]
        better = value > best[at]
        best[at[better]] = value[better]
        best_share[at[better]] = share[better]
    out = []
    for row in best_share:
        at = np.argsort(-row, kind="stable")
        out.append([(model.languages[i], float(min(row[i], 1.0))) for i in at if row[i] > 0.005])
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _found(texts: list[str | None], model: Model) -> list[list[tuple[str, float]]]:
    """Mixtures of a batch, some texts at a time; none for texts without a letter."""
    limit = _BLOCK_NUMBERS // max(1, len(model.languages))
    found: list[list] = [[] for _ in texts]
    block, size = [], 0
    for k, text in enumerate(texts):
        if has_letter(text):
            block.append(k)
            size += len(text)
        if block and (size > limit or k == len(texts) - 1):
            for at, mixture in zip(block, mixtures([texts[i] for i in block], model)):
                found[at] = mixture
            block, size = [], 0
    return found


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, mixture) per row of (doc_id, text): the largest language and its share.

    A text that is null or has no letter is undetermined with score 0, and so is every text where nothing was
    learned.
    """
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _found(batch.column("text").to_pylist(), model)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([m[0][0] if m else UNDETERMINED for m in found], pa.string()),
                pa.array([m[0][1] if m else 0.0 for m in found], pa.float64()),
                pa.array([[{"lang": a, "share": s} for a, s in m] for m in found], kind),
            ],
            names=["doc_id", "lang_pred", "score", "mixture"],
        )

    schema = "doc_id bigint, lang_pred string, score double, mixture array<struct<lang: string, share: double>>"
    return map_batches(docs, rows, schema)


def determined(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of `docs`, with all their columns, whose language is determined.

    Where nothing was learned, none can be told from another: all texts with a letter stay.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        found = _found(texts, model) if model.languages else map(has_letter, texts)
        return batch.filter(pa.array([bool(m) for m in found]))

    return map_batches(docs, rows, docs.schema)


def language_digest(docs: DataFrame) -> DataFrame:
    """Language of every row, learned from the rows whose checksum of the id modulo 4 is not 2.

    Repeated rows give repeated results; an empty table gives no rows. A null id counts as not held out.
    """
    held_out = in_share(F.col("doc_id"), 4, 2)
    model = train(docs, ~held_out)
    found = identify(id_and_text(docs, "doc_id", "text"), model)
    shares = F.array_join(
        F.transform("mixture", lambda m: F.concat(m["lang"], F.lit(":"), F.format_number(m["share"], 3))), ","
    )
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", shares.alias("mixture"))
