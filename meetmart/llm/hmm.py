"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihoods by the forward recursion.

The most frequent words are symbols of their own, as many as make up a share of all tokens, so the vocabulary
grows with that of the corpus; all others fall into classes by their ending. A text's likelihood is that of its symbols under the
model, times that of each word within its class. Tasks encode texts once into a table of symbols; each round of
training reads that table, adds up expected counts per partition, and only their sum, bounded by symbols times
states, goes to the driver. Rounds end when they gain too little.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import id_and_text, in_share, in_tasks, most_frequent, ship, utf8
from meetmart.sources.scratch import materialized

STATES = 8
#: Training ends with the first round that raises the mean log likelihood of a token by less than this.
LEAST_GAIN = 0.02
#: The most frequent words have symbols of their own: as many as make up this share of all words, at least so many.
OWN_SHARE, FEWEST_OWN = 0.7, 4096
#: Classes of all other words.
CLASSES = 1024
#: Most frequent words whose counts go to all tasks; the counts of others are joined. This also bounds the words
#: with a symbol, as the model goes to all tasks.
KNOWN_WORDS = 1 << 18
#: Added to each count.
ADDED = 0.1
_FLUSH = 200_000
#: Symbols that a task works on at a time, padding included, and bytes of symbols it puts side by side.
_BLOCK_SYMBOLS = 400_000
_GATHERED_BYTES = 16_000_000
#: Symbols are the classes, the end of a text, then words of their own, the most frequent first.
_END_SYMBOL = CLASSES
_FIRST_OWN = CLASSES + 1
_SYMBOL = "<u4"


def word_class(word: bytes) -> int:
    """Class of a word by its last two bytes."""
    return zlib.crc32(word[-2:]) % CLASSES


def _class_column(word: str) -> Column:
    return (F.crc32(F.expr(f"substring({word}, greatest(octet_length({word}) - 1, 1), 2)")) % CLASSES).cast("int")


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text in UTF-8 between ASCII white space, ASCII letters in lower case."""
    return raw.lower().split()


class Counts(NamedTuple):
    """What is known of the training tokens."""

    table: DataFrame  # word, n, class
    total: int  # tokens, ends included
    distinct: int  # different tokens, the end included
    ends: int  # training texts
    known: dict[bytes, int]  # places of the most frequent words in the next two
    own: int  # how many of them have a symbol
    symbol: np.ndarray
    count: np.ndarray
    class_total: np.ndarray  # tokens and different words of a class, without words that have a symbol
    class_distinct: np.ndarray

    def base(self, n: int | np.ndarray):
        """log10 of the smoothed share of a token that occurs n times."""
        return np.log10((n + ADDED) / (self.total + ADDED * (self.distinct + 1)))

    def inner(self, kind: int, n: int | np.ndarray):
        """log10 of the smoothed share of a word within its class."""
        return np.log10((n + ADDED) / (self.class_total[kind] + ADDED * (self.class_distinct[kind] + 1)))


def count_tokens(docs: DataFrame, learn: Column) -> Counts:
    """Counts of all words of the rows that `learn` selects; tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counted() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for raw in utf8(batch.column("text")):
                seen.update(tokens(raw))
                if len(seen) > _FLUSH:
                    yield counted()
        yield counted()

    rows = docs.where(learn)
    table = in_tasks(rows.select("text"), run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    table = materialized(table.withColumn("class", _class_column("word")), "words")
    ends = rows.count()
    sums = table.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    top = most_frequent(table, KNOWN_WORDS)
    known = {word: k for k, (word, _) in enumerate(top)}
    kinds = np.array([word_class(word) for word, _ in top], np.int64)
    count = np.array([n for _, n in top], np.int64)
    owners = min(len(top), max(FEWEST_OWN, int(np.searchsorted(np.cumsum(count), OWN_SHARE * (sums.n or 0))) + 1))
    places = np.arange(len(top))
    symbol = np.where(places < owners, _FIRST_OWN + places, kinds)
    own = Counter()
    for kind, n in zip(kinds[:owners].tolist(), count[:owners].tolist()):
        own[kind, "n"] += n
        own[kind, "words"] += 1
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in table.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        class_total[r["class"]] = r.n - own[r["class"], "n"]
        class_distinct[r["class"]] = r.words - own[r["class"], "words"]
    total, distinct = (sums.n or 0) + ends, sums.words + (ends > 0)
    return Counts(table, total, distinct, ends, known, owners, symbol, count, class_total, class_distinct)


def encode(docs: DataFrame, counts: Counts, held_out: Column) -> DataFrame:
    """A table of symbols per row, with what the known words add to the scores, and the other words to join.

    Null texts are empty: only their end is a token.
    """
    spark = docs.sparkSession
    shared: Broadcast = spark.sparkContext.broadcast(counts._replace(table=None))  # bounded by KNOWN_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.known
        value = shared.value
        end, absent = float(value.base(value.ends)), itertools.repeat(-1)
        for batch in batches:
            rows = []
            for raw in utf8(batch.column("text")):
                words = tokens(raw)
                place = np.fromiter(map(known.get, words, absent), np.int64, len(words))
                symbols = np.full(len(words) + 1, _END_SYMBOL, np.int64)
                n = np.zeros(len(words), np.int64)
                found = place >= 0
                symbols[:-1][found], n[found] = value.symbol[place[found]], value.count[place[found]]
                others: Counter = Counter()
                for k in np.flatnonzero(~found).tolist():
                    others[words[k]] += 1
                    symbols[k] = word_class(words[k])
                there = n > 0
                inside = there & (symbols[:-1] < CLASSES)
                kinds = symbols[:-1][inside]
                rows.append((
                    symbols.astype(_SYMBOL).tobytes(), len(words) + 1, int(there.sum()) + (value.ends > 0),
                    float(value.base(n[there]).sum()) + end, float(value.inner(kinds, n[inside]).sum()),
                    [{"word": w, "times": c} for w, c in others.items()],
                ))
            kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), kind]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            names = ["symbols", "n_tokens", "n_known", "base", "inner", "others"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], names=["doc_id", "held_out", *names])

    schema = (
        "doc_id bigint, held_out boolean, symbols binary, n_tokens bigint, n_known bigint, base double, "
        "inner double, others array<struct<word: binary, times: int>>"
    )
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    coded = in_tasks(rows, run, schema).withColumn("row", F.monotonically_increasing_id())
    return materialized(coded, "symbols")


# The model


class Hmm(NamedTuple):
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


def first_model(counts: Counts, seed: int = 11) -> Hmm:
    """States that tend to stay, each with its own random slant on the words' shares."""
    share = np.full(_FIRST_OWN + counts.own, 0.01)
    share[:CLASSES] += counts.class_total
    share[_END_SYMBOL] += counts.ends
    share[_FIRST_OWN:] += counts.count[: counts.own]
    slant = np.random.default_rng(seed).lognormal(0.0, 0.7, (len(share), STATES))
    slant[_END_SYMBOL] = 1.0
    emit = share[:, None] * slant
    move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.9)
    return Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together: the more texts lie side by side, the fewer steps they take."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= _GATHERED_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _lanes(coded: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side, the longest first: their numbers, symbols by step and lane, lanes alive by step."""
    sizes = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        longest = int(sizes[order[at]])
        mine = order[at : at + max(1, _BLOCK_SYMBOLS // longest)]
        symbols = np.full((longest, len(mine)), _END_SYMBOL, np.int64)
        for lane, k in enumerate(mine):
            symbols[: sizes[k], lane] = np.frombuffer(coded[k], _SYMBOL)
        alive = np.searchsorted(-sizes[mine], -np.arange(longest), side="left")
        yield mine, symbols, alive
        at += len(mine)


def _forward(model: Hmm, symbols: np.ndarray, alive: np.ndarray, kind=np.float64):
    """Scaled forward values by step, scales (1 where a lane has ended), and emissions."""
    steps, lanes = symbols.shape
    emitted = model.emit.astype(kind)[symbols]
    ahead = np.zeros((steps, lanes, STATES), kind)
    scale = np.ones((steps, lanes), kind)
    move = model.move.astype(kind)
    now = model.start.astype(kind) * emitted[0]
    for t in range(steps):
        n = alive[t]
        if t:
            now = (ahead[t - 1, :n] @ move) * emitted[t, :n]
        total = now.sum(axis=1)
        scale[t, :n] = total
        ahead[t, :n] = now / total[:, None]
    return ahead, scale, emitted


def likelihoods(coded: list[bytes], model: Hmm) -> np.ndarray:
    """log10 probability of each text's symbols, by the scaled forward recursion."""
    out = np.zeros(len(coded))
    for mine, symbols, alive in _lanes(coded):
        _, scale, _ = _forward(model, symbols, alive)
        out[mine] = np.log10(scale).sum(axis=0)
    return out


def expected_counts(coded: list[bytes], model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of some texts, and their log likelihood."""
    start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model.emit.shape)
    likelihood = 0.0
    kind = np.float32
    towards = model.move.astype(kind).T.copy()
    for _, symbols, alive in _lanes(coded):
        ahead, scale, emitted = _forward(model, symbols, alive, kind)
        steps, lanes = symbols.shape
        back = np.zeros_like(ahead)  # emission times backward value over scale, by step
        weight = np.zeros_like(ahead)
        ends = np.r_[alive[1:], 0]
        after = None
        for t in range(steps - 1, -1, -1):
            n = alive[t]
            behind = np.ones((n, STATES), kind)
            if ends[t]:
                behind[: ends[t]] = after @ towards
            weight[t, :n] = ahead[t, :n] * behind
            after = emitted[t, :n] * behind / scale[t, :n, None]
            back[t, :n] = after
        likelihood += float(np.log(scale, dtype=np.float64).sum())
        start += weight[0].sum(axis=0)
        move += ahead[:-1].reshape(-1, STATES).T.astype(np.float64) @ back[1:].reshape(-1, STATES)
        flat, values = symbols.ravel(), weight.reshape(-1, STATES)
        for s in range(STATES):
            emit[:, s] += np.bincount(flat, values[:, s], len(emit))
    return start, move * model.move, emit, likelihood


def train(coded: DataFrame, model: Hmm, tokens: int, least_gain: float = LEAST_GAIN) -> Hmm:
    """Baum-Welch over the rows of `encode` that are not held out; no token changes nothing.

    A round shows the likelihood of the model it began with. The last one is that whose gain over the round
    before is below `least_gain` per token. Each other round raises a sum that is never above 0, so rounds end.
    """
    rows = coded.where(~F.col("held_out")).select("symbols")
    before, gain = -np.inf, np.inf
    while tokens and gain >= least_gain * tokens:
        model, likelihood = _next_model(rows, model)
        before, gain = likelihood, likelihood - before
    return model


def _next_model(rows: DataFrame, model: Hmm) -> tuple[Hmm, float]:
    """The model after a round, and the log likelihood of the rows under the model before it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    states = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for texts in _gathered(batches):
            part = expected_counts(texts.column("symbols").to_pylist(), shared.value)
            total = part if total is None else tuple(a + b for a, b in zip(total, part))
        if total is not None:
            first, moves, emit, likelihood = total
            at = np.flatnonzero(emit.any(axis=1))
            row = np.r_[-np.arange(1, 3 + STATES), at]  # what is no emission has negative numbers
            values = np.vstack([np.full(STATES, likelihood / STATES), first, moves, emit[at]])
            yield pa.RecordBatch.from_arrays([pa.array(row), *map(pa.array, values.T.copy())], names=["i", *states])

    added = in_tasks(rows, run, "i bigint, " + ", ".join(f"{s} double" for s in states)).groupBy("i")
    table = added.agg(*(F.sum(s).alias(s) for s in states)).toArrow()  # symbols times states at most
    place = table.column("i").to_numpy()
    values = np.column_stack([table.column(s).to_numpy() for s in states])
    total = np.zeros((2 + STATES, STATES))
    total[-place[place < 0] - 1] = values[place < 0]
    start, move, emit = total[1] + 0.1, total[2:] + 0.1, model.emit * 10 + 1e-6
    emit[place[place >= 0]] += values[place >= 0]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)), total[0].sum()


def score(coded: DataFrame, model: Hmm, counts: Counts) -> DataFrame:
    """Rows of `encode` with n_known, base_score and score of all their words."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _gathered(batches):
            found = likelihoods(texts.column("symbols").to_pylist(), shared.value)
            rows = texts.column("row").combine_chunks()
            yield pa.RecordBatch.from_arrays([rows, pa.array(found)], names=["row", "_path"])

    paths = in_tasks(coded.select("row", "symbols"), run, "row bigint, _path double")
    below = counts.total + ADDED * (counts.distinct + 1)
    classes = coded.sparkSession.createDataFrame(
        [(k, float(counts.class_total[k] + ADDED * (counts.class_distinct[k] + 1))) for k in range(CLASSES)],
        "class int, _below double",
    )
    n = F.coalesce("n", F.lit(0))
    others = coded.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.times")
    joined = (
        others.join(counts.table.select("word", "n"), "word", "left")
        .withColumn("class", _class_column("word"))
        .join(F.broadcast(classes), "class")  # CLASSES rows
        .groupBy("row")
        .agg(
            F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("_known"),
            F.sum(F.col("times") * F.log10((n + ADDED) / below)).alias("_base"),
            F.sum(F.col("times") * F.log10((n + ADDED) / F.col("_below"))).alias("_inner"),
        )
    )
    plain = coded.drop("symbols", "others")
    return (
        plain.join(paths, "row")
        .join(joined, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
            F.lit(counts.total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
            (F.col("_path") + F.col("inner") + F.coalesce("_inner", F.lit(0.0))).alias("score"),
        )
    )


def score_digest(docs: DataFrame) -> DataFrame:
    """Scores of every row, learned from the rows whose checksum of the id modulo 10 is not 0.

    Null texts are empty. Repeated rows give a row each. Without training rows every token is unseen. A null id
    counts as not held out.
    """
    ship(docs.sparkSession)
    docs = id_and_text(docs, "doc_id", "text")
    held_out = in_share(F.col("doc_id"), 10, 0)
    counts = count_tokens(docs, ~held_out)
    coded = encode(docs, counts, held_out)
    return score(coded, train(coded, first_model(counts), counts.total), counts)
