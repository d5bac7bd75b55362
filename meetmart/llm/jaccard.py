"""Near-duplicate join by Jaccard similarity of word n-grams: MinHash banding, then verification on full sets.

Documents with equal n-gram sets are one copy class. Its MinHash signature is cut into bands, whose number and
width follow from the threshold and the recall wanted. Classes that meet on a band hash are candidates, and so are
all that these connect: a few texts of a template meet by chance and chain many together. Such groups are first laid
out in tiles with their hashes alone, which cut them into groups of classes that agree about as much as near
copies do; only their n-gram sets are fetched. Then tiles of bounded size compare the full sets of those pairs
that agree in at least half of the threshold's share of all hashes, whether or not they share a band. A tile returns
a number of links per class and edges of a spanning forest, never the pairs themselves.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from meetmart.llm.components import connected_components
from meetmart.llm.texts import _FOLD, id_and_text, in_tasks, ship, utf8
from meetmart.sources.scratch import materialized

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 128
#: Classes and n-grams of one side of a tile.
TILE_CLASSES, TILE_GRAMS = 1024, 1 << 21
#: Classes of one side of a tile that holds hashes alone.
HASH_TILE_CLASSES = 2048
#: Deviations of the estimated similarity by which a pair at the threshold may fall below it and stay a candidate.
_DEVIATIONS = 5
#: Classes of small groups of candidates that are compared in one call.
_CALL_CLASSES = 512
#: Bytes of text that a task hashes at a time.
_BLOCK_BYTES = 1 << 20


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the widest bands that find a pair at the threshold with the recall, within `most` hashes."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"{most} hashes cannot reach recall {recall} at {threshold}")
    return best


# Hashes of a block of texts


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE, _PLACE = _odd(1, 256), _odd(2, 64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the folded words of all texts, one after the other, and the number of words of each."""
    folded = [t.translate(_FOLD) for t in texts]
    raw = np.frombuffer(b" ".join(folded) + b" ", np.uint8)
    letter = raw != 32
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(at) != 1])  # in `at`
    starts = at[first]
    word = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(at)]))
    place = at - starts[word]
    powers = np.ones(int(place.max()) + 1, np.uint64)
    powers[1:] = np.cumprod(np.full(len(powers) - 1, _PLACE[0]))
    hashed = _mix(np.add.reduceat(_BYTE[raw[at]] * powers[place], first))
    ends = np.cumsum([len(t) + 1 for t in folded])
    return hashed, np.diff(np.r_[0, np.searchsorted(starts, ends)])


def gram_hashes(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, and how many each has. A shorter text is one n-gram of its own."""
    hashed, counts = word_hashes(texts)
    sizes = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    padded = np.r_[hashed, np.zeros(words, np.uint64)]
    begin = np.cumsum(counts) - counts
    total = int(sizes.sum())
    at = np.repeat(begin, sizes) + np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(begin + counts, sizes) - at  # words from here to the end of the text
    grams = np.zeros(total, np.uint64)
    for k in range(words):
        grams += np.where(left > k, padded[at + k], np.uint64(0)) * _PLACE[k + 1]
    return _mix(grams), sizes


def signatures(grams: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (texts x bands), and 16 bits of every minimum, of texts with at least one n-gram."""
    starts = np.cumsum(sizes) - sizes
    factors, offsets = _odd(3, bands * rows), _odd(4, bands * rows)
    out = np.zeros((len(sizes), bands), np.uint64)
    short = np.zeros((len(sizes), bands * rows), np.uint16)
    for band in range(bands):
        for row in range(rows):
            k = band * rows + row
            least = np.minimum.reduceat(grams * factors[k] + offsets[k], starts)
            out[:, band] += least * _PLACE[row + 8]
            short[:, k] = least & np.uint64(0xFFFF)
    return _mix(out), short


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= _BLOCK_BYTES or k == len(texts) - 1:
            yield first, k + 1
            first, size = k + 1, 0


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, grams, set_key, bands, minima) per row; null from the key on for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            grams_of, keys, found, minima = [], [], [], []
            for a, b in _blocks(texts):
                grams, sizes = gram_hashes(texts[a:b], words)
                some = np.flatnonzero(sizes)
                signed = iter(zip(*signatures(grams, sizes[some], bands, rows)) if len(some) else ())
                ends = np.cumsum(sizes)
                for size, end in zip(sizes.tolist(), ends.tolist()):
                    distinct = np.unique(grams[end - size : end])
                    grams_of.append(len(distinct))
                    keys.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest() if size else None)
                    hashed, short = next(signed) if size else (None, None)
                    found.append(hashed.tobytes() if size else None)
                    minima.append(short.tobytes() if size else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(grams_of, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(found, pa.binary()), pa.array(minima, pa.binary())],
                names=["doc_id", "text_hash", "grams", "set_key", "bands", "minima"],
            )

    rows_in = docs.withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id bigint, text_hash bigint, grams bigint, set_key binary, bands binary, minima binary"
    return in_tasks(rows_in, run, schema)


# Verification in a tile


def _intersections(a: list[np.ndarray], b: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the common part of a[x[k]] and b[y[k]] for all k; exact in either of two ways.

    Few pairs are compared one by one; many pairs as a product of incidence matrices over the n-grams that
    occur on both sides, some columns at a time.
    """
    pool, number = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    in_a = number[: sum(map(len, a))]
    in_b = number[len(in_a) :]
    both = np.intersect1d(in_a, in_b)
    if len(x) * 2e-5 < len(a) * len(b) * len(both) / 1e10:
        return np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in zip(x, y)], np.int64)
    place = np.full(len(pool), -1)
    place[both] = np.arange(len(both))
    total = np.zeros((len(a), len(b)), np.float32)
    step = max(1, (1 << 24) // max(len(a), len(b)))
    sides = []
    for sets, flat in ((a, in_a), (b, in_b)):
        column, row = place[flat], np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        sides.append((row[column >= 0], column[column >= 0]))
    for low in range(0, len(both), step):
        wide = min(step, len(both) - low)
        matrices = []
        for (row, column), sets in zip(sides, (a, b)):
            mine = (column >= low) & (column < low + wide)
            matrix = np.zeros((len(sets), wide), np.float32)
            matrix[row[mine], column[mine] - low] = 1
            matrices.append(matrix)
        total += matrices[0] @ matrices[1].T
    return total[x, y].astype(np.int64)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima each row of a has in common with each row of b."""
    if len(a) * len(b) * a.shape[1] <= 1 << 20:
        return (a[:, None, :] == b[None, :, :]).sum(axis=2)
    total = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        total += a[:, k][:, None] == b[:, k][None, :]
    return total


def _compare(minima_a, minima_b, sets_a, sets_b, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose sets reach the threshold.

    The share of equal minima estimates the similarity; pairs below half the threshold are not compared. With
    a hundred hashes a pair at 0.8 falls below 0.4 less often than once in 10**15 times.
    """
    share = _agreement(minima_a, minima_b) >= threshold / 2 * minima_a.shape[1]
    if same:
        share = np.triu(share, 1)
    x, y = np.nonzero(share)
    if not len(x):
        return x, y
    size_a, size_b = (np.array([len(s) for s in sets]) for sets in (sets_a, sets_b))
    large = np.minimum(size_a[x], size_b[y]) >= threshold * np.maximum(size_a[x], size_b[y]) - 1e-9
    x, y = x[large], y[large]
    if not len(x):
        return x, y
    common = _intersections(sets_a, sets_b, x, y)
    near = common >= threshold * (size_a[x] + size_b[y] - common) - 1e-9
    return x[near], y[near]


def _roots(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest index that each index is linked with."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _groups_in(table: pa.Table) -> list[list[dict]]:
    """Rows of one call by group, in order of their nodes."""
    rows = {}
    for row in table.to_pylist():  # a row may come twice if the table repeats it
        rows.setdefault((row["component"], row["node"]), row)
    groups: dict[int, list[dict]] = {}
    for row in sorted(rows.values(), key=lambda r: (r["component"], r["node"])):
        groups.setdefault(row["component"], []).append(row)
    return list(groups.values())


def least_agreement(threshold: float, hashes: int) -> float:
    """Share of equal minima below which a pair is no candidate.

    A pair at the threshold falls below it by five deviations: with a hundred hashes and 0.8, where the border is 0.6,
    about once in a million times, while unrelated texts of one template stay far below.
    """
    return max(threshold / 2, threshold - _DEVIATIONS * math.sqrt(threshold * (1 - threshold) / hashes))


def _agreeing_tile(table: pa.Table, threshold: float) -> pa.Table:
    """Forest edges between classes whose hashes agree like those of near copies."""
    nodes, roots = [], []
    for members in _groups_in(table):
        low, high = members[0]["low"], members[0]["high"]
        minima = np.array([np.frombuffer(m["minima"], np.uint16) for m in members])
        border = least_agreement(threshold, minima.shape[1]) * minima.shape[1] - 1e-9
        if low == high:
            x, y = np.nonzero(np.triu(_agreement(minima, minima) >= border, 1))
        else:
            block = np.array([m["block"] for m in members])
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            x, y = np.nonzero(_agreement(minima[left], minima[right]) >= border)
            x, y = left[x], right[y]
        root = _roots(len(members), x, y)
        for k in np.flatnonzero(root != np.arange(len(members))):
            nodes.append(members[k]["node"])
            roots.append(members[root[k]]["node"])
    return pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())})


def _tile(table: pa.Table, threshold: float) -> pa.Table:
    """Links and forest edges of the classes in one call; each group of candidates stands for itself."""
    out: list[tuple[int, int, int, int]] = []
    for members in _groups_in(table):
        low, high = members[0]["low"], members[0]["high"]
        minima = np.array([np.frombuffer(m["minima"], np.uint16) for m in members])
        sets = [np.frombuffer(m["set"], np.uint64) for m in members]
        copies = np.array([m["copies"] for m in members])
        if low == high:
            x, y = _compare(minima, minima, sets, sets, True, threshold)
        else:
            block = np.array([m["block"] for m in members])
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            x, y = _compare(minima[left], minima[right], [sets[i] for i in left], [sets[i] for i in right], False, threshold)
            x, y = left[x], right[y]
        if not len(x):
            continue
        count = len(members)
        documents = np.bincount(x, copies[y], count) + np.bincount(y, copies[x], count)
        classes = np.bincount(x, minlength=count) + np.bincount(y, minlength=count)
        root = _roots(count, x, y)
        for k in np.flatnonzero(classes):
            out.append((members[k]["node"], members[root[k]]["node"], int(documents[k]), int(classes[k])))
    columns = zip(*out) if out else [[]] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "root", "documents", "classes"])


def _with_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Members with the sorted n-gram hashes of their text."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = texts["doc_id"].eqNullSafe(members["doc_id"]) & (texts["text_hash"] == members["text_hash"])
    joined = texts.join(members, same).select("text", *[members[c] for c in members.columns if c not in ("doc_id", "text_hash")])
    rest = [c for c in joined.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sets = utf8(batch.column("text")), []
            for a, b in _blocks(texts):
                grams, sizes = gram_hashes(texts[a:b], words)
                ends = np.cumsum(sizes)
                sets += [np.unique(grams[e - s : e]).tobytes() for s, e in zip(sizes, ends)]
            columns = [*[batch.column(c) for c in rest], pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "set"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name != "text")
    return in_tasks(joined, run, f"{schema}, set binary")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, class_id, copy_id, n_copies, n_links, n_link_classes) per row of `docs`.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, letters in lower case; a text of
    fewer than `words` words is one n-gram. `copy_id` is the smallest id of the rows with an equal n-gram set,
    `class_id` the smallest of all rows connected by links, `n_links` the number of other rows whose similarity
    is at least `threshold`, copies included, and `n_link_classes` that of other copy classes. Rows without words
    (null, empty) have no links and are classes of their own. Repeated rows are copies of each other.
    """
    docs = id_and_text(docs, id_col, text_col)
    return _classified(docs, threshold, words, recall).drop("text_hash", "stays")


def one_of_each_class(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows of `docs`, with all their columns: of each class of near duplicates the one with the smallest id.

    Rows without words stay. Of repeated rows (the same id and text) one stays.
    """
    found = materialized(_classified(id_and_text(docs, id_col, text_col), threshold, words, recall), "classified")
    other = uuid.uuid4().hex  # names that no column of `docs` has
    key, hashed = f"_id_{other}", f"_hash_{other}"
    staying = found.where("stays").select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed))
    repeated = staying.groupBy(key, hashed).count().where("count > 1").limit(1).count() > 0
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    kept = docs.join(
        staying.distinct() if repeated else staying,
        docs[id_col].eqNullSafe(F.col(key)) & (text_hash == F.col(hashed)),
        "leftsemi",
    )
    if repeated or found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        kept = kept.withColumn(hashed, text_hash).dropDuplicates([id_col, hashed]).drop(hashed)
    return kept


def _classified(docs: DataFrame, threshold: float, words: int, recall: float) -> DataFrame:
    """`near_duplicates` with the hash of the text and whether the row is the one of its class that stays."""
    ship(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    sketch = materialized(sketches(docs, words, bands, rows), "sketches")
    copies = materialized(
        sketch.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("copy_id"),
            F.count(F.lit(1)).alias("copies"),
            # null ids come last
            F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash", "grams", "bands", "minima")).alias("first"),
        )
        .select("set_key", "copy_id", "copies", "first.*", F.monotonically_increasing_id().alias("node")),
        "copies",
    )
    links = materialized(_links(docs, copies.drop("no_id"), threshold, words, bands), "links")
    groups = connected_components(
        links.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    groups = materialized(groups, "groups")
    totals = links.groupBy("node").agg(F.sum("documents").alias("documents"), F.sum("classes").alias("classes"))
    order = F.struct("no_id", "doc_id", "text_hash")
    ids = (
        copies.join(groups, "node")
        .groupBy("component")
        .agg(F.min("copy_id").alias("class_id"), F.min(order).alias("best"))
    )
    named = groups.join(ids, "component").select("node", "class_id", "best")
    classes = materialized(
        copies.join(named, "node", "left")
        .join(totals, "node", "left")
        .select(
            F.col("set_key").alias("_key"),
            F.coalesce("class_id", "copy_id").alias("class_id"),
            "copy_id",
            F.col("copies").alias("n_copies"),
            (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
            F.coalesce("classes", F.lit(0)).cast("long").alias("n_link_classes"),
            F.coalesce(F.col("best"), order).alias("_best"),
        ),
        "classes",
    )
    with_words = sketch.where(F.col("set_key").isNotNull()).select("doc_id", "text_hash", "set_key")
    best = F.col("_best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_best.text_hash") == F.col("text_hash"))
    found = (
        with_words.join(classes, F.col("set_key") == F.col("_key"))
        .withColumn("stays", best)
        .drop("set_key", "_key", "_best")
    )
    zero = F.lit(0).cast("long")
    alone = sketch.where(F.col("set_key").isNull()).select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
        F.lit(1).cast("long").alias("n_copies"), zero.alias("n_links"), zero.alias("n_link_classes"),
        F.lit(True).alias("stays"),
    )
    return found.unionByName(alone)


def _links(docs: DataFrame, copies: DataFrame, threshold: float, words: int, bands: int) -> DataFrame:
    """(node, root, documents, classes) of copy classes, per tile."""
    spark = docs.sparkSession
    hashes = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.struct(k.alias("band"), F.hex(F.substr("bands", k * 8 + 1, F.lit(8))).alias("hash")),
    )
    buckets = copies.select("node", F.explode(hashes).alias("b")).select("node", "b.band", "b.hash")
    shared = materialized(
        buckets.groupBy("band", "hash").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "buckets",
    )
    met = buckets.join(shared, ["band", "hash"]).where("node != first")
    edges = met.select(F.col("node").alias("a"), F.col("first").alias("b"))
    met = materialized(connected_components(edges), "candidates")
    ship(spark)
    hashed = _blocks_of(met.join(copies.select("node", "minima", F.lit(0).alias("grams")), "node"), HASH_TILE_CLASSES)
    agreeing = _tiled(hashed, ["node", "minima"]).applyInArrow(
        lambda table: _agreeing_tile(table, threshold), "node bigint, root bigint"
    )
    agreeing = agreeing.select(F.col("node").alias("a"), F.col("root").alias("b"))
    near = materialized(connected_components(agreeing), "agreeing")
    members = _blocks_of(near.join(copies.drop("set_key", "copy_id", "bands"), "node"), TILE_CLASSES)
    return _tiled(_with_sets(docs, members, words), ["node", "copies", "minima", "set"]).applyInArrow(
        lambda table: _tile(table, threshold), "node bigint, root bigint, documents bigint, classes bigint"
    )


def _blocks_of(members: DataFrame, most: int) -> DataFrame:
    """Members of groups with the number of blocks of their group, their own block, and the call they belong to.

    A block has about `most` classes, or TILE_GRAMS n-grams, at most. Groups of one block share calls, of which there
    are enough for both bounds.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("grams").alias("grams"))
    sizes = materialized(sizes, "sizes")
    blocks = F.greatest(F.ceil(F.col("n") / most), F.ceil(F.col("grams") / TILE_GRAMS), F.lit(1)).cast("int")
    total = sizes.agg(F.sum("n").alias("n"), F.sum("grams").alias("grams")).first()
    calls = max(1, (total.n or 0) // _CALL_CLASSES, 4 * (total.grams or 0) // TILE_GRAMS)
    # groups that fit one tile share a call with others
    call = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("component"), F.lit(calls))).otherwise(F.col("component"))
    placed = members.drop("grams").join(sizes.select("component", blocks.alias("blocks")), "component")
    return placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("call", call)


def _tiled(members: DataFrame, columns: list[str]) -> GroupedData:
    """Members by tile: each is sent to the tiles that pair its block with all blocks of its group."""
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high")),
    )
    names = ["call", "component", "block", *columns]
    laid = members.select(*names, F.explode(tiles).alias("t")).select(*names, "t.low", "t.high")
    return laid.groupBy("call", "low", "high")
