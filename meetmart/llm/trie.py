"""Trie of conversation prefixes, built from composable fingerprints instead of rebuilt texts.

A turn is an element of a monoid: a pair of power and value modulo a prime, in four lanes; a sequence of turns has
the product of its elements. Conversations are rebuilt from the head of another one and the rest of their own. The
fingerprint of each rebuilt prefix follows from products along the stored conversations: the head's product takes
the place of the product of what it replaces, which is cancelled. Only references to turns and numbers move.

Prefixes with equal depth and fingerprint are a node. That their turns are equal is verified: all references of a node
must lead to one content, and all stored turns of a content must hold the same role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.scan import scanned
from meetmart.llm.texts import in_tasks
from meetmart.sources.scratch import materialized

PRIME = (1 << 31) - 1
LANES = 4
#: Turns that a head may take over at most, and the size of the groups of conversations that share one.
MOST_HEAD, GROUP = 8, 5
#: Ids that one row of a list of ends holds at most.
_PIECE_IDS = 4096
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "f1", "f2"]
_POWERS = [f"p{k}" for k in range(LANES)]
_VALUES = [f"v{k}" for k in range(LANES)]
_TURNS = [f"x{k}" for k in range(LANES)]


def _bases(seed: int) -> list[int]:
    return [int(b) for b in np.random.default_rng(seed).integers(1 << 20, PRIME - 1, LANES)]


def compose(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of elements (number of turns, powers, values), row by row."""
    out = np.empty_like(right)
    p, v = slice(1, 1 + LANES), slice(1 + LANES, 1 + 2 * LANES)
    out[:, 0] = left[:, 0] + right[:, 0]
    out[:, p] = left[:, p] * right[:, p] % PRIME
    out[:, v] = (left[:, v] * right[:, p] + right[:, v]) % PRIME
    return out


def _plain_text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, bytes) of all turns with an id; null role or text is empty.

    `content` is the SHA-256 of role and text, with the role's length ahead, so that no two pairs run together.
    """
    role, text = _plain_text("role"), _plain_text("text")
    joined = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").cast("long").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(joined.cast("binary"), 256)).alias("content"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def _verify_contents(turns: DataFrame) -> None:
    """All stored turns of a content hold the same role and text; equal ones are merged before the shuffle."""
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    differ = turns.groupBy("content").agg(F.min(both).alias("low"), F.max(both).alias("high")).where("low <> high")
    if differ.limit(1).count():
        raise ValueError("two different turns have one SHA-256")


def _elements(turns: DataFrame, seed: int) -> DataFrame:
    """Turns as (conv_id, turn, role, content, bytes, x0.., _n, p0.., v0..): each with its element of the monoid."""
    bases = _bases(seed)
    names = ["conv_id", "turn", "role", "content", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw = np.frombuffer(b"".join(batch.column("content").to_pylist()), ">u8").reshape(n, LANES)
            x = (raw % np.uint64(PRIME - 1)).astype(np.int64) + 1
            lanes = [pa.array(x[:, k]) for k in range(LANES)]
            powers = [pa.array(np.full(n, b, np.int64)) for b in bases]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *lanes, pa.array(np.ones(n, np.int64)), *powers, *lanes],
                names=[*names, *_TURNS, "_n", *_POWERS, *_VALUES],
            )

    numbers = ", ".join(f"{c} bigint" for c in ["bytes", *_TURNS, "_n", *_POWERS, *_VALUES])
    return in_tasks(turns.select(names), run, f"conv_id bigint, turn bigint, role string, content binary, {numbers}")


def _packed(values: list[Column]) -> list[Column]:
    """Two longs out of four lanes."""
    return [F.shiftleft(values[k], 31).bitwiseOR(values[k + 1]) for k in (0, 2)]


def _times(a: Column, b: Column) -> Column:
    return (a * b) % F.lit(PRIME)


def rebuilt_prefixes(conversations: DataFrame, seed: int = 5) -> DataFrame:
    """(conv_id, depth, f1, f2, g1, g2, x1, x2, bytes, last) of all prefixes of all rebuilt conversations.

    f: fingerprint of the prefix, g: that of the prefix without its last turn, x: content of the last turn,
    `last`: whether the prefix is the whole. Depth 0 has fingerprint 0. Turns with equal numbers are ordered by role,
    then by content.
    """
    turns = turns_of(conversations)
    _verify_contents(turns)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("content")]
    steps = scanned(_elements(turns, seed), "conv_id", order, ["_n", *_POWERS, *_VALUES], compose, "turns")
    step = F.struct(F.col("_n").alias("k"), *_POWERS, *_VALUES, *_TURNS, "bytes")
    stored = steps.groupBy("conv_id").agg(
        F.max("_n").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_n") <= MOST_HEAD, step))).alias("head")
    )
    stored = materialized(stored, "conversations")  # a row per conversation with eight turns at most
    donors = stored.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("n_base"), F.col("head").alias("base_head")
    )
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    plan = (
        stored.withColumn("h", (crc % (MOST_HEAD + 1)).cast("long"))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
        .join(donors, "base", "left")
        .withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
        .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    plan = materialized(plan, "plan")

    def at(head: str, place: str, field: str, none: int) -> Column:
        return F.when(F.col(place) > 0, F.try_element_at(F.col(head), F.col(place).cast("int"))[field]).otherwise(F.lit(none))

    roots = plan.select(
        "conv_id", F.lit(0).cast("long").alias("depth"),
        *(F.lit(0).cast("long").alias(c) for c in (*_VALUES, *_TURNS, "bytes")), "length",
    )
    heads = plan.where("m > 0").select(
        "conv_id", "length", F.explode(F.slice("base_head", F.lit(1), F.col("m").cast("int"))).alias("s")
    ).select("conv_id", F.col("s.k").alias("depth"), *(f"s.{c}" for c in (*_VALUES, *_TURNS, "bytes")), "length")
    # own turns beyond the h-th: the head's product instead of the own first h, whose product is cancelled
    cut = plan.where("n > h").select(
        "conv_id", "h", "m", "length",
        *(at("base_head", "m", v, 0).alias(f"b{v}") for v in _VALUES),
        *(at("head", "h", v, 0).alias(f"o{v}") for v in _VALUES),
        *(at("head", "h", p, 1).alias(f"o{p}") for p in _POWERS),
    )
    bases = _bases(seed)
    own = steps.join(cut, "conv_id").where(F.col("_n") > F.col("h"))
    moved = []
    for k in range(LANES):
        # the power of the suffix is that of the whole, divided by that of the first h
        undo = _power(F.lit(pow(bases[k], -1, PRIME)), F.col("h"))
        shift = _times((F.col(f"bv{k}") - F.col(f"ov{k}") + PRIME) % PRIME, _times(F.col(f"p{k}"), undo))
        moved.append(((F.col(f"v{k}") + shift) % PRIME).alias(f"v{k}"))
    own = own.select("conv_id", (F.col("m") + F.col("_n") - F.col("h")).alias("depth"), *moved, *_TURNS, "bytes", "length")
    every = roots.unionByName(heads).unionByName(own)
    values, xs = [F.col(v) for v in _VALUES], [F.col(x) for x in _TURNS]
    parents = [
        _times((v - x + PRIME) % PRIME, F.lit(pow(b, -1, PRIME))) for v, x, b in zip(values, xs, bases)
    ]
    names = ("f1", "f2", "g1", "g2", "x1", "x2")
    columns = [c.alias(n) for n, c in zip(names, _packed(values) + _packed(parents) + _packed(xs))]
    return every.select("conv_id", "depth", *columns, "bytes", (F.col("depth") == F.col("length")).alias("last"))


def _power(base: Column, exponent: Column) -> Column:
    """`base` to the power of 0 to MOST_HEAD."""
    steps = F.sequence(F.lit(1), F.lit(MOST_HEAD))
    return F.aggregate(steps, F.lit(1).cast("long"), lambda a, k: F.when(k <= exponent, _times(a, base)).otherwise(a))


def _ends(prefixes: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256): the SHA-256 of the ascending ids of the conversations that end in a node.

    Ids are sorted across tasks and joined into pieces of a bounded number of ids, so that what one task has to
    hash in a row, even for a node in which very many conversations end, is a short table of long texts.
    """
    ends = prefixes.where("last").select(*_NODE, "conv_id")
    ordered = ends.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in _NODE], axis=1)
            ids = batch.column("conv_id").to_pylist()
            new = np.r_[True, (np.diff(keys, axis=0) != 0).any(axis=1)]
            begin = np.flatnonzero(new)
            starts = np.repeat(begin, np.diff(np.r_[begin, n]))
            cuts = np.flatnonzero(new | ((np.arange(n) - starts) % _PIECE_IDS == 0))
            joined = [",".join(map(str, ids[a:b])) for a, b in zip(cuts, [*cuts[1:], n])]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(keys[cuts, k]) for k in range(3)), pa.array([ids[a] for a in cuts], pa.int64()), pa.array(joined)],
                names=[*_NODE, "first", "ids"],
            )

    joined = in_tasks(ordered, pieces, "depth bigint, f1 bigint, f2 bigint, first bigint, ids string")
    together = joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashed = None, None

        def row(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{**dict(zip(_NODE, k)), "ends_sha256": h.hexdigest()} for k, h in done],
                pa.schema([(c, pa.int64()) for c in _NODE] + [("ends_sha256", pa.string())]),
            )

        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
                if key == now:
                    hashed.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((now, hashed))
                now, hashed = key, hashlib.sha256(ids.encode())
            if done:
                yield row(done)
        if now is not None:
            yield row([(now, hashed)])

    return in_tasks(together, digests, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def _nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All prefixes and their nodes; with other numbers if a node turns out to hold different turns."""
    for seed in range(5, 10):
        prefixes = materialized(rebuilt_prefixes(conversations, seed), "prefixes")
        nodes = prefixes.groupBy(*_NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"),
            F.min("g1").alias("g1"), F.min("g2").alias("g2"),
            ((F.min("x1") == F.max("x1")) & (F.min("x2") == F.max("x2")) & (F.min("g1") == F.max("g1")) & (F.min("g2") == F.max("g2"))).alias("equal"),
        )
        nodes = materialized(nodes, "nodes")
        if not nodes.where(~F.col("equal")).limit(1).count():
            return prefixes, nodes.drop("equal")
    raise ValueError("fingerprints of different prefixes kept colliding")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node belongs to its smallest member, so the nodes of a conversation are the lower end of its path, a chain. What
    lies below a node is the rest of its own chain and the whole chains of its other members: sums over subtrees
    need no walk over levels. Rows without conv_id are left out; an empty table has no root.
    """
    prefixes, nodes = _nodes(conversations)
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = (
        nodes.join(children, _NODE, "left")
        .fillna(0, ["n_children"])
        .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    )
    nodes = nodes.withColumn("_n", F.lit(1).cast("long")).select(
        "conv_id", *_NODE, "g1", "g2", "n_convs", "n_children", "leaf", "saved", F.col("saved").alias("below"), "_n"
    )
    add = lambda a, b: a + b
    # from the end of a chain upwards
    nodes = materialized(scanned(nodes, "conv_id", [F.col("depth").desc()], ["_n", "below"], add, "chains"), "trie")
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.sum("saved").alias("saved"), F.max("leaf").alias("leaf")
    )
    others = (
        prefixes.join(chains, "conv_id")
        .where("depth < top")
        .groupBy(*_NODE)
        .agg(F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaves"))
    )
    # the parent of a chain's top is another conversation's node
    tops = nodes.join(chains.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"]).where("depth > 0")
    parents = tops.select((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2"), F.col("conv_id").alias("child"))
    parents = parents.join(nodes.select(*_NODE, F.col("conv_id").alias("parent")), _NODE).select(
        F.col("child").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "parent"
    )
    return (
        nodes.join(others, _NODE, "left")
        .join(_ends(prefixes), _NODE, "left")
        .join(chains.select("conv_id", F.col("leaf").alias("own_leaf")), "conv_id")
        .join(parents, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("own_leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("below") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
