"""SimHash fingerprints and a search for all fingerprints within a Hamming radius, in built-in functions only.

Terms are pairs of neighbouring words; each occurrence votes with the pair's weight (its length, so that pairs
of short common words count less) on the 64 bits of the pair's hash. Votes are added up in 16 numbers of four
16-bit counters each, over spans of words short enough that no counter overflows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetmart.llm.components import connected_components
from meetmart.sources.scratch import materialized

BITS = 64
RADIUS = 3
_COUNTER = 0x0001000100010001
_MOST_WEIGHT = 16
#: Pairs per span: weight times pairs stays below 2**15, the room of the topmost counter.
_SPAN = 2**15 // _MOST_WEIGHT - 1
#: Ids and keys (no texts) that are put in order together, and how many such blocks there are at most.
_BLOCK_ROWS = 65_536
_MOST_BLOCKS = 20_000
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _NO_WORD), lambda w: w != "")


def terms(padded: Column) -> Column:
    """Hash and weight of each pair of neighbours in an array of two words or more."""
    return F.zip_with(
        F.slice(padded, 1, F.size(padded) - 1),
        F.slice(padded, 2, F.size(padded) - 1),
        lambda a, b: F.struct(
            F.xxhash64(a, b).alias("h"),
            F.least(F.lit(_MOST_WEIGHT), F.lit(1) + F.octet_length(a) + F.octet_length(b)).cast("long").alias("w"),
        ),
    )


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, simhash) of rows with unique `keys` and a column `text`.

    If the rows lie partitioned by some of `keys` already, nothing is shuffled.
    """
    split = texts.select(*keys, words(F.col("text")).alias("_words"))
    padded = split.select(  # a lone word, or no word, pairs with nothing
        *keys,
        F.when(F.size("_words") > 1, F.col("_words"))
        .otherwise(F.concat("_words", F.array(F.lit(""), F.lit(""))))
        .alias("_words"),
    )
    votes = padded.select(*keys, F.posexplode(terms(F.col("_words"))).alias("_at", "_term")).select(
        *keys, F.expr(f"_at div {_SPAN}").alias("_span"), "_term.h", "_term.w"
    )
    spans = votes.groupBy(*keys, "_span").agg(
        F.sum("w").alias("_all"),
        *[
            F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_COUNTER)) * F.col("w")).alias(f"_s{j}")
            for j in range(16)
        ],
    )

    def ones(bit: int) -> Column:
        return F.shiftrightunsigned(f"_s{bit % 16}", 16 * (bit // 16)).bitwiseAND(F.lit(0xFFFF))

    added = spans.groupBy(*keys).agg(
        F.sum("_all").alias("_all"), *[F.sum(ones(b)).alias(f"_b{b}") for b in range(BITS)]
    )
    bits = [
        F.when(2 * F.col(f"_b{b}") > F.col("_all"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
        for b in range(BITS)
    ]
    value = bits[0]
    for bit in bits[1:]:
        value = value.bitwiseOR(bit)
    return added.select(*keys, value.alias("simhash"))


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# Neighbours by id


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for an id and a text; equal for equal rows only, as far as MD5 tells texts apart."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)))


def in_blocks(groups: DataFrame, block_rows: int = _BLOCK_ROWS) -> DataFrame:
    """(key, doc_id, ...) with the key of the next row, in ascending ids; after the last comes the first.

    Null ids come first, equal ids are ordered by key. Keys are hashes, so rows of one id, or without any, spread
    over blocks like all others. Only ids and keys are put in order, texts stay where they are. The first rows of
    the blocks are looked up in a table of at most one row per block, whose number is bounded.
    """
    blocks = max(1, min(_MOST_BLOCKS, groups.count() // block_rows))
    order = [F.col("doc_id").asc_nulls_first(), F.col("key").asc()]
    placed = groups.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id())
    placed = materialized(placed, "ids-in-blocks")
    firsts = placed.groupBy("_block").agg(F.min(F.struct("doc_id", "key"))["key"].alias("_first"))
    by_block = Window.orderBy("_block")  # one row per block
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = firsts.select(
        "_block", F.coalesce(F.lead("_first").over(by_block), F.first("_first").over(whole)).alias("_behind")
    )
    ahead = placed.withColumn("_ahead", F.lead("key").over(Window.partitionBy("_block").orderBy(*order)))
    return (
        ahead.join(F.broadcast(behind), "_block")
        .withColumn("next_key", F.coalesce("_ahead", "_behind"))
        .drop("_block", "_ahead", "_behind")
    )


# Search


def block_masks(rows: int, radius: int = RADIUS) -> list[int]:
    """Masks of the permuted tables: two fingerprints within `radius` agree on one mask at least.

    The 64 bits are cut into more blocks than `radius`; each table keeps all but `radius` of them as its key.
    The number of blocks grows with the logarithm of the rows until keys of unlike fingerprints rarely meet.
    """
    blocks = radius + 1
    while BITS * (blocks - radius) // blocks < math.log2(max(rows, 2)) + 5 and blocks < 2 * radius + 2:
        blocks += 1
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(kept) for kept in itertools.combinations(part, blocks - radius)]


def near_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(simhash, other) for all pairs of distinct fingerprints within the radius, both ways round.

    Each table is a shuffle on the kept bits; a pair counts only in the first table in which it agrees. A
    fingerprint has a bounded number of others within a small radius, whatever the size of the data.
    """
    masks = block_masks(distinct.count(), radius)
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    kept = [F.col("simhash").bitwiseAND(F.lit(m)).alias("key") for m in signed]
    keys = F.array(*[F.struct(F.lit(k).alias("t"), key) for k, key in enumerate(kept)])
    tables = distinct.select("simhash", F.explode(keys).alias("_k")).select("simhash", "_k.t", "_k.key")
    a, b = tables.alias("a"), tables.alias("b")
    apart = F.col("a.simhash").bitwiseXOR(F.col("b.simhash"))
    first = F.when(apart.bitwiseAND(F.lit(signed[0])) == 0, 0)
    for k, m in enumerate(signed[1:], 1):
        first = first.when(apart.bitwiseAND(F.lit(m)) == 0, k)
    pairs = a.join(
        b,
        (F.col("a.t") == F.col("b.t"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.simhash") < F.col("b.simhash"))
        & (F.bit_count(apart) <= radius)
        & (first == F.col("a.t")),
    ).select(F.col("a.simhash").alias("x"), F.col("b.simhash").alias("y"))
    both = F.array(
        F.struct(F.col("x").alias("simhash"), F.col("y").alias("other")),
        F.struct(F.col("y").alias("simhash"), F.col("x").alias("other")),
    )
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def near_classes(sizes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(simhash, n_near, class_id) from (simhash, n rows, smallest id `first`) of distinct fingerprints.

    Links are pairs of fingerprints within the radius; a class holds all that links connect, and bears the smallest
    id of its rows (null if none has an id). `n_near` counts the rows, but for one itself, within the radius.
    """
    links = materialized(near_fingerprints(sizes.select("simhash"), radius), "near-fingerprints")
    others = (
        links.join(sizes.select(F.col("simhash").alias("other"), "n"), "other")
        .groupBy("simhash")
        .agg(F.sum("n").alias("n_others"))
    )
    edges = links.where("simhash < other").select(F.col("simhash").alias("a"), F.col("other").alias("b"))
    member = connected_components(edges).withColumnRenamed("node", "simhash")
    joined = sizes.join(others, "simhash", "left").join(member, "simhash", "left")
    joined = joined.withColumn("component", F.coalesce("component", "simhash"))
    # a class is pre-aggregated on the map side, so a large one costs no task more
    smallest = joined.groupBy("component").agg(F.min("first").alias("class_id"))
    return joined.join(smallest, "component").select(
        "simhash", (F.col("n") - 1 + F.coalesce("n_others", F.lit(0))).alias("n_near"), "class_id"
    )


def _quarter(n_chars: Column) -> Column:
    return F.floor(n_chars / 4).cast("int")


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as `times` says, in bounded pieces."""
    piece = 2**16
    parts = rows.withColumn("_part", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {piece})")))
    held = F.expr(f"explode(sequence(1L, least({piece}L, {times} - _part * {piece})))")
    return parts.withColumn("_copy", held).drop("_part", "_copy", times)


def edited_digest(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and documents within the radius.

    The edited text has the last quarter of the characters replaced by as many first ones of the next document's
    text (by id; after the last, the first). Null texts are empty; texts without words share one fingerprint.
    Rows of one id, or without an id, are ordered by a hash of their texts. Repeated rows give a row each; all but
    the last of them are followed by their own text. They are counted before texts are shuffled. `n_near` counts
    the other rows whose fingerprint lies within the radius; `class_id` is the smallest id of all documents
    connected through such links.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(row_key(doc_id, text).alias("key"), doc_id.alias("doc_id"), text.alias("text"))
    groups = texts.select("key", "doc_id", F.char_length("text").cast("long").alias("n_chars"))
    groups = groups.groupBy("key", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("n"))
    ordered = materialized(in_blocks(materialized(groups, "ids")), "ids-in-order")
    # a row sends the row before it as many of its first characters as that one moves
    whole = texts.groupBy("key").agg(F.first("text").alias("text"))
    asked = ordered.select(F.col("next_key").alias("key"), F.col("key").alias("to"), _quarter(F.col("n_chars")).alias("m"))
    sent = whole.join(asked, "key").select(F.col("to").alias("key"), F.left("text", F.col("m")).alias("_sent"))
    both = whole.join(sent, "key").join(ordered.select("key", "n_chars", "n"), "key")

    def edit(source: str) -> Column:
        moved = _quarter(F.col("n_chars"))
        kept = F.left("text", (F.col("n_chars") - moved).cast("int"))
        return F.concat(kept, F.left(F.col(source), moved))

    kinds = [
        F.struct(F.lit(0).alias("kind"), F.col("text")),
        F.struct(F.lit(1).alias("kind"), edit("_sent").alias("text")),
    ]
    again = F.struct(F.lit(2).alias("kind"), edit("text").alias("text"))  # followed by a copy of itself
    kinds = F.when(F.col("n") > 1, F.array(*kinds, again)).otherwise(F.array(*kinds))
    votes = fingerprints(both.select("key", F.explode(kinds).alias("_k")).select("key", "_k.*"), ["key", "kind"])
    by_key = votes.groupBy("key").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("simhash"))).alias(f"print{k}") for k in range(3)]
    )
    digests = both.select(
        "key", F.sha2(edit("_sent"), 256).alias("sha1"), F.when(F.col("n") > 1, F.sha2(edit("text"), 256)).alias("sha2")
    )
    found = materialized(digests.join(by_key, "key"), "fingerprints")
    after = found.select(F.col("key").alias("next_key"), F.col("print0").alias("next"))
    rows = ordered.join(found, "key").join(after, "next_key").withColumnRenamed("print0", "simhash")
    last = F.struct(
        F.lit(1).cast("long").alias("times"), F.col("sha1").alias("sha"), F.col("print1").alias("edited"), F.col("next")
    )
    rest = F.struct(
        (F.col("n") - 1).alias("times"), F.col("sha2").alias("sha"), F.col("print2").alias("edited"),
        F.col("simhash").alias("next"),
    )
    each = F.explode(F.when(F.col("n") > 1, F.array(last, rest)).otherwise(F.array(last))).alias("_e")
    sizes = rows.groupBy("simhash").agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"))
    near = materialized(near_classes(materialized(sizes, "distinct-fingerprints"), radius), "near-classes")
    spread = rows.join(near, "simhash").select("doc_id", "n_chars", "simhash", "n_near", "class_id", each)
    return _repeated(spread.select("*", "_e.*"), "times").select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        hex64(F.col("simhash")).alias("fingerprint"),
        hex64(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("simhash"), F.col("edited")).alias("near_edited"),
        likeness(F.col("simhash"), F.col("next")).alias("near_next"),
        "n_near",
        "class_id",
    )
