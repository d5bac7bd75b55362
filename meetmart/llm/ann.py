"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of the vectors; every vector is then put into a leaf. A query walks the
tree in the order of a priority queue by the inner product with the centroids and visits so many leaves that the
share of true neighbours found, measured on some queries against all vectors, reaches the target. Leaves that lie
together form groups; a query goes to a group once, with the list of its leaves there. It goes first to the group of
its best leaf, then, with the k-th best score found, to all others that can hold anything as good: a leaf whose
centroid and radius rule that out is not visited. Queries and vectors meet in tiles of bounded size, so a leaf that
holds a large part of all rows is split over many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetmart.llm.texts import in_tasks, ship
from meetmart.sources.scratch import materialized

#: Vectors that the tree is fitted on: at most so many, and at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 16, 1 << 26
#: Queries that the number of visits is calibrated on.
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.98
BRANCHES = 16
LEAF_ROWS = 256
#: Sample points that a leaf is fitted on at least; so the size of the sample bounds the number of leaves.
LEAF_POINTS = 8
#: Groups of leaves: so many at least, or as many as it takes for groups of so many rows.
GROUPS, GROUP_ROWS = 32, 1 << 17
#: Vectors and queries of a tile, and queries that a leaf is compared with at a time.
TILE_ROWS, TILE_QUERIES, _QUERY_BLOCK = GROUP_ROWS, 1 << 14, 2048
#: Numbers that a batch of walks holds at a time.
_WALK_NUMBERS = 1 << 22
_LLOYD_ROUNDS = 8


class Tree(NamedTuple):
    """Centroids of all nodes but the root; the children of a node are consecutive; leaves have a number."""

    centroids: np.ndarray
    first: np.ndarray  # first child of a node, by node + 1 (0 is the root); -1 for leaves
    count: np.ndarray  # children of a node
    leaf: np.ndarray  # number of a leaf, by node; -1 for inner nodes
    leaves: int


def _kmeans(points: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centers = points[random.choice(len(points), k, replace=False)].copy()
    for _ in range(_LLOYD_ROUNDS):
        near = np.argmax(points @ centers.T - (centers**2).sum(1) / 2, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=k)
        filled = sizes > 0
        centers[filled] = sums[filled] / sizes[filled, None]
    near = np.argmax(points @ centers.T - (centers**2).sum(1) / 2, axis=1)
    used = np.unique(near)
    return centers[used], np.searchsorted(used, near)


def grow_tree(points: np.ndarray, leaf_points: int, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Splits nodes by k-means until they hold `leaf_points` sample points at most, or equal points only."""
    random = np.random.default_rng(seed)
    points = np.ascontiguousarray(points, np.float64)
    centroids, first, count, leaf = [], [-1], [0], []
    leaves = 0
    queue = [(0, points)]  # node + 1, its points
    while queue:
        node, mine = queue.pop(0)
        k = min(branches, max(2, -(-len(mine) // leaf_points)))
        if len(mine) > leaf_points and (mine != mine[0]).any():
            centers, near = _kmeans(mine, min(k, len(mine)), random)
            if len(centers) > 1:
                first[node], count[node] = len(centroids), len(centers)
                for c, center in enumerate(centers):
                    centroids.append(center)
                    first.append(-1)
                    count.append(0)
                    leaf.append(-1)
                    queue.append((len(centroids), mine[near == c]))
                continue
        if node:
            leaf[node - 1] = leaves
            leaves += 1
    width = points.shape[1] if points.ndim == 2 else 0
    return Tree(
        np.array(centroids, np.float64).reshape(-1, width), np.array(first), np.array(count), np.array(leaf, np.int64),
        max(leaves, 1),
    )


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point: the nearest child at every level."""
    node = np.zeros(len(points), np.int64)
    active = np.arange(len(points)) if tree.first[0] >= 0 else np.zeros(0, np.int64)
    while len(active):
        order = active[np.argsort(node[active], kind="stable")]
        starts = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0])
        for rows in np.split(order, starts[1:]):
            at = node[rows[0]]
            children = slice(tree.first[at], tree.first[at] + tree.count[at])
            centers = tree.centroids[children]
            near = np.argmax(points[rows] @ centers.T - (centers**2).sum(1) / 2, axis=1)
            node[rows] = tree.first[at] + near + 1
        active = active[tree.first[node[active]] >= 0]
    return tree.leaf[node - 1] if tree.first[0] >= 0 else node


def best_bins(tree: Tree, query: np.ndarray, visits: int) -> list[int]:
    """The first `visits` leaves that a best-first walk by inner product reaches."""
    if tree.first[0] < 0:
        return [0]
    found: list[int] = []
    queue = [(0.0, 0)]
    while queue and len(found) < visits:
        _, node = heapq.heappop(queue)
        start = tree.first[node]
        if start < 0:
            found.append(int(tree.leaf[node - 1]))
            continue
        scores = tree.centroids[start : start + tree.count[node]] @ query
        for k, score in enumerate(scores.tolist()):
            heapq.heappush(queue, (-score, int(start) + k + 1))
    return found


def paths(tree: Tree) -> np.ndarray:
    """Nodes from below the root to each leaf (leaves x levels); a shorter path repeats its leaf."""
    found: list[list[int]] = [[] for _ in range(tree.leaves)]
    stack: list[tuple[int, list[int]]] = [(0, [])]
    while stack:
        node, path = stack.pop()
        start = tree.first[node]
        if start < 0:
            if node:
                found[tree.leaf[node - 1]] = path
            continue
        stack += [(int(start) + k + 1, [*path, int(start) + k]) for k in range(tree.count[node])]
    depth = max(map(len, found))
    return np.array([path + path[-1:] * (depth - len(path)) for path in found], np.int64).reshape(tree.leaves, depth)


def walk_order(tree: Tree, queries: np.ndarray, way: np.ndarray) -> np.ndarray:
    """All leaves in the order in which `best_bins` reaches them, for many queries side by side.

    The queue takes a leaf when the worst score on its path comes up; among leaves held up by one and the same
    node, the worst score below that node decides, and so on.
    """
    if not way.shape[1]:
        return np.zeros((len(queries), 1), np.int64)
    scores = (queries @ tree.centroids.T)[:, way]  # queries x leaves x levels
    level = np.arange(way.shape[1])
    held, keys = np.full(scores.shape[:2], -1), []
    for _ in level:
        rest = np.where(level > held[:, :, None], scores, np.inf)
        worst = rest.min(axis=2)
        keys.append(-worst)
        last = way.shape[1] - 1 - np.argmin(rest[:, :, ::-1], axis=2)
        held = np.where(np.isfinite(worst), last, way.shape[1])
    return np.lexsort(keys[::-1], axis=1)


def groups_of(way: np.ndarray, sizes: np.ndarray, groups: int) -> np.ndarray:
    """The group of each leaf: neighbours in the tree, about equally many rows each."""
    order = np.lexsort(way.T[::-1]) if way.shape[1] else np.zeros(len(sizes), np.int64)
    before = np.cumsum(sizes[order]) - sizes[order] / 2
    out = np.empty(len(sizes), np.int64)
    out[order] = np.minimum(before * groups / max(sizes.sum(), 1), groups - 1).astype(np.int64)
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in one order of summation, so that equal vectors have equal scores everywhere."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def top_pairs(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int, least=None):
    """(query index, row index, score) of each query's k best rows but its own; ties to the smaller id.

    `least`, if given, is the score below which a query wants no row.
    """
    if not len(rows) or not len(queries):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rough = queries @ rows.T
    rough[query_ids[:, None] == row_ids[None, :]] = -np.inf
    keep = min(k, len(rows))
    floor = np.partition(rough, len(rows) - keep, axis=1)[:, len(rows) - keep]
    # what rounding of the fast product could have put below the k-th stays a candidate
    slack = 1e-12 * np.sqrt((queries**2).sum(1) * (rows**2).sum(1).max()) * queries.shape[1]
    if least is not None:
        floor = np.maximum(floor, least)
    q, r = np.nonzero((rough >= (floor - slack)[:, None]) & np.isfinite(rough))
    score = inner_products(queries[q], rows[r])
    if least is not None:
        good = score >= least[q]
        q, r, score = q[good], r[good], score[good]
    order = np.lexsort((row_ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return q[best], r[best], score[best]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Rows that take part as (vec_id, vector), and their number of components.

    Left out: null ids; vectors that are null, empty, zero, or hold null or non-finite components; and vectors
    whose number of components is not the most frequent one (the larger of equally frequent).
    """

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    vector = F.col(vector_col)
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", finite)
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    width = most.width if most else 1
    return rows.where(F.size("vector") == width), width


def _partial_best(rows: DataFrame, asked: list, width: int, k: int, tree: Tree) -> DataFrame:
    """Per partition, the k best rows of some given queries, with their leaves."""
    ids = np.array([r.vec_id for r in asked], np.int64)
    vectors = np.array([r.vector for r in asked], np.float64).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            points, row_ids = _matrix(batch.column("vector"), width), batch.column("vec_id").to_numpy()
            q, r, score = top_pairs(vectors, ids, points, row_ids, k)
            best.append((q, row_ids[r], score, leaf_of(tree, points)[r]))
        if best:
            q, r, score, leaf = map(np.concatenate, zip(*best))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (q.astype(np.int32), r, score, leaf)], names=["query", "vec_id", "score", "leaf"]
            )

    return in_tasks(rows, run, "query int, vec_id bigint, score double, leaf bigint")


def calibrate(rows: DataFrame, queries: DataFrame, width: int, tree: Tree, k: int, target: float) -> int:
    """The smallest number of leaf visits, doubled from 1 and then narrowed, that reaches the target recall.

    Measured on a bounded number of queries (by a hash of the id) against all rows.
    """
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).collect()
    if not asked:
        return 1
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = _partial_best(rows, asked, width, k, tree).withColumn("rank", F.row_number().over(order))
    truth = best.where(F.col("rank") <= k).select("query", "leaf").collect()
    way = paths(tree)
    asked_vectors = np.array([r.vector for r in asked], np.float64).reshape(-1, width)
    places = [np.argsort(walk_order(tree, q[None], way)[0]) for q in asked_vectors]
    place = [places[r.query][r.leaf] for r in truth]
    place = np.sort(place)
    visits = 1
    while visits < tree.leaves and (place < visits).mean() < target:
        visits *= 2
    low, high = visits // 2, min(visits, tree.leaves)
    while low + 1 < high:
        middle = (low + high) // 2
        low, high = (low, middle) if (place < middle).mean() >= target else (middle, high)
    return max(1, high)


def search_tile(
    rows: np.ndarray, row_ids: np.ndarray, leaves: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
    wanted: list, least: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, row index, score) of each query's k best rows in the leaves it wants, `least` or better.

    Leaves that queries want early go first; after each, a query wants no less than its k-th best so far.
    """
    by_leaf = np.argsort(leaves, kind="stable")
    here, begin = np.unique(leaves[by_leaf], return_index=True)
    spans = dict(zip(here.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(leaves)])))
    sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
    flat = np.concatenate([np.asarray(w, np.int64) for w in wanted]) if len(wanted) else np.zeros(0, np.int64)
    asker = np.repeat(np.arange(len(wanted)), sizes)
    early = 1 / (1 + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    order = np.argsort(flat, kind="stable")
    asked, first = np.unique(flat[order], return_index=True)
    urgency = np.add.reduceat(early[order], first) if len(first) else early
    ends = [*first[1:].tolist(), len(flat)]
    least = np.where(np.isnan(least), -np.inf, least)
    best = np.full((len(wanted), k), -np.inf)
    found: list[tuple[np.ndarray, ...]] = []
    for at in np.argsort(-urgency, kind="stable").tolist():
        if int(asked[at]) not in spans:
            continue
        a, b = spans[int(asked[at])]
        mine = by_leaf[a:b]
        askers = asker[order[first[at] : ends[at]]]
        for block in range(0, len(askers), _QUERY_BLOCK):
            who = askers[block : block + _QUERY_BLOCK]
            q, r, score = top_pairs(queries[who], query_ids[who], rows[mine], row_ids[mine], k, least[who])
            if not len(q):
                continue
            found.append((who[q], mine[r], score))
            new = np.full((len(who), k), -np.inf)
            new[q, np.arange(len(q)) - np.searchsorted(q, q)] = score
            best[who] = np.partition(np.hstack([best[who], new]), k, axis=1)[:, k:]
            least[who] = np.maximum(least[who], best[who].min(axis=1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, r, score = map(np.concatenate, zip(*found))
    order = np.lexsort((row_ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    good = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[good], r[good], score[good]


def nearest(
    rows: DataFrame, queries: DataFrame, width: int, k: int = 20, target: float = TARGET_RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest rows found.

    `rows` and `queries` are (vec_id, vector) with `width` components each. Rows with a query's id are its own
    and are no candidates. Of rows with equal vectors only as many of the smallest ids are searched as k and
    the rows of one id together: the others cannot be among the k nearest of any query. A query whose leaves
    hold too few rows visits further ones, so it has k results wherever there are k candidates.
    """
    spark = rows.sparkSession
    ship(spark)
    repeated = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    need = k + repeated  # rows among which a query finds k that are not its own
    same = Window.partitionBy("vector").orderBy("vec_id")
    rows = rows.withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= need).drop("_same")
    rows = materialized(rows, "vectors")
    total = rows.count()
    most = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width))
    share = min(1.0, most / max(total, 1))
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array([r.vector for r in drawn.select("vector").limit(most).collect()], np.float64).reshape(-1, width)
    points = max(min(LEAF_POINTS, LEAF_ROWS), LEAF_ROWS * len(sample) / max(total, 1))
    tree = grow_tree(sample, max(1, int(points))) if len(sample) else grow_tree(np.zeros((0, width)), 1)
    centers = np.zeros((tree.leaves, width))
    if len(tree.leaf):
        centers[tree.leaf[tree.leaf >= 0]] = tree.centroids[tree.leaf >= 0]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            found = leaf_of(tree, vectors)
            far = np.sqrt(((vectors - centers[found]) ** 2).sum(axis=1))
            columns = [*batch.columns, pa.array(found), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "leaf", "far"])

    visits = calibrate(rows, queries, width, tree, k, target)

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"vec_id bigint, vector {kind}, leaf bigint, far double"
    placed = materialized(in_tasks(rows, place, schema), "leaves")
    # one row per leaf, so a bounded number
    sizes, radius = np.zeros(tree.leaves, np.int64), np.zeros(tree.leaves)
    for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():
        sizes[r.leaf], radius[r.leaf] = r.n, r.far
    way = paths(tree)
    group = groups_of(way, sizes, max(1, min(tree.leaves, max(GROUPS, -(-total // GROUP_ROWS)))))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _WALK_NUMBERS // max(1, way.size))
        for batch in batches:
            vectors, bins = _matrix(batch.column("vector"), width), []
            for at in range(0, len(vectors), step):
                order = walk_order(tree, vectors[at : at + step], way)
                enough = (np.cumsum(sizes[order], axis=1) < need).sum(axis=1) + 1
                bins += [leaves[: max(visits, n)] for leaves, n in zip(order.astype(np.int32), enough)]
            columns = [*batch.columns, pa.array(bins, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "bins"])

    def ask(first: bool):
        """A row per query and group that it visits, with its leaves there: the first group, or all others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _matrix(batch.column("vector"), width)
                least = batch.column("least").to_numpy(zero_copy_only=False).astype(float)
                norms = np.sqrt((vectors**2).sum(axis=1))
                who, where, leaves = [], [], []
                for n, bins in enumerate(batch.column("bins").to_pylist()):
                    bins = np.array(bins, np.int64)
                    bins = bins[sizes[bins] > 0]
                    if not len(bins):
                        continue
                    mine = group[bins] == group[bins[0]]
                    bins = bins[mine] if first else bins[~mine]
                    if not first and not np.isnan(least[n]):
                        bound = centers[bins] @ vectors[n] + norms[n] * radius[bins]
                        bins = bins[bound >= least[n] - 1e-9 * (1 + abs(least[n]))]
                    for g in np.unique(group[bins]).tolist():
                        who.append(n)
                        where.append(g)
                        leaves.append(bins[group[bins] == g].astype(np.int32))
                take = pa.array(who, pa.int64())
                columns = [batch.column(c).take(take) for c in ("vec_id", "vector", "least")]
                columns += [pa.array(where, pa.int64()), pa.array(leaves, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "least", "grp", "leaves"])

        return run

    kind = queries.schema["vector"].dataType.simpleString()
    walked = materialized(in_tasks(queries, walk, f"vec_id bigint, vector {kind}, bins array<int>"), "walks")
    asked = f"vec_id bigint, vector {kind}, least double, grp bigint, leaves array<int>"
    numbers = spark.createDataFrame([(n, int(g)) for n, g in enumerate(group)], "leaf bigint, grp bigint")
    placed = placed.join(F.broadcast(numbers), "leaf").select("vec_id", "vector", "leaf", "grp")  # a row per leaf
    rows_of = np.bincount(group, sizes, group.max() + 1).astype(np.int64)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return materialized(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")

    begin = walked.withColumn("least", F.lit(None).cast("double"))
    best = ranked(_visit(placed, in_tasks(begin, ask(True), asked), rows_of, width, k))
    worst = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    rest = in_tasks(walked.join(worst, "vec_id", "left").select("vec_id", "vector", "bins", "least"), ask(False), asked)
    best = ranked(_visit(placed, materialized(rest, "asking"), rows_of, width, k).unionByName(best.drop("rank")))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _visit(placed: DataFrame, asking: DataFrame, rows_of: np.ndarray, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of what queries find in the groups they ask (vec_id, vector, least, grp, leaves)."""
    spark = placed.sparkSession
    askers = {r.grp: r.n for r in asking.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per group
    tiles = spark.createDataFrame(
        [(g, int(-(-rows_of[g] // TILE_ROWS)), -(-n // TILE_QUERIES)) for g, n in askers.items() if rows_of[g]],
        "grp bigint, blocks bigint, slices bigint",
    )
    tiles = F.broadcast(tiles)  # at most one row per group

    def spread(own: str, others: str, own_name: str, other_name: str) -> Column:
        """This row's own part, paired with every part of the other side."""
        mine = F.pmod(F.xxhash64("vec_id"), F.col(own)).alias(own_name)
        parts = F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1)
        return F.explode(F.transform(parts, lambda part: F.struct(mine, part.alias(other_name)))).alias("t")

    left = placed.join(tiles, "grp").select(
        "grp", "vec_id", "vector", "leaf", spread("blocks", "slices", "block", "slice")
    ).select("vec_id", "vector", "leaf", "grp", "t.block", "t.slice")
    right = asking.join(tiles, "grp").select(
        "grp", "vec_id", "vector", "least", "leaves", spread("slices", "blocks", "slice", "block")
    ).select("vec_id", "vector", "least", "leaves", "grp", "t.block", "t.slice")

    def tile(mine: pa.Table, wanted: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not mine.num_rows or not wanted.num_rows:
            empty = pa.array([], pa.int64())
            return pa.table([empty, empty, pa.array([], pa.float64())], names=names)
        row_ids, query_ids = mine.column("vec_id").to_numpy(), wanted.column("vec_id").to_numpy()
        points, vectors = (_matrix(t.column("vector").combine_chunks(), width) for t in (mine, wanted))
        least = wanted.column("least").to_numpy().astype(float)
        leaves = wanted.column("leaves").to_pylist()
        q, r, score = search_tile(points, row_ids, mine.column("leaf").to_numpy(), vectors, query_ids, leaves, least, k)
        return pa.table([pa.array(query_ids[q]), pa.array(row_ids[r]), pa.array(score)], names=names)

    keys = ["grp", "block", "slice"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        tile, "query_id bigint, vec_id bigint, score double"
    )


def neighbours_of_every_20th(table: DataFrame, k: int = 20, target: float = TARGET_RECALL) -> DataFrame:
    """`nearest` with the rows whose vec_id is divisible by 20 as queries, against all rows.

    An empty table, or one without valid vectors, gives no rows. Of repeated ids with different vectors each is
    a query, and their results are ranked together.
    """
    rows, width = valid_vectors(table, "vec_id", "embedding")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), width, k, target)
