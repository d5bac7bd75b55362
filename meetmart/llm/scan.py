"""Running products of an associative operation along sorted groups, without a group having to fit one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import in_tasks
from meetmart.sources.scratch import materialized

#: Elements side by side (rows x numbers): the left ones, then the right ones.
Combine = Callable[[np.ndarray, np.ndarray], np.ndarray]


def running(starts: np.ndarray, values: np.ndarray, combine: Combine) -> np.ndarray:
    """Inclusive products within consecutive groups; `starts` holds the index at which each row's group begins."""
    values = values.copy()
    at = np.arange(len(values))
    longest = int((at - starts).max()) if len(at) else 0
    reach = 1
    while reach <= longest:
        far = at[at - starts >= reach]
        values[far] = combine(values[far - reach], values[far])
        reach *= 2
    return values


def scanned(
    rows: DataFrame, key: str, order: list[str | Column], elements: list[str], combine: Combine, name: str
) -> DataFrame:
    """`rows` with each of `elements` (bigint columns) replaced by the product up to its row within `key`.

    Rows are sorted across tasks by key and order, so a key with a large part of all rows spans many tasks. Tasks
    scan what they hold; of the keys that go on in the next task only the totals (two rows a task at most) meet on
    the driver, and the products before a task come back as a table of that size. `key` is a bigint, never null. The
    first element counts rows: it is 1 and adds up.
    """
    ordered = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    names = rows.columns
    schema = f"{_ddl(rows)}, _task int"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last_key, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            begin = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
            starts = np.repeat(begin, np.diff(np.r_[begin, len(keys)]))
            values = running(starts, np.stack([batch.column(e).to_numpy() for e in elements], axis=1), combine)
            if last_key is not None and keys[0] == last_key:
                first = starts == 0
                values[first] = combine(np.broadcast_to(last, values[first].shape), values[first])
            last_key, last = keys[-1], values[-1:].copy()
            columns = [pa.array(values[:, elements.index(c)]) if c in elements else batch.column(c) for c in names]
            columns.append(pa.array(np.full(len(keys), task, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_task"])

    done = materialized(in_tasks(ordered, local, schema), name)
    before = _before_tasks(done, key, elements, combine)
    if not before:
        return done.drop("_task")
    spanning = {k for k, _ in before}

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, tasks = batch.column(key).to_numpy(), batch.column("_task").to_numpy()
            values = np.stack([batch.column(e).to_numpy() for e in elements], axis=1)
            hit = np.isin(keys, list(spanning))
            for k, t in set(zip(keys[hit].tolist(), tasks[hit].tolist())):
                if (k, t) in before:
                    mine = (keys == k) & (tasks == t)
                    values[mine] = combine(np.broadcast_to(before[k, t], values[mine].shape), values[mine])
            columns = [pa.array(values[:, elements.index(c)]) if c in elements else batch.column(c) for c in batch.schema.names[:-1]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return in_tasks(done, move, _ddl(rows))


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)


def _before_tasks(done: DataFrame, key: str, elements: list[str], combine: Combine) -> dict:
    """For each key that began in an earlier task, and each later task of it: the product of all before."""
    edges = done.groupBy("_task").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()  # a row a task
    held: dict[int, list[int]] = {}
    for row in sorted(edges):
        for k in {row.low, row.high}:
            held.setdefault(k, []).append(row._task)
    held = {k: tasks for k, tasks in held.items() if len(tasks) > 1}
    if not held:
        return {}
    pairs = done.sparkSession.createDataFrame([(k, t) for k, tasks in held.items() for t in tasks], f"`{key}` bigint, _task int")
    totals: dict = {}
    # the last of a key's rows in a task has the total
    last = F.max(F.struct(F.col(elements[0]).alias("_number"), *elements)).alias("last")
    for row in done.join(F.broadcast(pairs), [key, "_task"]).groupBy(key, "_task").agg(last).collect():
        totals[row[key], row._task] = np.array([[row["last"][e] for e in elements]], np.int64)
    before = {}
    for k, tasks in held.items():
        so_far = None
        for t in tasks:
            if so_far is not None:
                before[k, t] = so_far
            so_far = totals[k, t] if so_far is None else combine(so_far, totals[k, t])
    return before
