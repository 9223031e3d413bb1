"""Connected components of a link table: forests within tasks, star contraction in Spark joins across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import checkpoint_dir

#: Links that a task reduces to a forest at a time (16 bytes each).
TASK_LINKS = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) for the vertices of some links that aren't the smallest."""
    names, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = where[: len(a)], where[len(a):]
    label = np.arange(len(names))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        # Also the labels' own labels move, so paths shrink by half or more.
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, have = [], 0

    def close() -> pa.RecordBatch:
        a, b = (np.concatenate([h.column(k).to_numpy() for h in held]) for k in ("a", "b"))
        v, root = forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(root)], ["a", "b"])
    for batch in batches:
        held.append(batch)
        have += batch.num_rows
        if have >= TASK_LINKS:
            yield close()
            held, have = [], 0
    if have:
        yield close()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(v, label)`` for every vertex that has a link; label is its component's smallest vertex.

    ``edges`` has long columns ``a`` and ``b``; loops, repeats and nulls are
    ignored. In each round the links are dealt TASK_LINKS a task at least, every task
    replaces its links by a forest with the same components, and where there are several tasks
    a star contraction joins their forests, until nothing changes. Each step ends in a reliable checkpoint. A hot
    vertex is an aggregate with map-side combine and a join that the runtime can split.
    """
    checkpoint_dir(edges.sparkSession)
    now = edges.select("a", "b").filter("a != b").checkpoint()
    mark = None
    while True:
        n = now.count()
        now = now.coalesce(max(1, n // TASK_LINKS)).mapInArrow(_forests, "a long, b long").checkpoint()
        if n < TASK_LINKS:  # one task, one forest
            break
        now = _small_star(_large_star(now)).checkpoint()
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("b").alias("v"), F.col("b").alias("label"))
    return now.select(F.col("a").alias("v"), F.col("b").alias("label")).union(roots.distinct())
