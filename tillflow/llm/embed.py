"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c) of each other, in every
projection too. All vectors of a label are put in epsilon grid order: sorted by the grid
cells (width eps) of their leading principal components. Consecutive vectors form blocks,
consecutive blocks form intervals, FAN at a time, up to one interval a label. The join starts
with each top interval against itself and goes down level by level: a pair of intervals whose
bounding boxes are further than eps apart is provably distant and skipped with all
below it; the others are replaced by the pairs of their children. What remains at the
bottom are pairs of blocks, whose cosines are one matrix product in double precision.

Equal vectors of a label collapse to one before the join and count by their number. A pair
of blocks doesn't return its links: it returns how many each vector has, and the edges
of a spanning forest, at most one a vector. So a group of n near copies costs n rows a block pair,
not n squared. Components come from the forests.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label or vec_id, link with nothing and are components of their own; vectors of
different lengths never link; rows that repeat a vec_id with the same vector and label count once; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.graph import components
from tillflow.session import checkpoint_dir

COSINE = 0.98
#: Leading principal dimensions of the grid and of the bounding boxes.
DIMS = 6
BLOCK = 512
FAN_BITS = 4
#: Directions that the covariance is summed along.
SKETCH = 64
#: Slack for rounding in the provable bound.
SLACK = 1e-7


def _norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _valid(rows: DataFrame) -> Column:
    total = _norm(F.col("embedding"))  # null if a component is, and not finite if one isn't
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                      & ~F.isnan(total) & (total > 0) & (total < float("inf")), F.lit(False))


def _matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if dim is None else flat.reshape(-1, dim)


def principal_axes(reps: DataFrame, dim: int, dims: int = DIMS) -> np.ndarray:
    """(dim, dims) orthonormal axes of large variance of the unit vectors.

    The tasks sum the covariance times SKETCH fixed directions, so that dim * SKETCH sums reach the
    driver; up to SKETCH components these are the coordinate axes and the sums the covariance itself, beyond
    it is completed from them (Nystrom). Any orthonormal axes give right results; better ones skip more blocks."""
    rank = min(dim, SKETCH)
    ways = np.eye(dim) if dim <= SKETCH else np.linalg.qr(np.random.default_rng(11).standard_normal((dim, rank)))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first, n = np.zeros((dim, rank)), np.zeros(dim), 0
        for batch in batches:
            if batch.num_rows:
                u = _matrix(batch.column("embedding"))
                u /= np.linalg.norm(u, axis=1, keepdims=True)
                total += u.T @ (u @ ways)
                first += u.sum(0)
                n += len(u)
        if n:
            both = np.concatenate([total.reshape(-1), first, [n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], ["i", "x"])
    sums = (reps.filter(F.size("embedding") == dim).select("embedding").mapInArrow(run, "i long, x double")
            .groupBy("i").agg(F.sum("x").alias("x")).collect())
    flat = np.zeros(dim * rank + dim + 1)
    for r in sums:
        flat[r["i"]] = r["x"]
    n = max(flat[-1], 1)
    mean = flat[dim * rank: -1] / n
    part = flat[: dim * rank].reshape(dim, rank) / n - np.outer(mean, mean @ ways)
    if dim <= SKETCH:
        return np.linalg.eigh(part)[1][:, ::-1][:, :dims]
    size, turn = np.linalg.eigh((ways.T @ part + part.T @ ways) / 2)
    size = np.maximum(size, 1e-9 * max(size.max(), 1e-300))
    return np.linalg.svd(part @ (turn / np.sqrt(size)), full_matrices=False)[0][:, :dims]


def _block_table(reps: DataFrame, axes: np.ndarray, eps: float, size: int) -> DataFrame:
    """Blocks of consecutive vectors in epsilon grid order; ids, numbers and vectors are binary."""
    dims = axes.shape[1]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            u = _matrix(batch.column("embedding"))
            u /= np.linalg.norm(u, axis=1, keepdims=True)
            y = u @ axes
            grid = np.floor(y / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("many"), batch.column("label"), batch.column("embedding"),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * dims), pa.array(y.reshape(-1))),
                 *[pa.array(grid[:, d]) for d in range(dims)]],
                ["rep", "many", "label", "embedding", "y", *[f"g{d}" for d in range(dims)]])
    grid_cols = [f"g{d}" for d in range(dims)]
    kind = dict(reps.dtypes)
    shape = (f"rep long, many long, label {kind['label']}, embedding {kind['embedding']}, y array<double>, "
             + ", ".join(f"{g} int" for g in grid_cols))
    order = ["label", *grid_cols, "rep"]
    ranged = (reps.select("rep", "many", "label", "embedding").mapInArrow(cells, shape)
              .repartitionByRange(*order).sortWithinPartitions(*order))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        label, held, have = None, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, have
            part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, have = [], 0
            y = _matrix(part.column("y"), dims)
            vectors = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([task], pa.int64()), pa.array([number - 1], pa.int64()), part.column("label").slice(0, 1),
                pa.array([y.min(0).tolist()]), pa.array([y.max(0).tolist()]),
                pa.array([part.column("rep").to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([part.column("many").to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([vectors.tobytes()], pa.binary()), pa.array([vectors.dtype.str])],
                ["task", "number", "label", "lo", "hi", "ids", "many", "vectors", "kind"])
        for batch in batches:
            labels = batch.column("label").to_pylist()
            at = 0
            while at < len(labels):
                if held and (labels[at] != label or have == size):
                    yield close()
                label = labels[at]
                end = at
                while end < len(labels) and labels[end] == label and end - at < size - have:
                    end += 1
                held.append(batch.slice(at, end - at))
                have += end - at
                at = end
        if held:
            yield close()
    return ranged.mapInArrow(
        gather, f"task long, number long, label {kind['label']}, lo array<double>, hi array<double>, "
                "ids binary, many binary, vectors binary, kind string")


def _near(eps: float) -> Column:
    """Whether the boxes (lo, hi) and (lo2, hi2) are within eps."""
    gap = F.zip_with(F.zip_with("lo", "hi2", lambda a, b: a - b), F.zip_with("lo2", "hi", lambda a, b: a - b),
                     lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= F.lit((eps + SLACK) ** 2)


def _intervals(blocks: DataFrame) -> DataFrame:
    """(node, label, lo, hi): the next level, FAN consecutive nodes of a label as one."""
    dims = range(DIMS)
    up = blocks.groupBy(F.shiftright("node", FAN_BITS).alias("node"), "label").agg(
        F.array(*[F.min(F.get("lo", F.lit(d))) for d in dims]).alias("lo"),
        F.array(*[F.max(F.get("hi", F.lit(d))) for d in dims]).alias("hi"))
    return up.select("node", "label", F.filter("lo", lambda x: x.isNotNull()).alias("lo"),
                     F.filter("hi", lambda x: x.isNotNull()).alias("hi"))


def _as_pairs(pairs: DataFrame, nodes: DataFrame, eps: float) -> DataFrame:
    """Pairs (a <= b) of the children of ``pairs`` whose boxes are near."""
    kids = nodes.withColumn("up", F.shiftright("node", FAN_BITS))
    left = kids.select(F.col("up").alias("pa"), "label", F.col("node").alias("a"), "lo", "hi")
    right = kids.select(F.col("up").alias("pb"), F.col("label").alias("label2"), F.col("node").alias("b"),
                        F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    both = (pairs.withColumnRenamed("label", "plabel").join(left, (F.col("pa") == F.col("a0")) & (F.col("plabel") == F.col("label")))
            .join(right, (F.col("pb") == F.col("b0")) & (F.col("label2") == F.col("label"))))
    return both.filter("a <= b").filter(_near(eps)).select("label", F.col("a").alias("a0"), F.col("b").alias("b0"))


def near_pairs(nodes: DataFrame, top_level: int, eps: float) -> DataFrame:
    """(label, a0, b0): the block pairs that the descent through the intervals can't rule out."""
    levels = [nodes.select("node", "label", "lo", "hi")]
    for _ in range(top_level):
        levels.append(_intervals(levels[-1]).checkpoint())
    pairs = levels[-1].select("label", F.col("node").alias("a0"), F.col("node").alias("b0"))
    for level in reversed(levels[:-1]):
        pairs = _as_pairs(pairs, level, eps).checkpoint()
    return pairs


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a boolean matrix, the smallest row of its component (a large number if none)."""
    far = np.int64(1 << 40)
    i, j = np.nonzero(linked)
    row = np.where(linked.any(1), np.arange(linked.shape[0], dtype=np.int64), far)
    col = np.full(linked.shape[1], far)
    while True:
        np.minimum.at(col, j, row[i])
        new = row.copy()
        np.minimum.at(new, i, col[j])
        # The label of a label is a shorter way to the root.
        good = new < far
        new[good] = np.minimum(new[good], new[new[good]])
        if (new == row).all():
            return row, col
        row = new


def block_links(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (v, w, n): n links of v if w is null, else a forest edge between v and w."""
    def unit(row: dict, side: str) -> np.ndarray:
        ids = np.frombuffer(row["ids" + side], "<i8")
        x = np.frombuffer(row["vectors" + side], row["kind" + side]).astype(np.float64).reshape(len(ids), -1)
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            ida, idb = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["ids2"], "<i8")
            ma, mb = np.frombuffer(row["many"], "<i8"), np.frombuffer(row["many2"], "<i8")
            a, b = unit(row, ""), unit(row, "2")
            if a.shape[1] != b.shape[1]:
                continue
            linked = a @ b.T >= cosine
            same = row["a0"] == row["b0"]
            if same:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            na = linked @ mb
            has = np.flatnonzero(na)
            v, w, n = [ida[has]], [np.full(len(has), -1)], [na[has]]
            if not same:
                nb = ma @ linked
                has = np.flatnonzero(nb)
                v, w, n = [*v, idb[has]], [*w, np.full(len(has), -1)], [*n, nb[has]]
            top, side = _forest(linked)
            for names, root in ((ida, top), (idb, side)):
                got = np.flatnonzero(root < (1 << 40))
                other = ida[root[got]]
                new = names[got] != other
                v.append(names[got][new])
                w.append(other[new])
                n.append(np.zeros(int(new.sum()), np.int64))
            v, w, n = (np.concatenate(x).astype(np.int64) for x in (v, w, n))
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(w, mask=w == -1) if (n > 0).any() else pa.array(w), pa.array(n)],
                                             ["v", "w", "n"])


def near_duplicates(table: DataFrame, cosine: float = COSINE, size: int = BLOCK) -> DataFrame:
    """The contract's row per vector."""
    spark = table.sparkSession
    checkpoint_dir(spark)
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = table.select("vec_id", "label", "embedding")
    keyed = rows.withColumn("ok", _valid(rows)).withColumn("h1", F.xxhash64("embedding")).withColumn(
        "h2", F.xxhash64(F.lit(7), "embedding"))
    good = keyed.filter("ok")
    groups = (good.groupBy("label", "h1", "h2", "vec_id").agg(F.lit(1).alias("one"))
              .groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))).checkpoint()
    own = groups.select(F.col("label").alias("l"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), "rep", "many")
    match = (F.col("label") == F.col("l")) & (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2"))
    reps = (good.join(own, match & (F.col("vec_id") == F.col("rep")))
            .select("rep", "many", "label", "embedding", "h1", "h2").dropDuplicates(["rep", "label", "h1", "h2"])
            .drop("h1", "h2").checkpoint())
    widths = [r[0] for r in reps.select(F.size("embedding")).distinct().collect()]  # the lengths of vectors that occur
    counted = None
    for dim in sorted(widths):
        mine = reps.filter(F.size("embedding") == dim)
        axes = principal_axes(mine, dim)
        blocks = _block_table(mine, axes, eps, size).checkpoint()
        seen = blocks.agg(F.max("number").alias("n"), F.max("task").alias("t")).first()
        bits = int(seen["n"]).bit_length()
        nodes = blocks.withColumn("node", F.shiftleft("task", bits) + F.col("number"))
        top = -(-(bits + int(seen["t"]).bit_length()) // FAN_BITS)
        pairs = near_pairs(nodes, top, eps)
        full = nodes.select("node", "ids", "many", "vectors", "kind")
        second = full.select(F.col("node").alias("node2"), *[F.col(c).alias(c + "2") for c in ("ids", "many", "vectors", "kind")])
        joined = (pairs.join(full, F.col("a0") == F.col("node")).join(second, F.col("b0") == F.col("node2"))
                  .select("a0", "b0", *[c + s for s in ("", "2") for c in ("ids", "many", "vectors", "kind")]))
        links = joined.mapInArrow(lambda it: block_links(it, cosine), "v long, w long, n long")
        counted = links if counted is None else counted.union(links)
    if counted is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    counted = counted.checkpoint()
    labels = components(counted.filter("w is not null").select(F.col("v").alias("a"), F.col("w").alias("b")))
    many = counted.filter("w is null").groupBy("v").agg(F.sum("n").alias("n"))
    named = labels.select(F.col("v").alias("cv"), F.col("label").alias("component"))
    found = (groups.join(many, F.col("rep") == F.col("v"), "left").join(named, F.col("rep") == F.col("cv"), "left")
             .select(F.col("label").alias("l"), F.col("h1").alias("a1"), F.col("h2").alias("a2"),
                     (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")).checkpoint())
    out = keyed.join(found, F.col("ok") & match, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
