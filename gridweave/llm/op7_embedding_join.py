"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, connected_components, open_uri, table

THRESHOLD = 0.9
BLOCK = 1 << 14  # vectors of a leaf interval at most
BLOCK_BYTES = 8 << 20  # and of their numbers
INNER = 256  # vectors of the smallest interval that is told apart within a leaf
FANOUT = 16
AXES = 6  # leading principal dimensions of the grid
SAMPLE = 4096  # vectors from which the principal dimensions are taken; any directions give right results


def _classes(vectors: DataFrame, id_col: str, col: str) -> DataFrame:
    """(id, key, vec): vec holds doubles; key is the same for equal vectors, and null for those that can't be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vecs = [], []
            for name, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = None if name is None or v is None or None in v else np.array(v, np.float64)
                if x is not None and len(x) and np.isfinite(x).all() and x.any():
                    raw = (x + 0.0).tobytes()  # -0.0 and 0.0 are one
                    keys.append(xxhash.xxh3_128_digest(raw) + len(x).to_bytes(4, "little"))
                    vecs.append(raw)
                else:
                    keys.append(None)
                    vecs.append(None)
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["id", "key", "vec"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(id_col, col).mapInArrow(run, f"id {kind}, key binary, vec binary")


def _axes(classes: DataFrame, n: int = SAMPLE, k: int = AXES) -> dict[int, np.ndarray]:
    """By length of vector, orthonormal leading directions, of a bounded sample in the order of a hash."""
    rows = classes.select("vec").orderBy(F.xxhash64("key"), "key").limit(n).collect()
    out = {}
    for size in {len(r["vec"]) // 8 for r in rows}:
        x = np.array([np.frombuffer(r["vec"]) for r in rows if len(r["vec"]) == 8 * size])
        x = _unit(x)
        out[size] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :k]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of huge or tiny numbers run over
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _grid(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, k: int = AXES) -> DataFrame:
    """Adds the cell on the leading directions, as an array to sort by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column(batch.schema.get_field_index("vec")).to_pylist()
            cells = []
            for v in vecs:
                x = np.frombuffer(v)
                y = _unit(x[None])[0, :k] if len(x) not in axes else _unit(x[None])[0] @ axes[len(x)]
                cells.append([len(x), *np.floor(y / eps).astype(int).tolist(), *[0] * (k - len(y))])
            yield pa.record_batch([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])

    return classes.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in classes.schema)}, cell array<int>")


def _numbered(cells: DataFrame, scratch: Scratch, tasks: int, block: int) -> DataFrame:
    """Each class with its number along the order of cells, `node`, and its leaf interval; both from 0.

    The order is dealt out by ranges of (cell, hash of key), so one crowded cell spreads over many tasks. Only a count
    for each task is summed over all. Numbers are written before they are used, so that they stay what they are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            seq = pa.array(np.arange(seen, seen + batch.num_rows))
            yield pa.record_batch([*batch.columns, pa.array(np.full(batch.num_rows, part)), seq], names=[*batch.schema.names, "part", "seq"])
            seen += batch.num_rows

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema)
    order = ["cell", F.xxhash64("key"), "key"]
    ordered = cells.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = scratch.keep(ordered.mapInArrow(count, f"{fields}, part long, seq long").drop("cell"), "ordered")
    sums = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = sums.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    node = F.col("first") + F.col("seq")
    return placed.join(F.broadcast(first), "part").withColumn("node", node).withColumn("leaf", F.floor(node / block).cast("long")).drop("part", "seq", "first")


def _leaves(numbered: DataFrame, axes: dict[int, np.ndarray], scratch: Scratch, folder: str, k: int = AXES) -> DataFrame:
    """(leaf, lo, hi) for each leaf interval: its box on the leading directions. Its vectors go to a file in folder.

    A file holds one leaf and is renamed when whole, so a task that runs again leaves the same file.
    """

    def build(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("node")
        ys = []
        for v in own["vec"]:
            x = np.frombuffer(v)
            y = _unit(x[None])[0, :k] if len(x) not in axes else _unit(x[None])[0] @ axes[len(x)]
            ys.append([len(x) * 10.0, *y, *[0.0] * (k - len(y))])  # vectors of other lengths are far away
        y = np.array(ys)
        inner = np.lexsort(y.T[::-1])
        own, y = own.iloc[inner], y[inner]
        arrays = (own["node"].to_numpy(np.int64), own["copies"].to_numpy(np.int64), own["vec"].map(len).to_numpy(np.int64), np.frombuffer(b"".join(own["vec"])), y)
        leaf = int(own["leaf"].iloc[0])
        _save(f"{folder}/{leaf}", arrays)
        return pd.DataFrame({"leaf": [leaf], "lo": [y.min(axis=0).tolist()], "hi": [y.max(axis=0).tolist()]})

    return scratch.keep(numbered.groupBy("leaf").applyInPandas(build, "leaf long, lo array<double>, hi array<double>"), "leaves")


def _save(uri: str, arrays: tuple[np.ndarray, ...]) -> None:
    from pyspark import TaskContext

    store, path, file = open_uri(f"{uri}.{TaskContext.get().taskAttemptId()}.tmp", write=True)
    with file:
        for x in arrays:
            raw = io.BytesIO()
            np.save(raw, x)
            file.write(raw.getvalue())
    store.move(path, path.rsplit(".", 2)[0])


def _load(uri: str) -> _Leaf:
    with open_uri(uri)[2] as file:
        raw = io.BytesIO(file.read())
    return _Leaf([np.load(raw) for _ in range(5)])


def _near(a: str, b: str, eps: float) -> F.Column:
    """Whether two boxes may hold points within eps."""
    gap = f"zip_with(zip_with({a}.lo, {b}.hi, (x, y) -> x - y), zip_with({b}.lo, {a}.hi, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D))"
    return F.expr(f"aggregate({gap}, 0D, (s, x) -> s + x * x) <= {(eps + 1e-9) ** 2!r}")


def _interval_pairs(leaves: DataFrame, eps: float, fanout: int = FANOUT) -> DataFrame:
    """(a, b), a <= b: pairs of leaf intervals that aren't provably distant.

    Intervals of `fanout` intervals form a tree. From the root pair downwards each surviving pair is replaced by the
    pairs of its children, with an equi-join on the parent for either side, and pairs with distant boxes are skipped.
    """
    k = AXES + 1
    box = [f(F.col(side)[i]).alias(f"{side}{i}") for side, f in (("lo", F.min), ("hi", F.max)) for i in range(k)]
    base = leaves.select(F.col("leaf").alias("node"), "lo", "hi")
    most = base.agg(F.max("node")).first()[0]
    if most is None:
        return base.select(F.col("node").alias("a"), F.col("node").alias("b"))
    levels = [base]
    while most:
        most //= fanout
        up = levels[-1].groupBy(F.floor(F.col("node") / fanout).cast("long").alias("node")).agg(*box)
        levels.append(up.select("node", F.array(*(f"lo{i}" for i in range(k))).alias("lo"), F.array(*(f"hi{i}" for i in range(k))).alias("hi")))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        kids = level.select(F.floor(F.col("node") / fanout).cast("long").alias("parent"), "node", "lo", "hi")
        one = pairs.join(kids.alias("p"), F.col("a") == F.col("p.parent")).select("b", F.struct("node", "lo", "hi").alias("x"))
        both = one.join(kids.select(F.col("parent").alias("up"), F.struct("node", "lo", "hi").alias("y")), F.col("b") == F.col("up"))
        pairs = both.where("x.node <= y.node").where(_near("x", "y", eps)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return pairs


class _Leaf:
    def __init__(self, arrays):
        self.ids, self.copies, self.sizes, self.flat, self.spots = arrays
        self.ends = np.cumsum(self.sizes // 8)

    def vectors(self, a: int, b: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in a..b that hold vectors of this many numbers, and the vectors."""
        at = np.arange(a, b)[self.sizes[a:b] == 8 * size]
        return at, np.array([self.flat[self.ends[i] - size : self.ends[i]] for i in at]).reshape(len(at), size)


def _tiles(a: _Leaf, b: _Leaf, same: bool, eps: float, span: tuple[int, int, int, int]) -> Iterator[tuple[int, int, int, int]]:
    """Recursive join of two intervals: halves the longer one, and skips pairs whose boxes are distant."""
    a0, a1, b0, b1 = span
    if same and b1 <= a0:
        return
    x, y = a.spots[a0:a1], b.spots[b0:b1]
    gap = np.maximum(0, np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)))
    if (gap * gap).sum() > (eps + 1e-9) ** 2:
        return
    if max(a1 - a0, b1 - b0) <= INNER:
        yield span
    elif a1 - a0 >= b1 - b0:
        m = (a0 + a1) // 2
        yield from _tiles(a, b, same, eps, (a0, m, b0, b1))
        yield from _tiles(a, b, same, eps, (m, a1, b0, b1))
    else:
        m = (b0 + b1) // 2
        yield from _tiles(a, b, same, eps, (a0, a1, b0, m))
        yield from _tiles(a, b, same, eps, (a0, a1, m, b1))


def join_leaves(a: _Leaf, b: _Leaf, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of a's classes, links of b's classes, u, v): u, v are ids whose edges connect all that is linked here.

    Links count copies. The cosine is a double; within 1e-9 of the threshold it is taken again by its plain formula.
    """
    eps = math.sqrt(2 - 2 * threshold)
    la, lb = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a0, a1, b0, b1 in _tiles(a, b, same, eps, (0, len(a.ids), 0, len(b.ids))):
        for size in np.unique(a.sizes[a0:a1]) // 8:
            i, x = a.vectors(a0, a1, size)
            j, y = b.vectors(b0, b1, size)
            if not len(j):
                continue
            cos = _unit(x) @ _unit(y).T
            for p, q in zip(*np.nonzero(np.abs(cos - threshold) < 1e-9), strict=True):
                cos[p, q] = x[p] @ y[q] / (math.sqrt(x[p] @ x[p]) * math.sqrt(y[q] @ y[q]))
            near = cos >= threshold
            if same:
                near &= i[:, None] < j[None, :]
            if not near.any():
                continue
            np.add.at(la, i, near @ b.copies[j])
            np.add.at(lb, j, a.copies[i] @ near)
            u, v = _stars(near, a.ids[i], b.ids[j])
            us.append(u)
            vs.append(v)
    return la, lb, np.concatenate(us), np.concatenate(vs)


def _stars(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked id to the least id of its component within this tile: no more than there are ids."""
    big = np.iinfo(np.int64).max
    rows, cols = np.nonzero(near)
    l, r = np.where(near.any(1), left, big), np.where(near.any(0), right, big)
    while True:
        low = np.minimum(l[rows], r[cols])
        l2, r2 = l.copy(), r.copy()
        np.minimum.at(l2, rows, low)
        np.minimum.at(r2, cols, low)
        if (l2 == l).all() and (r2 == r).all():
            break
        l, r = l2, r2
    u, v = np.concatenate((left[l < big], right[r < big])), np.concatenate((l[l < big], r[r < big]))
    return u[u != v], v[u != v]


def linked(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """id_col, n_links, component_id, kept: a row for each row of vectors.

    Pairs link at a cosine of at least threshold (over 0). Vectors that are null, empty or zero, or hold null or
    non-finite numbers, link with nothing, nor do rows without an id or vectors of different lengths; their n_links is
    0 and their component is their own id. Equal vectors are one class that is joined once, however many there are,
    and whose copies count as links; pairs between classes are counted and never sent. Classes are named by their place
    in the order, and components by the least id of their rows only at the end; so rows that share an id but not a
    vector are rows of their own.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine over 0")
    spark: SparkSession = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    eps = math.sqrt(2 - 2 * threshold)
    rows = scratch.keep(_classes(vectors, id_col, col), "rows")
    grouped = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"), F.min("vec").alias("vec"))
    classes = scratch.keep(grouped, "classes")
    axes = _axes(classes)
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.length("vec")), F.lit(8)).alias("longest")).first()
    block = max(1, min(block, BLOCK_BYTES // size["longest"]))
    tasks = max(1, math.ceil(size["n"] / block))
    numbered = scratch.keep(_numbered(_grid(classes, axes, eps), scratch, tasks, block), "numbered")
    folder = scratch.path("files")
    leaves = _leaves(numbered, axes, scratch, folder)
    pairs = scratch.keep(_interval_pairs(leaves, eps), "pairs")
    dealt = pairs.repartitionByRange(max(1, min(pairs.count(), 10_000)), "a", "b").sortWithinPartitions("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, a = None, None
        for batch in batches:
            for i, j in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i != at:
                    at, a = i, _load(f"{folder}/{i}")
                b = a if i == j else _load(f"{folder}/{j}")
                la, lb, u, v = join_leaves(a, b, i == j, threshold)
                p, q = la > 0, lb > 0
                node = np.concatenate((a.ids[p], b.ids[q], u))
                other = np.concatenate((a.ids[p], b.ids[q], v))
                n = np.concatenate((la[p], lb[q], np.zeros(len(u), np.int64)))
                yield pa.record_batch([pa.array(node), pa.array(other), pa.array(n)], names=["u", "v", "n"])

    found = scratch.keep(dealt.mapInArrow(run, "u long, v long, n long"), "found")
    counts = found.where("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("far"))
    groups = connected_components(found.where("u != v").select("u", "v"), scratch)
    placed = numbered.select("key", "node", "low", "copies").join(counts, "node", "left").join(groups, "node", "left").withColumn("root", F.coalesce("component", "node"))
    names = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    about = placed.join(names, "root").select("key", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), "component_id")
    joined = rows.where("key IS NOT NULL").select("id", "key").join(about, "key").select("id", "n_links", "component_id")
    alone = rows.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    wide = "long" if vectors.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int") else vectors.schema[id_col].dataType
    return joined.unionAll(alone).select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast(wide).alias("component_id"), kept.alias("kept"))


def op7_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))
