"""Embedding near-duplicates by an epsilon grid order join.

Vectors of cosine ``least`` or more lie, scaled to length 1, within ``epsilon`` of each
other. They are sorted by the cells of a grid of that width on the leading
principal directions (the epsilon grid order) and cut into groups of blocks of the
sequence. The join then works on pairs of sequence intervals: a pair of groups, and
within it a pair of blocks, is left out where their bounding boxes, in the leading
directions, are provably further apart than ``epsilon``. Only pairs of blocks
that survive are compared: by float32 products, and in double precision where
those are too close to ``least`` to tell.

Where boxes rule out little, as with vectors that lie in no few directions, the
work is quadratic. So that the disk is not, no copy of a vector is dealt out:
groups meet by a join without keys, whose tasks each read two parts of the one
written copy. A task holds two such parts and a worker a batch of group pairs,
however many vectors there are. Nothing but a bounded sample is collected.
Equal vectors are one row throughout, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notemill.llm.common import components, forest, released
from notemill.session import drop_scratch, saved, saved_alone

SAMPLE = 8192      # vectors the principal directions are fitted on, at most
CELL_DIMS = 6      # leading directions the order is made of
BOX_DIMS = 16      # leading directions the bounding boxes are made of
BLOCK = 256        # vectors of a block
BLOCKS = 32        # blocks of a group, at most
GROUP = 1 << 21    # bytes of a group's vectors, about
EXACT = 1 << 16    # pairs multiplied at a time in double precision
SLACK = 1e-9       # so that rounding never leaves out a pair


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _typed(vectors: DataFrame, column: str) -> Column:
    """``column`` in single precision where it comes so, else in double."""
    kind = vectors.schema[column].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(column).cast("array<float>" if single else "array<double>")


def usable(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(_id, _vector) of vectors without NULL or non-finite components and not zero; singles stay singles."""
    return vectors.select(F.col(id_col).cast("bigint").alias("_id"), _typed(vectors, column).alias("_vector")).filter(_usable("_vector"))


def _digest(vector: str) -> list[Column]:
    """128 bits of a vector; 0.0 and -0.0 are the same."""
    plain = F.transform(vector, lambda x: x + F.lit(0.0))
    return [F.xxhash64(F.lit(seed), plain) for seed in (1, 2)]


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length 1; the scale is taken out first, so squares can't overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long vectors, scaled to length 1."""
    return _scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


def directions(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions by vector length, from a bounded sample in hash order. They only steer the order and the boxes."""
    rows = distinct.select("_dim", "_vector").orderBy(F.xxhash64("_vector"), "_vector").limit(SAMPLE).collect()
    found = {}
    for dim in {r["_dim"] for r in rows}:
        own = _matrix(pa.array([r["_vector"] for r in rows if r["_dim"] == dim], pa.list_(pa.float64())))
        _, axes = np.linalg.eigh(own.T @ own - len(own) * np.outer(own.mean(axis=0), own.mean(axis=0)))
        found[dim] = axes[:, ::-1][:, :BOX_DIMS]
    return found


def _axes(axes: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return axes.get(dim, np.eye(dim)[:, :BOX_DIMS])


def ordered(distinct: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """``distinct`` with the bytes of the vector and the grid cell it has when scaled to length 1."""
    item = _item(distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                lead = _matrix(own.column(3)) @ _axes(axes, int(dim))
                cells = np.zeros((len(lead), CELL_DIMS), np.int32)
                cells[:, : min(CELL_DIMS, lead.shape[1])] = np.floor(lead[:, :CELL_DIMS] / epsilon)
                raw = own.column(3).flatten().to_numpy(zero_copy_only=False).astype(item).reshape(len(own), -1)
                yield pa.RecordBatch.from_pydict({
                    "_class": own.column(0), "_dim": own.column(1), "_copies": own.column(2), "_cell": pa.array(cells.tolist(), pa.list_(pa.int32())),
                    "_raw": pa.array([r.tobytes() for r in raw], pa.binary()),
                })

    return distinct.select("_class", "_dim", "_copies", "_vector").mapInArrow(
        released(run), "_class bigint, _dim int, _copies bigint, _cell array<int>, _raw binary"
    )


def _item(distinct: DataFrame) -> str:
    """How a component is stored."""
    return "<f4" if isinstance(distinct.schema["_vector"].dataType.elementType, T.FloatType) else "<f8"


def groups(rows: DataFrame, axes: dict[int, np.ndarray], item: str, block: int = BLOCK) -> DataFrame:
    """(number, dim, low, high, ids, copies, raw): the sequence cut into groups of blocks with their bounding boxes; numbers rise with it."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, "_dim", "_cell", "_class").sortWithinPartitions("_dim", "_cell", "_class").withColumn("_part", F.spark_partition_id())
    most, size = BLOCKS, GROUP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = 0, None

        def cut(own: pa.Table) -> pa.RecordBatch:
            nonlocal at
            dim, raw = own["_dim"][0].as_py(), b"".join(own["_raw"].to_pylist())
            wide = np.zeros((len(own), BOX_DIMS))
            lead = _scaled(np.frombuffer(raw, item).astype(np.float64).reshape(len(own), dim)) @ _axes(axes, dim)
            wide[:, : lead.shape[1]] = lead
            out = pa.RecordBatch.from_pydict({
                "number": pa.array([(own["_part"][0].as_py() << 32) + at], pa.int64()), "dim": pa.array([dim], pa.int32()),
                "low": pa.array([wide.min(axis=0).tolist()], pa.list_(pa.float64())), "high": pa.array([wide.max(axis=0).tolist()], pa.list_(pa.float64())),
                "ids": [own["_class"].to_numpy().astype("<i8").tobytes()], "copies": [own["_copies"].to_numpy().astype("<i8").tobytes()], "raw": [raw],
            })
            at += 1
            return out

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            dims = held["_dim"].to_numpy()
            while len(held):
                rows = block * max(1, min(most, size // (block * int(dims[0]) * int(item[-1]))))
                take = min(rows, int(np.searchsorted(dims, dims[0], side="right")))
                if take == len(held):  # more of them may come
                    break
                yield cut(held.slice(0, take))
                held, dims = held.slice(take), dims[take:]
        if held is not None and len(held):
            yield cut(held)

    return ranged.mapInArrow(
        released(run), "number bigint, dim int, low array<double>, high array<double>, ids binary, copies binary, raw binary"
    )


def _gap2(a: str, b: str):
    """Squared distance of two boxes."""
    apart = F.zip_with(
        F.zip_with(f"{b}.low", f"{a}.high", lambda x, y: x - y), F.zip_with(f"{a}.low", f"{b}.high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)


class Group:
    """Vectors of a group, scaled to length 1, and the bounding boxes of its blocks."""

    def __init__(self, number: int, dim: int, ids: bytes, copies: bytes, raw: bytes, item: str, axes: dict[int, np.ndarray], block: int) -> None:
        self.number, self.ids, self.copies = number, np.frombuffer(ids, "<i8"), np.frombuffer(copies, "<i8")
        self.units = _scaled(np.frombuffer(raw, item).astype(np.float64).reshape(-1, dim))
        self.single, self.block = self.units.astype(np.float32), block
        self.starts = np.arange(0, len(self.ids), block)
        lead = self.units @ _axes(axes, dim)
        self.low, self.high = np.minimum.reduceat(lead, self.starts), np.maximum.reduceat(lead, self.starts)


def _close(left: Group, right: Group, least: float, epsilon: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked vectors, block by block of ``left``; each pair once."""
    # A sum of as many products in float32, and each factor, is off by its share of the length at most.
    off = (left.units.shape[1] + 8) * 2.0 ** -22
    for i, start in enumerate(left.starts):
        apart = np.maximum(0, np.maximum(right.low - left.high[i], left.low[i] - right.high))
        near = (apart * apart).sum(axis=1) <= (epsilon + SLACK) ** 2
        if left.number == right.number:
            near[:i] = False
        if not near.any():
            continue
        chosen = None if near.all() else np.flatnonzero(np.repeat(near, right.block)[: len(right.ids)])
        about = left.single[start:start + left.block] @ (right.single if chosen is None else right.single[chosen]).T
        x, y = np.divmod(np.flatnonzero(about >= least - off), about.shape[1])  # far faster than by rows where few are found
        unsure = about[x, y] <= least + off
        x, y = x + start, y if chosen is None else chosen[y]
        found = ~unsure
        unsure = np.flatnonzero(unsure)
        for k in range(0, len(unsure), EXACT):
            own = unsure[k:k + EXACT]
            found[own] = np.einsum("ij,ij->i", left.units[x[own]], right.units[y[own]]) >= least
        if left.number == right.number:
            found &= x < y
        if found.any():
            yield x[found], y[found]


def _compare(left: Group, right: Group, least: float, epsilon: float) -> pa.RecordBatch | None:
    """(a, b, n) of two groups: how many links each class has, and a forest that connects them."""
    size, same = len(left.ids), left.number == right.number
    every, copies = (left.ids, left.copies) if same else (np.concatenate((left.ids, right.ids)), np.concatenate((left.copies, right.copies)))
    n, ends = np.zeros(len(every), np.int64), []
    for x, y in _close(left, right, least, epsilon):
        y = y if same else y + size
        for one, other in ((x, y), (y, x)):
            n += np.bincount(one, copies[other], len(every)).astype(np.int64)
        ends.append(forest(len(every), x, y))
    if not ends:
        return None
    member, root = forest(len(every), *map(np.concatenate, zip(*ends, strict=True)))
    some = np.flatnonzero(n)
    blank = lambda count: pa.nulls(count, pa.int64())
    return pa.RecordBatch.from_pydict({
        "a": pa.array(np.concatenate((every[some], every[member])), pa.int64()),
        "b": pa.concat_arrays([blank(len(some)), pa.array(every[root], pa.int64())]), "n": pa.concat_arrays([pa.array(n[some], pa.int64()), blank(len(member))]),
    })


def joined(parts: DataFrame, axes: dict[int, np.ndarray], item: str, least: float, epsilon: float, block: int = BLOCK) -> DataFrame:
    """(a, b, n): for every pair of groups, ``n`` links of class ``a`` (b NULL), and links (a, b) of a forest.

    Vectors of different length never meet. The lengths are compared in both directions, not as
    a key: by a key all groups would go to one task, and each would be copied for it.
    """
    a, b = parts.alias("a"), parts.alias("b")
    near = F.expr("a.number <= b.number AND a.dim <= b.dim AND b.dim <= a.dim") & (_gap2("a", "b") <= (epsilon + SLACK) ** 2)
    names = ("number", "dim", "ids", "copies", "raw")
    met = a.join(b, near).select(*[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side in ("a", "b") for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = [c[at].as_py() for c in batch.columns]
                if left is None or left.number != row[0]:
                    left = Group(*row[:5], item, axes, block)
                right = left if row[5] == row[0] else Group(*row[5:], item, axes, block)
                found = _compare(left, right, least, epsilon)
                if found is not None:
                    yield found

    return met.mapInArrow(released(run), "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, least: float = 0.95, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    NULL, zero and non-finite vectors, and vectors with a NULL component, link
    with nothing; so do vectors of different length. Rows that repeat an id are
    vectors of their own. A NULL vec_id stays NULL; the smallest id of a
    component passes it over.
    """
    epsilon, spark = float(np.sqrt(max(1e-12, 2 - 2 * least))), vectors.sparkSession
    distinct = lambda: usable(vectors).groupBy("_vector").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_copies")).withColumns(
        {"_dim": F.size("_vector"), "_class": F.monotonically_increasing_id()}
    )
    classes, whole = saved_alone(spark, distinct, "ego-classes")
    axes, item = directions(classes), _item(classes)
    parts, grouped = saved_alone(spark, lambda: groups(ordered(classes, axes, epsilon), axes, item, block), "ego-groups")
    # Rows find their class by 128 bits of the vector, once these are known to be different for all; else by the vector.
    key = ["_key0", "_key1"]
    named = saved(classes.select("_class", "_low", "_copies", *[d.alias(k) for d, k in zip(_digest("_vector"), key, strict=True)]), "ego-names")
    told = named.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    if told:
        drop_scratch(spark, whole)
    else:
        key, named = ["_vector"], classes.select("_class", "_low", "_copies", "_vector")
    links = saved(joined(parts, axes, item, least, epsilon, block), "ego-links")
    drop_scratch(spark, grouped)
    roots = components(links.filter("b IS NOT NULL").select("a", "b"), "ego-stars")
    others = links.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("_others"))
    placed = (
        named.join(roots, F.col("_class") == F.col("node"), "left").join(others, F.col("_class") == F.col("a"), "left")
        .select(*key, "_low", F.coalesce("root", "_class").alias("_root"), (F.coalesce("_others", F.lit(0)) + F.col("_copies") - 1).alias("_links"))
    )
    lowest = placed.groupBy("_root").agg(F.min("_low").alias("_component"))
    members = placed.join(lowest, "_root").select(*[F.col(k).alias(f"{k}_of") for k in key], "_links", "_component")
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), _typed(vectors, "embedding").alias("_vector"))
    own = _digest("_vector") if told else [F.col("_vector")]
    every = every.select("vec_id", *[F.when(_usable("_vector"), c).alias(k) for c, k in zip(own, key, strict=True)])
    same = [F.col(k) == F.col(f"{k}_of") for k in key]
    return every.join(members, same, "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("_component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("_component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
