"""Helpers shared by the text operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.session import saved

#: Internal order key of a NULL id: below every other id.
NULL_ID = -(1 << 63)


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``_text``, ``_turn``, ``_row``) of each row; rows equal in ``_id`` and ``_text`` are the same document.

    NULL ids get :data:`NULL_ID`, NULL texts become empty; ``_row`` is the row as it
    came. ``_turn`` tells the texts of one id apart: 0 where an id has only one text,
    else a number that rises with the text's MD5. It is given out after a sort by
    (id, MD5), never derived from a short hash, so two texts can't share one.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    keyed = docs.select(
        F.coalesce(docs[id_col].cast("bigint"), F.lit(NULL_ID)).alias("_id"), text.alias("_text"), F.unhex(F.md5(text.cast("binary"))).alias("_md5"),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
    )
    several = keyed.groupBy("_id").agg(F.min("_md5").alias("_low"), F.max("_md5").alias("_high")).filter("_low <> _high").select("_id")
    several = saved(several, "row-ids")
    texts = keyed.select("_id", "_md5").join(several, "_id", "left_semi").distinct()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = texts.repartitionByRange(tasks, "_id", "_md5").sortWithinPartitions("_id", "_md5").withColumn("_turn", F.monotonically_increasing_id() + 1)
    # Usually this table is empty or small, and the texts do not move for it.
    return keyed.join(saved(turns, "row-turns"), ["_id", "_md5"], "left").select("_id", "_text", F.coalesce("_turn", F.lit(0).cast("bigint")).alias("_turn"), "_row")


def real_id(column: str = "_id"):
    """The id as it came in, NULL for :data:`NULL_ID`."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow`` that gives free memory back to the system at its end.

    Spark keeps Python workers for later tasks, and allocators keep what a task
    freed; without this a worker holds the largest amount it ever needed.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
                trim(0)

    return wrapped


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds fewer texts as Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict | None], schema: str, rows: int | None = None) -> DataFrame:
    """``function`` over each Arrow batch, or over slices of ``rows``; it returns columns by name, in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, rows) if rows else batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(released(run), schema)


def forest(size: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the given links between 0..size-1: (member, smallest member).

    Keeps which numbers are connected with fewer than ``size`` links.
    """
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    member = np.flatnonzero(root != np.arange(size))
    return member, root[member]


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of ``links`` (a, b): (node, root) for every node but the roots.

    Alternating large and small stars (Kiveris et al.): each round joins links
    to the smallest neighbour of their nodes, until only stars are left. Every
    round is written to the shared folder, so a lost executor costs one round.
    Link rows stay distributed; the driver sees a count and a checksum.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    stars, mark = saved(pairs, label), None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or not now[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        inner = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = saved(inner.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), label)
