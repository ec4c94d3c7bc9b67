"""Changed keys without a version column, by digests of their rows.

A row's digest is two 64-bit hashes of its columns as JSON. The digest of a key,
and of a bucket of keys, is the sum of its rows' digests, so it does not depend
on their order and counts copies. Snapshots are compared top down: bucket
digests first, then the keys of the buckets that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.session import scratch_path

PARTS = ("n", "d0", "d1", "d2", "d3")
BUCKETS = 4096


def _summed(rows: DataFrame, key: str, text: Column) -> DataFrame:
    """(_key, n, d0 .. d3): digests of ``text`` summed up by key, in halves of 32 bits; combines on the map side."""
    hashed = rows.select(F.col(key).alias("_key"), F.xxhash64(F.lit(0), text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b"))
    half = F.lit(0xFFFFFFFF).cast("bigint")
    return hashed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_a").bitwiseAND(half)).alias("d0"), F.sum(F.shiftrightunsigned("_a", 32)).alias("d1"),
        F.sum(F.col("_b").bitwiseAND(half)).alias("d2"), F.sum(F.shiftrightunsigned("_b", 32)).alias("d3"),
    )


def key_digests(df: DataFrame, key: str, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, _key, n, d0 .. d3): rows and digest of every key.

    ``columns`` are those that count, by default all. NULLs count as values, a
    NULL key as a key. A key may have two billion rows.
    """
    text = F.to_json(F.struct(*sorted(df.columns if columns is None else columns)), {"timeZone": "UTC"})
    bucket = F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("bucket")
    return _summed(df, key, text).select(bucket, "_key", *PARTS)


def store_digests(digests: DataFrame, path: str | None = None) -> DataFrame:
    """Written with a folder per bucket and read back; below the shared folder unless ``path`` is given."""
    spark = digests.sparkSession
    path = path or scratch_path(spark, "digests")
    digests.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(path)
    return spark.read.schema(digests.schema).parquet(path)


def bucket_digests(digests: DataFrame) -> DataFrame:
    """(bucket, n, d0 .. d3): keys and the digest of every bucket.

    A key enters by a hash of itself and its digest, so rows that move from one
    key to another change the bucket even if their sum stays.
    """
    return _summed(digests, "bucket", F.to_json(F.struct("_key", *PARTS))).withColumnRenamed("_key", "bucket")


def differing_buckets(held: DataFrame, new: DataFrame) -> list[int]:
    """Buckets whose digests differ or that one side lacks: at most as many numbers as there are buckets."""
    sides = held.select("bucket", F.struct(*PARTS).alias("_old")).join(new.select("bucket", F.struct(*PARTS).alias("_new")), "bucket", "full_outer")
    return sorted(r.bucket for r in sides.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("bucket").collect())


def content_changes(held: DataFrame, new: DataFrame, key: str, buckets: Sequence[int]) -> DataFrame:
    """(key, kind): keys that are ``new``, ``updated`` or ``deleted`` in the given buckets.

    Both sides are key digests. Stored by ``store_digests``, only the folders of
    these buckets are read.
    """
    some = F.col("bucket").isin(list(buckets))
    side = lambda df, name: df.filter(some).select(F.col("_key").alias(f"{name}_key"), F.struct(*PARTS).alias(name))
    both = side(held, "_old").join(side(new, "_new"), F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    old, now = F.col("_old"), F.col("_new")
    kind = F.when(old.isNull(), "new").when(now.isNull(), "deleted").otherwise("updated")
    return both.filter(~old.eqNullSafe(now)).select(F.when(old.isNull(), F.col("_new_key")).otherwise(F.col("_old_key")).alias(key), kind.alias("kind"))
