"""Thin sinks over Spark's own catalog tables.

Plain file tables know no row-level change, so a change is a new set of rows
(see ``operators.merge``) that is written in one of two ways:

* small tables are written as a new version and a view is switched to it,
* note tables are partitioned by a hash bucket of the song, and only the
  buckets of changed songs are overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.operators.cdc import scope
from notemill.session import saved

BUCKET = "song_bucket"
BUCKET_COUNT = "song.buckets"  # table property


def quoted(name: str) -> str:
    """Each part of a dotted name in backticks."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quoted(name))


def write_table(df: DataFrame, name: str, mode: str = "overwrite", on_schema_change: str = "error") -> None:
    """Overwrite or append. ``on_schema_change='recreate'`` drops a table with other columns first."""
    spark = df.sparkSession
    if mode == "overwrite" and on_schema_change == "recreate" and table_exists(spark, name):
        if set(read_table(spark, name).columns) != set(df.columns):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    df.write.format("parquet").mode(mode).saveAsTable(quoted(name))


def ensure_column(spark: SparkSession, name: str, column: str, data_type: str) -> None:
    """Add a column to a table that lacks it; old rows read NULL."""
    if column not in read_table(spark, name).columns:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS (`{column}` {data_type})")


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop tables and versioned tables; absent ones are fine."""
    for name in names:
        for version in _versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
        views = {r.viewName for r in spark.sql("SHOW VIEWS").collect()}
        spark.sql(f"DROP {'VIEW' if name in views else 'TABLE'} IF EXISTS {quoted(name)}")


def _versions(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"SHOW TABLES LIKE '{name}__v*'").collect()
    return sorted(r.tableName for r in rows)


def publish(df: DataFrame, name: str) -> None:
    """Write the next version of a small table and switch its view to it.

    ``df`` may read the current version. The switch is one catalog call; until
    then readers see the old rows. The version before the current one is kept
    for readers that have already planned on it.
    """
    spark = df.sparkSession
    old = _versions(spark, name)
    number = int(old[-1][len(name) + 3:].split("_")[0]) + 1 if old else 1
    version = f"{name}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    df.write.format("parquet").saveAsTable(quoted(version))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT * FROM {quoted(version)}")
    for stale in old[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(stale)}")


def bucket_of(key: Column | str, buckets: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key.cast("bigint")), F.lit(buckets)).cast("int")


def create_bucketed(df: DataFrame, name: str, buckets: int, key: str = "song_id") -> None:
    """First write of a note table. The rebalance hint splits hot buckets into several files.

    The number of buckets becomes a property of the table. It is set before
    rows are written, so a table never holds rows without it.
    """
    rows = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
    rows.limit(0).write.format("parquet").partitionBy(BUCKET).saveAsTable(quoted(name))
    df.sparkSession.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{BUCKET_COUNT}' = '{int(buckets)}')")
    with dynamic_overwrite(df.sparkSession):
        rows.select(*read_table(df.sparkSession, name).columns).write.insertInto(quoted(name), overwrite=True)


def bucket_count(spark: SparkSession, name: str) -> int:
    """The number of buckets a table was made with."""
    found = [r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect() if r.key == BUCKET_COUNT]
    if not found:
        raise ValueError(f"{name} has no property {BUCKET_COUNT}: it is no bucketed table")
    return int(found[0])


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return read_table(spark, name).drop(BUCKET)


def read_songs(spark: SparkSession, name: str, keys: DataFrame, key: str = "song_id") -> DataFrame:
    """Rows of ``keys`` from a note table, reading only their buckets."""
    touched = touched_buckets(keys, bucket_count(spark, name), key)
    rows = read_table(spark, name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    return scope(rows, keys, key)


def touched_buckets(keys: DataFrame, buckets: int, key: str = "song_id") -> list[int]:
    """Bucket numbers of the keys: at most ``buckets`` integers reach the driver."""
    return [r[0] for r in keys.select(bucket_of(key, buckets)).distinct().collect()]


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions a write has rows for. ``insertInto`` reads this from the session."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_songs(
    spark: SparkSession, name: str, rows: DataFrame, keys: DataFrame, key: str = "song_id",
) -> None:
    """Replace all rows of ``keys`` by ``rows`` (which hold only such keys).

    Only the buckets of the keys are read and written, by dynamic partition
    overwrite: their other songs are carried over. A bucket left without rows
    is not overwritten by Spark, so it is dropped explicitly; which ones those
    are is read from the keys of what will be written, before it is: the new rows
    are made once, in a copy that both read. The step is idempotent, hence a run
    that died between buckets is repaired by running the same batch again.
    """
    buckets = bucket_count(spark, name)
    touched = touched_buckets(keys, buckets, key)
    if not touched:
        return
    current = read_table(spark, name)
    kept = current.filter(F.col(BUCKET).isin(touched)).join(keys.select(key), key, "left_anti")
    fresh = saved(rows.withColumn(BUCKET, bucket_of(key, buckets)), "fresh-songs")
    filled = {r[0] for r in kept.select(BUCKET).unionByName(fresh.select(BUCKET)).distinct().collect()}
    out = kept.select(*current.columns).unionByName(fresh.select(*current.columns)).hint("rebalance", BUCKET)
    with dynamic_overwrite(spark):
        out.write.insertInto(quoted(name), overwrite=True)
    for bucket in sorted(set(touched) - filled):
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({BUCKET} = {bucket})")
