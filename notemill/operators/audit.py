"""Where a song is, and whether its rows are up to date, across all tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


def layer_of(table: str) -> str:
    return table.split("__")[0]


def _key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _of_keys(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted keys. The keys are cast, not the table's column, so bucket and partition pruning hold."""
    own = wanted.select(F.col("key").try_cast(_key_type(df, key)).alias("_wanted"))
    return df.join(own, F.col(key) == F.col("_wanted"), "left_semi")


def presence(tables: Mapping[str, tuple[DataFrame, str]], keys: DataFrame) -> DataFrame:
    """(layer, table, key, rows) for every given key and table, 0 where absent.

    ``tables`` maps a name such as ``silver__notes`` to its rows and key
    column. Each table is first reduced to the given keys, which are cast to
    the type of its key column, then counted by key on the map side.
    """
    name = keys.columns[0]
    wanted = keys.select(F.col(name).cast("bigint").alias("key")).distinct()

    def tally(table: str, df: DataFrame, key: str) -> DataFrame:
        counts = _of_keys(df, key, wanted).groupBy(F.col(key).cast("bigint").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        return wanted.join(counts, F.col("key") == F.col("_key"), "left").select(
            F.lit(layer_of(table)).alias("layer"), F.lit(table).alias("table"), "key",
            F.coalesce("_n", F.lit(0)).alias("rows"),
        )

    return reduce(DataFrame.unionByName, [tally(t, df, key) for t, (df, key) in tables.items()])


def layer_tally(found: DataFrame) -> DataFrame:
    """(key, layer, present, missing): number of tables per layer with and without the key."""
    return found.groupBy("key", "layer").agg(
        F.count_if(F.col("rows") > 0).alias("present"), F.count_if(F.col("rows") == 0).alias("missing")
    )


def verdict(found: DataFrame) -> DataFrame:
    """How far each key has come: ``clean``, ``bronze``, ``silver``, ``full`` or ``partial``."""
    count = lambda layer, test: F.count_if((F.col("layer") == layer) & test)
    here, gone = F.col("rows") > 0, F.col("rows") == 0
    per_key = found.groupBy("key").agg(
        *[count(layer, here).alias(f"{layer}_present") for layer in LAYERS],
        *[count(layer, gone).alias(f"{layer}_missing") for layer in LAYERS],
    )
    full = lambda layer: F.col(f"{layer}_missing") == 0
    none = lambda layer: F.col(f"{layer}_present") == 0
    state = (
        F.when(none("bronze") & none("silver") & none("gold"), "clean")
        .when(full("bronze") & none("silver") & none("gold"), "bronze")
        .when(full("bronze") & full("silver") & none("gold"), "silver")
        .when(full("bronze") & full("silver") & full("gold"), "full")
        .otherwise("partial")
    )
    return per_key.withColumn("state", state)


def staleness(
    tables: Mapping[str, tuple[DataFrame, str, str | None]], keys: DataFrame, sentinels: tuple[float, ...],
    floor: float | None = None,
) -> DataFrame:
    """(layer, table, key, rows, stale_rows, status) per table and key.

    ``tables`` gives rows, key column and the column to check (None: only
    presence). A row is stale while that column still holds a sentinel, or is
    at least ``floor`` (for values that were shifted by a large offset).
    Status is ``updated``, ``failed`` (bronze) or ``pending`` (later layers).
    """
    name = keys.columns[0]
    wanted = keys.select(F.col(name).cast("string").alias("key")).distinct()

    def check(table: str, df: DataFrame, key: str, column: str | None) -> DataFrame:
        stale = F.lit(False)
        if column is not None:
            value = F.col(column).try_cast("double")
            stale = value.isin(list(sentinels))
            if floor is not None:
                stale = stale | (value >= floor)
        counts = _of_keys(df, key, wanted).groupBy(F.col(key).try_cast(_key_type(df, key)).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.coalesce(stale, F.lit(False))).alias("_stale")
        )
        waiting = F.lit("failed" if layer_of(table) == "bronze" else "pending")
        same = F.col("key").try_cast(_key_type(df, key)) == F.col("_key")
        return wanted.join(counts, same, "left").select(
            F.lit(layer_of(table)).alias("layer"), F.lit(table).alias("table"), "key",
            F.coalesce("_n", F.lit(0)).alias("rows"), F.coalesce("_stale", F.lit(0)).alias("stale_rows"),
            F.when(F.coalesce("_n", F.lit(0)) == 0, waiting).when(F.col("_stale") > 0, waiting)
            .otherwise(F.lit("updated")).alias("status"),
        )

    return reduce(DataFrame.unionByName, [check(t, *spec) for t, spec in tables.items()])


def staleness_verdict(checked: DataFrame) -> DataFrame:
    """One row: counts per status and ``passed``, ``partial`` or ``failed`` overall."""
    n = lambda status: F.count_if(F.col("status") == status)
    return checked.agg(
        n("updated").alias("updated"), n("failed").alias("failed"), n("pending").alias("pending")
    ).withColumn(
        "state",
        F.when(F.col("failed") > 0, "failed").when(F.col("updated") == 0, "empty")
        .when(F.col("pending") > 0, "partial").otherwise("passed"),
    )


def catalog_state(spark: SparkSession, names: list[str]) -> DataFrame:
    """(layer, table, exists) for every table name."""
    rows = [(layer_of(n), n, spark.catalog.tableExists(n)) for n in names]
    return spark.createDataFrame(rows, "layer string, table string, exists boolean")
