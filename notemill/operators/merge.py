"""Table changes as DataFrame operators: current rows in, new rows out.

Key sets stay DataFrames (never a literal list through the driver), so a
change costs one anti- or left join with the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.operators.cdc import freeze


def _unique(source: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """One row per key of ``source`` with ``columns``; the job fails if a key occurs twice."""
    once = F.when(F.col("_copies") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"merge source has several rows for one key {tuple(keys)}")).cast("boolean")
    )
    rows = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.any_value(c).alias(c) for c in columns]
    )
    return rows.filter(once).select(*keys, *columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows become the source row, unmatched source rows are added.

    Columns the source lacks are NULL in its rows; new columns appear.
    """
    kept = target.join(_unique(source, keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def delete_keys(target: DataFrame, keys_df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows whose ``key`` (default: the name in ``keys_df``) is not in ``keys_df``."""
    name = keys_df.columns[0]
    gone = keys_df.select(F.col(name).cast("bigint").alias("_gone"))
    return target.join(gone, F.col(key or name).cast("bigint") == F.col("_gone"), "left_anti")


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL keeps the row)."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def replace_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """All rows of the incoming keys give way to the incoming rows.

    The distinct incoming keys are frozen, so the join knows their size.
    """
    incoming = freeze(source.select(key).distinct())
    kept = target.join(incoming, key, "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def cascade_delete(
    tables: Mapping[str, tuple[DataFrame, str]], keys_df: DataFrame,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete one key set from many tables, each with its own key column.

    Returns the remaining rows per table and a report (table, rows_before,
    rows_deleted, rows_after), counted in one pass per table.
    """
    name = keys_df.columns[0]
    keys_df = freeze(keys_df.select(F.col(name).cast("bigint").alias(name)).distinct())
    gone = keys_df.select(F.col(name).alias("_gone"))

    def tally(table: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(F.col(key).cast("bigint").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        marked = per_key.join(gone, F.col("_key") == F.col("_gone"), "left")
        hit = F.when(F.col("_gone").isNotNull(), F.col("_n")).otherwise(0)
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        return marked.agg(
            F.lit(table).alias("table"), total("_n").alias("rows_before"), total(hit).alias("rows_deleted"),
            total(F.col("_n") - hit).alias("rows_after"),
        )

    left = {table: delete_keys(df, keys_df, key) for table, (df, key) in tables.items()}
    report = reduce(DataFrame.unionByName, [tally(t, df, key) for t, (df, key) in tables.items()])
    return left, report


def update_where(target: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; all read the old row."""
    return target.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in changes.items()
    })


def merge_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
) -> DataFrame:
    """Matched rows take ``columns`` from the source, NULLs included; nothing is added."""
    incoming = _unique(source, keys, columns).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in columns],
        F.lit(True).alias("_hit"),
    )
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    joined = target.join(incoming, same, "left")
    return joined.withColumns({
        c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns
    }).select(*target.columns)
