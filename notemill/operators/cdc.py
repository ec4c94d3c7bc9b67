"""Change detection between two snapshots keyed by id and version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.session import saved


def _differs(a: Column, b: Column, null_safe: bool) -> Column:
    """Plain ``!=`` is NULL, hence not a change, when either side is NULL."""
    return ~a.eqNullSafe(b) if null_safe else a != b


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias(key)).distinct()


def deleted_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of ``old`` that ``new`` lacks."""
    return _keys(old, key).join(_keys(new, key), key, "left_anti")


def new_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of ``new`` that ``old`` lacks."""
    return deleted_keys(new, old, key)


def updated_keys(
    old: DataFrame, new: DataFrame, key: str, version: str, null_safe: bool = False,
) -> DataFrame:
    """Keys in both whose version differs, with the old and the new version.

    When ``old`` has no version column yet, every common key counts as updated.
    """
    after = new.select(F.col(key).cast("bigint").alias(key), F.col(version).alias(f"new_{version}")).distinct()
    if version not in old.columns:
        return _keys(old, key).join(after, key).select(
            key, F.lit(None).cast("bigint").alias(f"previous_{version}"), f"new_{version}"
        )
    before = old.select(F.col(key).cast("bigint").alias(key), F.col(version).alias(f"previous_{version}")).distinct()
    return before.join(after, key).filter(
        _differs(F.col(f"previous_{version}"), F.col(f"new_{version}"), null_safe)
    ).select(key, f"previous_{version}", f"new_{version}")


def changed_keys(
    source: DataFrame, target: DataFrame, key: str, version: str | Sequence[str], null_safe: bool = False,
) -> DataFrame:
    """Keys of ``source`` that are new to ``target`` or differ in any version column.

    ``target`` may be a fact table: it is first reduced to its distinct (key,
    versions), which combines on the map side.
    """
    versions = [version] if isinstance(version, str) else list(version)
    present = [v for v in versions if v in target.columns]
    wanted = source.select(F.col(key).cast("bigint").alias(key), *versions).distinct()
    held = target.select(
        F.col(key).cast("bigint").alias("_key"), *[F.col(v).alias(f"_held_{v}") for v in present]
    ).distinct()
    changed = F.col("_key").isNull()
    if len(present) < len(versions):
        changed = F.lit(True)
    for v in present:
        changed = changed | F.coalesce(_differs(F.col(v), F.col(f"_held_{v}"), null_safe), F.lit(False))
    return wanted.join(held, F.col(key) == F.col("_key"), "left").filter(changed).select(key).distinct()


def combine_keys(*key_frames: DataFrame) -> DataFrame:
    """Distinct union of key frames (first column of each)."""
    first, *rest = [df.select(df.columns[0]) for df in key_frames]
    for df in rest:
        first = first.unionByName(df)
    return first.distinct()


def freeze(keys: DataFrame) -> DataFrame:
    """Materialise a key set before the table it was read from is rewritten.

    It is written to the shared folder, so it outlives executors.
    """
    return saved(keys, "keys")


def scope(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``.

    Give frozen keys for a note table: they are broadcast by their true size,
    and beyond that a hot song can be split in the join.
    """
    return df.join(keys.select(key), key, "left_semi").select(*df.columns)


def change_summary(
    old: DataFrame, new: DataFrame, key: str, version: str, null_safe: bool = False,
) -> DataFrame:
    """Counts of new, updated, deleted and unchanged keys, and those to process."""
    before = old.select(F.col(key).alias("_old"), F.col(version).alias("_ov"))
    after = new.select(F.col(key).alias("_new"), F.col(version).alias("_nv"))
    kind = (
        F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "deleted")
        .when(_differs(F.col("_ov"), F.col("_nv"), null_safe), "updated").otherwise("unchanged")
    )
    kinds = before.join(after, F.col("_old") == F.col("_new"), "full_outer").select(kind.alias("kind"))
    count = lambda k: F.count_if(F.col("kind").isin(k if isinstance(k, list) else [k]))
    return kinds.agg(
        count("new").alias("new"), count("updated").alias("updated"), count("deleted").alias("deleted"),
        count("unchanged").alias("unchanged"), count(["new", "updated"]).alias("to_process"),
    )


def with_version(df: DataFrame, songlist: DataFrame, key: str = "song_id", how: str = "inner") -> DataFrame:
    """Attach the change token; ``inner`` drops rows of songs the list lacks."""
    tokens = songlist.select(
        F.col("id").cast("bigint").alias("_id"), F.col("swf_version").cast("bigint").alias("swf_version")
    )
    return df.join(tokens, F.col(key).cast("bigint") == F.col("_id"), how).drop("_id")


def latest_payloads(charts: DataFrame) -> DataFrame:
    """One payload per song and part: the last to land where ``landed_at`` says so, else the one with most notes.

    Equal ones are told apart by a hash of the chart, so a rerun picks the same.
    """
    keys = ["song_id", *[c for c in ("first_note_id",) if c in charts.columns]]
    landed = [c for c in ("landed_at",) if c in charts.columns]
    others = [c for c in charts.columns if c not in keys]
    order = F.struct(*landed, F.size("chart"), F.xxhash64("chart"))
    best = charts.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in charts.columns])


def settle_versions(songlist: DataFrame, held: DataFrame, payload_keys: DataFrame) -> DataFrame:
    """The song list to store: a version advances only once its payload has arrived.

    A song that is new or has a new version, but whose payload (song_id) is
    missing, keeps the version held so far (NULL for a new song), so that the
    next run finds it changed again.
    """
    before = held.select(F.col("id").cast("bigint").alias("_held_id"), F.col("swf_version").alias("_held_version"))
    arrived = payload_keys.select(F.col("song_id").cast("bigint").alias("_arrived")).distinct()
    rows = songlist.join(before, F.col("id") == F.col("_held_id"), "left").join(
        arrived, F.col("id") == F.col("_arrived"), "left"
    )
    version = F.when(F.col("_arrived").isNotNull(), F.col("swf_version")).otherwise(F.col("_held_version"))
    return rows.withColumn("swf_version", version.cast("bigint")).select(*songlist.columns)
