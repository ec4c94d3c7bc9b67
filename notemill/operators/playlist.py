"""From the raw playlist to the typed one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notemill.functions.scalars import GENRES, decode, epoch_to_timestamp, flag, mmss_to_seconds, split_names
from notemill.operators.cdc import scope, with_version

SILVER_COLUMNS = (
    "genre", "name", "difficulty", "style", "song_length", "song_id", "num_arrows", "preview_id", "release_date",
    "author", "stepauthor", "song_rating", "explicit_flag", "legacy_flag", "unranked_flag", "credits", "price",
    "swf_version",
)


def widen_numbers(df: DataFrame) -> DataFrame:
    """Every numeric column as double (payloads mix whole and decimal numbers)."""
    return df.withColumns({
        f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    })


def flags_to_bool(df: DataFrame, prefix: str = "o_") -> DataFrame:
    """Every ``<prefix>x`` column as boolean ``x_flag``; NULL is false.

    Only the leading prefix is dropped from the name.
    """
    flags = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns({c: flag(c) for c in flags}).withColumnsRenamed(
        {c: f"{c[len(prefix):]}_flag" for c in flags}
    )


def clean_playlist(playlist: DataFrame, songlist: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Decode, parse and type the playlist; songs the list lacks get a NULL version."""
    rows = playlist.withColumn("level", F.col("level").cast("bigint"))
    if keys is not None:
        rows = scope(rows, keys.select(F.col(keys.columns[0]).alias("level")), "level")
    typed = (
        flags_to_bool(with_version(rows, songlist, key="level", how="left"))
        .withColumns({
            "genre": decode("genre", GENRES),
            "time": mmss_to_seconds("time"),
            "stepauthor": split_names("stepauthor"),
            "releasedate": epoch_to_timestamp("releasedate"),
        })
        .na.fill(0, subset=["credits", "price"])
        .withColumnsRenamed({
            "level": "song_id", "time": "song_length", "previewhash": "preview_id",
            "releasedate": "release_date", "arrows": "num_arrows",
        })
    )
    whole = lambda *names: {n: F.col(n).cast("int") for n in names}
    return typed.withColumns(whole("difficulty", "style", "num_arrows", "credits", "price")).select(*SILVER_COLUMNS)
