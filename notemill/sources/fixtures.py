"""A made-up song in every layer, and stale values to be repaired.

Both exist to exercise change detection on live tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import schemas
from notemill.functions.scalars import set_map_value
from notemill.operators import cdc, density, gold, notes, playlist
from notemill.operators.merge import merge_update, update_where
from notemill.plans.medallion import TABLES, VERSION, Medallion, ledger
from notemill.sources import tables

# Values no real row holds.
FAKE_VERSION = 7_700_077
FAKE_LEVEL = 555
FAKE_NOTE_COUNT = "-1"
TIME_SHIFT_SECONDS = 4_000_000


def synthetic_song(runs: Medallion, song_id: int = 99_999, name: str = "made-up song") -> dict[str, DataFrame]:
    """Rows of one short song for every table that is keyed by song.

    Only its landed rows are made up: a climb over the lanes, a tie, and a
    chord. All later layers come from running the operators on them.
    """
    spark = runs.spark
    chart = [[float(3 * k), float(k % runs.lanes), float(k), 97.0 * k] for k in range(7)]
    chart += [[21.0, 1.0, 2.0, 800.0], [21.0, 1.0, 3.0, 800.0], [30.0, 0.0, 1.0, 1040.5], [30.0, 2.0, 1.0, 1040.5]]
    listed = spark.createDataFrame(
        [(song_id, name, "nobody", None, 5, 21, "1:05", len(chart), 8, 1, "someone", FAKE_VERSION, 0, None)], schemas.SONGLIST
    )
    landed = spark.createDataFrame([(song_id, {"name": name, "note_count": str(len(chart))}, chart)], schemas.CHARTS)
    played = spark.createDataFrame([(
        float(song_id), name, 21.0, 5.0, 2.0, "1:05", float(len(chart)), "none", 1.0e9, "nobody", "someone", 2.5, 1.0, 0.0, None, None, None
    )], schemas.PLAYLIST)
    told = notes.explode_notes(cdc.with_version(landed, listed), runs.lanes, VERSION)
    merged = notes.merge_chords(notes.separate_ties(told), runs.lanes, carry=VERSION)
    vertical = density.vertical_density(notes.split_chords(merged, runs.lanes), carry=VERSION)
    horizontal = density.horizontal_density(merged, runs.kernel, runs.lanes, carry=VERSION)
    # A single song has no percentile to be measured by: its length counts as half.
    length = listed.select(F.col("id").alias("song_id"), "note_count", F.lit(0.5).alias("song_length_log_normalized"), "swf_version")
    silver = playlist.clean_playlist(played, listed)
    facts = gold.song_facts(length, silver, runs.table("silver__reliability_scores"))
    return {
        "bronze__songlist": listed, "bronze__charts": landed.withColumn("notes", F.size("chart")), "bronze__playlist": played,
        "silver__playlist": silver, "silver__notes": told, "silver__notes_adjusted": merged, "silver__vertical_density": vertical,
        "silver__horizontal_density": horizontal, "silver__chart_features": length,
        "gold__features": gold.label_features(gold.join_densities(vertical, horizontal), facts),
    }


def insert_synthetic_song(runs: Medallion, song_id: int = 99_999) -> None:
    """Put the synthetic song into every table that exists."""
    for name, rows in synthetic_song(runs, song_id).items():
        if runs.exists(name):
            _store(runs, name, runs.table(name).unionByName(
                rows.select(*[c for c in rows.columns if c in runs.table(name).columns]), allowMissingColumns=True
            ), song_id)


def _store(runs: Medallion, name: str, changed: DataFrame, song_id: int | None = None) -> None:
    key, bucketed = TABLES[name]
    if not bucketed:
        tables.publish(changed, name)
        return
    keys = runs.spark.createDataFrame([(song_id,)], f"{key} bigint")
    rows = changed.filter(F.col(key) == song_id)
    if runs.exists(ledger(name)) and "swf_version" in rows.columns:
        held = tables.read_table(runs.spark, ledger(name))
        own = rows.select("song_id", *[c for c in held.columns if c in rows.columns and c != "song_id"]).distinct()
        tables.publish(held.filter(F.col("song_id") != song_id).unionByName(own, allowMissingColumns=True), ledger(name))
    tables.replace_songs(runs.spark, name, rows, keys)


def inject_stale(runs: Medallion, song_id: int, song_name: str) -> list[str]:
    """Spoil one song in all tables: versions, times, levels and chart info. Returns the tables."""
    fake = F.lit(FAKE_VERSION).cast("bigint")
    late: dict[str, Column] = {
        "ms": F.col("ms") + TIME_SHIFT_SECONDS * 1000, "timestamp": F.col("timestamp") + TIME_SHIFT_SECONDS,
    }
    edits: dict[str, dict[str, Column]] = {
        "bronze__songlist": {"swf_version": fake},
        "bronze__contested": {"old_diff": F.lit(str(FAKE_LEVEL)), "new_diff": F.lit(str(FAKE_LEVEL))},
        "silver__chart_features": {"swf_version": fake},
        "silver__notes": {**late, "swf_version": fake},
        "silver__notes_adjusted": {**late, "swf_version": fake},
        "silver__vertical_density": {**late, "swf_version": fake},
        "silver__horizontal_density": {**late, "swf_version": fake},
        "silver__playlist": {"swf_version": fake},
        "silver__contested": {"new_difficulty": F.lit(FAKE_LEVEL)},
        "gold__features": {"swf_version": fake},
    }
    done = []
    for name, changes in edits.items():
        if runs.exists(name):
            key = TABLES[name][0]
            here = F.col(key) == (song_name if key == "song_name" else song_id)
            _store(runs, name, update_where(runs.table(name), here, changes), song_id)
            done.append(name)
    if runs.exists("bronze__charts"):
        charts = runs.table("bronze__charts")
        edited = charts.filter(F.col("song_id") == song_id).withColumn(
            "info", set_map_value("info", "note_count", FAKE_NOTE_COUNT)
        )
        _store(runs, "bronze__charts", merge_update(charts, edited, ["song_id"], ["info"]), song_id)
        done.append("bronze__charts")
    return done
