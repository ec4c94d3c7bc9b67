"""Charts to notes, tied notes, chords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.functions.scalars import (
    COLORS, DEFAULT_LANES, active_lanes, decode, lane_active, one_hot, or_lanes,
)
from notemill.session import saved


def with_seconds(df: DataFrame) -> DataFrame:
    """Seconds next to the integer milliseconds every operator compares on."""
    return df.withColumn("timestamp", F.col("ms") / F.lit(1000.0))


def explode_notes(charts: DataFrame, lanes: int = DEFAULT_LANES, carry: Sequence[str] = ()) -> DataFrame:
    """One row per note of ``chart``; ``note_id`` counts from 1.

    The elements of a note are frame number, lane index, colour code and
    milliseconds, whole or decimal: the first three are cut, milliseconds are
    rounded. An index outside the lanes or an unlisted colour gives NULL. A
    chart may come in parts, each with the ``first_note_id`` it starts from.
    ``carry`` names song-level columns to repeat on every note.
    """
    first = F.col("first_note_id") if "first_note_id" in charts.columns else F.lit(1)
    notes = charts.select("song_id", first.cast("int").alias("_first"), *carry, F.posexplode("chart").alias("position", "note"))
    part = lambda i: F.get("note", F.lit(i))
    return with_seconds(
        notes.select(
            F.col("song_id").cast("bigint").alias("song_id"),
            (F.col("position") + F.col("_first")).alias("note_id"),
            part(0).cast("int").alias("framers"),
            one_hot(part(1).cast("int"), lanes).alias("orientation"),
            decode(part(2).cast("int"), COLORS).alias("color"),
            F.round(part(3)).cast("bigint").alias("ms"),
            *carry,
        )
    )


def separate_ties(notes: DataFrame, eps: float = 1, time: str = "ms") -> DataFrame:
    """Move every note that repeats its lane at the same time by ``eps``.

    Only the note with the lowest ``note_id`` (unique within a song) of a tie
    stays. Positions are compared before any move, so the second and third of
    three equal notes land on the same new time.

    The first note of each tie comes from a map-side combining aggregate which
    keeps only real ties, so any number of copies shrinks before the shuffle.
    The ties are written out before the join: Spark then knows their size and
    broadcasts them if they are few (the notes are not shuffled at all), or else
    sorts both sides, where adaptive execution can split a tie with very many
    copies, since the small side comes straight from a scan.
    """
    firsts = (
        notes.groupBy("song_id", "orientation", time)
        .agg(F.min("note_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select(
            F.col("song_id").alias("_song"), F.col("orientation").alias("_lane"),
            F.col(time).alias("_time"), "_first",
        )
    )
    firsts = saved(firsts, "ties")
    same_place = (
        (F.col("song_id") == F.col("_song"))
        & F.col("orientation").eqNullSafe(F.col("_lane"))
        & (F.col(time) == F.col("_time"))
    )
    moved = F.when(F.col("note_id") > F.col("_first"), F.col(time) + F.lit(eps)).otherwise(F.col(time))
    out = notes.join(firsts, same_place, "left").withColumn(time, moved.cast(notes.schema[time].dataType))
    out = out.select(*notes.columns)
    return with_seconds(out).select(*notes.columns) if time == "ms" and "timestamp" in notes.columns else out


def merge_chords(
    notes: DataFrame, lanes: int = DEFAULT_LANES, time: str = "ms", carry: Sequence[str] = (),
) -> DataFrame:
    """One row per (song, time): lowest note id and frame, OR of the lanes.

    ``carry`` names columns that are constant within a song. All aggregates combine on the map side, so a hot song or a hot moment
    reaches the shuffle as one row per map task.
    """
    merged = notes.groupBy("song_id", time).agg(
        F.min("note_id").alias("note_id"),
        F.min("framers").alias("framers"),
        or_lanes("orientation", lanes).alias("orientation"),
        *[F.max(c).alias(c) for c in carry],
    ).select("song_id", "note_id", "framers", "orientation", time, *carry)
    return with_seconds(merged) if time == "ms" else merged


def split_chords(chords: DataFrame, lanes: int = DEFAULT_LANES) -> DataFrame:
    """One row per active lane of each chord."""
    active = active_lanes([lane_active("orientation", lane) for lane in range(lanes)])
    others = [c for c in chords.columns if c != "orientation"]
    return chords.select(*others, F.explode(active).alias("_lane")).select(*others, one_hot("_lane", lanes).alias("orientation"))


def invalid_orientations(notes: DataFrame) -> DataFrame:
    """Rows whose bit-string holds a digit above 1."""
    return notes.filter(F.col("orientation").rlike("[2-9]"))


def tied_notes(notes: DataFrame, time: str = "ms") -> DataFrame:
    """Groups of notes that share song, time and lane, with their size."""
    return (
        notes.groupBy("song_id", time, "orientation")
        .agg(F.count(F.lit(1)).alias("note_count"))
        .filter("note_count > 1")
    )


def largest_ties(notes: DataFrame, k: int = 5, time: str = "ms") -> DataFrame:
    """The ``k`` largest ties; equal sizes are ordered by key."""
    return tied_notes(notes, time).orderBy(
        F.desc("note_count"), "song_id", time, "orientation"
    ).limit(k)


def trace_ties(notes: DataFrame, ties: DataFrame, horizon: int = 10, eps: int = 1,
               lanes: int = DEFAULT_LANES) -> DataFrame:
    """Before, after separation and after merging, around each given tie.

    ``ties`` holds (song_id, ms), few rows such as :func:`largest_ties` gives.
    The stages after the move show ``[ms, ms + horizon)``. Only the songs of the
    ties are processed.
    """
    songs = ties.select(F.col("song_id").alias("_song")).distinct()
    notes = notes.join(songs, F.col("song_id") == F.col("_song"), "left_semi")
    at = ties.select(F.col("song_id").alias("_song"), F.col("ms").alias("tie_ms")).distinct()

    def around(stage: str, df: DataFrame, width: int) -> DataFrame:
        near = (F.col("song_id") == F.col("_song")) & (F.col("ms") >= F.col("tie_ms")) & (
            F.col("ms") < F.col("tie_ms") + width
        )
        return df.join(at, near).select(
            F.lit(stage).alias("stage"), "song_id", "tie_ms", "note_id", "orientation", "ms"
        )

    separated = separate_ties(notes, eps)
    return (
        around("before", notes, 1)
        .unionByName(around("separated", separated, horizon))
        .unionByName(around("merged", merge_chords(separated, lanes), horizon))
    )
