"""Assembly of the note-level feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.functions.scalars import DEFAULT_LANES, ratio
from notemill.operators.cdc import scope, with_version
from notemill.operators.density import JUDGE, Kernel, note_densities
from notemill.session import saved

FEATURES = (
    "song_id", "note_id", "orientation", "vertical_density", "horizontal_density", "position_in_song",
    "song_length_log_normalized", "hold", "mine", "swf_version",
)


def position_in_song() -> Column:
    """Note ordinal over the catalogue's note count; may exceed 1."""
    return ratio(F.col("note_id"), F.col("note_count"))


def constants() -> dict[str, Column]:
    """The game has no held notes, and a missed moment always costs."""
    return {"hold": F.lit(0), "mine": F.lit(1)}


def join_densities(vertical: DataFrame, horizontal: DataFrame) -> DataFrame:
    """Both densities of each note, one to one on song, note and lane."""
    return vertical.join(
        horizontal.select("song_id", "note_id", "orientation", "horizontal_density"),
        ["song_id", "note_id", "orientation"],
    )


def assemble_features(
    vertical: DataFrame, horizontal: DataFrame, chart: DataFrame, keys: DataFrame | None = None,
) -> DataFrame:
    """Vertical ⋈ horizontal (one to one on song, note and lane) ⋈ chart features.

    With ``keys`` (song_id) all inputs are reduced before they are joined.
    """
    if keys is not None:
        vertical, horizontal, chart = (scope(df, keys, "song_id") for df in (vertical, horizontal, chart))
    dense = join_densities(vertical, horizontal)
    songs = saved(chart.select("song_id", "note_count", "song_length_log_normalized"), "chart-features")
    return dense.join(songs, "song_id").withColumns(
        {"position_in_song": position_in_song(), **constants()}
    ).select(*FEATURES)


def attach_labels(features: DataFrame, playlist: DataFrame, rel: DataFrame) -> DataFrame:
    """Difficulty of the song and reliability of that level; NULL where unknown."""
    return features.join(saved(song_labels(playlist, rel), "song-labels"), "song_id", "left")


def song_labels(playlist: DataFrame, rel: DataFrame) -> DataFrame:
    """(song_id, difficulty, sample_weight), one row per playlist song."""
    levels = rel.select(F.col("new_difficulty").alias("_level"), F.col("avg_reliability").alias("sample_weight"))
    songs = playlist.select("song_id", "difficulty")
    return songs.join(levels, F.col("difficulty") == F.col("_level"), "left").drop("_level")


def song_facts(chart: DataFrame, playlist: DataFrame, rel: DataFrame) -> DataFrame:
    """Everything gold needs per song: length features, label and weight."""
    return chart.select("song_id", "note_count", "song_length_log_normalized").join(
        song_labels(playlist, rel), "song_id", "left"
    )


def _labelled(dense: DataFrame) -> DataFrame:
    return dense.withColumns({"position_in_song": position_in_song(), **constants()}).select(
        *FEATURES, "difficulty", "sample_weight"
    )


def label_features(dense: DataFrame, facts: DataFrame) -> DataFrame:
    """Note rows with both densities and a version, joined with :func:`song_facts`.

    The song-level tables are joined with each other first, so the note table
    takes part in one join only. Their result is written out: Spark broadcasts
    it if it is small, and can split a hot song if it is not, since a skewed
    join is only rebalanced when both sides come straight from a shuffle.
    """
    return _labelled(dense.join(saved(facts, "song-facts"), "song_id"))


def features_from_chords(
    chords: DataFrame, songlist: DataFrame, chart: DataFrame, playlist: DataFrame, rel: DataFrame,
    kernel: Kernel = JUDGE, lanes: int = DEFAULT_LANES,
) -> DataFrame:
    """Gold straight from the chords: one shuffle of the notes, no join of note tables."""
    return features_of_songs(chords, with_version(song_facts(chart, playlist, rel), songlist), kernel, lanes)


def features_of_songs(chords: DataFrame, facts: DataFrame, kernel: Kernel = JUDGE, lanes: int = DEFAULT_LANES) -> DataFrame:
    """Gold from chords and one row of :func:`song_facts` with a version per song; songs without one are dropped."""
    return _labelled(note_densities(chords, kernel, lanes, songs=facts))


def gold_features(
    vertical: DataFrame, horizontal: DataFrame, chart: DataFrame, playlist: DataFrame, rel: DataFrame,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Gold from the stored density tables."""
    if keys is not None:
        vertical, horizontal, chart = (scope(df, keys, "song_id") for df in (vertical, horizontal, chart))
    return label_features(join_densities(vertical, horizontal), song_facts(chart, playlist, rel))
