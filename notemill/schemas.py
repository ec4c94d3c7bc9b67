"""Table schemas. Versions are ``bigint`` everywhere.

Fixed values: column names, their order and their types are those of the published tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SONGLIST = """
    id bigint, name string, author string, author_url string, genre int, difficulty int, length string,
    note_count bigint, max_nps int, min_nps int, stepauthor string, swf_version bigint, timestamp bigint,
    timestamp_format string
"""
CHARTS = "song_id bigint, info map<string,string>, chart array<array<double>>"
CHART_PAYLOADS = "song_id bigint, first_note_id int, status int, info map<string,string>, chart array<array<double>>, _corrupt_record string"
PLAYLIST = """
    level double, name string, difficulty double, genre double, style double, time string, arrows double,
    previewhash string, releasedate double, author string, stepauthor string, song_rating double,
    o_explicit double, o_legacy double, o_unranked double, credits double, price double
"""
SILVER_PLAYLIST = """
    genre string, name string, difficulty int, style int, song_length int, song_id bigint, num_arrows int,
    preview_id string, release_date timestamp, author string, stepauthor array<string>, song_rating double,
    explicit_flag boolean, legacy_flag boolean, unranked_flag boolean, credits int, price int, swf_version bigint
"""
NOTES = """
    song_id bigint, note_id int, framers int, orientation string, color string, ms bigint, timestamp double,
    swf_version bigint
"""
NOTES_ADJUSTED = """
    song_id bigint, note_id int, framers int, orientation string, ms bigint, timestamp double, swf_version bigint
"""
VERTICAL_DENSITY = """
    song_id bigint, note_id int, ms bigint, timestamp double, orientation string, prev_timestamp double,
    time_delta double, vertical_density double, swf_version bigint
"""
HORIZONTAL_DENSITY = """
    song_id bigint, note_id int, ms bigint, timestamp double, orientation string, horizontal_density double,
    nearby_notes_count int, swf_version bigint
"""
CHART_FEATURES = "song_id bigint, note_count bigint, song_length_log_normalized double, swf_version bigint"
RELIABILITY = """
    new_difficulty int, avg_reliability double, stddev_reliability double, num_assessments bigint,
    total_reliability double, avg_recency double, avg_acceptance double
"""
GOLD_FEATURES = """
    song_id bigint, note_id int, orientation string, vertical_density double, horizontal_density double,
    position_in_song double, song_length_log_normalized double, hold int, mine int, swf_version bigint,
    difficulty int, sample_weight double
"""


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """A frame without rows: what an idle incremental run passes on."""
    return spark.createDataFrame([], ddl)
