"""Views over the test tables that stand in for charts, playlists and disputes.

One hour of ``events`` plays one millisecond of a song. Every view reads its
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.operators.notes import with_seconds
from notemill.operators.running import row_numbers

HOUR_US = 3_600_000_000
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01 00:00 UTC
PART_NOTES = 4096
ROW_WIDTHS = (1 << 14, 1 << 28)
ROWS_PER_TASK = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(song_id, event_id, us, ms, orientation) straight from the events."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lane = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("song_id"), "event_id", us.alias("us"),
        F.floor((us - EPOCH_US) / HOUR_US).alias("ms"),
        F.when(lane == "click", "1000").when(lane == "view", "0100")
        .when(lane == "purchase", "0010").otherwise("0001").alias("orientation"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes numbered from 1 within each song by time; very large songs are numbered by slices."""
    numbered = row_numbers(
        raw_notes(spark, sf_dir), ["song_id"], "us", tiebreak=["event_id"], name="note_id",
        rows_per_task=ROWS_PER_TASK,
    )
    return with_seconds(
        numbered.select("song_id", "note_id", F.floor(F.col("ms") * 30 / 1000).cast("int").alias("framers"),
                        "ms", "orientation")
    )


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested charts in parts of ``PART_NOTES`` notes, so that an array never grows without bound.

    All parts keep the id of their song and carry ``first_note_id``.
    """
    first = F.expr(f"(note_id - 1) div {PART_NOTES}") * PART_NOTES + 1
    lane = F.locate("1", F.col("orientation")) - 1
    note = F.array(
        F.col("framers").cast("bigint"), lane.cast("bigint"), (F.col("note_id") % 10).cast("bigint"), F.col("ms")
    )
    return (
        notes(spark, sf_dir)
        .select(
            "song_id", first.cast("int").alias("first_note_id"), F.struct("note_id", note.alias("note")).alias("entry"),
        )
        .groupBy("song_id", "first_note_id")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select(
            "song_id", "first_note_id",
            F.create_map(
                F.lit("name"), F.concat(F.lit("song_"), F.col("song_id").cast("string")),
                F.lit("note_count"), F.size("entries").cast("string"),
            ).alias("info"),
            F.col("entries.note").alias("chart"),
        )
    )


def songlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("id"), F.concat(F.lit("song_"), key.cast("string")).alias("name"),
        (key * 7 % 120 + 1).cast("int").alias("difficulty"),
        F.col("p_retailprice").cast("int").alias("note_count"),
        F.col("p_size").cast("bigint").alias("swf_version"),
    )


def counted_songlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song list of songs that have notes, with their true note count."""
    counts = raw_notes(spark, sf_dir).groupBy("song_id").agg(F.count(F.lit(1)).alias("note_count"))
    songs = songlist(spark, sf_dir).drop("note_count")
    return songs.join(counts, songs.id == counts.song_id).drop("song_id")


def old_songlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songlist(spark, sf_dir).filter("id % 10 <> 0")


def new_songlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    bumped = F.when(F.col("id") % 5 == 0, F.col("swf_version") + 1).otherwise(F.col("swf_version"))
    return songlist(spark, sf_dir).filter("id % 11 <> 0").withColumn("swf_version", bumped)


def raw_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The playlist as delivered: numbers as doubles, codes, ``m:ss``, 0/1 flags."""
    key = F.col("p_partkey")
    seconds = F.col("p_size") * 7
    double = lambda c: c.cast("double")
    paid = F.when(key % 2 == 0, double(F.col("p_size")))
    return table(spark, sf_dir, "part").select(
        double(key).alias("level"), F.concat(F.lit("song_"), key.cast("string")).alias("name"),
        double(key * 7 % 120 + 1).alias("difficulty"), double(key % 15).alias("genre"),
        double(key % 3).alias("style"),
        F.concat(F.floor(seconds / 60).cast("string"), F.lit(":"),
                 F.lpad((seconds % 60).cast("string"), 2, "0")).alias("time"),
        double(F.col("p_size") * 10).alias("arrows"),
        F.concat(F.lit("preview"), key.cast("string")).alias("previewhash"),
        double(F.lit(946684800) + key * 86400).alias("releasedate"),
        F.col("p_name").alias("author"),
        F.when(key % 2 == 0, F.concat("p_brand", F.lit(" & "), "p_type")).otherwise(F.col("p_brand")).alias("stepauthor"),
        double(key % 5).alias("song_rating"),
        double(F.col("p_size") % 2).alias("o_explicit"),
        F.when(key % 3 != 0, F.lit(1.0)).alias("o_legacy"),
        F.when(key % 5 == 0, 1.0).otherwise(0.0).alias("o_unranked"),
        paid.alias("credits"), paid.alias("price"),
    )


def contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating disputes as raw text, one sheet per year, rows numbered per sheet."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    # A sheet is a year. Rows are numbered as they are in the table; their longer texts are made afterwards.
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *order, "l_shipdate", F.year("l_shipdate").alias("year"))
    numbered = row_numbers(rows, ["year"], "l_orderkey", ROW_WIDTHS, order, "sheet_row")
    q = F.col("l_quantity").cast("int")
    day = F.date_format("l_shipdate", "yyyy/MM/dd")
    line, pick = F.col("l_linenumber"), F.col("l_suppkey") % 10
    return numbered.select(
        F.concat(F.lit("song_"), F.col("l_partkey").cast("string")).alias("song_name"),
        F.when(F.col("l_suppkey") % 20 == 7, "no").otherwise(q.cast("string")).alias("old_diff"),
        F.when(line == 1, "no change").when(line == 2, "change")
        .when(line == 3, F.concat(F.lit("(resolved) "), (q + 1).cast("string")))
        .when(line == 4, (q + 4).cast("string")).when(line == 5, (q - 8).cast("string"))
        .when(line == 6, "200").otherwise((q + 2).cast("string")).alias("new_diff"),
        F.when(pick == 3, F.lit(None)).when(pick == 4, F.concat(F.lit("v"), day))
        .when(pick == 5, "n/a").otherwise(day).alias("date"),
        F.concat(F.col("year").cast("string"), F.lit(" Difficulty Changes")).alias("source_sheet"), "sheet_row",
    )


def chart_songlist(charts_df: DataFrame, songs: DataFrame) -> DataFrame:
    """The song list of the charts' songs, with the notes of all their parts."""
    counts = charts_df.groupBy(F.col("song_id").alias("id")).agg(F.sum(F.size("chart")).cast("bigint").alias("note_count"))
    return songs.drop("note_count").join(counts, "id").select("id", "name", "difficulty", "note_count", "swf_version")


def chart_playlist(charts_df: DataFrame, raw: DataFrame) -> DataFrame:
    """The raw playlist of the charts' songs."""
    return raw.join(charts_df.select(F.col("song_id").cast("double").alias("level")), "level", "left_semi").select(*raw.columns)
