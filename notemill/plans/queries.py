"""Registered queries: name -> (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.functions.scalars import (
    GENRES, decode, epoch_to_timestamp, lane_active, mmss_to_seconds, one_hot, register_combine_orientations,
    set_map_value, split_names,
)
from notemill.operators import audit, cdc, chart, content, density, gold, merge, moments, notes, playlist, profile, reliability
from notemill.operators.running import cut_large_keys, forward_fill, row_numbers
from notemill.plans.medallion import TABLES, Medallion, database
from notemill.session import saved, scratch_path
from notemill.sources import derived, landed, tables

AS_OF_YEAR = 2001

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last bits. Adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def nudged(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Rounded after a nudge of a hundredth of the last digit, so that short decimals which would tie all go up."""
    return df.withColumns({c: F.round(F.col(c) + 10.0 ** -(digits + 2), digits) for c in columns})


# -- shared inputs. Tables that several branches of a plan read are written once.

def stored_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(derived.notes(spark, sf_dir), "notes")


def chords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.merge_chords(notes.separate_ties(stored_notes(spark, sf_dir)))


def stored_chords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(chords(spark, sf_dir), "chords")


def lane_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.split_chords(stored_chords(spark, sf_dir))


def stored_contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(derived.contested(spark, sf_dir), "contested")


def silver_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.clean_playlist(derived.raw_playlist(spark, sf_dir), derived.songlist(spark, sf_dir))


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.reliability_weights(
        stored_contested(spark, sf_dir), silver_playlist(spark, sf_dir), AS_OF_YEAR
    )


def silver_contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.dq_filter(weights(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.reliability_scores(silver_contested(spark, sf_dir))


def counted_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chart.chart_features(derived.counted_songlist(spark, sf_dir))


# -- notes ---------------------------------------------------------------------

@query("note_1_explode_notes")
def _(spark, sf_dir):
    return notes.explode_notes(derived.charts(spark, sf_dir))


@query("note_2_separate_ties")
def _(spark, sf_dir):
    return notes.separate_ties(stored_notes(spark, sf_dir)).select("song_id", "note_id", "orientation", "ms")


@query("note_2_separate_ties_seconds")
def _(spark, sf_dir):
    return notes.separate_ties(stored_notes(spark, sf_dir), 1e-3, "timestamp").select(
        "song_id", "note_id", "orientation", "timestamp"
    )


@query("note_3_merge_chords")
def _(spark, sf_dir):
    return chords(spark, sf_dir).select("song_id", "ms", "note_id", "framers", "orientation")


@query("note_4_split_chords")
def _(spark, sf_dir):
    return notes.split_chords(chords(spark, sf_dir)).select("song_id", "note_id", "ms", "orientation")


@query("agg_5_lane_or")
def _(spark, sf_dir):
    register_combine_orientations(spark)
    return chords(spark, sf_dir).select(
        "song_id", "ms", F.expr("combine_orientations(array(orientation, '0001'))").alias("with_last_lane"),
        *[lane_active("orientation", k).alias(f"lane_{k}") for k in range(4)],
    )


@query("prj_9_one_hot")
def _(spark, sf_dir):
    size = F.col("p_size") % 6
    return derived.table(spark, sf_dir, "part").select(
        "p_partkey", one_hot(size).alias("four_lanes"), one_hot(size, 6).alias("six_lanes")
    )


@query("dq_6_invalid_orientations")
def _(spark, sf_dir):
    merged = chords(spark, sf_dir)
    marked = merged.withColumn(
        "orientation", F.when(F.col("note_id") % 7 == 0, F.regexp_replace("orientation", "1", "2"))
        .otherwise(F.col("orientation"))
    )
    return notes.invalid_orientations(marked).select("song_id", "note_id", "orientation")


@query("dq_7_tied_notes")
def _(spark, sf_dir):
    return notes.tied_notes(derived.raw_notes(spark, sf_dir))


@query("srt_3_largest_ties")
def _(spark, sf_dir):
    return notes.largest_ties(derived.raw_notes(spark, sf_dir))


@query("dq_7_trace_ties")
def _(spark, sf_dir):
    played = stored_notes(spark, sf_dir)
    return notes.trace_ties(played, notes.largest_ties(played))


# -- densities -----------------------------------------------------------------

@query("den_1_vertical_density")
def _(spark, sf_dir):
    return density.vertical_density(lane_rows(spark, sf_dir)).drop("timestamp")


@query("den_1_vertical_density_sliced")
def _(spark, sf_dir):
    """Slices of 64 ms, so that most songs cross many edges."""
    return density.vertical_density(lane_rows(spark, sf_dir), widths=(64, 256)).drop("timestamp")


@query("den_1_vertical_density_seconds")
def _(spark, sf_dir):
    played = notes.separate_ties(stored_notes(spark, sf_dir), 1e-3, "timestamp").drop("ms")
    merged = saved(notes.merge_chords(played, time="timestamp"), "chords")
    return density.vertical_density(notes.split_chords(merged), "timestamp", widths=(131, 131 * 4096))


@query("den_3_horizontal_density")
def _(spark, sf_dir):
    dense = density.horizontal_density(chords(spark, sf_dir)).drop("ms", "timestamp")
    return rounded(dense, "horizontal_density")


@query("den_3_horizontal_density_sliced")
def _(spark, sf_dir):
    dense = density.horizontal_density(chords(spark, sf_dir), slice_ms=64).drop("ms", "timestamp")
    return rounded(dense, "horizontal_density")


@query("den_3_horizontal_density_by_pairs")
def _(spark, sf_dir):
    return rounded(density.horizontal_density_by_pairs(lane_rows(spark, sf_dir)), "horizontal_density")


@query("den_3_horizontal_density_seconds")
def _(spark, sf_dir):
    dense = density.horizontal_density_by_pairs(lane_rows(spark, sf_dir), time="timestamp")
    return rounded(dense.drop("timestamp"), "horizontal_density")


@query("den_3_horizontal_density_seconds_prefix")
def _(spark, sf_dir):
    """Times in seconds by prefix counts, in slices of 64 ms, so that most songs cross edges."""
    dense = density.horizontal_density_in_seconds(lane_rows(spark, sf_dir), slice_seconds=0.064)
    return rounded(dense.drop("timestamp"), "horizontal_density")


@query("den_4_explain_density")
def _(spark, sf_dir):
    """Every neighbour of the last note of the first song."""
    rows = lane_rows(spark, sf_dir)
    song, note, lane = rows.orderBy("song_id", F.desc("note_id"), "orientation").select("song_id", "note_id", "orientation").first()
    return density.explain_density(rows, song, note, lane)


@query("den_note_densities")
def _(spark, sf_dir):
    dense = density.note_densities(stored_chords(spark, sf_dir)).drop("timestamp", "prev_timestamp", "time_delta")
    return rounded(dense, "horizontal_density")


@query("den_note_densities_sliced")
def _(spark, sf_dir):
    dense = density.note_densities(stored_chords(spark, sf_dir), widths=(64, 256)).drop("timestamp", "prev_timestamp", "time_delta")
    return rounded(dense, "horizontal_density")


@query("jn_5_band_pairs")
def _(spark, sf_dir):
    return density.band_pairs(lane_rows(spark, sf_dir), density.JUDGE.reach).groupBy(
        "song_id", "note_id", "orientation"
    ).agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("diff").alias("sum_diff"),
        F.min("diff").alias("min_diff"), F.max("diff").alias("max_diff"),
    )


@query("den_4_verify_density")
def _(spark, sf_dir):
    merged = stored_chords(spark, sf_dir)
    checked = density.verify_density(notes.split_chords(merged), density.horizontal_density(merged))
    return rounded(checked, "calculated", "horizontal_density")


@query("dq_9_vertical_by_difficulty")
def _(spark, sf_dir):
    dense = density.vertical_density(lane_rows(spark, sf_dir))
    return rounded(density.density_by_difficulty(dense, derived.songlist(spark, sf_dir), "vertical_density"), "avg_density")


@query("agg_13_density_correlation")
def _(spark, sf_dir):
    dense = density.note_densities(stored_chords(spark, sf_dir))
    songs = derived.songlist(spark, sf_dir)
    rows = [
        density.density_correlation(density.density_by_difficulty(dense, songs, c), top).withColumn("density", F.lit(c))
        for c, top in (("vertical_density", 150.0), ("horizontal_density", 15.0))
    ]
    return rounded(rows[0].unionByName(rows[1]), "correlation")


# -- charts --------------------------------------------------------------------

@query("cht_1_chart_features")
def _(spark, sf_dir):
    return rounded(chart.chart_features(derived.songlist(spark, sf_dir)), "song_length_log_normalized", digits=9)


@query("agg_4_percentile")
def _(spark, sf_dir):
    counts = derived.counted_songlist(spark, sf_dir)
    return spark.range(1).select(F.lit(chart.exact_percentile(counts, "note_count", 0.95)).alias("p95"))


@query("agg_4_percentile_of_many_values")
def _(spark, sf_dir):
    """A column of mostly different doubles, of which no task sorts more than a thousand."""
    prices = derived.table(spark, sf_dir, "lineitem")
    found = [(s, chart.exact_percentile(prices, "l_extendedprice", s, most=1000)) for s in (0.05, 0.5, 0.95)]
    return rounded(spark.createDataFrame(found, "share double, value double"), "value")


@query("cht_1_percentile_after_changes")
def _(spark, sf_dir):
    """p95 of the note counts after a run, from the counts before it and the changed songs alone."""
    old, new = snapshots(spark, sf_dir)
    updated = cdc.updated_keys(old, new, "id", "swf_version").select("id")
    gone = cdc.deleted_keys(old, new, "id").unionByName(updated)
    come = cdc.new_keys(old, new, "id").unionByName(updated)
    stored = saved(chart.value_counts(old, "note_count"), "note-counts")
    counts = [chart.value_counts(cdc.scope(songs.withColumn("id", F.col("id").cast("bigint")), keys, "id"), "note_count") for songs, keys in ((old, gone), (new, come))]
    after = saved(chart.merged_counts(stored, *counts), "note-counts")
    return chart.percentile_of_counts(after, 0.95).withColumn("songs", after.agg(F.sum("n").alias("n")).scalar())


@query("dq_10_length_check")
def _(spark, sf_dir):
    return rounded(
        chart.length_check(counted_features(spark, sf_dir)),
        "avg_notes", "min_normalized", "max_normalized", "avg_normalized", "share_above",
    )


@query("agg_14_histogram")
def _(spark, sf_dir):
    return rounded(chart.histogram(derived.counted_songlist(spark, sf_dir), "note_count", 10), "bin_low", "bin_high")


@query("agg_14_histogram_lengths")
def _(spark, sf_dir):
    lengths = counted_features(spark, sf_dir).withColumn("length", F.round("song_length_log_normalized", 4))
    return rounded(chart.histogram(lengths, "length", 50), "bin_low", "bin_high")


# -- change detection ----------------------------------------------------------

def snapshots(spark, sf_dir):
    return derived.old_songlist(spark, sf_dir), derived.new_songlist(spark, sf_dir)


@query("cdc_1_deleted_keys")
def _(spark, sf_dir):
    return cdc.deleted_keys(*snapshots(spark, sf_dir), "id")


@query("cdc_2_new_keys")
def _(spark, sf_dir):
    return cdc.new_keys(*snapshots(spark, sf_dir), "id")


@query("cdc_3_updated_keys")
def _(spark, sf_dir):
    return cdc.updated_keys(*snapshots(spark, sf_dir), "id", "swf_version")


@query("cdc_4_changed_keys")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return cdc.changed_keys(new, old, "id", "swf_version")


@query("cdc_4_changed_keys_null_safe")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    unknown = old.withColumn("swf_version", F.when(F.col("id") % 7 != 0, F.col("swf_version")))
    return cdc.changed_keys(new, unknown, "id", "swf_version", null_safe=True)


@query("cdc_5_combined_keys")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    both = cdc.combine_keys(cdc.new_keys(old, new, "id"), cdc.updated_keys(old, new, "id", "swf_version"))
    return cdc.freeze(both)


@query("cdc_6_version_missing")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return cdc.updated_keys(old.drop("swf_version"), new, "id", "swf_version").select("id", "new_swf_version")


@query("cdc_6_changes_by_content")
def _(spark, sf_dir):
    """Changes of whole song rows, told by digests; only buckets that differ are read."""
    held, now = (content.store_digests(content.key_digests(songs, "id", buckets=256)) for songs in snapshots(spark, sf_dir))
    differing = content.differing_buckets(content.bucket_digests(held), content.bucket_digests(now))
    return content.content_changes(held, now, "id", differing)


@query("cdc_7_scope")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    changed = cdc.changed_keys(new, old, "id", "swf_version").withColumnRenamed("id", "song_id")
    return cdc.scope(derived.raw_notes(spark, sf_dir), changed, "song_id").select("song_id", "event_id", "ms")


@query("cdc_8_change_summary")
def _(spark, sf_dir):
    return cdc.change_summary(*snapshots(spark, sf_dir), "id", "swf_version")


@query("cdc_10_with_version")
def _(spark, sf_dir):
    return cdc.with_version(
        derived.raw_notes(spark, sf_dir).select("song_id", "event_id"), derived.new_songlist(spark, sf_dir)
    )


@query("cdc_settle_versions")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    arrived = new.filter("id % 2 = 0").select(F.col("id").alias("song_id"))
    return cdc.settle_versions(new, old, arrived).select("id", "swf_version")


# -- table changes -------------------------------------------------------------

SONG = ("id", "name", "difficulty", "swf_version")


@query("dml_1_merge_upsert")
def _(spark, sf_dir):
    return merge.merge_upsert(*snapshots(spark, sf_dir), ["id"]).select(*SONG)


@query("dml_2_delete_keys")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return merge.delete_keys(old, cdc.deleted_keys(old, new, "id")).select(*SONG)


@query("dml_3_delete_where")
def _(spark, sf_dir):
    return merge.delete_where(derived.songlist(spark, sf_dir), F.col("swf_version").isin(3, 7, 11)).select(*SONG)


@query("dml_4_replace_by_key")
def _(spark, sf_dir):
    target = derived.raw_notes(spark, sf_dir).select("song_id", "event_id", "ms")
    incoming = target.filter("song_id % 3 = 0 AND event_id % 2 = 0").withColumn("ms", F.col("ms") + 1000)
    return merge.replace_by_key(target, incoming, "song_id")


def cascade_inputs(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    held = {
        "bronze__songlist": (old, "id"),
        "bronze__playlist": (derived.raw_playlist(spark, sf_dir), "level"),
        "silver__notes": (derived.raw_notes(spark, sf_dir), "song_id"),
    }
    return held, cdc.deleted_keys(old, new, "id")


@query("dml_5_cascade_report")
def _(spark, sf_dir):
    return merge.cascade_delete(*cascade_inputs(spark, sf_dir))[1]


@query("dml_5_cascade_rows")
def _(spark, sf_dir):
    left, _ = merge.cascade_delete(*cascade_inputs(spark, sf_dir))
    return left["silver__notes"].select("song_id", "event_id")


@query("dml_6_update_where")
def _(spark, sf_dir):
    return merge.update_where(
        derived.songlist(spark, sf_dir), F.col("id") % 9 == 4,
        {"swf_version": F.lit(999999).cast("bigint"), "difficulty": F.col("difficulty") + F.col("swf_version").cast("int")},
    ).select(*SONG)


@query("dml_7_merge_update")
def _(spark, sf_dir):
    source = derived.new_songlist(spark, sf_dir).select(
        "id", F.when(F.col("id") % 4 != 0, F.concat("name", F.lit("_b"))).alias("name")
    )
    return merge.merge_update(derived.old_songlist(spark, sf_dir), source, ["id"], ["name"]).select(*SONG)


# -- decoding ------------------------------------------------------------------

@query("prj_1_decode_genre")
def _(spark, sf_dir):
    return derived.raw_playlist(spark, sf_dir).select("level", decode("genre", GENRES).alias("genre"))


@query("prj_11_clean_playlist")
def _(spark, sf_dir):
    return silver_playlist(spark, sf_dir).withColumns({
        "stepauthor": F.array_join("stepauthor", "|"),
        "release_date": F.unix_seconds("release_date"),
    })


@query("prj_4_parse_fields")
def _(spark, sf_dir):
    return derived.raw_playlist(spark, sf_dir).select(
        "level", mmss_to_seconds("time").alias("seconds"), F.size(split_names("stepauthor")).alias("authors"),
        F.year(epoch_to_timestamp("releasedate")).alias("release_year"),
        mmss_to_seconds(F.concat("time", F.lit("x"))).alias("bad_time"),
    )


@query("fn_6_map_update")
def _(spark, sf_dir):
    info = derived.charts(spark, sf_dir).select(
        "song_id", "first_note_id", set_map_value("info", "note_count", "99999").alias("info")
    )
    return info.select(
        "song_id", "first_note_id", F.element_at("info", "name").alias("name"), F.element_at("info", "note_count").alias("note_count"),
        F.size("info").alias("entries"),
    )


# -- reliability ---------------------------------------------------------------

@query("rel_2_forward_fill")
def _(spark, sf_dir):
    sheets = stored_contested(spark, sf_dir).withColumn("_date", reliability.clean_date("date"))
    return forward_fill(
        sheets, ["source_sheet"], "sheet_row", "_date", reliability.ROW_WIDTHS, "change_date"
    ).select("source_sheet", "sheet_row", F.col("change_date").cast("string").alias("change_date"))


@query("rel_2_forward_fill_sliced")
def _(spark, sf_dir):
    sheets = stored_contested(spark, sf_dir).withColumn("_date", reliability.clean_date("date"))
    return forward_fill(sheets, ["source_sheet"], "sheet_row", "_date", (1000, 8000), "change_date").select(
        "source_sheet", "sheet_row", F.col("change_date").cast("string").alias("change_date")
    )


def year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose position, the year, takes a handful of values."""
    return derived.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


YEAR_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("win_3_row_numbers_sliced")
def _(spark, sf_dir):
    """Numbers within a flag by year, a thousand rows a slice."""
    numbered = row_numbers(year_rows(spark, sf_dir), ["l_returnflag"], "year", tiebreak=YEAR_ORDER, name="nth", rows_per_task=1000)
    return numbered.drop("l_extendedprice")


@query("win_3_slice_sizes")
def _(spark, sf_dir):
    """Whether a flag is cut as finely as its rows ask for: no slice above twice the wanted rows."""
    cut = cut_large_keys(year_rows(spark, sf_dir), ["l_returnflag"], "year", 1000, YEAR_ORDER)
    slices = cut.groupBy("l_returnflag", "_slice0").agg(F.count(F.lit(1)).alias("n"))
    return slices.groupBy("l_returnflag").agg(
        F.sum("n").alias("rows"), (F.max("n") <= 2000).alias("bounded"), (F.count(F.lit(1)) >= F.sum("n") / 2000).alias("fine"),
    )


@query("rel_4_parse_disputes")
def _(spark, sf_dir):
    return reliability.parse_disputes(stored_contested(spark, sf_dir)).select(
        "source_sheet", "sheet_row", "old_difficulty", "new_difficulty", "change_year", "is_actual_change",
        "difficulty_change",
    )


SCORED = (
    "song_name", "old_difficulty", "new_difficulty", "difficulty_change", "is_actual_change", "change_year",
    "source_sheet", "num_changes", "stability_score", "recency_score", "acceptance_score", "magnitude_confidence",
    "resolution_bonus", "reliability_weight",
)


@query("rel_12_reliability_weights")
def _(spark, sf_dir):
    scored = weights(spark, sf_dir).select(*SCORED, F.col("change_date").cast("string").alias("change_date"))
    return rounded(scored, "stability_score", "reliability_weight", digits=9)


@query("flt_1_dq_counts")
def _(spark, sf_dir):
    return reliability.dq_counts(weights(spark, sf_dir))


@query("rel_13_song_consensus")
def _(spark, sf_dir):
    songs = reliability.song_consensus(silver_contested(spark, sf_dir))
    return nudged(
        songs.withColumn("latest_change", F.col("latest_change").cast("string")),
        "weighted_difficulty", "avg_reliability", "total_reliability", "difficulty_stddev",
    )


STATS = ("avg_reliability", "stddev_reliability", "total_reliability", "avg_recency", "avg_acceptance")


@query("rel_14_difficulty_reliability")
def _(spark, sf_dir):
    return rounded(reliability.difficulty_reliability(silver_contested(spark, sf_dir)), *STATS, digits=8)


def moments_after_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after the last sheet has come: only disputes of its songs are taken out and put in."""
    sheets = stored_contested(spark, sf_dir)
    # Sheets are parsed one by one, so a row is the same before and after.
    parsed = saved(reliability.parse_disputes(sheets).drop("old_diff", "date", "sheet_row"), "parsed-disputes")
    last = sheets.agg(F.max("source_sheet").alias("m")).scalar()
    touched = saved(sheets.filter(F.col("source_sheet") == last).select("song_name").distinct(), "touched-songs")
    songs = silver_playlist(spark, sf_dir)
    earlier = F.col("source_sheet") != last
    of_songs = lambda rows: cdc.scope(rows, touched, "song_name")
    before, after = (
        moments.dispute_moments(reliability.dq_filter(reliability.reliability_weights(rows, songs, AS_OF_YEAR, parsed=typed)))
        for rows, typed in ((sheets.filter(earlier), parsed.filter(earlier)), (of_songs(sheets), of_songs(parsed)))
    )
    held = saved(before, "dispute-moments")
    # All that counts for a song is in its own disputes and cells: the old cells go, the new ones come.
    gone, come = of_songs(held), after
    return moments.moments_after(held, gone, come)


@query("rel_13_consensus_after_changes")
def _(spark, sf_dir):
    songs = moments.consensus_of_moments(moments_after_sheet(spark, sf_dir))
    return nudged(
        songs.withColumn("latest_change", F.col("latest_change").cast("string")),
        "weighted_difficulty", "avg_reliability", "total_reliability", "difficulty_stddev", digits=7,
    )


@query("rel_14_reliability_after_changes")
def _(spark, sf_dir):
    return rounded(moments.difficulty_of_moments(moments_after_sheet(spark, sf_dir)), *STATS, digits=8)


@query("rel_15_densify")
def _(spark, sf_dir):
    return rounded(
        reliability.densify(reliability.difficulty_reliability(silver_contested(spark, sf_dir))), *STATS, digits=8
    )


@query("rel_16_reliability_scores")
def _(spark, sf_dir):
    return rounded(scores(spark, sf_dir), *STATS, digits=8)


@query("rel_16_reliability_scores_even")
def _(spark, sf_dir):
    """The even frame: two levels before, two after."""
    return rounded(reliability.reliability_scores(silver_contested(spark, sf_dir), 2, 2), *STATS, digits=8)


@query("rel_17_sample_weights")
def _(spark, sf_dir):
    songs = silver_playlist(spark, sf_dir).select("song_id", "name", "difficulty")
    return rounded(
        reliability.sample_weights(songs, scores(spark, sf_dir)).select("song_id", "difficulty", "num_assessments", "sample_weight"),
        "sample_weight",
    )


@query("dq_1_null_counts")
def _(spark, sf_dir):
    return profile.null_counts(
        weights(spark, sf_dir),
        ["song_name", "old_difficulty", "new_difficulty", "change_date", "difficulty_change", "reliability_weight"],
    )


@query("dq_2_profile")
def _(spark, sf_dir):
    disputed = silver_contested(spark, sf_dir).filter("is_actual_change")
    return rounded(profile.numeric_profile(disputed, "difficulty_change"), "mean", "stddev")


@query("dq_2_weight_profile")
def _(spark, sf_dir):
    weighed = rounded(silver_contested(spark, sf_dir), "reliability_weight", digits=9)
    spread = profile.numeric_profile(weighed, "reliability_weight", accuracy=10_000_000)
    return rounded(spread, "mean", "stddev")


@query("dq_3_changes_by_year")
def _(spark, sf_dir):
    return profile.count_by(silver_contested(spark, sf_dir), "change_year").orderBy("change_year")


def ranked(spark, sf_dir, descending):
    """Assessments, each a row of a sheet; equal weights in the order of the sheets."""
    scored = reliability.reliability_weights(
        stored_contested(spark, sf_dir), silver_playlist(spark, sf_dir), AS_OF_YEAR, carry=["sheet_row"]
    )
    rows = rounded(reliability.dq_filter(scored), "reliability_weight", digits=9).select(
        "song_name", "new_difficulty", "change_year", "num_changes", "reliability_weight", "source_sheet", "sheet_row"
    )
    return profile.top_k(rows, "reliability_weight", 10, descending, ["source_sheet", "sheet_row"])


@query("dq_4_highest_weights")
def _(spark, sf_dir):
    return ranked(spark, sf_dir, True)


@query("dq_4_lowest_weights")
def _(spark, sf_dir):
    return ranked(spark, sf_dir, False)


@query("dq_5_resolved")
def _(spark, sf_dir):
    return derived.contested(spark, sf_dir).filter(reliability.is_resolved("new_diff")).select(
        "song_name", "old_diff", "new_diff", "source_sheet", "sheet_row"
    )


@query("srt_2_top_songs")
def _(spark, sf_dir):
    songs = rounded(
        reliability.song_consensus(silver_contested(spark, sf_dir)).select("song_name", "total_reliability", "num_assessments"),
        "total_reliability", digits=8,
    )
    return profile.top_k(songs, "total_reliability", 10, True, ["song_name"])


def smoothed(spark, sf_dir):
    levels = reliability.densify(reliability.difficulty_reliability(silver_contested(spark, sf_dir)))
    return reliability.smooth_ordinal(levels)


@query("dq_8_smoothing_report")
def _(spark, sf_dir):
    return rounded(reliability.smoothing_report(smoothed(spark, sf_dir)), "before_smooth", "after_smooth", "change")


@query("agg_16_smoothing_ranges")
def _(spark, sf_dir):
    ranges = reliability.smoothing_ranges(smoothed(spark, sf_dir))
    return rounded(ranges, *ranges.columns)


@query("dq_12_weight_coverage")
def _(spark, sf_dir):
    songs = silver_playlist(spark, sf_dir).select("song_id", "name", "difficulty")
    covered = reliability.weight_coverage(reliability.sample_weights(songs, scores(spark, sf_dir)))
    return rounded(covered, "min_weight", "max_weight", "mean_weight", "stddev_weight")


# -- gold ----------------------------------------------------------------------

GOLD_DOUBLES = ("horizontal_density", "position_in_song", "song_length_log_normalized")


@query("gld_2_assemble_features")
def _(spark, sf_dir):
    merged, songs = stored_chords(spark, sf_dir), derived.counted_songlist(spark, sf_dir)
    vertical = cdc.with_version(density.vertical_density(notes.split_chords(merged)), songs)
    features = gold.assemble_features(vertical, density.horizontal_density(merged), chart.chart_features(songs))
    return rounded(features, *GOLD_DOUBLES)


@query("gld_3_attach_labels")
def _(spark, sf_dir):
    features = derived.raw_notes(spark, sf_dir).select("song_id", "event_id")
    return rounded(gold.attach_labels(features, silver_playlist(spark, sf_dir), scores(spark, sf_dir)), "sample_weight")


@query("gld_features")
def _(spark, sf_dir):
    songs = derived.counted_songlist(spark, sf_dir)
    features = gold.features_from_chords(
        stored_chords(spark, sf_dir), songs, chart.chart_features(songs), silver_playlist(spark, sf_dir),
        scores(spark, sf_dir),
    )
    return rounded(features, *GOLD_DOUBLES, "sample_weight")


@query("gld_features_from_tables")
def _(spark, sf_dir):
    merged, songs = stored_chords(spark, sf_dir), derived.counted_songlist(spark, sf_dir)
    vertical = cdc.with_version(density.vertical_density(notes.split_chords(merged)), songs)
    features = gold.gold_features(
        vertical, density.horizontal_density(merged), chart.chart_features(songs), silver_playlist(spark, sf_dir),
        scores(spark, sf_dir),
    )
    return rounded(features, *GOLD_DOUBLES, "sample_weight")


# -- files and tables ----------------------------------------------------------

@query("src_1_songlist_json")
def _(spark, sf_dir):
    path = scratch_path(spark, "songlist-json")
    derived.songlist(spark, sf_dir).write.json(path)
    return landed.read_songlist(spark, path, multiline=False).select(*SONG, "note_count")


RANGE_BYTES, RANGES, LARGEST_RANGE = 16_384, 1024, 1 << 26


@contextmanager
def small_ranges(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> Iterator[None]:
    """Files below ``path`` are read in ranges of ``size`` bytes, so that small ones too have borders inside records.

    Each range is a task that reports to the driver, so larger inputs have larger ranges: about
    ``RANGES`` of them, until they reach ``LARGEST_RANGE`` bytes.
    """
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    size = max(size, min(held // RANGES, LARGEST_RANGE))
    try:
        for name, value in zip(names, (size, size), strict=True):
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


def write_arrays(df: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """JSON array files of about ``rows_per_file`` rows each."""
    files = max(1, -(-df.count() // rows_per_file))
    rows = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(files)).alias("file"), F.to_json(F.struct(*df.columns)).alias("row"))
    arrays = rows.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("row"), ",\n"), F.lit("]")).alias("line"))
    arrays.write.partitionBy("file").text(path)


@query("src_1_songlist_json_array")
def _(spark, sf_dir):
    path = scratch_path(spark, "songlist-array")
    write_arrays(derived.songlist(spark, sf_dir), path)
    with small_ranges(spark, path):
        return saved(landed.read_songlist(spark, path).select(*SONG, "note_count"), "songlist")


@query("src_3_playlist_json_array")
def _(spark, sf_dir):
    path = scratch_path(spark, "playlist-array")
    raw = derived.raw_playlist(spark, sf_dir)
    write_arrays(raw, path)
    with small_ranges(spark, path):
        return saved(landed.read_playlist(spark, path).select(*raw.columns), "playlist")


@query("src_2_charts_json")
def _(spark, sf_dir):
    path = scratch_path(spark, "charts-json")
    status = F.when(F.col("song_id") % 5 == 0, 500).otherwise(200)
    derived.charts(spark, sf_dir).withColumn("status", status).write.json(path)
    return notes.explode_notes(landed.read_charts(spark, path)).drop("timestamp")


@query("src_2_charts_decimals")
def _(spark, sf_dir):
    """Charts with decimal numbers are read in full; what is no JSON is kept as a reject."""
    path = scratch_path(spark, "charts-decimals")
    half = F.transform("chart", lambda note: F.array(note[0] + 0.5, note[1].cast("double"), note[2].cast("double"), note[3] + 0.25))
    lines = derived.charts(spark, sf_dir).withColumns({"chart": half, "status": F.lit(200)}).select(F.to_json(F.struct("*")).alias("line"))
    broken = derived.songlist(spark, sf_dir).select(F.concat(F.lit('{"song_id": '), F.col("id").cast("string"), F.lit(', "chart": [[')).alias("line"))
    lines.unionByName(broken).write.text(path)
    told = notes.explode_notes(landed.read_charts(spark, path)).groupBy("song_id").agg(
        F.count(F.lit(1)).alias("notes"), F.sum("ms").alias("sum_ms"), F.sum("framers").alias("sum_framers"), F.max("note_id").alias("last_note")
    )
    return told.withColumn("rejected", F.lit(saved(landed.rejected_charts(spark, path), "rejects").count()))


@query("src_3_playlist_json")
def _(spark, sf_dir):
    path = scratch_path(spark, "playlist-json")
    derived.raw_playlist(spark, sf_dir).write.json(path)
    return landed.read_playlist(spark, path, multiline=False)


def write_sheets(contested: DataFrame, path: str) -> None:
    """Exports as ``<title>.csv`` folders: empty row, header row, then the rows in order."""
    cell = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", cell("song_name"), F.lit(""), cell("old_diff"), cell("new_diff"), cell("date"))
    rows = contested.select("source_sheet", "sheet_row", line.alias("line"))
    head = rows.groupBy("source_sheet").agg(F.min("sheet_row").alias("first"))
    heads = [
        head.select("source_sheet", (F.col("first") - back).alias("sheet_row"), F.lit(text).alias("line"))
        for back, text in ((2, ",,,,"), (1, "Song Name,,Old Diff,New Diff!,Date"))
    ]
    titles = [r[0] for r in head.select("source_sheet").collect()]
    lines = saved(rows.unionByName(heads[0]).unionByName(heads[1]), "sheet-lines")
    for title in titles:
        lines.filter(F.col("source_sheet") == title).orderBy("sheet_row").select("line").write.text(
            f"{path}/{title}.csv"
        )
    lines.select("line").write.text(f"{path}/Notes.csv")


@query("src_4_read_sheets")
def _(spark, sf_dir):
    path = scratch_path(spark, "sheets")
    write_sheets(derived.contested(spark, sf_dir), path)
    return landed.read_sheets(spark, path, multiline=False).drop("ingestion_timestamp")


@query("src_4_read_sheets_multiline")
def _(spark, sf_dir):
    """Cells with line breaks, empty lines, commas and quotes, in ranges that begin anywhere."""
    path = scratch_path(spark, "sheets")
    odd = F.when(F.col("sheet_row") % 3 == 0, F.concat("song_name", F.lit('\n\n"live", '), F.col("old_diff"), F.lit('"\n'))).otherwise(F.col("song_name"))
    write_sheets(derived.contested(spark, sf_dir).withColumn("song_name", odd), path)
    with small_ranges(spark, path):
        return saved(landed.read_sheets(spark, path).drop("ingestion_timestamp"), "sheets")


@query("set_2_union_by_name")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return landed.union_all([
        old.select("id", "name"), new.select("id", "swf_version"), old.select("id", "difficulty"),
    ])


@contextmanager
def fresh_database(spark: SparkSession) -> Iterator[None]:
    """A database of its own for one query, dropped at the end. What is returned from it is copied first."""
    path = scratch_path(spark, "run")
    name = "run_" + path.rsplit("-", 1)[1]
    with database(spark, name, path):
        try:
            yield
        finally:
            spark.sql(f"DROP DATABASE {name} CASCADE")


@query("snk_1_overwrite_append")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    with fresh_database(spark):
        tables.write_table(new.select(*SONG), "songs")
        tables.write_table(old.select(*SONG), "songs")
        tables.write_table(new.select(*SONG), "songs", mode="append")
        return saved(tables.read_table(spark, "songs"), "result")


@query("snk_3_recreate_add_column")
def _(spark, sf_dir):
    songs = derived.songlist(spark, sf_dir)
    with fresh_database(spark):
        tables.write_table(songs.select("id", "name"), "songs")
        tables.write_table(songs.select("id", "swf_version"), "songs", on_schema_change="recreate")
        tables.ensure_column(spark, "songs", "difficulty", "int")
        return saved(tables.read_table(spark, "songs"), "result")


@query("snk_publish_upsert")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    with fresh_database(spark):
        tables.publish(old.select(*SONG), "songs")
        tables.publish(merge.merge_upsert(tables.read_table(spark, "songs"), new.select(*SONG), ["id"]), "songs")
        return saved(tables.read_table(spark, "songs"), "result")


@query("snk_replace_songs")
def _(spark, sf_dir):
    played = derived.raw_notes(spark, sf_dir).select("song_id", "event_id", "ms")
    incoming = played.filter("song_id % 3 = 0 AND event_id % 2 = 0").withColumn("ms", F.col("ms") + 1000)
    keys = cdc.freeze(incoming.select("song_id").distinct())
    with fresh_database(spark):
        tables.create_bucketed(played, "notes", 8)
        tables.replace_songs(spark, "notes", incoming, keys)
        return saved(tables.read_bucketed(spark, "notes"), "result")


@query("snk_bucket_count")
def _(spark, sf_dir):
    """The stored number of buckets holds, whatever a later run would like."""
    played = derived.raw_notes(spark, sf_dir).select("song_id", "event_id", "ms")
    keys = cdc.freeze(played.select("song_id").filter("song_id % 5 = 0").distinct())
    with fresh_database(spark):
        tables.create_bucketed(played, "notes", 4)
        tables.replace_songs(spark, "notes", played.filter("song_id % 5 = 0 AND event_id % 2 = 1"), keys)
        own = tables.read_bucketed(spark, "notes").groupBy("song_id").agg(F.count(F.lit(1)).alias("notes"))
        return saved(own.withColumn("buckets", F.lit(tables.bucket_count(spark, "notes"))), "result")


def medallion_inputs(spark, sf_dir):
    charts = saved(derived.charts(spark, sf_dir), "charts")
    songs = derived.chart_songlist(charts, derived.songlist(spark, sf_dir))
    raw = derived.chart_playlist(charts, derived.raw_playlist(spark, sf_dir))
    old = songs.filter("id % 10 <> 0")
    bumped = F.when(F.col("id") % 5 == 0, F.col("swf_version") + 1).otherwise(F.col("swf_version"))
    new = songs.filter("id % 11 <> 0").withColumn("swf_version", bumped)
    return old, new, charts, raw, stored_contested(spark, sf_dir)


@query("run_incremental_gold")
def _(spark, sf_dir):
    old, new, charts, raw, contested = medallion_inputs(spark, sf_dir)
    with fresh_database(spark):
        runs = Medallion(spark, as_of_year=AS_OF_YEAR, buckets=8)
        runs.run(old, charts, raw, contested)
        runs.run(new, charts, raw, contested)
        return saved(rounded(runs.table("gold__features"), *GOLD_DOUBLES, "sample_weight"), "result")


@query("run_duplicate_payloads")
def _(spark, sf_dir):
    """Every chart lands twice; the notes are there once."""
    _, new, charts, raw, contested = medallion_inputs(spark, sf_dir)
    with fresh_database(spark):
        runs = Medallion(spark, as_of_year=AS_OF_YEAR, buckets=8)
        runs.ingest_songs(new, charts.unionByName(charts))
        runs.refresh_notes()
        return saved(runs.table("silver__notes").groupBy("song_id").agg(F.count(F.lit(1)).alias("notes"), F.max("note_id").alias("last_note")), "result")


@query("run_idle")
def _(spark, sf_dir):
    """What a run over unchanged input does with each note table, also for songs whose notes have no valid lane."""
    _, new, charts, raw, contested = medallion_inputs(spark, sf_dir)
    lost = F.transform("chart", lambda note: F.array(note[0], F.lit(9).cast(charts.schema["chart"].dataType.elementType.elementType), note[2], note[3]))
    charts = charts.withColumn("chart", F.when(F.col("song_id") % 7 == 0, lost).otherwise(F.col("chart")))
    with fresh_database(spark):
        runs = Medallion(spark, as_of_year=AS_OF_YEAR, buckets=8)
        runs.run(new, charts, raw, contested)
        report = runs.run(new, charts, raw, contested)
        rows = [(name, mode, runs.table(name).select("song_id").distinct().count()) for name, mode in report if TABLES[name][1]]
        return spark.createDataFrame(rows, "table string, mode string, songs bigint")


@query("aud_1_presence")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    held = {
        "bronze__songlist": (new, "id"), "bronze__playlist": (derived.raw_playlist(spark, sf_dir), "level"),
        "silver__notes": (derived.raw_notes(spark, sf_dir), "song_id"), "gold__features": (old, "id"),
    }
    return audit.presence(held, derived.songlist(spark, sf_dir).select("id"))


@query("aud_2_verdict")
def _(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    held = {
        "bronze__songlist": (new, "id"), "silver__notes": (derived.raw_notes(spark, sf_dir), "song_id"),
        "gold__features": (old, "id"),
    }
    return audit.verdict(audit.presence(held, derived.songlist(spark, sf_dir).select("id"))).select("key", "state")


@query("aud_3_staleness")
def _(spark, sf_dir):
    songs = derived.songlist(spark, sf_dir)
    stale = merge.update_where(songs, F.col("id") % 9 == 4, {"swf_version": F.lit(999999).cast("bigint")})
    shifted = derived.raw_notes(spark, sf_dir).withColumn(
        "ms", F.when(F.col("song_id") % 4 == 0, F.col("ms") + 999999000).otherwise(F.col("ms"))
    )
    held = {
        "bronze__songlist": (stale, "id", "swf_version"), "silver__notes": (shifted, "song_id", "ms"),
        "gold__features": (songs, "id", None),
    }
    return audit.staleness(held, songs.select("id"), (999999, 999), floor=999999000)
