"""How far a difficulty rating can be trusted, from rating disputes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.functions.scalars import clean_date, column, ratio
from notemill.operators.running import forward_fill
from notemill.session import saved

MAX_DIFFICULTY = 120
RESOLVED = "(resolved)"
ROW_WIDTHS = (1 << 14, 1 << 28)

# What a difficulty level without any dispute gets.
UNCONTESTED = {
    "avg_reliability": 0.20,
    "num_assessments": 0,
    "total_reliability": 0.20,
    "avg_recency": 0.6,
    "avg_acceptance": 0.7,
}

SILVER_COLUMNS = (
    "song_name", "old_difficulty", "new_difficulty", "difficulty_change", "is_actual_change", "change_date",
    "change_year", "source_sheet", "num_changes", "stability_score", "recency_score", "acceptance_score",
    "magnitude_confidence", "resolution_bonus", "reliability_weight", "ingestion_timestamp",
    "transformation_timestamp",
)


def change_year(source_sheet: Column | str) -> Column:
    """Year from the first four characters of a sheet title."""
    return F.substring(column(source_sheet), 1, 4).try_cast("int")


def parse_old(c: Column | str) -> Column:
    """``no`` and anything that is no number give NULL."""
    return F.when(column(c) != "no", column(c).try_cast("int"))


def is_resolved(c: Column | str) -> Column:
    return column(c).contains(RESOLVED)


def parse_new(new: Column | str, old_difficulty: Column | str) -> Column:
    """``no change`` keeps the old level, ``change`` is unknown, ``(resolved) X`` is X."""
    new = column(new)
    return (
        F.when(new == "no change", column(old_difficulty))
        .when(new == "change", F.lit(None).cast("int"))
        .when(is_resolved(new), F.regexp_extract(new, r"\(resolved\)\s*(\d+)", 1).try_cast("int"))
        .otherwise(new.try_cast("int"))
    )


def recency(year: Column, as_of_year: int) -> Column:
    """1.0 for the current year, 0.1 less for each of three years, then 0.6 (also for no year)."""
    ago = F.lit(as_of_year) - year
    # Fixed values.
    return (
        F.when(ago <= 0, F.lit(1.0)).when(ago == 1, F.lit(0.9)).when(ago == 2, F.lit(0.8))
        .when(ago == 3, F.lit(0.7)).otherwise(F.lit(0.6))
    )


def acceptance(new_difficulty: Column, current: Column) -> Column:
    """0.7 without a current level, 1.0 when the proposal equals it, else 0.5."""
    # Fixed values.
    return F.when(current.isNull(), F.lit(0.7)).when(new_difficulty == current, F.lit(1.0)).otherwise(F.lit(0.5))


def magnitude(change: Column) -> Column:
    """Trust in the size of a change; 0.5 when it is unknown."""
    size = F.abs(change)
    # Fixed values.
    return F.when(size <= 2, F.lit(1.0)).when(size <= 5, F.lit(0.8)).when(size > 5, F.lit(0.6)).otherwise(F.lit(0.5))


def parse_disputes(
    contested: DataFrame, order: str = "sheet_row", widths: Sequence[int] = ROW_WIDTHS,
) -> DataFrame:
    """Typed dispute rows: dates (filled forward within each sheet), levels, change.

    ``order`` is the row ordinal within the sheet. The fill works by slices of
    it, so one very long sheet spreads over many tasks.
    """
    dated = contested.withColumn("_date", clean_date("date"))
    filled = forward_fill(dated, ["source_sheet"], order, "_date", widths, "change_date").drop("_date")
    levels = filled.withColumns({
        "change_year": change_year("source_sheet"), "old_difficulty": parse_old("old_diff"),
    }).withColumn("new_difficulty", parse_new("new_diff", "old_difficulty"))
    return levels.withColumns({
        "is_actual_change": ~F.coalesce(F.col("new_diff") == "no change", F.lit(False)),
        "difficulty_change": F.col("new_difficulty") - F.col("old_difficulty"),
    })


def song_lookup(contested: DataFrame, playlist: DataFrame) -> DataFrame:
    """(song_name, num_changes, current_difficulty) for every disputed song.

    A name the playlist holds several times gives several rows, which fan the
    disputes out. With both song-level facts in one table the dispute rows take
    part in a single join.
    """
    counts = contested.filter(F.col("song_name").isNotNull()).groupBy("song_name").agg(
        F.count(F.lit(1)).alias("num_changes")
    )
    current = playlist.select(
        F.col("name").alias("_name"), F.col("difficulty").cast("int").alias("current_difficulty")
    )
    return counts.join(current, F.col("song_name") == F.col("_name"), "left").select(
        F.col("song_name").alias("_song"), "num_changes", "current_difficulty"
    )


def reliability_weights(
    contested: DataFrame, playlist: DataFrame, as_of_year: int, order: str = "sheet_row",
    widths: Sequence[int] = ROW_WIDTHS, carry: Sequence[str] = (), parsed: DataFrame | None = None,
) -> DataFrame:
    """Score every dispute: stability × recency × acceptance × magnitude + bonus.

    Songs are counted before any quality filter. ``as_of_year`` is explicit so
    that the result does not move with the calendar. ``carry`` names columns of
    ``contested`` to keep beside the published ones. ``parsed`` is what
    :func:`parse_disputes` makes of ``contested``, where it is at hand. The song lookup is written
    out, so that Spark broadcasts it by its true size or can split a hot song.
    """
    parsed = parse_disputes(contested, order, widths) if parsed is None else parsed
    lookup = saved(song_lookup(contested, playlist), "song-lookup")
    joined = parsed.join(lookup, F.col("song_name") == F.col("_song"), "left")
    scored = joined.withColumns({
        "stability_score": ratio(F.lit(1.0), F.col("num_changes") + 1),
        "recency_score": recency(F.col("change_year"), as_of_year),
        "acceptance_score": acceptance(F.col("new_difficulty"), F.col("current_difficulty")),
        "magnitude_confidence": magnitude(F.col("difficulty_change")),
        "resolution_bonus": F.when(is_resolved("new_diff"), F.lit(0.2)).otherwise(F.lit(0.0)),
        "ingestion_timestamp": (
            F.col("ingestion_timestamp") if "ingestion_timestamp" in contested.columns
            else F.lit(None).cast("timestamp")
        ),
        "transformation_timestamp": F.current_timestamp(),
    }).withColumn(
        "reliability_weight",
        F.col("stability_score") * F.col("recency_score") * F.col("acceptance_score") * F.col("magnitude_confidence")
        + F.col("resolution_bonus"),
    )
    return scored.select(*SILVER_COLUMNS, *carry)


def quality_rules(max_difficulty: int = MAX_DIFFICULTY) -> dict[str, Column]:
    """Rules in the order they are applied."""
    level = F.col("new_difficulty")
    return {"not_null": level.isNotNull(), "positive": level > 0, "max": level <= max_difficulty}


def dq_filter(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows that satisfy every rule."""
    for rule in (rules or quality_rules()).values():
        df = df.filter(rule)
    return df


def dq_counts(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row: rows in, rows each rule removes after those before it, rows out. One pass."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("rows_before")]
    for name, rule in (rules or quality_rules()).items():
        holds = F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(passed & ~holds).alias(f"removed_{name}"))
        passed = passed & holds
    return df.agg(*counts, F.count_if(passed).alias("rows_after"))


def song_consensus(silver: DataFrame) -> DataFrame:
    """Weighted level and its spread for every disputed song."""
    level, weight = F.col("new_difficulty"), F.col("reliability_weight")
    return silver.groupBy("song_name").agg(
        ratio(F.sum(level * weight), F.sum(weight)).alias("weighted_difficulty"),
        F.avg(weight).alias("avg_reliability"),
        F.sum(weight).alias("total_reliability"),
        F.count(F.lit(1)).alias("num_assessments"),
        F.max("change_date").alias("latest_change"),
        F.stddev_samp(level).alias("difficulty_stddev"),
        F.min(level).alias("min_contested_difficulty"),
        F.max(level).alias("max_contested_difficulty"),
    )


def difficulty_reliability(silver: DataFrame) -> DataFrame:
    """Reliability statistics of every disputed difficulty level."""
    weight = F.col("reliability_weight")
    return silver.groupBy("new_difficulty").agg(
        F.avg(weight).alias("avg_reliability"),
        F.stddev_samp(weight).alias("stddev_reliability"),
        F.count(F.lit(1)).alias("num_assessments"),
        F.sum(weight).alias("total_reliability"),
        F.avg("recency_score").alias("avg_recency"),
        F.avg("acceptance_score").alias("avg_acceptance"),
    )


def densify(rel: DataFrame, low: int = 1, high: int = MAX_DIFFICULTY, defaults: dict | None = None) -> DataFrame:
    """Every level ``low..high``; levels without disputes get the defaults and a NULL spread."""
    defaults = UNCONTESTED if defaults is None else defaults
    levels = rel.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("new_difficulty"))
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    return levels.join(rel, "new_difficulty", "left").withColumns(filled).select(
        "new_difficulty", "avg_reliability", "stddev_reliability", "num_assessments", "total_reliability",
        "avg_recency", "avg_acceptance",
    )


def smooth_ordinal(rel: DataFrame, preceding: int = 3, following: int = 2) -> DataFrame:
    """Rolling mean of ``avg_reliability`` over neighbouring levels.

    The default frame is six rows wide, three before and two after. The window
    has no partition: its input has one row per level (120 after
    :func:`densify`), which bounds it.
    """
    frame = Window.orderBy("new_difficulty").rowsBetween(-preceding, following)
    return rel.withColumns({
        "avg_reliability_raw": F.col("avg_reliability"),
        "avg_reliability": F.avg("avg_reliability").over(frame),
    })


def reliability_scores(silver: DataFrame, preceding: int = 3, following: int = 2) -> DataFrame:
    """Levels 1..120 with smoothed reliability, in one pass over the disputes."""
    return smooth_ordinal(densify(difficulty_reliability(silver)), preceding, following).drop("avg_reliability_raw")


def smoothing_report(smoothed: DataFrame) -> DataFrame:
    """Before and after for every tenth level and every undisputed one."""
    return smoothed.filter((F.col("new_difficulty") % 10 == 0) | (F.col("num_assessments") == 0)).select(
        "new_difficulty", F.col("avg_reliability_raw").alias("before_smooth"),
        F.col("avg_reliability").alias("after_smooth"),
        (F.col("avg_reliability") - F.col("avg_reliability_raw")).alias("change"), "num_assessments",
    )


def smoothing_ranges(smoothed: DataFrame) -> DataFrame:
    """One row: ranges before and after, mean absolute change, largest rise and fall."""
    before, after = F.col("avg_reliability_raw"), F.col("avg_reliability")
    return smoothed.agg(
        F.min(before).alias("min_before"), F.max(before).alias("max_before"),
        F.min(after).alias("min_after"), F.max(after).alias("max_after"),
        F.avg(before).alias("mean_before"), F.avg(F.abs(after - before)).alias("mean_abs_change"),
        F.max(after - before).alias("max_increase"), F.min(after - before).alias("max_decrease"),
    )


def sample_weights(playlist: DataFrame, rel: DataFrame, default: float = 0.20) -> DataFrame:
    """Every song with the reliability of its level, ``default`` where there is none."""
    scores = rel.withColumnRenamed("new_difficulty", "_level")
    return playlist.join(scores, F.col("difficulty") == F.col("_level"), "left").withColumn(
        "sample_weight", F.coalesce("avg_reliability", F.lit(default))
    ).drop("_level")


def weight_coverage(weighted: DataFrame) -> DataFrame:
    """One row: songs with and without a score and the spread of the weights."""
    return weighted.agg(
        F.count(F.lit(1)).alias("songs"),
        F.count("avg_reliability").alias("with_score"),
        F.count_if(F.col("avg_reliability").isNull()).alias("with_default"),
        F.min("sample_weight").alias("min_weight"), F.max("sample_weight").alias("max_weight"),
        F.avg("sample_weight").alias("mean_weight"), F.stddev_samp("sample_weight").alias("stddev_weight"),
    )
