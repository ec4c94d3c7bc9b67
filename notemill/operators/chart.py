"""Song-level length features and their distribution checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.functions.scalars import ratio
from notemill.operators.cdc import scope
from notemill.session import saved


def percentile_of(df: DataFrame, column: str, share: float, accuracy: int | None = None) -> Column:
    """Percentile over the whole frame as a scalar subquery (no driver round-trip).

    Exact with interpolation by default: the aggregate merges counts per
    distinct value, so repeated values combine on the map side. ``accuracy``
    switches to the approximate form. For columns with many distinct values,
    :func:`exact_percentile` is exact without holding them in one task.
    """
    value = F.percentile(column, F.lit(share)) if accuracy is None else F.percentile_approx(column, share, accuracy)
    return df.agg(value.alias("p")).scalar()


def _rank_value(values: DataFrame, count: int, rank: int, most: int, accuracy: int) -> float:
    """The value of 0-based ``rank`` among ``count`` values ``v``, by rounds of counts over narrowing ranges.

    Each round takes two approximate percentiles on both sides of the rank and
    counts exactly what lies below and up to them, which tells the range the rank
    lies in. That range holds about four ``accuracy``-ths of the values, or a
    single value however often it comes. At most ``most`` values are sorted.
    """
    margin = 2.0
    while count > most:
        shares = [min(1.0, max(0.0, (rank + side * margin * count / accuracy) / max(1, count - 1))) for side in (-1, 1)]
        low, high = values.agg(F.percentile_approx("v", F.array(*map(F.lit, shares)), accuracy).alias("p")).first()["p"]
        below, upto = values.agg(F.count_if(F.col("v") < F.lit(low)), F.count_if(F.col("v") <= F.lit(high))).first()
        if below <= rank < upto and low == high:
            return low
        before = count
        if rank < below:
            values, count = values.filter(F.col("v") < F.lit(low)), below
        elif rank >= upto:
            values, count, rank = values.filter(F.col("v") > F.lit(high)), count - upto, rank - upto
        else:
            values, count, rank = values.filter(F.col("v").between(F.lit(low), F.lit(high))), upto - below, rank - below
        # Two values may hold all the rows; then the edges themselves are tried one by one.
        margin = 2.0 if count < before else margin / 4
    return values.orderBy("v").offset(rank).limit(1).first()["v"]


def exact_percentile(df: DataFrame, column: str, share: float, most: int = 100_000, accuracy: int = 10_000) -> float | None:
    """The percentile with interpolation, equal to ``percentile``, for columns of any number of distinct values.

    NULLs don't count; of none, the result is NULL. The values are scanned a few
    times, ``log(n)`` with a base of thousands, and no task holds more than ``most``.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    count = values.count()
    if not count:
        return None
    place = share * (count - 1)
    rank = int(place)
    value = _rank_value(values, count, rank, most, accuracy)
    if rank == place:
        return value
    # The next value: the same one if it comes often enough, else the smallest larger one.
    upto, larger = values.agg(F.count_if(F.col("v") <= F.lit(value)), F.min(F.when(F.col("v") > F.lit(value), F.col("v")))).first()
    after = value if upto > rank + 1 else larger
    return (rank + 1 - place) * value + (place - rank) * after


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n): how often each value comes. A mergeable stand-in for the column: see :func:`merged_counts`."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merged_counts(counts: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """``counts`` after rows were removed and added, each as (value, n). A negative count is an error: those rows were never counted."""
    signed = counts.unionByName(added).unionByName(removed.select("value", (-F.col("n")).alias("n")))
    total = signed.groupBy("value").agg(F.sum("n").alias("n")).filter("n <> 0")
    wrong = F.raise_error(F.concat(F.lit("more rows removed than counted of value "), F.col("value").cast("string")))
    return total.withColumn("n", F.when(F.col("n") > 0, F.col("n")).otherwise(wrong.cast("bigint")))


def _ranked_counts(counts: DataFrame) -> tuple[DataFrame, Column]:
    """(value, n, _from) with the 0-based rank of each value's first row, and the number of all rows.

    Values are sorted by ranges; only the totals of ranges meet in one task.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = saved(
        counts.repartitionByRange(tasks, "value").sortWithinPartitions("value").withColumns({"_task": F.spark_partition_id()}), "value-counts"
    )
    before = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = placed.groupBy("_task").agg(F.sum("n").alias("n"))
    offsets = slices.select("_task", before(Window.orderBy("_task")).alias("_offset"))  # one row per task
    ranked = placed.join(offsets, "_task").withColumn("_from", F.col("_offset") + before(Window.partitionBy("_task").orderBy("value")))
    return ranked, placed.agg(F.sum("n").alias("n")).scalar()


def _holds(rank: Column) -> Column:
    return (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("n"))


def percentile_of_counts(counts: DataFrame, share: float) -> DataFrame:
    """One row (p): the percentile with interpolation of the column that ``counts`` (value, n) stands for."""
    ranked, total = _ranked_counts(counts)
    place = F.lit(share) * (total - 1)
    low, high = F.floor(place), F.ceil(place)
    ends = ranked.agg(
        F.max(F.when(_holds(low), F.col("value").cast("double"))).alias("low"), F.max(F.when(_holds(high), F.col("value").cast("double"))).alias("high"),
    )
    return ends.select(F.when(low == high, F.col("low")).otherwise((high - place) * F.col("low") + (place - low) * F.col("high")).alias("p"))


def quantiles_of_counts(counts: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """One row: by name, the smallest value that at least that share of the rows doesn't exceed, without interpolation."""
    ranked, total = _ranked_counts(counts)
    rank = lambda share: F.greatest(F.ceil(F.lit(share) * total), F.lit(1)) - 1
    return ranked.agg(*[F.max(F.when(_holds(rank(share)), F.col("value"))).alias(name) for name, share in shares.items()])


def chart_features(songlist: DataFrame, keys: DataFrame | None = None, accuracy: int | None = None) -> DataFrame:
    """``ln(note_count) / ln(p95 of note_count)``.

    The percentile is over all songs, also when only ``keys`` (song_id) are
    wanted. It is NULL where the logarithm of the percentile is 0.
    """
    songs = songlist.select(
        F.col("id").cast("bigint").alias("song_id"), "note_count", F.col("swf_version").cast("bigint").alias("swf_version")
    )
    p95 = percentile_of(songlist, "note_count", 0.95, accuracy)
    wanted = songs if keys is None else scope(songs, keys, "song_id")
    return wanted.select(
        "song_id", "note_count",
        ratio(F.ln("note_count"), F.ln(p95)).alias("song_length_log_normalized"),
        "swf_version",
    )


def length_check(features: DataFrame, threshold: float = 1.0, alarm: float = 0.10) -> DataFrame:
    """One row: ranges, the share of songs above ``threshold``, pass if below ``alarm``."""
    norm = F.col("song_length_log_normalized")
    totals = features.agg(
        F.count(F.lit(1)).alias("total_songs"),
        F.min("note_count").alias("min_notes"), F.max("note_count").alias("max_notes"),
        F.avg("note_count").alias("avg_notes"),
        F.min(norm).alias("min_normalized"), F.max(norm).alias("max_normalized"),
        F.avg(norm).alias("avg_normalized"),
        F.count_if(norm <= threshold).alias("at_or_below"), F.count_if(norm > threshold).alias("above"),
    )
    share = ratio(F.col("above"), F.col("total_songs"))
    return totals.withColumns({"share_above": share, "passed": share < alarm})


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal bins between minimum and maximum, empty bins included."""
    value = F.col(column).cast("double")
    values = df.filter(F.col(column).isNotNull()).select(value.alias("v"))
    low = values.agg(F.min("v").alias("m")).scalar()
    high = values.agg(F.max("v").alias("m")).scalar()
    placed = values.select("v", low.alias("low"), high.alias("high"))
    bin_of = F.when(
        F.col("high") > F.col("low"),
        F.least(F.width_bucket("v", "low", "high", F.lit(bins)), F.lit(bins).cast("bigint")),
    ).otherwise(F.lit(1).cast("bigint"))
    counts = placed.groupBy(bin_of.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"), low.alias("low"), high.alias("high"))
    edge = lambda i: F.col("low") + (F.col("high") - F.col("low")) * i / F.lit(float(bins))
    return every.join(counts, F.col("bin") == F.col("_bin"), "left").select(
        "bin", edge(F.col("bin") - 1).alias("bin_low"), edge(F.col("bin")).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
    )
