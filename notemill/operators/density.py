"""Vertical (same lane) and horizontal (any lane) note density.

Songs are cut into time slices, so a song of any size spreads over many tasks.
After :func:`~notemill.operators.notes.merge_chords` there is one chord per
millisecond, hence a slice never holds more than ``SLICE_MS`` chords plus its
overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.functions.scalars import DEFAULT_LANES, active_lanes, lane_active, lane_count, one_hot
from notemill.operators.notes import split_chords
from notemill.operators.running import Running, carried_into_slices, running, slice_id

SLICE_MS = 1 << 17
SLICE_WIDTHS = (SLICE_MS, SLICE_MS << 12)
GUARD = 1e-9  # seconds; wider than the rounding of a difference of times below a million seconds


@dataclass(frozen=True)
class Kernel:
    """Step weights over ``time − neighbour time``, each step ``[low, high)``, in ms."""

    bounds: tuple[int, ...]
    weights: tuple[float, ...]

    @property
    def reach(self) -> int:
        return max(abs(b) for b in self.bounds)

    def bands(self) -> list[tuple[int, int, float]]:
        """(low, high, weight), neighbouring steps of equal weight joined."""
        out: list[tuple[int, int, float]] = []
        for low, high, weight in zip(self.bounds, self.bounds[1:], self.weights):
            if out and out[-1][2] == weight:
                out[-1] = (out[-1][0], high, weight)
            else:
                out.append((low, high, weight))
        return out

    def weight(self, diff: Column, unit: float = 1) -> Column:
        """Weight of a signed difference; ``unit`` scales the bounds (1e-3 for seconds)."""
        scale = lambda b: F.lit(b) if unit == 1 else F.lit(round(b * unit, 9))
        out = F.lit(0.0)
        for low, high, weight in self.bands():
            out = F.when((diff >= scale(low)) & (diff < scale(high)), F.lit(float(weight))).otherwise(out)
        return out


# Judge window in milliseconds and the weight of each step.
JUDGE = Kernel(
    bounds=(-117, -83, -50, -17, 17, 50, 83, 117),
    weights=(0.1, 0.5, 1.0, 1.0, 1.0, 0.5, 0.5),
)


def _vertical_columns(time: str, per_second: float) -> list[Column]:
    """Previous time, gap and density from ``_prev``, in seconds."""
    gap = F.col(time) - F.col("_prev")
    return [
        (F.col("_prev") / F.lit(per_second)).alias("prev_timestamp"),
        (gap / F.lit(per_second)).alias("time_delta"),
        F.when(gap > 0, F.lit(per_second) / gap).otherwise(F.lit(0.0)).alias("vertical_density"),
    ]


def vertical_density(
    lane_rows: DataFrame, time: str = "ms", widths: Sequence[int] = SLICE_WIDTHS, carry: Sequence[str] = (),
) -> DataFrame:
    """Inverse of the gap to the previous note of the same song and lane.

    The first note of a lane has NULL previous time and gap; it and any note
    without a positive gap has density 0. Takes integer ``ms`` or a column of
    seconds (give the slice widths in seconds then). ``carry`` columns pass through.
    """
    per_second = 1000.0 if time == "ms" else 1.0
    prev = running(
        lane_rows, ["song_id", "orientation"], time, {"_prev": Running("max", F.col(time))},
        widths, tiebreak=["note_id"],
    )
    return prev.select(
        "song_id", "note_id",
        *(["ms"] if time == "ms" else []),
        (F.col(time) / F.lit(per_second)).alias("timestamp"),
        "orientation", *_vertical_columns(time, per_second), *carry,
    )


def _with_overlap(df: DataFrame, reach: int, slice_ms: int) -> DataFrame:
    """Rows of each slice plus copies of those within ``reach`` of its edges."""
    near = F.sequence(F.expr(f"(ms - {reach}) div {slice_ms}L"), F.expr(f"(ms + {reach}) div {slice_ms}L"))
    return df.withColumn("_slice0", F.explode(near))


def _density_columns(kernel: Kernel, window) -> dict[str, Column]:
    """Kernel sum and neighbour count over ``_lanes``, as range frames.

    ``low <= ms − other < high`` holds for ``other`` in ``[ms − high + 1, ms − low]``.
    """
    notes_in = lambda low, high: F.coalesce(F.sum("_lanes").over(window.rangeBetween(low, high)), F.lit(0))
    density, counts = F.lit(0.0), []
    for low, high, weight in kernel.bands():
        counts.append(notes_in(1 - high, -low))
        density = density + F.lit(float(weight)) * counts[-1]
    reach = kernel.reach
    if (kernel.bounds[0], kernel.bounds[-1]) == (-reach, reach):
        # The steps cover [-reach, reach); only the far end is missing. A frame
        # costs as much per row as it holds rows, so this halves the work.
        nearby = sum(counts, notes_in(-reach, -reach))
    else:
        nearby = notes_in(-reach, reach)
    return {"horizontal_density": density, "nearby_notes_count": (nearby - 1).cast("int")}


def horizontal_density(
    chords: DataFrame, kernel: Kernel = JUDGE, lanes: int = DEFAULT_LANES, slice_ms: int = SLICE_MS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Kernel sum over all notes of the song around each note, itself included.

    Takes chords or single-lane rows with integer ``ms`` and counts lanes with
    range frames: no pairs are formed, and all lanes of a chord share one
    computation. ``nearby_notes_count`` also counts a note exactly ``reach``
    away on either side, whatever its weight.
    """
    rows = _with_overlap(
        chords.select(
            "song_id", "note_id", "ms", "orientation", lane_count("orientation", lanes).alias("_lanes"), *carry
        ),
        kernel.reach, slice_ms,
    )
    window = Window.partitionBy("song_id", "_slice0").orderBy("ms")
    dense = rows.withColumns(_density_columns(kernel, window)).filter(F.expr(f"_slice0 = ms div {slice_ms}L"))
    return split_chords(
        dense.select(
            "song_id", "note_id", "ms", (F.col("ms") / F.lit(1000.0)).alias("timestamp"), "orientation",
            "horizontal_density", "nearby_notes_count", *carry,
        ),
        lanes,
    )


def note_densities(
    chords: DataFrame, kernel: Kernel = JUDGE, lanes: int = DEFAULT_LANES,
    widths: Sequence[int] = SLICE_WIDTHS, songs: DataFrame | None = None,
) -> DataFrame:
    """Both densities of every note from one shuffle and one sort of the chords.

    A slice holds its chords, the chords just outside it (for the horizontal
    frames) and one row with the last time of each lane before it (for the
    vertical gap). Needs one row per (song, ms).

    ``songs`` (one row per ``song_id``) adds song-level columns and drops songs
    it lacks. Its rows are sent to each slice of their song, so the chords stay
    where they are and a hot song stays spread out.
    """
    slice_ms = widths[0]
    lane_ms = {f"_lane{k}": F.when(lane_active("orientation", k), F.col("ms")) for k in range(lanes)}
    base = chords.select("song_id", "note_id", "ms", "orientation").withColumns(lane_ms)
    carried = carried_into_slices(
        base, ["song_id"], "ms", {f"_prev{k}": Running("max", F.col(f"_lane{k}")) for k in range(lanes)}, widths
    )
    before = (F.col("_slice0") * slice_ms - (slice_ms + kernel.reach)).alias("ms")
    markers = carried.select(
        "song_id", before, F.lit(0).alias("_lanes"), "_slice0",
        *[F.col(f"_prev{k}").alias(f"_lane{k}") for k in range(lanes)],
    )
    rows = _with_overlap(
        base.withColumn("_lanes", lane_count("orientation", lanes)), kernel.reach, slice_ms
    ).unionByName(markers, allowMissingColumns=True)

    window = Window.partitionBy("song_id", "_slice0").orderBy("ms")
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    dense = rows.withColumns({
        **_density_columns(kernel, window),
        **{f"_prev{k}": F.max(f"_lane{k}").over(earlier) for k in range(lanes)},
    }).filter(F.expr(f"_slice0 = ms div {slice_ms}L AND _lanes > 0"))

    extra = []
    if songs is not None:
        extra = [c for c in songs.columns if c != "song_id"]
        slices = base.select("song_id", slice_id(base, "ms", slice_ms).alias("_slice0")).distinct()
        dense = dense.join(slices.join(songs, "song_id"), ["song_id", "_slice0"])

    active = active_lanes([F.col(f"_lane{k}").isNotNull() for k in range(lanes)])
    previous = F.coalesce(*[F.when(F.col("_lane") == k, F.col(f"_prev{k}")) for k in range(lanes)])
    note = dense.select(
        "song_id", "note_id", "ms", "horizontal_density", "nearby_notes_count",
        *[f"_prev{k}" for k in range(lanes)], *extra, F.explode(active).alias("_lane"),
    ).withColumn("_prev", previous)
    return note.select(
        "song_id", "note_id", "ms", (F.col("ms") / F.lit(1000.0)).alias("timestamp"),
        one_hot("_lane", lanes).alias("orientation"), *_vertical_columns("ms", 1000.0),
        "horizontal_density", "nearby_notes_count", *extra,
    )


def band_pairs(lane_rows: DataFrame, reach: float, time: str = "ms") -> DataFrame:
    """Every pair of notes of a song at most ``reach`` apart, as a binned equi-join.

    Times fall into bins as wide as the reach; each neighbour is offered to its
    own bin and the two beside it. A join key is one bin of one song, never a
    whole song, and the exact test runs within it.
    """
    bin_of = F.floor(F.col(time) / F.lit(reach))
    target = lane_rows.select("song_id", "note_id", "orientation", time, bin_of.alias("_bin"))
    nearby = lane_rows.select(
        F.col("song_id").alias("_song"), F.col("note_id").alias("nearby_note_id"),
        F.col("orientation").alias("nearby_orientation"), F.col(time).alias("_near"),
        F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("_near_bin"),
    )
    close = (
        (F.col("song_id") == F.col("_song"))
        & (F.col("_bin") == F.col("_near_bin"))
        & (F.abs(F.col(time) - F.col("_near")) <= F.lit(reach))
    )
    return target.join(nearby, close).select(
        "song_id", "note_id", "orientation", time, "nearby_note_id", "nearby_orientation",
        F.col("_near").alias(f"nearby_{time}"), (F.col(time) - F.col("_near")).alias("diff"),
    )


def horizontal_density_by_pairs(
    lane_rows: DataFrame, kernel: Kernel = JUDGE, time: str = "ms",
) -> DataFrame:
    """The same density from explicit pairs. For times in seconds (doubles),
    where half-open range frames cannot be written, and as a cross-check."""
    unit = 1 if time == "ms" else 1e-3
    pairs = band_pairs(lane_rows, kernel.reach if unit == 1 else round(kernel.reach * unit, 9), time)
    return pairs.groupBy("song_id", "note_id", time, "orientation").agg(
        F.sum(kernel.weight(F.col("diff"), unit)).alias("horizontal_density"),
        (F.count(F.lit(1)) - 1).cast("int").alias("nearby_notes_count"),
    )


def horizontal_density_in_seconds(
    lane_rows: DataFrame, kernel: Kernel = JUDGE, time: str = "timestamp", slice_seconds: float = SLICE_MS / 1000,
) -> DataFrame:
    """The same density for times in seconds (doubles), without pairs.

    The notes at least ``b`` before a note are a prefix of its song, so the notes
    of a step are the difference of two prefix counts. These are running sums
    that follow the sorted times, so the work stays linear however dense a song
    is. Times within ``GUARD`` of a step's edge are left out of the prefix and
    compared as differences of doubles, as explicit pairs would be.

    One row per input row; repeated rows are notes of their own. Rows whose song
    or time is NULL, or whose time is NaN, have none.
    """
    scaled = lambda b: round(b * 1e-3, 9)
    edge = scaled(kernel.reach) + 2 * GUARD
    slice_of = lambda t: F.floor(t / F.lit(slice_seconds))
    t = F.col("_t")
    counted = lane_rows.filter(F.col(time).isNotNull() & ~F.isnan(time)).groupBy("song_id", F.col(time).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.withColumn("_slice", F.explode(F.sequence(slice_of(t - edge), slice_of(t + edge))))

    before = lambda b: f"{abs(b)!r}D {'PRECEDING' if b >= 0 else 'FOLLOWING'}"
    over = lambda first, last: f"OVER (PARTITION BY song_id, _slice ORDER BY _t RANGE BETWEEN {first} AND {last})"
    bounds = [scaled(b) for b in sorted({x for low, high, _ in kernel.bands() for x in (low, high)} | {-kernel.reach, kernel.reach})]
    sums = {}
    for k, b in enumerate(bounds):
        sums[f"_sure{k}"] = F.expr(f"coalesce(sum(_n) {over('UNBOUNDED PRECEDING', before(b + GUARD))}, 0L)")
        sums[f"_edge{k}"] = F.expr(f"collect_list(struct(_t AS t, _n AS n)) {over(before(b + GUARD), before(b - GUARD))}")
    placed = rows.withColumns(sums).filter(F.col("_slice") == slice_of(t))

    def reached(b: float, compare: str) -> Column:
        """Notes whose difference to this one is ``compare`` than ``b``."""
        k = bounds.index(b)
        test = f"x.t > _t - {b + GUARD!r}D AND _t - x.t {compare} {b!r}D"
        return F.expr(f"_sure{k} + aggregate(_edge{k}, 0L, (s, x) -> s + IF({test}, x.n, 0L))")

    density = F.lit(0.0)
    for low, high, weight in kernel.bands():
        density = density + F.lit(float(weight)) * (reached(scaled(low), ">=") - reached(scaled(high), ">="))
    nearby = reached(scaled(-kernel.reach), ">=") - reached(scaled(kernel.reach), ">")
    dense = placed.select(
        F.col("song_id").alias("_song"), "_t", density.alias("horizontal_density"), (nearby - 1).cast("int").alias("nearby_notes_count")
    )
    notes = lane_rows.select("song_id", "note_id", time, "orientation")
    return notes.join(dense, (F.col("song_id") == F.col("_song")) & (F.col(time) == F.col("_t"))).drop("_song", "_t")


def explain_density(
    lane_rows: DataFrame, song_id: int, note_id: int, orientation: str, kernel: Kernel = JUDGE,
) -> DataFrame:
    """All neighbours of one note with signed difference, weight and self mark."""
    song = lane_rows.filter(F.col("song_id") == song_id)
    is_target = (F.col("note_id") == note_id) & (F.col("orientation") == orientation)
    target_ms = song.filter(is_target).agg(F.min("ms").alias("ms")).scalar()
    diff = F.col("target_ms") - F.col("ms")
    return (
        song.withColumn("target_ms", target_ms)
        .filter(F.abs(diff) <= kernel.reach)
        .select(
            "song_id", "note_id", "orientation", "ms", diff.alias("diff_ms"),
            kernel.weight(diff).alias("weight"), is_target.alias("is_self"),
        )
    )


def verify_density(
    lane_rows: DataFrame, stored: DataFrame, kernel: Kernel = JUDGE, tolerance: float = 1e-3,
) -> DataFrame:
    """Recompute every note from its pairs and compare with the stored value.

    Rows on one side only do not match: a stored row may be missing or too many.
    """
    key = ["song_id", "note_id", "orientation"]
    again = horizontal_density_by_pairs(lane_rows, kernel).select(
        *key, F.col("horizontal_density").alias("calculated"),
        F.col("nearby_notes_count").alias("calculated_count"),
    )
    return again.join(stored.select(*key, "horizontal_density", "nearby_notes_count"), key, "full_outer").withColumn(
        "matches",
        F.coalesce(F.abs(F.col("calculated") - F.col("horizontal_density")) < tolerance, F.lit(False)),
    )


def density_by_difficulty(densities: DataFrame, songlist: DataFrame, column: str) -> DataFrame:
    """Mean density of each song next to its name and difficulty."""
    means = densities.groupBy("song_id").agg(F.avg(column).alias("avg_density"))
    songs = songlist.select(F.col("id").cast("bigint").alias("song_id"), "name", "difficulty")
    return means.join(songs, "song_id").select("song_id", "name", "avg_density", "difficulty")


def density_correlation(
    song_means: DataFrame, max_density: float, max_difficulty: float = 150, min_density: float | None = None,
) -> DataFrame:
    """Pearson correlation of mean density and difficulty over the plotted range."""
    rows = song_means.filter((F.col("avg_density") <= max_density) & (F.col("difficulty") <= max_difficulty))
    if min_density is not None:
        rows = rows.filter(F.col("avg_density") >= min_density)
    return rows.agg(
        F.count(F.lit(1)).alias("songs"), F.corr("avg_density", "difficulty").alias("correlation")
    )
