import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from notemill.functions.scalars import register_combine_orientations
from notemill.operators import density, notes

NOTES = "song_id bigint, note_id int, framers int, orientation string, ms bigint"


def frame(spark, rows):
    return notes.with_seconds(spark.createDataFrame(rows, NOTES))


def random_notes(n=300, seed=0, span=400):
    """Notes of three songs; song 1 holds most of them, with many ties."""
    pick = random.Random(seed)
    out, counters = [], defaultdict(int)
    for _ in range(n):
        song = 1 if pick.random() < 0.7 else pick.choice([2, 3])
        counters[song] += 1
        out.append((song, counters[song], pick.randrange(9), pick.choice(["1000", "0100", "0010", "0001", None]),
                    pick.randrange(span)))
    return out


def test_explode_notes_decodes_positions_lanes_and_colours(spark, rows):
    charts = spark.createDataFrame(
        [(7, [[10, 0, 0, 1500], [11, 3, 9, 1533], [12, 4, 8, 1600]]), (8, []), (9, None)],
        "song_id bigint, chart array<array<bigint>>",
    )
    assert rows(notes.explode_notes(charts), "song_id", "note_id", "framers", "orientation", "color", "ms", "timestamp") == [
        (7, 1, 10, "1000", "blue", 1500, 1.5),
        (7, 2, 11, "0001", None, 1533, 1.533),
        (7, 3, 12, None, "white", 1600, 1.6),
    ]
    wide = notes.explode_notes(charts, lanes=6)
    assert rows(wide, "orientation") == [("000010",), ("000100",), ("100000",)]


def test_three_equal_notes_lose_one(spark, rows):
    played = frame(spark, [(1, 1, 5, "1000", 10), (1, 2, 4, "1000", 10), (1, 3, 3, "1000", 10), (1, 4, 9, "0001", 10)])
    separated = notes.separate_ties(played)
    assert rows(separated, "note_id", "ms", "timestamp") == [(1, 10, 0.01), (2, 11, 0.011), (3, 11, 0.011), (4, 10, 0.01)]
    assert rows(notes.merge_chords(separated), "note_id", "framers", "orientation", "ms") == [
        (1, 5, "1001", 10), (2, 3, "1000", 11),
    ]


def test_separate_ties_like_lag(spark):
    played = random_notes()
    previous, want = {}, {}
    for song, note, _, lane, ms in sorted(played, key=lambda r: (r[0], str(r[3]), r[4], r[1])):
        want[song, note] = ms + 1 if previous.get((song, lane)) == ms else ms
        previous[song, lane] = ms
    got = notes.separate_ties(frame(spark, played))
    assert {(r.song_id, r.note_id): r.ms for r in got.collect()} == want


def test_group_of_null_lanes_merges_to_zeros(spark, rows):
    played = frame(spark, [(1, 1, 1, None, 5), (1, 2, 1, None, 5), (1, 3, 1, "11", 9), (1, 4, 1, "00100", 9)])
    assert rows(notes.merge_chords(played), "ms", "orientation") == [(5, "0000"), (9, "1110")]


@pytest.mark.parametrize("parts, want", [(["1000", "0001"], "1001"), (["1100", "0010"], "1110"), ([], "0000")])
def test_lane_or_examples(spark, parts, want):
    register_combine_orientations(spark)
    one = spark.createDataFrame([(parts,)], "p array<string>").selectExpr("combine_orientations(p) AS o")
    assert one.first().o == want
    if parts:
        merged = notes.merge_chords(frame(spark, [(1, i, 0, p, 3) for i, p in enumerate(parts)]))
        assert merged.first().orientation == want


def test_split_undoes_merge(spark):
    merged = notes.merge_chords(notes.separate_ties(frame(spark, random_notes(seed=3))))
    lanes = notes.split_chords(merged)
    again = notes.merge_chords(lanes)
    pick = ("song_id", "ms", "note_id", "orientation")
    has_lane = merged.filter("orientation <> '0000'")
    assert set(map(tuple, again.select(*pick).collect())) == set(map(tuple, has_lane.select(*pick).collect()))
    assert merged.groupBy("song_id", "ms").count().filter("count > 1").isEmpty()


def test_invalid_orientations_and_ties(spark, rows):
    played = frame(spark, [(1, 1, 0, "1200", 1), (1, 2, 0, "1000", 2), (1, 3, 0, "1000", 2), (2, 1, 0, "1000", 2)])
    assert rows(notes.invalid_orientations(played), "note_id") == [(1,)]
    assert rows(notes.largest_ties(played), "song_id", "ms", "orientation", "note_count") == [(1, 2, "1000", 2)]
    trace = notes.trace_ties(played, notes.largest_ties(played))
    assert rows(trace, "stage", "note_id", "ms") == [
        ("before", 2, 2), ("before", 3, 2), ("merged", 2, 2), ("merged", 3, 3), ("separated", 2, 2), ("separated", 3, 3),
    ]


# -- densities -----------------------------------------------------------------

WEIGHTS = [0.1, 0.5, 1.0, 1.0, 1.0, 0.5, 0.5]
BOUNDS = [-117, -83, -50, -17, 17, 50, 83, 117]


def weight(diff):
    return next((w for w, lo, hi in zip(WEIGHTS, BOUNDS, BOUNDS[1:]) if lo <= diff < hi), 0.0)


def brute_densities(lanes):
    out, by_song = {}, defaultdict(list)
    for r in lanes:
        by_song[r.song_id].append(r)
    for song, played in by_song.items():
        for r in played:
            near = [r.ms - o.ms for o in played if abs(r.ms - o.ms) <= 117]
            earlier = [o.ms for o in played if o.orientation == r.orientation and o.ms < r.ms]
            vertical = 1000.0 / (r.ms - max(earlier)) if earlier else 0.0
            out[song, r.note_id, r.orientation] = (vertical, round(sum(map(weight, near)), 6), len(near) - 1)
    return out


@pytest.fixture(scope="module")
def chords(spark):
    rows = [(s, n, f, o, ms - 1500) for s, n, f, o, ms in random_notes(500, seed=5, span=6000)]
    return notes.merge_chords(notes.separate_ties(frame(spark, rows))).cache()


@pytest.mark.parametrize("widths", [(1 << 17, 1 << 29), (300, 2400), (117, 1170), (40, 400)])
def test_densities_match_brute_force_for_any_slicing(spark, chords, widths):
    lanes = notes.split_chords(chords)
    want = brute_densities(lanes.collect())
    key = lambda r: (r.song_id, r.note_id, r.orientation)
    vertical = density.vertical_density(lanes, widths=widths).collect()
    assert {key(r): r.vertical_density for r in vertical} == {k: v[0] for k, v in want.items()}
    horizontal = density.horizontal_density(chords, slice_ms=widths[0]).collect()
    assert {key(r): (round(r.horizontal_density, 6), r.nearby_notes_count) for r in horizontal} == {
        k: v[1:] for k, v in want.items()}
    fused = density.note_densities(chords, widths=widths).collect()
    assert {key(r): (r.vertical_density, round(r.horizontal_density, 6), r.nearby_notes_count) for r in fused} == want
    assert all(r.horizontal_density >= 1 for r in horizontal)


def test_range_frames_equal_pairs(spark, chords):
    lanes = notes.split_chords(chords)
    pairs = density.horizontal_density_by_pairs(lanes)
    checked = density.verify_density(lanes, density.horizontal_density(chords))
    assert checked.filter("NOT matches").isEmpty()
    assert pairs.count() == lanes.count()


def test_window_edges(spark):
    """A note 117 ms earlier counts with weight 0, one 117 ms later with weight 0.1."""
    lanes = frame(spark, [(1, 1, 0, "1000", 0), (1, 2, 0, "0100", 117), (1, 3, 0, "0010", 235)])
    got = {r.note_id: (r.horizontal_density, r.nearby_notes_count) for r in density.horizontal_density(lanes).collect()}
    assert got == {1: (1.1, 1), 2: (1.0, 1), 3: (1.0, 0)}


def test_seconds_form(spark):
    lanes = spark.createDataFrame(
        [(1, 1, "1000", 0.0), (1, 2, "1000", 0.5), (1, 3, "0100", 0.55), (1, 4, "1000", 200.5)],
        "song_id bigint, note_id int, orientation string, timestamp double",
    )
    got = density.vertical_density(lanes, "timestamp", (131, 131 * 4096))
    assert {r.note_id: (r.time_delta, r.vertical_density) for r in got.collect()} == {
        1: (None, 0.0), 2: (0.5, 2.0), 3: (None, 0.0), 4: (200.0, 0.005)}
    pairs = density.horizontal_density_by_pairs(lanes, time="timestamp")
    assert {r.note_id: r.nearby_notes_count for r in pairs.collect()} == {1: 0, 2: 1, 3: 1, 4: 0}


def test_golden_song(spark, rows):
    """Lane 0 at 1.5 and 2.0 s gives 2.0; lane 3 at 0.0 and 2.0 s gives 0.5; first notes give 0."""
    played = frame(spark, [(9, 1, 0, "0001", 0), (9, 2, 0, "0010", 500), (9, 3, 0, "0100", 1000),
                           (9, 4, 0, "1000", 1500), (9, 5, 0, "1001", 2000)])
    got = density.note_densities(played)
    assert rows(got, "note_id", "orientation", "prev_timestamp", "time_delta", "vertical_density",
                "horizontal_density", "nearby_notes_count") == [
        (1, "0001", None, None, 0.0, 1.0, 0), (2, "0010", None, None, 0.0, 1.0, 0),
        (3, "0100", None, None, 0.0, 1.0, 0), (4, "1000", None, None, 0.0, 1.0, 0),
        (5, "0001", 0.0, 2.0, 0.5, 2.0, 1), (5, "1000", 1.5, 0.5, 2.0, 2.0, 1),
    ]


def test_explain_density_adds_up(spark, chords):
    lanes = notes.split_chords(chords)
    target = density.horizontal_density(chords).orderBy(F.desc("nearby_notes_count"), "note_id").first()
    told = density.explain_density(lanes, target.song_id, target.note_id, target.orientation).collect()
    assert round(sum(r.weight for r in told), 6) == round(target.horizontal_density, 6)
    assert sum(r.is_self for r in told) == 1 and len(told) == target.nearby_notes_count + 1


def test_density_correlation(spark):
    dense = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 4.0), (3, 99.0)], "song_id bigint, d double")
    songs = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 5)], "id bigint, name string, difficulty int")
    means = density.density_by_difficulty(dense, songs, "d")
    got = density.density_correlation(means, 10).first()
    assert got.songs == 2 and abs(got.correlation - 1.0) < 1e-9


@pytest.mark.parametrize("slice_seconds", [0.05, 0.4, 131.072])
def test_prefix_counts_equal_pairs_of_seconds(spark, slice_seconds):
    r = random.Random(11)
    times = [r.randrange(1500) / 1000 for _ in range(150)]  # many differences right at an edge
    times += [t + s * 2.0 ** -50 for t in times[:20] for s in (-1, 1)] + [r.uniform(-0.3, 1.5) for _ in range(60)]
    times += [90_000.117, 90_000.0, 90_000.05, 90_000.033]
    rows = [(r.choice([1, 1, 1, 2]), i, t, r.choice(["1000", "0100"])) for i, t in enumerate(times)]
    rows += [(None, 900, 0.1, "1000"), (1, 901, None, "1000"), (1, 902, float("nan"), "1000")]
    lanes = spark.createDataFrame(rows, "song_id bigint, note_id bigint, timestamp double, orientation string")
    pairs = density.horizontal_density_by_pairs(lanes, time="timestamp")
    found = density.horizontal_density_in_seconds(lanes, slice_seconds=slice_seconds)
    plain = lambda df: {(x.song_id, x.note_id): (round(x.horizontal_density, 6), x.nearby_notes_count) for x in df.collect()}
    assert plain(found) == plain(pairs) and found.count() == len(times)
    assert density.horizontal_density_in_seconds(lanes.limit(0)).count() == 0
    assert density.horizontal_density_in_seconds(lanes.unionByName(lanes)).count() == 2 * len(times)
