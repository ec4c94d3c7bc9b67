"""Whole runs: full, idle, incremental, and the three change scenarios."""

import random

import pytest
from pyspark.sql import functions as F

from notemill.operators import audit
from notemill.plans.medallion import TABLES, Medallion, database
from notemill.sources.fixtures import FAKE_LEVEL, FAKE_VERSION, TIME_SHIFT_SECONDS, inject_stale, insert_synthetic_song

NOTE_TABLES = [t for t, (_, bucketed) in TABLES.items() if bucketed]
COMPARED = [t for t in TABLES if not t.startswith("bronze")]


def landed(spark, versions, seed=0, notes=12, difficulty=None):
    """Frames of one landing: songs of ``versions``, whose charts depend on the version."""
    songs, charts, plays, disputes = [], [], [], []
    for song, version in versions.items():
        pick = random.Random(song * 1000 + version + seed)
        chart = [[float(i), float(pick.randrange(4)), float(pick.randrange(10)), float(ms)] for i, ms in
                 enumerate(sorted(pick.randrange(400) for _ in range(notes + song % 5)))]
        songs.append((song, f"song {song}", len(chart), version))
        charts.append((song, {"name": f"song {song}", "note_count": str(len(chart))}, chart))
        level = float((difficulty or {}).get(song, song * 7 % 120 + 1))
        plays.append((float(song), f"song {song}", level, 3.0, 1.0, "1:30", 9.0, "h", 1e9, "a", "x & y", 1.0, 1.0, 0.0, 0.0, 1.0, 1.0))
        disputes.append((f"song {song}", "10", str(5 + song % 9), "2020/01/0%d" % (1 + song % 9), "2020 Difficulty Changes", song))
    from notemill import schemas
    return (
        spark.createDataFrame(songs, "id bigint, name string, note_count bigint, swf_version bigint"),
        spark.createDataFrame(charts, schemas.CHARTS),
        spark.createDataFrame(plays, schemas.PLAYLIST),
        spark.createDataFrame(disputes, "song_name string, old_diff string, new_diff string, date string, source_sheet string, sheet_row bigint"),
    )


def contents(runs, name):
    df = runs.table(name)
    doubles = {c: F.round(c, 9) for c, t in df.dtypes if t == "double"}
    drop = [c for c in ("transformation_timestamp", "ingestion_timestamp") if c in df.columns]
    df = df.withColumns(doubles).drop(*drop)
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def modes(report):
    return {name: mode for name, mode in report if name in NOTE_TABLES}


def test_incremental_equals_full(spark):
    first = {i: 1 for i in range(1, 13)}
    second = {**{i: 1 for i in range(3, 13)}, 4: 2, 5: 2, 20: 1}
    moved = {7: 99}  # a new level without a new version
    with database(spark, "inc"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        assert set(modes(runs.run(*landed(spark, first))).values()) == {"full"}
        assert set(modes(runs.run(*landed(spark, first))).values()) == {"skip"}
        report = modes(runs.run(*landed(spark, second, difficulty=moved)))
        assert set(report.values()) == {"incremental"}
        got = {t: contents(runs, t) for t in COMPARED}
    with database(spark, "full"):
        fresh = Medallion(spark, as_of_year=2021, buckets=4)
        fresh.run(*landed(spark, second, difficulty=moved))
        want = {t: contents(fresh, t) for t in COMPARED}
        fresh.reset()
        assert audit.catalog_state(spark, list(TABLES)).filter("exists").isEmpty()
    for table in COMPARED:
        assert got[table] == want[table], table
    assert len(got["gold__features"]) > 50


def test_missing_chart_stays_pending(spark):
    songs, charts, plays, disputes = landed(spark, {1: 1, 2: 1})
    with database(spark, "pending"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        runs.run(songs, charts.filter("song_id = 1"), plays, disputes)
        assert {r.id: r.swf_version for r in runs.table("bronze__songlist").collect()} == {1: 1, 2: None}
        assert [r[0] for r in runs.table("gold__features").select("song_id").distinct().collect()] == [1]
        runs.run(songs, charts, plays, disputes)
        assert {r.id: r.swf_version for r in runs.table("bronze__songlist").collect()} == {1: 1, 2: 1}
        assert {r[0] for r in runs.table("gold__features").select("song_id").distinct().collect()} == {1, 2}


def test_idle_run_skips_songs_without_rows(spark):
    """Notes outside all lanes leave no density rows, but the song was processed."""
    songs, charts, plays, disputes = landed(spark, {1: 1, 2: 1})
    outside = F.transform("chart", lambda note: F.array(note[0], F.lit(9.0), note[2], note[3]))
    charts = charts.withColumn("chart", F.when(F.col("song_id") == 2, outside).otherwise(F.col("chart")))
    with database(spark, "idle"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        runs.run(songs, charts, plays, disputes)
        assert set(modes(runs.run(songs, charts, plays, disputes)).values()) == {"skip"}


def test_chart_landed_twice_counts_once(spark):
    songs, charts, plays, disputes = landed(spark, {1: 1, 2: 1})
    with database(spark, "twice"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        runs.run(songs, charts.unionByName(charts), plays, disputes)
        notes = runs.table("silver__notes")
        assert notes.count() == notes.select("song_id", "note_id").distinct().count() > 20


def test_chart_without_notes_stays_pending(spark):
    songs, charts, plays, disputes = landed(spark, {1: 1, 2: 1})
    empty = charts.withColumn("chart", F.when(F.col("song_id") == 1, F.col("chart")))
    with database(spark, "noteless"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        runs.run(songs, empty, plays, disputes)
        assert {r.id: r.swf_version for r in runs.table("bronze__songlist").collect()} == {1: 1, 2: None}
        runs.run(songs, charts, plays, disputes)
        assert {r[0] for r in runs.table("gold__features").select("song_id").distinct().collect()} == {1, 2}


def test_bucket_count_is_the_tables_own(spark):
    inputs = landed(spark, {i: 1 for i in range(1, 9)})
    changed = landed(spark, {i: 1 + (i == 3) for i in range(1, 9)})
    with database(spark, "counts"):
        Medallion(spark, as_of_year=2021, buckets=4).run(*inputs)
        other = Medallion(spark, as_of_year=2021, buckets=8)
        assert set(modes(other.run(*changed)).values()) == {"incremental"}
        notes = other.table("silver__notes")
        assert notes.count() == notes.select("song_id", "note_id").distinct().count()
        assert {r[0] for r in notes.select("song_id").distinct().collect()} == set(range(1, 9))


def test_clearing_scratch_keeps_tables(spark):
    from notemill.session import clear_scratch

    with database(spark, "kept"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        runs.run(*landed(spark, {1: 1, 2: 1}))
        before = runs.table("gold__features").count()
        clear_scratch(spark)
        spark.catalog.refreshTable("gold__features")
        assert runs.table("gold__features").count() == before > 0


@pytest.fixture(scope="module")
def live(spark):
    """A database with ten songs, shared by the three scenarios."""
    with database(spark, "live"):
        runs = Medallion(spark, as_of_year=2021, buckets=4)
        inputs = landed(spark, {i: 1 for i in range(1, 11)})
        runs.run(*inputs)
        yield runs, inputs


def tables_of(runs):
    return {t: (runs.table(t), TABLES[t][0]) for t in TABLES if TABLES[t][0] in ("id", "level", "song_id")}


def state(runs, spark, song):
    keys = spark.createDataFrame([(song,)], "song_id bigint")
    return audit.verdict(audit.presence(tables_of(runs), keys)).first().state


def test_new_song(spark, live):
    runs, (songs, charts, plays, disputes) = live
    without = lambda df, key: df.filter(F.col(key) != 5)
    runs.run(without(songs, "id"), without(charts, "song_id"), without(plays, "level"), disputes)
    assert state(runs, spark, 5) == "clean"
    runs.ingest_songs(songs, charts)
    runs.ingest_playlist(plays)
    assert state(runs, spark, 5) == "bronze"
    runs.refresh_playlist(), runs.refresh_notes(), runs.refresh_adjusted(), runs.refresh_vertical()
    assert state(runs, spark, 5) == "partial"
    runs.refresh_horizontal(), runs.refresh_chart_features()
    assert state(runs, spark, 5) == "silver"
    runs.refresh_gold()
    assert state(runs, spark, 5) == "full"


def test_deleted_song_leaves_every_table(spark, live):
    runs, inputs = live
    insert_synthetic_song(runs)
    assert state(runs, spark, 99_999) == "full"
    runs.run(*inputs)
    assert state(runs, spark, 99_999) == "clean"


def test_stale_song_is_repaired_everywhere(spark, live):
    runs, inputs = live
    before = {t: contents(runs, t) for t in COMPARED}
    assert len(inject_stale(runs, 3, "song 3")) == 11
    check = {
        "bronze__songlist": "swf_version", "bronze__contested": "new_diff", "bronze__charts": None,
        "silver__chart_features": "swf_version", "silver__notes": "timestamp", "silver__notes_adjusted": "timestamp",
        "silver__vertical_density": "timestamp", "silver__horizontal_density": "timestamp",
        "silver__playlist": "swf_version", "silver__contested": "new_difficulty", "gold__features": "swf_version",
    }

    def statuses():
        out = {}
        for key, value in (("song_id", 3), ("song_name", "song 3")):
            picked = {t: (runs.table(t), TABLES[t][0], c) for t, c in check.items() if (TABLES[t][0] == "song_name") == (key == "song_name")}
            keys = spark.createDataFrame([(value,)], [key])
            found = audit.staleness(picked, keys, (FAKE_VERSION, FAKE_LEVEL), floor=TIME_SHIFT_SECONDS)
            out.update({r.table: r.status for r in found.collect()})
        return out

    spoiled = statuses()
    assert all(s == ("failed" if t.startswith("bronze") else "pending") for t, s in spoiled.items() if t != "bronze__charts")
    runs.run(*inputs)
    assert set(statuses().values()) == {"updated"}
    assert {t: contents(runs, t) for t in COMPARED} == before
    info = runs.table("bronze__charts").filter("song_id = 3").first().info
    assert info["note_count"] != "99999"
