"""Change detection, table changes, decoding, sources and sinks."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notemill import schemas
from notemill.operators import audit, cdc, chart, gold, merge, playlist
from notemill.plans.medallion import database
from notemill.sources import landed, tables

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SNAP = "id bigint, swf_version bigint"
snapshot = st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.integers(1, 3)), max_size=10)


def snap(spark, rows):
    return spark.createDataFrame(list(rows.items()) if isinstance(rows, dict) else rows, SNAP)


def ids(df):
    return sorted(r[0] for r in df.collect())


@SLOW
@given(snapshot, snapshot)
def test_changes_partition_all_keys(spark, old, new):
    a, b = snap(spark, old), snap(spark, new)
    deleted, fresh = ids(cdc.deleted_keys(a, b, "id")), ids(cdc.new_keys(a, b, "id"))
    updated = ids(cdc.updated_keys(a, b, "id", "swf_version"))
    assert deleted == sorted(set(old) - set(new)) and fresh == sorted(set(new) - set(old))
    assert updated == sorted(k for k in set(old) & set(new) if None not in (old[k], new[k]) and old[k] != new[k])
    assert ids(cdc.changed_keys(b, a, "id", "swf_version")) == sorted(fresh + updated)
    safe = ids(cdc.updated_keys(a, b, "id", "swf_version", null_safe=True))
    assert safe == sorted(k for k in set(old) & set(new) if old[k] != new[k])
    row = cdc.change_summary(a, b, "id", "swf_version").first()
    assert (row.new, row.updated, row.deleted, row.to_process) == (len(fresh), len(updated), len(deleted), len(fresh + updated))
    assert row.new + row.updated + row.deleted + row.unchanged == len(set(old) | set(new))


@SLOW
@given(snapshot, snapshot)
def test_upsert_is_idempotent(spark, target, source):
    a, b = snap(spark, target), snap(spark, source)
    once = merge.merge_upsert(a, b, ["id"])
    assert dict(map(tuple, once.collect())) == {**target, **source}
    twice = merge.merge_upsert(once, b, ["id"])
    assert sorted(map(repr, twice.collect())) == sorted(map(repr, once.collect()))


def test_upsert_refuses_duplicate_source_keys(spark):
    with pytest.raises(Exception, match="several rows for one key"):
        merge.merge_upsert(snap(spark, {1: 1}), snap(spark, [(1, 2), (1, 3)]), ["id"]).collect()


def test_version_column_missing_and_combine(spark):
    a, b = snap(spark, {1: 1, 2: 1}), snap(spark, {2: 1, 3: 1})
    assert ids(cdc.updated_keys(a.drop("swf_version"), b, "id", "swf_version")) == [2]
    assert ids(cdc.changed_keys(b, a.drop("swf_version"), "id", "swf_version")) == [2, 3]
    both = cdc.freeze(cdc.combine_keys(cdc.new_keys(a, b, "id"), cdc.deleted_keys(a, b, "id")))
    assert ids(both) == [1, 3]


def test_settle_versions_keeps_missing_payloads_pending(spark, rows):
    new, held = snap(spark, {1: 5, 2: 5, 3: 5, 4: 7}), snap(spark, {2: 4, 3: 4, 4: 7})
    arrived = spark.createDataFrame([(3,)], "song_id bigint")
    assert rows(cdc.settle_versions(new, held, arrived)) == [(1, None), (2, 4), (3, 5), (4, 7)]


def test_deletes_and_updates(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id bigint, n string")
    assert ids(merge.delete_where(t, F.col("n") == "a")) == [2, 3]
    keys = spark.createDataFrame([(1,), (3,), (3,)], "song_id bigint")
    assert ids(merge.delete_keys(t, keys, "id")) == [2]
    assert rows(merge.update_where(t, F.col("id") > 1, {"n": F.lit("x"), "id": F.col("id") * 10})) == [
        (1, "a"), (20, "x"), (30, "x")]
    source = spark.createDataFrame([(1, None), (9, "z")], "id bigint, n string")
    assert rows(merge.merge_update(t, source, ["id"], ["n"])) == [(1, None), (2, None), (3, "c")]
    assert rows(merge.replace_by_key(t, source, "id")) == [(1, None), (2, None), (3, "c"), (9, "z")]
    left, report = merge.cascade_delete({"bronze__a": (t, "id"), "silver__b": (source, "id")}, keys)
    assert ids(left["bronze__a"]) == [2] and ids(left["silver__b"]) == [9]
    assert rows(report) == [("bronze__a", 3, 2, 1), ("silver__b", 2, 1, 1)]


# -- playlist, chart and gold --------------------------------------------------

def test_clean_playlist(spark):
    raw = spark.createDataFrame([
        (5.0, "n", 7.0, 13.0, 1.0, "2:05", 9.0, "h", 86400.0, "a", "x & y", 1.5, 1.0, None, 0.0, None, 3.0),
        (6.0, "m", 8.0, 14.0, 1.0, "bad", 9.0, "h", None, "a", "x", 1.5, 0.0, 1.0, 2.0, 4.0, None),
    ], schemas.PLAYLIST).withColumn("o_o_secret", F.lit(1.0))
    got = {r.song_id: r for r in playlist.clean_playlist(raw, snap(spark, {5: 3})).collect()}
    assert (got[5].genre, got[5].song_length, got[5].stepauthor, got[5].credits, got[5].price) == ("Legacy", 125, ["x", "y"], 0, 3)
    assert (got[5].explicit_flag, got[5].legacy_flag, got[5].unranked_flag, got[5].swf_version) == (True, False, False, 3)
    assert got[5].release_date.isoformat() == "1970-01-02T00:00:00"
    assert (got[6].genre, got[6].song_length, got[6].unranked_flag, got[6].swf_version) == (None, None, False, None)
    assert "o_secret_flag" in playlist.flags_to_bool(raw).columns
    keys = spark.createDataFrame([(6,)], "song_id bigint")
    assert [r.song_id for r in playlist.clean_playlist(raw, snap(spark, {}), keys).collect()] == [6]
    assert playlist.clean_playlist(raw, snap(spark, {5: 3})).dtypes == schemas.empty(spark, schemas.SILVER_PLAYLIST).dtypes


def test_chart_features_use_all_songs_for_the_percentile(spark):
    songs = spark.createDataFrame([(i, i * 10, 1) for i in range(1, 22)], "id bigint, note_count bigint, swf_version bigint")
    keys = spark.createDataFrame([(20,)], "song_id bigint")
    one = chart.chart_features(songs, keys).collect()
    assert len(one) == 1 and abs(one[0].song_length_log_normalized - 1.0) < 1e-12  # p95 is 200
    check = chart.length_check(chart.chart_features(songs)).first()
    assert (check.total_songs, check.at_or_below, check.above, check.passed) == (21, 20, 1, True)
    flat = spark.createDataFrame([(1, 1, 1)], "id bigint, note_count bigint, swf_version bigint")
    assert chart.chart_features(flat).first().song_length_log_normalized is None


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in chart.histogram(df, "v", 5).orderBy("bin").collect()] == [(1, 2), (2, 0), (3, 0), (4, 0), (5, 2)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in chart.histogram(same, "v", 2).orderBy("bin").collect()] == [2, 0]


def test_gold_joins(spark, rows):
    v = spark.createDataFrame([(1, 1, "1000", 2.0, 7), (2, 1, "1000", 3.0, 7)], "song_id bigint, note_id int, orientation string, vertical_density double, swf_version bigint")
    h = v.select("song_id", "note_id", "orientation", (F.col("vertical_density") + 1).alias("horizontal_density"))
    c = spark.createDataFrame([(1, 0, 0.5, 7), (2, 4, 0.6, 7)], "song_id bigint, note_count bigint, song_length_log_normalized double, swf_version bigint")
    p = spark.createDataFrame([(1, 10), (2, 200)], "song_id bigint, difficulty int")
    r = spark.createDataFrame([(10, 0.3)], "new_difficulty int, avg_reliability double")
    labelled = gold.attach_labels(gold.assemble_features(v, h, c), p, r)
    assert rows(labelled, "song_id", "position_in_song", "hold", "mine", "difficulty", "sample_weight") == [
        (1, None, 0, 1, 10, 0.3), (2, 0.25, 0, 1, 200, None)]
    assert rows(gold.gold_features(v, h, c, p, r)) == rows(labelled)
    keys = spark.createDataFrame([(2,)], "song_id bigint")
    assert rows(gold.assemble_features(v, h, c, keys), "song_id") == [(2,)]


# -- files ---------------------------------------------------------------------

def test_json_payloads(spark, tmp_path, rows):
    (tmp_path / "songs.json").write_text(json.dumps([{"id": 1, "name": "a", "swf_version": 3, "note_count": 9}, {"id": 2}]))
    assert rows(landed.read_songlist(spark, str(tmp_path / "songs.json")), "id", "name", "swf_version") == [(1, "a", 3), (2, None, None)]
    charts = [{"song_id": 1, "status": 200, "info": {"name": "a"}, "chart": [[0, 1, 2, 33]]}, {"song_id": 2, "status": 500}]
    (tmp_path / "charts.json").write_text("\n".join(map(json.dumps, charts)))
    got = landed.read_charts(spark, str(tmp_path / "charts.json")).collect()
    assert [(r.song_id, r.info, r.chart) for r in got] == [(1, {"name": "a"}, [[0, 1, 2, 33]])]
    (tmp_path / "play.json").write_text(json.dumps([{"level": 1, "song_rating": 2}, {"level": 2.5, "song_rating": 2.25}]))
    assert rows(landed.read_playlist(spark, str(tmp_path / "play.json")), "level", "song_rating") == [(1.0, 2.0), (2.5, 2.25)]


def test_sheets(spark, tmp_path, rows):
    (tmp_path / "2020 Difficulty Changes.csv").write_text(
        ',,,\nSong Name,,Old Diff!,New Diff\n"a, b",x,1,"no\nchange"\nc,,,5\n')
    parts = tmp_path / "2021 Difficulty Changes.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text(",,\nSong Name,Date,\nd,2021/01/01,q\n")
    (parts / "part-1.csv").write_text("e,,q\nf,,q\n")
    (tmp_path / "Notes.csv").write_text(",\nx,y\n1,2\n")
    sheets = landed.read_sheets(spark, str(tmp_path))
    assert set(sheets.columns) == {"song_name", "old_diff", "new_diff", "date", "sheet_row", "source_sheet", "ingestion_timestamp"}
    assert rows(sheets, "source_sheet", "sheet_row", "song_name", "old_diff", "new_diff", "date") == [
        ("2020 Difficulty Changes", 1, "a, b", "1", "no\nchange", None),
        ("2020 Difficulty Changes", 2, "c", None, "5", None),
        ("2021 Difficulty Changes", 1, "d", None, None, "2021/01/01"),
        ("2021 Difficulty Changes", 2, "e", None, None, None),
        ("2021 Difficulty Changes", 3, "f", None, None, None),
    ]
    with pytest.raises(FileNotFoundError):
        landed.read_sheets(spark, str(tmp_path), "nothing")


# -- sinks ---------------------------------------------------------------------

def test_plain_tables(spark, rows):
    with database(spark, "plain"):
        one = snap(spark, {1: 1})
        tables.write_table(one, "t")
        tables.write_table(one, "t", mode="append")
        assert tables.read_table(spark, "t").count() == 2
        tables.write_table(one.withColumnRenamed("swf_version", "v"), "t", on_schema_change="recreate")
        assert tables.read_table(spark, "t").columns == ["id", "v"]
        tables.ensure_column(spark, "t", "extra", "bigint")
        tables.ensure_column(spark, "t", "extra", "bigint")
        assert rows(tables.read_table(spark, "t")) == [(1, 1, None)]
        tables.drop_tables(spark, ["t", "absent"])
        assert not tables.table_exists(spark, "t")


def test_published_versions(spark, rows):
    with database(spark, "published"):
        tables.publish(snap(spark, {1: 1}), "s")
        for n in range(3):
            current = tables.read_table(spark, "s")
            tables.publish(merge.merge_upsert(current, snap(spark, {n + 5: n}), ["id"]), "s")
        assert rows(tables.read_table(spark, "s")) == [(1, 1), (5, 0), (6, 1), (7, 2)]
        assert len([t for t in spark.catalog.listTables() if t.name.startswith("s__v")]) == 2
        tables.drop_tables(spark, ["s"])
        assert not tables.table_exists(spark, "s") and not spark.catalog.listTables()


def test_bucketed_tables_drop_emptied_buckets(spark, rows):
    with database(spark, "bucketed"):
        facts = spark.range(40).selectExpr("id AS song_id", "id * 2 AS v")
        tables.create_bucketed(facts, "f", 16)
        keys = spark.range(0, 40, 2).withColumnRenamed("id", "song_id")
        tables.replace_songs(spark, "f", facts.filter("song_id % 4 = 0").withColumn("v", F.lit(-1).cast("bigint")), keys)
        assert rows(tables.read_bucketed(spark, "f")) == sorted(
            [(i, i * 2) for i in range(1, 40, 2)] + [(i, -1) for i in range(0, 40, 4)], key=repr)
        tables.replace_songs(spark, "f", facts.limit(0), spark.range(39).withColumnRenamed("id", "song_id"))
        assert rows(tables.read_bucketed(spark, "f")) == [(39, 78)]
        only = spark.createDataFrame([(39,), (3,)], "song_id bigint")
        assert rows(tables.read_songs(spark, "f", only)) == [(39, 78)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


# -- audits --------------------------------------------------------------------

def test_presence_and_verdicts(spark, rows):
    one = lambda *keys: spark.createDataFrame([(k,) for k in keys], "id bigint")
    tabs = {"bronze__a": (one(1, 2, 3, 4), "id"), "silver__b": (one(2, 3, 3), "id"), "gold__c": (one(3, 4), "id")}
    found = audit.presence(tabs, one(1, 2, 3, 4, 5))
    assert rows(found.filter("key = 3"), "table", "rows") == [("bronze__a", 1), ("gold__c", 1), ("silver__b", 2)]
    assert rows(audit.verdict(found), "key", "state") == [(1, "bronze"), (2, "silver"), (3, "full"), (4, "partial"), (5, "clean")]
    assert rows(audit.layer_tally(found).filter("key = 4")) == [(4, "bronze", 1, 0), (4, "gold", 1, 0), (4, "silver", 0, 1)]


def test_staleness(spark, rows):
    t = spark.createDataFrame([("x", 999.0), ("x", 1.0), ("y", 2.0)], "n string, v double")
    keys = spark.createDataFrame([("x",), ("y",), ("z",)], "n string")
    tabs = {"bronze__a": (t, "n", "v"), "silver__b": (t, "n", "v"), "gold__c": (t, "n", None)}
    checked = audit.staleness(tabs, keys, (999,))
    assert rows(checked, "table", "key", "stale_rows", "status") == [
        ("bronze__a", "x", 1, "failed"), ("bronze__a", "y", 0, "updated"), ("bronze__a", "z", 0, "failed"),
        ("gold__c", "x", 0, "updated"), ("gold__c", "y", 0, "updated"), ("gold__c", "z", 0, "pending"),
        ("silver__b", "x", 1, "pending"), ("silver__b", "y", 0, "updated"), ("silver__b", "z", 0, "pending"),
    ]
    assert audit.staleness_verdict(checked).first().state == "failed"
    assert audit.staleness_verdict(checked.filter("key = 'y'")).first().state == "passed"
    assert rows(audit.catalog_state(spark, ["bronze__none"])) == [("bronze", "bronze__none", False)]


def test_replaced_songs_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    with database(spark, "made_once"):
        tables.drop_tables(spark, ["made"])
        tables.create_bucketed(spark.createDataFrame([(i, 0) for i in range(40)], "song_id long, note_id int"), "made", 4)
        fresh = spark.createDataFrame([(i, 1) for i in range(10)], "song_id long, note_id int").mapInPandas(counted, "song_id long, note_id int")
        tables.replace_songs(spark, "made", fresh, spark.range(20).selectExpr("id AS song_id"))
        assert made.value == 10
        assert sorted(map(tuple, tables.read_bucketed(spark, "made").collect())) == [(i, 1) for i in range(10)] + [(i, 0) for i in range(20, 40)]
        tables.drop_tables(spark, ["made"])
