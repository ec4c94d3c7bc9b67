"""Ledgers of moments and digests against full recomputation."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from notemill.operators import content, moments, reliability
from notemill.plans import queries

SILVER = "song_name string, new_difficulty int, change_date date, reliability_weight double, recency_score double, acceptance_score double"


def dispute(r):
    pick = lambda *values: r.choice([*values, None]) if r.random() < 0.1 else r.choice(values)
    return (pick("a", "b", "c"), pick(*range(1, 30)), datetime.date(2020, 1, 1) + datetime.timedelta(r.randrange(9)), pick(0.1, 1 / 3, r.random(), 1.2), pick(0.25, 1.0), pick(0.5, 2 / 3))


def near(df, key):
    return {r[key]: {c: pytest.approx(r[c], abs=1e-7) if isinstance(r[c], float) else r[c] for c in df.columns} for r in df.collect()}


def test_moments_follow_changes(spark):
    r = random.Random(3)
    frame = lambda rows: spark.createDataFrame(rows, SILVER)
    held = [dispute(r) for _ in range(120)]
    held += held[:5] + [("alone", 7, None, 0.3, 0.5, 0.5), ("void", None, None, None, None, None)]
    ledger = moments.dispute_moments(frame(held))
    for _ in range(3):
        gone = [held.pop(r.randrange(len(held))) for _ in range(50)]
        come = [dispute(r) for _ in range(30)]
        held += come
        after = moments.moments_after(ledger, *[moments.dispute_moments(frame(rows)) for rows in (gone, come)])
        ledger = spark.createDataFrame(after.collect(), after.schema)
        for got, want, key in (
            (moments.consensus_of_moments(ledger), reliability.song_consensus(frame(held)), "song_name"),
            (moments.difficulty_of_moments(ledger), reliability.difficulty_reliability(frame(held)), "new_difficulty"),
        ):
            assert got.columns and sorted(got.columns) == sorted(want.columns)
            assert {r[key]: r.asDict() for r in got.collect()} == near(want, key)
    # What was added can be taken away to the last row.
    rest = moments.dispute_moments(frame(held))
    assert moments.moments_after(ledger, rest, rest.limit(0)).count() == 0
    with pytest.raises(Exception, match="more disputes removed"):
        moments.moments_after(rest, moments.dispute_moments(frame([("z", 1, None, 0.1, 0.1, 0.1)])), rest.limit(0)).collect()
    assert moments.consensus_of_moments(rest.limit(0)).count() == 0


def test_a_sheet_touches_only_disputes_of_its_songs(spark, monkeypatch):
    rows = [
        ("a", "5", "6", "2020/01/01", "2020 Difficulty Changes", 1), ("b", "5", "no change", None, "2020 Difficulty Changes", 2),
        ("b", "7", "(resolved) 8", "2020/02/01", "2020 Difficulty Changes", 3), (None, "7", "8", None, "2020 Difficulty Changes", 4),
        ("b", "5", "9", "2021/01/01", "2021 Difficulty Changes", 1), ("c", "3", "4", None, "2021 Difficulty Changes", 2),
        ("b", "5", "9", "2021/01/01", "2021 Difficulty Changes", 3),
    ]
    sheets = spark.createDataFrame(rows, "song_name string, old_diff string, new_diff string, date string, source_sheet string, sheet_row int")
    songs = spark.createDataFrame([("b", 9), ("b", 3), ("c", 4)], "name string, difficulty int")
    monkeypatch.setattr(queries, "stored_contested", lambda *_: sheets)
    monkeypatch.setattr(queries, "silver_playlist", lambda *_: songs)
    given, weigh, summed, dispute_moments = [], reliability.reliability_weights, [], moments.dispute_moments

    def weighed(contested, *args, **kw):
        given.append((contested, kw["parsed"]))
        return weigh(contested, *args, **kw)

    monkeypatch.setattr(reliability, "reliability_weights", weighed)
    monkeypatch.setattr(moments, "dispute_moments", lambda silver: summed.append(silver) or dispute_moments(silver))
    got = queries.moments_after_sheet(spark, "").collect()
    whole = dispute_moments(reliability.dq_filter(weigh(sheets, songs, queries.AS_OF_YEAR))).collect()
    held_null = [r for r in whole if r.song_name is None]
    assert sorted(map(repr, got)) == sorted(map(repr, whole)) and len(held_null) == 1
    assert [{r.song_name for r in frame.collect()} for frame in given[1]] == [{"b", "c"}] * 2
    assert len(summed) == 2  # the cells that go are read off the ledger


def test_moments_are_exact_sums_of_whole_numbers(spark):
    scores = [9999.75, 0.1, 9999.75, 1e-12, -0.5, float("nan"), None]
    rows = [("a", 99_999, datetime.date(2020, 1, 1), x, x, x) for x in scores]
    ledger = moments.dispute_moments(spark.createDataFrame(rows, SILVER))
    assert {f.dataType.simpleString() for f in ledger.schema.fields if f.name not in moments.CELL} == {"bigint"}
    song, level = moments.consensus_of_moments(ledger).first(), moments.difficulty_of_moments(ledger).first()
    total = 19999.100000000001  # 9999.75 * 2 + 0.1 + 1e-12 - 0.5
    assert (song.total_reliability, song.avg_reliability, song.num_assessments) == (total, total / 5, 7)
    assert song.weighted_difficulty == 99_999 and level.total_reliability == total
    assert level.stddev_reliability == pytest.approx(statistics.stdev(x for x in scores if x is not None and x == x), rel=1e-12)
    assert moments.moments_after(ledger, ledger, ledger.limit(0)).count() == 0
    for x in (10_000.0, -10_000.0):
        with pytest.raises(Exception, match="10,000 or more"):
            moments.dispute_moments(spark.createDataFrame([("a", 1, None, x, 0.1, 0.1)], SILVER)).collect()


def test_parsed_disputes_are_not_parsed_again(spark, monkeypatch):
    rows = [("a", "5", "7", "2020/01/02", "2020 Difficulty Changes", 1), ("b", "no", "change", "n/a", "2020 Difficulty Changes", 2), ("a", "6", "(resolved) 4", "v2021/3/4", "2021 Difficulty Changes", 1)]
    sheets = spark.createDataFrame(rows, "song_name string, old_diff string, new_diff string, date string, source_sheet string, sheet_row bigint")
    songs = spark.createDataFrame([("a", 7), ("a", 4)], "name string, difficulty int")
    found = lambda **known: sorted(map(str, reliability.reliability_weights(sheets, songs, 2021, **known).drop("transformation_timestamp").collect()))
    parsed, want = reliability.parse_disputes(sheets).drop("old_diff", "date", "sheet_row"), found()
    monkeypatch.setattr(reliability, "parse_disputes", None)
    assert len(want) == 5 and found(parsed=parsed) == want


NOTES = "song_id bigint, n int, bucket string, tags array<string>"


def changes(spark, old, new, **kind):
    sides = [content.store_digests(content.key_digests(spark.createDataFrame(rows, NOTES), "song_id", buckets=16, **kind)) for rows in (old, new)]
    differing = content.differing_buckets(*[content.bucket_digests(s) for s in sides])
    found = content.content_changes(*sides, "song_id", differing)
    return {(r.song_id, r.kind) for r in found.collect()}, differing, found


def test_content_changes_equal_a_comparison_of_rows(spark):
    r = random.Random(5)
    note = lambda: (r.choice([*range(30), None]), r.randint(0, 3), r.choice(["x", None]), r.choice([["a"], [None], [], None]))
    old = [note() for _ in range(200)]
    new = [n for n in old if n[0] != 3]
    r.shuffle(new)
    at = next(i for i, n in enumerate(new) if n[0] == 4)
    new[at] = (4, 99, None, None)
    new += [(77, 1, None, None), next(n for n in new if n[0] is None)]  # a copy more is a change
    got, differing, found = changes(spark, old, new)
    assert got == {(3, "deleted"), (4, "updated"), (77, "new"), (None, "updated")}
    assert len(differing) <= 4
    scans = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in scans.replace("isnotnull", "")
    assert changes(spark, old, old[::-1])[:2] == (set(), [])
    assert changes(spark, [], [])[0] == set()
    assert changes(spark, [], new[:1])[0] == {(new[0][0], "new")}


def test_content_tells_columns_and_keys_apart(spark):
    row = lambda key, n, text, tags: [(key, n, text, tags)]
    assert changes(spark, row(1, None, "x", None), row(1, 1, None, ["x"]))[0] == {(1, "updated")}
    assert changes(spark, row(1, 1, None, [None]), row(1, 1, None, []))[0] == {(1, "updated")}
    assert changes(spark, row(1, 1, "x", None), row(1, 2, "x", None), columns=["bucket"])[0] == set()
    # Rows that change places between two songs of one bucket.
    swapped = [(a, 0, None, None) for a in range(40)], [(a, a % 2, None, None) for a in range(40)]
    assert changes(spark, *swapped, columns=["n"])[0] == {(a, "updated") for a in range(1, 40, 2)}
