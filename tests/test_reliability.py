import datetime

import pytest
from pyspark.sql import functions as F

from notemill.functions.scalars import clean_date
from notemill.operators import profile, reliability as rel

CONTESTED = "song_name string, old_diff string, new_diff string, date string, source_sheet string, sheet_row bigint"
D = datetime.date


def contested(spark, rows):
    return spark.createDataFrame(rows, CONTESTED)


def playlist(spark, rows):
    return spark.createDataFrame(rows, "name string, difficulty int")


def test_dates_are_cleaned_and_filled_in_row_order(spark):
    rows = [("a", "1", "2", d, "2020 Difficulty Changes", i) for i, d in
            enumerate([None, "v2020/01/05", "x", "2020/02/30", "2020/03/01v ", "2020/1/5"])]
    rows += [("a", "1", "2", None, "2021 Difficulty Changes", 0)]
    parsed = rel.parse_disputes(contested(spark, rows[::-1]), widths=(2, 4)).collect()
    got = {(r.source_sheet[:4], r.sheet_row): r.change_date for r in parsed}
    assert [got["2020", i] for i in range(6)] == [
        None, D(2020, 1, 5), D(2020, 1, 5), D(2020, 1, 5), D(2020, 3, 1), D(2020, 3, 1)]
    assert got["2021", 0] is None
    assert spark.range(1).select(clean_date(F.lit("2024/1/5")).alias("d")).first().d is None


@pytest.mark.parametrize("old, new, want", [
    ("45", "no change", (45, 45, 0, False)),
    ("no", "no change", (None, None, None, False)),
    ("45", "change", (45, None, None, True)),
    ("45", "(resolved) 50", (45, 50, 5, True)),
    ("45", "(resolved)", (45, None, None, True)),
    (" 45 ", "47", (45, 47, 2, True)),
    ("45.0", "x", (None, None, None, True)),
    ("45", None, (45, None, None, True)),
])
def test_level_notation(spark, old, new, want):
    row = rel.parse_disputes(contested(spark, [("a", old, new, None, "2020", 1)])).first()
    assert (row.old_difficulty, row.new_difficulty, row.difficulty_change, row.is_actual_change) == want


@pytest.mark.parametrize("change, want", [(-2, 1.0), (0, 1.0), (3, 0.8), (-5, 0.8), (6, 0.6), (-9, 0.6), (None, 0.5)])
def test_magnitude(spark, change, want):
    df = spark.createDataFrame([(change,)], "c int")
    assert df.select(rel.magnitude(F.col("c")).alias("m")).first().m == want


@pytest.mark.parametrize("year, want", [(2005, 1.0), (2001, 1.0), (2000, 0.9), (1999, 0.8), (1998, 0.7), (1990, 0.6), (None, 0.6)])
def test_recency(spark, year, want):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(rel.recency(F.col("y"), 2001).alias("r")).first().r == want


def test_weight_formula_and_name_fan_out(spark):
    rows = [
        ("a", "10", "11", "2001/01/01", "2001 Difficulty Changes", 1),
        ("a", "10", "(resolved) 40", None, "1999 Difficulty Changes", 1),
        ("a", "10", "change", None, "1990 Difficulty Changes", 1),
        ("b", "10", "10", None, "x", 1),
        (None, "10", "10", None, "x", 2),
    ]
    songs = playlist(spark, [("a", 11), ("a", 12), ("c", 1)])
    got = rel.reliability_weights(contested(spark, rows), songs, 2001)
    assert got.columns == list(rel.SILVER_COLUMNS)
    a = sorted((r.change_year, r.acceptance_score, round(r.reliability_weight, 9)) for r in got.filter("song_name = 'a'").collect())
    quarter = 1 / 4
    assert a == [
        (1990, 0.5, round(quarter * 0.6 * 0.5 * 0.5, 9)), (1990, 0.5, round(quarter * 0.6 * 0.5 * 0.5, 9)),
        (1999, 0.5, round(quarter * 0.8 * 0.5 * 0.6 + 0.2, 9)), (1999, 0.5, round(quarter * 0.8 * 0.5 * 0.6 + 0.2, 9)),
        (2001, 0.5, round(quarter * 0.5, 9)), (2001, 1.0, round(quarter, 9)),
    ]
    b = got.filter("song_name = 'b'").first()
    assert (b.num_changes, b.acceptance_score, b.recency_score, round(b.reliability_weight, 9)) == (1, 0.7, 0.6, 0.21)
    nameless = got.filter("song_name IS NULL").first()
    assert nameless.num_changes is None and nameless.reliability_weight is None
    counts = rel.dq_counts(got).first().asDict()
    assert counts == {"rows_before": 8, "removed_not_null": 2, "removed_positive": 0, "removed_max": 0, "rows_after": 6}
    assert rel.dq_filter(got).count() == 6


def silver(spark, rows):
    return spark.createDataFrame(
        rows, "song_name string, new_difficulty int, reliability_weight double, recency_score double, "
              "acceptance_score double, change_date date")


def test_levels_are_dense_and_smoothed(spark):
    df = silver(spark, [("a", 10, 0.4, 1.0, 0.5, None), ("b", 10, 0.2, 0.8, 1.0, None), ("c", 11, 0.5, 0.6, 0.7, None)])
    dense = {r.new_difficulty: r for r in rel.densify(rel.difficulty_reliability(df)).collect()}
    assert sorted(dense) == list(range(1, 121))
    assert dense[11].stddev_reliability is None and dense[11].num_assessments == 1
    assert (dense[50].avg_reliability, dense[50].num_assessments, dense[50].total_reliability, dense[50].avg_recency,
            dense[50].avg_acceptance) == (0.2, 0, 0.2, 0.6, 0.7)
    raw = {k: r.avg_reliability for k, r in dense.items()}
    for frame in ((3, 2), (2, 2)):
        smooth = {r.new_difficulty: r.avg_reliability for r in
                  rel.smooth_ordinal(rel.densify(rel.difficulty_reliability(df)), *frame).collect()}
        for level in (1, 8, 9, 13, 14, 120):
            near = [raw[k] for k in range(level - frame[0], level + frame[1] + 1) if k in raw]
            assert abs(smooth[level] - sum(near) / len(near)) < 1e-12
    assert len(rel.reliability_scores(df).columns) == 7


def test_consensus_and_sample_weights(spark):
    df = silver(spark, [("a", 10, 0.5, 1.0, 0.5, D(2020, 1, 1)), ("a", 20, 0.25, 1.0, 0.5, D(2021, 1, 1)), ("z", 5, 0.0, 1.0, 1.0, None)])
    got = {r.song_name: r for r in rel.song_consensus(df).collect()}
    assert abs(got["a"].weighted_difficulty - 10 / 0.75) < 1e-9 and got["a"].latest_change == D(2021, 1, 1)
    assert got["z"].weighted_difficulty is None and got["z"].difficulty_stddev is None
    songs = spark.createDataFrame([(1, 10), (2, 77), (3, None)], "song_id bigint, difficulty int")
    scores = rel.difficulty_reliability(df)
    weights = {r.song_id: r.sample_weight for r in rel.sample_weights(songs, scores).collect()}
    assert weights == {1: 0.5, 2: 0.2, 3: 0.2}
    coverage = rel.weight_coverage(rel.sample_weights(songs, scores)).first()
    assert (coverage.songs, coverage.with_score, coverage.with_default) == (3, 1, 2)


def test_reports(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 6.0)], "a int, b double")
    assert profile.null_counts(df, ["a", "b"]).first().asDict() == {"a": 0, "b": 1}
    row = profile.numeric_profile(df, "b").first()
    assert (row["count"], row.mean, row.min, row.max) == (2, 5.0, 4.0, 6.0)
    assert [r.a for r in profile.top_k(df, "b", 2, tiebreak=["a"]).collect()] == [3, 2]
    assert profile.count_by(df, "a").count() == 3


@pytest.mark.parametrize("kind", ["double", "int", "decimal(9,3)"])
def test_quartiles_of_high_accuracy_come_from_counts_of_values(spark, kind):
    """A sketch of such accuracy would hold all rows in one task; counts of values give the same quartiles."""
    rows = spark.range(0, 997, 1, 5).select(F.when(F.col("id") % 50 != 0, (F.col("id") * 37 % 101 - 40) / 8).cast(kind).alias("v"))
    for df in (rows, rows.limit(1).filter("v IS NULL"), rows.filter("v IS NOT NULL").limit(2)):
        found = profile.numeric_profile(df, "v", accuracy=10_000_000)
        c = F.col("v")
        sketch = df.agg(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
            *[F.percentile_approx(c, share, 10_000_000).alias(name) for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))], F.max(c).alias("max"),
        )
        assert found.dtypes == sketch.dtypes
        got, want = found.first().asDict(), sketch.first().asDict()
        for name in ("mean", "stddev"):  # sums of doubles depend on their order
            one, other = got.pop(name), want.pop(name)
            assert one == other or float(one) == pytest.approx(float(other), rel=1e-12)
        assert got == want
        assert "percentile_approx" not in found._jdf.queryExecution().toString()
    assert "percentile_approx" in profile.numeric_profile(rows, "v")._jdf.queryExecution().toString()
