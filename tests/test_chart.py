"""Percentiles by selection and from counts against the sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from notemill.operators import chart


def plain(values, share):
    ordered = sorted(values)
    place = share * (len(ordered) - 1)
    low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
    return low if place == int(place) else (math.ceil(place) - place) * low + (place - math.floor(place)) * high


def columns():
    r = random.Random(3)
    return {
        "distinct": [r.random() * 1e6 for _ in range(3000)], "wide": [10.0 ** r.randint(-300, 300) * r.choice([-1, 1]) for _ in range(2000)],
        "one value": [7.5] * 2500, "two values": [1.0] * 1200 + [2.0] * 1300, "heavy": [5.0] * 2000 + [r.random() for _ in range(900)],
        "few": [3.0, 1.0, 2.0], "single": [4.0],
    }


@pytest.mark.parametrize("name", columns())
@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_selection_equals_sorting(spark, name, share):
    values = columns()[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "x double").repartition(3)
    want = plain(values, share)
    assert chart.exact_percentile(df, "x", share, most=50, accuracy=200) == pytest.approx(want, rel=1e-12, abs=0)
    assert df.agg(F.percentile("x", F.lit(share))).first()[0] == pytest.approx(want, rel=1e-12, abs=0)


def test_selection_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert chart.exact_percentile(df, "x", 0.5) is None and chart.exact_percentile(df.limit(0), "x", 0.5) is None


def test_counts_follow_changes(spark):
    r = random.Random(8)
    held = [r.randint(1, 40) for _ in range(300)]
    one = lambda values: chart.value_counts(spark.createDataFrame([(v,) for v in values], "x int"), "x")
    counts = one([*held])
    for _ in range(3):
        gone = [held.pop(r.randrange(len(held))) for _ in range(40)]
        come = [r.randint(1, 60) for _ in range(30)]
        held += come
        counts = spark.createDataFrame(chart.merged_counts(counts, one(gone), one(come)).collect(), "value int, n bigint")
        assert {x.value: x.n for x in counts.collect()} == {v: held.count(v) for v in set(held)}
        for share in (0.0, 0.3, 0.95, 1.0):
            assert chart.percentile_of_counts(counts, share).first()["p"] == pytest.approx(plain(held, share))
    with pytest.raises(Exception, match="more rows removed"):
        chart.merged_counts(counts, one([999]), one([])).collect()
    assert chart.percentile_of_counts(counts.limit(0), 0.5).first()["p"] is None
