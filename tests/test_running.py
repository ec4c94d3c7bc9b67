"""Sliced running aggregates against plain loops, with one key holding most rows."""

import bisect
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from notemill.operators import running as slices
from notemill.operators.running import Running, cut_large_keys, forward_fill, row_numbers, running, splitters

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def data(n=400, seed=1):
    pick = random.Random(seed)
    positions = pick.sample(range(-500, 5000), n)
    return [("hot" if pick.random() < 0.6 else pick.choice("abc"), p, pick.choice([None, None, p])) for p in positions]


def brute(rows):
    out, seen = {}, defaultdict(lambda: (0, None))
    for key, position, value in sorted(rows, key=lambda r: r[1]):
        count, last = seen[key]
        seen[key] = (count + 1, value if value is not None else last)
        out[key, position] = (count + 1, seen[key][1], last)
    return out


@pytest.mark.parametrize("cut", [
    {"widths": ()}, {"widths": (64,)}, {"widths": (16, 256)}, {"widths": (7, 50, 600)}, {"rows_per_task": 20},
])
def test_running_matches_a_loop(spark, cut):
    rows = data()
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint")
    want = brute(rows)
    numbered = row_numbers(df, ["k"], "p", name="n", **cut)
    assert {(r.k, r.p): r.n for r in numbered.collect()} == {k: w[0] for k, w in want.items()}
    runs = {"before": Running("last", F.col("v"))}
    before = running(df, ["k"], "p", runs, **cut)
    assert before.columns == ["k", "p", "v", "before"]
    assert {(r.k, r.p): r.before for r in before.collect()} == {k: w[2] for k, w in want.items()}


def test_forward_fill(spark):
    rows = data(seed=2)
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint")
    filled = forward_fill(df, ["k"], "p", "v", (32, 512), "f")
    assert {(r.k, r.p): r.f for r in filled.collect()} == {k: w[1] for k, w in brute(rows).items()}


@pytest.mark.parametrize("positions", ["one", "few", "clustered", "far"])
def test_slices_hold_about_equal_rows_however_positions_lie(spark, positions):
    """99,991 of 100,000 rows on few positions, cut by their tiebreak."""
    of = {"one": F.lit(5), "few": F.col("id") % 3, "clustered": F.when(F.col("id") % 11_111 == 0, F.col("id") * 1000).otherwise(F.lit(7)), "far": F.col("id") * F.col("id")}
    df = spark.range(100_000).select(F.lit("hot").alias("k"), of[positions].cast("bigint").alias("p"), "id")
    df = df.unionByName(spark.range(50).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("p"), "id"))
    cut = cut_large_keys(df, ["k"], "p", 1000, ["id"])
    sizes = {(r.k, r["_slice0"]): r["count"] for r in cut.groupBy("k", "_slice0").count().collect()}
    assert len(sizes) > 60 and max(sizes.values()) <= 2000 and sizes[None, 0] == 50
    edges = cut.filter("k = 'hot'").groupBy("_slice0").agg(F.min(F.struct("p", "id")).alias("low"), F.max(F.struct("p", "id")).alias("high")).orderBy("_slice0").collect()
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(edges, edges[1:]))
    numbered = row_numbers(df, ["k"], "p", tiebreak=["id"], name="n", rows_per_task=1000)
    want = F.row_number().over(Window.partitionBy("k").orderBy("p", "id"))
    assert numbered.withColumn("w", want).filter("n <> w").count() == 0 and numbered.count() == 100_050


def test_rows_that_tie_in_all_but_other_columns_are_cut_too(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(1).cast("bigint").alias("p"), "id")
    sizes = [r["count"] for r in cut_large_keys(df, ["k"], "p", 1000).groupBy("_slice0").count().collect()]
    assert max(sizes) <= 2000
    numbers = [r.n for r in row_numbers(df, ["k"], "p", name="n", rows_per_task=1000).collect()]
    assert sorted(numbers) == list(range(1, 20_001))


def test_only_large_keys_are_cut(spark):
    df = spark.createDataFrame(data(), "k string, p bigint, v bigint")
    cut = cut_large_keys(df, ["k"], "p", 100)
    slices = {r.k: (r.s, r.c) for r in cut.groupBy("k").agg(
        F.count_distinct("_slice0").alias("s"), F.bool_or("_cut").alias("c")).collect()}
    assert slices["hot"][0] > 1 and slices["hot"][1]
    assert all(slices[k] == (1, False) for k in "abc")


def test_ties_follow_the_tiebreak(spark):
    df = spark.createDataFrame([("a", 5, i) for i in (3, 1, 2)] + [("a", 100, 9)], "k string, p bigint, t bigint")
    numbered = row_numbers(df, ["k"], "p", (10,), ["t"], "n")
    assert {r.t: r.n for r in numbered.collect()} == {1: 1, 2: 2, 3: 3, 9: 4}


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-300, 300), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])))
def test_running_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint")
    filled = forward_fill(df, ["k"], "p", "v", (13, 70), "f")
    assert {(r.k, r.p): r.f for r in filled.collect()} == {k: w[1] for k, w in brute(rows).items()}


def test_the_search_for_a_slice_copies_no_splitters(spark, monkeypatch):
    """A higher-order function is not compiled with its join, so the array of splitters would be written to every row."""
    monkeypatch.setattr(slices, "COARSE", 5000)
    df = spark.range(30_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 30_011).alias("p"), "id")
    cut = cut_large_keys(df, ["k"], "p", 50)
    assert "lambda" not in cut._jdf.queryExecution().optimizedPlan().toString()
    # The sample of small slices is sorted by coarse slices, not by key alone.
    assert "windowspecdefinition(_key_k#" in (plan := splitters(df, ["k"], "p", 50)._jdf.queryExecution().analyzed().toString())
    assert re.search(r"windowspecdefinition\(_key_k#\w+, _coarse#", plan)
    places = {r["_key_k"]: [tuple(x)[0] for x in r["_splits"]] for r in splitters(df, ["k"], "p", 50).collect()}
    rows = cut.select("k", "p", "_slice0").collect()
    assert len(places[0]) > 200 and all(r["_slice0"] == bisect.bisect_right(places[r.k], r.p) for r in rows)
    sizes = Counter((r.k, r["_slice0"]) for r in rows)
    assert max(sizes.values()) <= 100 and sum(sizes.values()) == 30_000
    numbered = row_numbers(df, ["k"], "p", name="n", rows_per_task=50)
    want = F.row_number().over(Window.partitionBy("k").orderBy("p"))
    assert numbered.withColumn("w", want).filter("n <> w").count() == 0 and numbered.count() == 30_000


def test_slice_summaries_read_the_rows_once(spark):
    """Two levels of slices read their summary twice, but the rows only for the one summary and for the result."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(400).selectExpr("id % 3 AS song", "id AS at", "nullif(id % 7, 0) AS value").mapInPandas(counted, "song long, at long, value long")
    filled = running(rows, ["song"], "at", {"last": Running("last", F.col("value"))}, (10, 100), include_current=True)
    assert filled._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    got = filled.collect()
    assert seen.value == 800
    held = lambda r: next((i % 7 for i in range(r.at, -1, -3) if i % 7), None)
    assert all(r["last"] == held(r) for r in got) and len(got) == 400
