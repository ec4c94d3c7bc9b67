"""Dispute statistics kept up to date from changed disputes alone.

The ledger has one row per (song, level, date) with counts, sums and squares of
the scores. They are taken in whole units of twelve digits after the point, so what was
added can be taken away again without a rest. Its cells double as the multiset
of levels and dates, which minimum and maximum need once rows go. Both the
consensus of songs and the statistics of levels are read off the one ledger.

A sum is kept as sums of its digits in base ``BASE`` (a square: ``SQUARE_BASE``),
lowest first: adding whole numbers costs a fraction of adding wide decimals, and
such a column holds the sum of 10^8 rows of the largest score, or more.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.functions.scalars import ratio

CELL = ("song_name", "new_difficulty", "change_date")
MEASURES = ("reliability_weight", "recency_score", "acceptance_score")
LIMIT = 10_000           # scores are below this
LEVEL = "decimal(5,0)"    # levels are below 100,000
UNITS = 10 ** 12         # units of one
BASE = 10 ** 6           # two digits hold a score
SQUARE_BASE = 10 ** 8    # four digits hold its square


def _div(c: Column, by: int) -> Column:
    return F.call_function("div", c, F.lit(by).cast("bigint"))


def _units(name: str) -> Column:
    """A score in whole units; what is no number has none."""
    x = F.col(name).cast("double")
    wrong = F.raise_error(F.concat(F.lit(f"{name} of 10,000 or more: "), x.cast("string"))).cast("bigint")
    whole = F.floor(x * F.lit(float(UNITS)) + F.lit(0.5))
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("bigint")).when(F.abs(x) >= LIMIT, wrong).otherwise(whole)


def _square(units: str) -> list[Column]:
    """The four digits of the square of a whole number below 10^16, lowest first."""
    high, low = _div(F.abs(F.col(units)), SQUARE_BASE), F.abs(F.col(units)) % SQUARE_BASE
    middle = high * low * 2 + _div(low * low, SQUARE_BASE)
    top = high * high + _div(middle, SQUARE_BASE)
    return [low * low % SQUARE_BASE, middle % SQUARE_BASE, top % SQUARE_BASE, _div(top, SQUARE_BASE)]


def dispute_moments(silver: DataFrame) -> DataFrame:
    """The ledger of scored disputes; combines on the map side.

    NULL scores are counted in ``n`` only. A score of 10,000 or more is an error.
    NULL songs, levels and dates are cells of their own.
    """
    units = {f"_{name}": _units(name) for name in MEASURES}
    rows = silver.select(*CELL, *[c.alias(u) for u, c in units.items()])
    rows = rows.select(*CELL, *units, *[c.alias(f"_square{k}") for k, c in enumerate(_square("_reliability_weight"))])
    none = F.lit(0).cast("bigint")
    sums = [F.count(F.lit(1)).alias("n")]
    for name in MEASURES:
        x = F.col(f"_{name}")
        digits = x % BASE, _div(x, BASE)
        sums += [F.count(x).alias(f"{name}_n"), *[F.coalesce(F.sum(d), none).alias(f"{name}_1{k}") for k, d in enumerate(digits)]]
    sums += [F.coalesce(F.sum(f"_square{k}"), none).alias(f"reliability_weight_2{k}") for k in range(4)]
    return rows.groupBy(*CELL).agg(*sums)


def moments_after(held: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """``held`` after disputes were removed and added, each given as a ledger.

    Cells that lost all rows go. A cell that lost more than it had is an error:
    those rows were never counted.
    """
    values = [c for c in held.columns if c not in CELL]
    minus = removed.select(*CELL, *[(-F.col(c)).alias(c) for c in values])
    signed = held.unionByName(added).unionByName(minus)
    kinds = {f.name: f.dataType for f in held.schema.fields}
    total = signed.groupBy(*CELL).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in values]).filter("n <> 0")
    wrong = F.raise_error(F.concat(F.lit("more disputes removed than counted of song "), F.coalesce("song_name", F.lit("NULL"))))
    return total.withColumn("n", F.when(F.col("n") > 0, F.col("n")).otherwise(wrong.cast("bigint")))


def _exact(digits: list[Column], base: int = BASE) -> Column:
    """The value of two sums of digits, lowest first, of units of 1 / base^2."""
    low, high = (d.cast("decimal(19,0)") for d in digits)
    return high * F.lit(1 / Decimal(base)) + low * F.lit(1 / Decimal(base) ** 2)


def _sum(name: str) -> Column:
    """The sum of a measure, exact."""
    return _exact([F.sum(f"{name}_1{k}") for k in range(2)])


def _mean(name: str) -> Column:
    return ratio(_sum(name), F.sum(f"{name}_n"))


def _total(name: str) -> Column:
    return F.when(F.sum(f"{name}_n") > 0, _sum(name).cast("double"))


def _sum_of_levels() -> Column:
    """The sum of level times weight, exact; digits are carried before they are summed up."""
    level = F.col("new_difficulty").cast(LEVEL).cast("bigint")
    low, high = (level * F.col(f"reliability_weight_1{k}") for k in range(2))
    high = high + _div(low, BASE)
    inner = _exact([F.sum(low % BASE), F.sum(high % BASE)])
    return F.sum(_div(high, BASE)).cast("decimal(19,0)") + inner


def _level_spread() -> Column:
    """Sample deviation of the levels; exact up to the root."""
    level, n = F.col("new_difficulty").cast("bigint"), F.col("n")
    count = F.sum(F.when(level.isNotNull(), n)).cast("decimal(15,0)")
    first, second = F.sum(level * n).cast("decimal(17,0)"), F.sum(level * level * n).cast("decimal(19,0)")
    return F.sqrt(ratio(count * second - first * first, count * (count - 1)))


def _weight_spread() -> Column:
    """Sample deviation of the weights; one below 1e-8 is within the rounding of doubles."""
    count, first = F.sum("reliability_weight_n").cast("double"), _sum("reliability_weight").cast("double")
    digits = [F.sum(f"reliability_weight_2{k}") for k in range(4)]
    for k in range(3):
        digits[k], digits[k + 1] = digits[k] % SQUARE_BASE, digits[k + 1] + _div(digits[k], SQUARE_BASE)
    low, high = (d.cast("decimal(19,0)") for d in digits[2:])
    square = (high + low * F.lit(1 / Decimal(SQUARE_BASE))).cast("double")
    square = square + (digits[1].cast("double") + digits[0].cast("double") / SQUARE_BASE) / SQUARE_BASE ** 2
    inner = square - F.try_divide(first * first, count)
    return F.sqrt(ratio(F.greatest(inner, F.lit(0.0)), count - 1))


def consensus_of_moments(ledger: DataFrame) -> DataFrame:
    """What ``reliability.song_consensus`` gives for the disputes of the ledger."""
    return ledger.groupBy("song_name").agg(
        ratio(_sum_of_levels(), _sum("reliability_weight")).alias("weighted_difficulty"),
        _mean("reliability_weight").alias("avg_reliability"),
        _total("reliability_weight").alias("total_reliability"),
        F.sum("n").alias("num_assessments"),
        F.max("change_date").alias("latest_change"),
        _level_spread().alias("difficulty_stddev"),
        F.min("new_difficulty").alias("min_contested_difficulty"),
        F.max("new_difficulty").alias("max_contested_difficulty"),
    )


def difficulty_of_moments(ledger: DataFrame) -> DataFrame:
    """What ``reliability.difficulty_reliability`` gives for the disputes of the ledger."""
    return ledger.groupBy("new_difficulty").agg(
        _mean("reliability_weight").alias("avg_reliability"),
        _weight_spread().alias("stddev_reliability"),
        F.sum("n").alias("num_assessments"),
        _total("reliability_weight").alias("total_reliability"),
        _mean("recency_score").alias("avg_recency"),
        _mean("acceptance_score").alias("avg_acceptance"),
    )
