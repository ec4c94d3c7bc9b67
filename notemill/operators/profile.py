"""Data-quality reports. Each is a single aggregation, but for quartiles of high accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.operators.chart import quantiles_of_counts, value_counts
from notemill.session import saved


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


#: Sketches of a larger accuracy hold about all rows, which would meet in one task.
SKETCH = 100_000


def numeric_profile(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, spread, range and approximate quartiles (bounded sketches).

    Above an accuracy of ``SKETCH`` the column is written out, and the quartiles are exact, read off the counts of its values.
    """
    c, quartiles = F.col(column), {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    basics = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max")]
    order = ["count", "mean", "stddev", "min", *quartiles, "max"]
    if accuracy <= SKETCH:
        return df.agg(*basics, *[F.percentile_approx(c, share, accuracy).alias(name) for name, share in quartiles.items()]).select(*order)
    values = saved(df.select(column), "profile-values")
    # Two frames of one row each.
    return values.agg(*basics).crossJoin(quantiles_of_counts(value_counts(values, column), quartiles)).select(*order)


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, by: str, k: int = 10, descending: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows by a column. Spark keeps k rows per task, never a full sort."""
    order = F.desc(by) if descending else F.asc(by)
    return df.orderBy(order, *tiebreak).limit(k)
