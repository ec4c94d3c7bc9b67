"""Running aggregates over groups that may be too large for one task.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. When
one key holds a third of the table that task never ends. Here the key is cut
into slices of its ordering column:

1. every slice is summarised by a map-side combining aggregate,
2. the running value *before* each slice is found on those summaries,
3. that value enters its slice as one extra row, so a single window over
   ``(key, slice)`` sees both the earlier slices and its own rows.

The rows are shuffled once, on ``(key, slice)``, and no join of large sides is
needed. Slices are cut in one of two ways:

* by fixed ``widths``, where positions are dense integers: a slice is then
  bounded by its width, and most keys fit in a few slices. Summaries are cut
  again by the next width, so they cannot pile up either;
* by ``rows_per_task``, where positions are sparse or clustered: only keys with
  more rows than that are cut, at quantiles of their rows, so that slices hold
  about as many rows each, however the positions lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notemill.session import saved


@dataclass(frozen=True)
class Running:
    """What to carry along: ``last`` non-null value, ``max`` or ``sum`` of ``source``.

    ``max`` is the cheap form of ``last`` where the source rises with the position.
    """

    kind: str
    source: Column

    def summary(self, name: str, order: Column) -> Column:
        value = F.col(name)
        if self.kind != "last":
            return {"sum": F.sum, "max": F.max}[self.kind](value)
        return F.max_by(value, F.when(value.isNotNull(), order))

    def over(self, name: str, window) -> Column:
        if self.kind != "last":
            return {"sum": F.sum, "max": F.max}[self.kind](name).over(window)
        return F.last(name, ignorenulls=True).over(window)


def slice_id(df: DataFrame, position: str, width: int) -> Column:
    """Slice number of a position; never decreases with the position."""
    if isinstance(df.schema[position].dataType, T.IntegralType):
        return F.expr(f"`{position}` div {width}L")
    return F.floor(F.col(position) / F.lit(float(width)))


#: Sampled rows per slice: a slice of twice the wanted rows would need half as many in its place, which is beyond 10 deviations.
POINTS = 100
#: Samples for smaller slices than this are numbered within slices of this many rows.
COARSE = 1_000_000


def _place(position: str, tiebreak: Sequence[str], columns: Sequence[str]) -> Column:
    """The order of rows within a key; rows that tie are told apart by a hash of all their columns."""
    return F.struct(position, *tiebreak, F.xxhash64(*columns).alias("_tie"))


def splitters(
    df: DataFrame, keys: Sequence[str], position: str, rows_per_task: int, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """(_key_<key>..., ``_splits``): for keys above ``rows_per_task`` rows, the places where slices start, in order.

    They are every ``POINTS``-th row of a sample, taken by a hash of the rows, so that a
    plan that is run again finds the same. There is one per ``rows_per_task`` rows. The
    sample of small slices is large; it is sorted within coarse slices, which start slices too.
    """
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    large = large.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    names = [f"_key_{k}" for k in keys]
    every = max(1, rows_per_task // POINTS)
    # Fewer than ``input / rows_per_task`` keys are large.
    rows = df.join(F.broadcast(large), same).select(*names, _place(position, tiebreak, df.columns).alias("_place"))
    sample = rows.filter(F.pmod(F.xxhash64(F.lit(7), "_place"), F.lit(every)) == 0)
    coarse = ["_coarse"] if rows_per_task * POINTS <= COARSE else []
    if coarse:
        starts = splitters(df, keys, position, COARSE, tiebreak).select(*[F.col(n).alias(f"_of{n}") for n in names], "_splits")
        own = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names])
        sample = _searched(sample.join(F.broadcast(starts), own, "left"), "_coarse", 20).select(*names, "_place", "_coarse")
    nth = F.row_number().over(Window.partitionBy(*names, *coarse).orderBy("_place"))
    wanted = F.col("_nth") % -(-rows_per_task // every) == 0
    for name in coarse:
        wanted = wanted | ((F.col("_nth") == 1) & (F.col(name) > 0))
    chosen = sample.withColumn("_nth", nth).filter(wanted)
    return chosen.groupBy(*names).agg(F.sort_array(F.collect_set("_place")).alias("_splits"))


def _searched(df: DataFrame, name: str, bits: int = 26) -> DataFrame:
    """``df`` plus ``name``: how many of ``_splits`` (fewer than 2^bits) lie at or before ``_place``, by binary search.

    Each step is a column of its own and no higher-order function, so that it is compiled
    and the array stays where it is: a function that is not would copy it to every row.
    A row of 2 GB can't hold 2^26 places of 32 bytes or more. One test a step keeps the
    compiled method below the 8,000 bytes beyond which the JVM interprets it.
    """
    found = df.withColumn(name, F.lit(0))
    for step in (1 << k for k in reversed(range(bits))):
        passed = F.get("_splits", F.col(name) + F.lit(step - 1)) <= F.col("_place")
        found = found.withColumn(name, F.col(name) + F.when(passed, F.lit(step)).otherwise(F.lit(0)))
    return found


def cut_large_keys(
    df: DataFrame, keys: Sequence[str], position: str, rows_per_task: int, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``df`` plus ``_slice0`` and ``_cut``: keys above ``rows_per_task`` rows fall into slices of about as many rows.

    Slices follow the order of (position, tiebreak), also where positions are
    equal. Only rows equal in all columns can't be parted. The splitters are
    broadcast: there are at most ``input / rows_per_task`` of them.
    """
    found = splitters(df, keys, position, rows_per_task, tiebreak)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    placed = df.withColumn("_place", _place(position, tiebreak, df.columns)).join(F.broadcast(found), same, "left")
    return _searched(placed, "_slice0").select(
        *df.columns, F.col("_slice0").cast("bigint").alias("_slice0"), F.col("_splits").isNotNull().alias("_cut"),
    )


def _above(widths: Sequence[int]) -> list[int]:
    """The upper widths in slices of the lowest: summaries are placed by slice number, not by position."""
    return [max(1, w // widths[0]) for w in widths[1:]]


def _carried(
    sliced: DataFrame, keys: Sequence[str], position: str, runs: Mapping[str, Running],
    widths: Sequence[int], tiebreak: Sequence[str], level: int,
) -> DataFrame:
    """One row per (keys, ``_slice<level>``): the running values before that slice."""
    name = f"_slice{level}"
    order = F.struct(position, *tiebreak) if tiebreak else F.col(position)
    summary = (
        sliced.withColumns({f"_in_{out}": run.source for out, run in runs.items()})
        .groupBy(*keys, name)
        .agg(*[run.summary(f"_in_{out}", order).alias(f"_sum_{out}") for out, run in runs.items()])
    )
    if widths and level == 0:
        # The next level reads the summary twice; without a copy each time would read the rows again.
        summary = saved(summary, "slices")
    upper = {out: Running(run.kind, F.col(f"_sum_{out}")) for out, run in runs.items()}
    return running(summary, keys, name, upper, widths, level=level + 1).select(*keys, name, *runs)


def carried_into_slices(
    df: DataFrame, keys: Sequence[str], position: str, runs: Mapping[str, Running], widths: Sequence[int],
) -> DataFrame:
    """One row per (keys, ``_slice0``) of ``widths[0]``: the running values before that slice."""
    sliced = df.withColumn("_slice0", slice_id(df, position, widths[0]))
    return _carried(sliced, keys, position, runs, _above(widths), (), 0)


def running(
    df: DataFrame, keys: Sequence[str], position: str, runs: Mapping[str, Running],
    widths: Sequence[int] = (), tiebreak: Sequence[str] = (), include_current: bool = False, level: int = 0,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``df`` plus one column per run: its value over the earlier rows of the key.

    ``widths`` are slice widths in units of ``position``, finest first; instead,
    ``rows_per_task`` cuts only large keys. With neither, a plain window over
    the keys is used. ``position`` must be NULL-free; rows that tie on it are
    ordered by ``tiebreak``.
    """
    end = Window.currentRow if include_current else -1
    inputs = {f"_in_{out}": run.source for out, run in runs.items()}
    by_slice = bool(widths) or rows_per_task is not None
    if not by_slice:
        window = Window.partitionBy(*keys).orderBy(position, *tiebreak).rowsBetween(Window.unboundedPreceding, end)
        rows = df.withColumns(inputs)
    else:
        name = f"_slice{level}"
        if rows_per_task is not None:
            sliced = cut_large_keys(df, keys, position, rows_per_task, tiebreak)
            several = sliced.filter("_cut")
        else:
            several = sliced = df.withColumn(name, slice_id(df, position, widths[0]))
        carried = _carried(several, keys, position, runs, _above(widths), tiebreak, level)
        markers = carried.select(
            *keys, name, *[F.col(out).alias(f"_in_{out}") for out in runs], F.lit(0).alias("_is_row")
        )
        rows = sliced.withColumns({**inputs, "_is_row": F.lit(1)}).unionByName(markers, allowMissingColumns=True)
        # A marker has no position, so it comes first; positions lead, as sorts compare by the first column that differs.
        window = (
            Window.partitionBy(name, *keys).orderBy(position, "_is_row", *tiebreak)
            .rowsBetween(Window.unboundedPreceding, end)
        )
    out = rows.withColumns({out: run.over(f"_in_{out}", window) for out, run in runs.items()})
    if by_slice:
        out = out.filter(F.col("_is_row") == 1)
    return out.select(*df.columns, *runs)


def row_numbers(
    df: DataFrame, keys: Sequence[str], position: str, widths: Sequence[int] = (),
    tiebreak: Sequence[str] = (), name: str = "row_number", rows_per_task: int | None = None,
) -> DataFrame:
    """``row_number`` over (keys) ordered by (position, tiebreak), by slices."""
    ones = {name: Running("sum", F.lit(1).cast("bigint"))}
    return running(
        df, keys, position, ones, widths, tiebreak, include_current=True, rows_per_task=rows_per_task
    )


def forward_fill(
    df: DataFrame, keys: Sequence[str], position: str, column: str, widths: Sequence[int], name: str,
) -> DataFrame:
    """Last non-null value of ``column`` up to and including each row."""
    return running(df, keys, position, {name: Running("last", F.col(column))}, widths, include_current=True)
