"""Column expressions. All are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Labels of the numeric genre codes.
GENRES = {
    1: "Dance",
    2: "Dance 2",
    3: "Funk",
    4: "Arcade",
    5: "Rock",
    6: "Classical",
    7: "Misc",
    8: "Secret",
    9: "Purchased",
    10: "Token",
    11: "Hip-Hop",
    12: "Skill Token",
    13: "Legacy",
}

# Labels of the numeric note colours.
COLORS = {
    0: "blue",
    1: "red",
    2: "purple",
    3: "yellow",
    4: "pink",
    5: "orange",
    6: "cyan",
    7: "green",
    8: "white",
}

DEFAULT_LANES = 4


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: Column | str, labels: Mapping[int, str]) -> Column:
    """Label of a code, NULL when the code is not listed."""
    c = column(c)
    out = F.lit(None).cast("string")
    for code in sorted(labels, reverse=True):
        out = F.when(c == code, F.lit(labels[code])).otherwise(out)
    return out


def one_hot(index: Column | str, lanes: int = DEFAULT_LANES) -> Column:
    """Lane index as a bit-string of ``lanes`` characters; NULL outside ``0..lanes-1``."""
    index = column(index)
    return F.when(
        index.between(0, lanes - 1),
        F.concat(F.repeat(F.lit("0"), index), F.lit("1"), F.repeat(F.lit("0"), lanes - 1 - index)),
    )


def lane_string(lane: int, lanes: int = DEFAULT_LANES) -> str:
    """Bit-string of the 0-based ``lane``."""
    return "".join("1" if i == lane else "0" for i in range(lanes))


def lane_active(orientation: Column | str, lane: int) -> Column:
    """Whether the 0-based ``lane`` is set in a bit-string."""
    return F.substring(column(orientation), lane + 1, 1) == "1"


def active_lanes(flags: Sequence[Column]) -> Column:
    """Array of the 0-based lanes whose flag is true.

    Built with ``array_remove``, which is generated code; ``array_compact`` and
    ``filter`` run a lambda per element outside of it.
    """
    marked = [F.when(is_set, F.lit(lane)).otherwise(F.lit(-1)) for lane, is_set in enumerate(flags)]
    return F.array_remove(F.array(*marked), -1)


def lane_count(orientation: Column | str, lanes: int = DEFAULT_LANES) -> Column:
    """Number of set lanes among the first ``lanes`` positions."""
    total = F.lit(0)
    for lane in range(lanes):
        total = total + F.when(lane_active(orientation, lane), 1).otherwise(0)
    return total


def or_lanes(orientation: Column | str, lanes: int = DEFAULT_LANES) -> Column:
    """Aggregate: lane-wise OR of bit-strings, all zeros for a group of NULLs.

    One integer maximum per lane, so it combines on the map side in a hash
    aggregate (a maximum of strings would need a sort).
    """
    orientation = column(orientation)
    digits = [
        F.coalesce(F.max(F.substring(orientation, lane + 1, 1).try_cast("int")), F.lit(0)).cast("string")
        for lane in range(lanes)
    ]
    return F.concat(*digits)


def register_combine_orientations(spark: SparkSession, lanes: int = DEFAULT_LANES) -> None:
    """``combine_orientations(array<string>)`` for SQL callers, as a SQL function."""
    digits = ", ".join(
        f"coalesce(array_max(transform(parts, p -> try_cast(substring(p, {lane + 1}, 1) AS int))), 0)"
        for lane in range(lanes)
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION combine_orientations(parts ARRAY<STRING>) "
        f"RETURNS STRING RETURN concat({digits})"
    )


def flag(c: Column | str) -> Column:
    """1 is true, anything else (NULL too) is false."""
    return F.coalesce(column(c) == 1, F.lit(False))


def mmss_to_seconds(c: Column | str) -> Column:
    """``m:ss`` as whole seconds, NULL when either part is missing or not a number."""
    parts = F.split(column(c), ":")
    return F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")


def split_names(c: Column | str) -> Column:
    """``A & B`` as an array."""
    return F.split(column(c), " & ")


def epoch_to_timestamp(c: Column | str) -> Column:
    """Unix seconds as a timestamp."""
    return F.timestamp_seconds(column(c).cast("bigint"))


def clean_date(c: Column | str) -> Column:
    """``yyyy/MM/dd`` with stray ``v`` marks removed; NULL when it is no date.

    A text without a slash is none and is not tried: each failed try builds an error inside Spark.
    """
    text = F.trim(F.replace(column(c), F.lit("v"), F.lit("")))
    return F.when(text.contains("/"), F.try_to_date(text, "yyyy/MM/dd"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as doubles; NULL instead of an error for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def set_map_value(c: Column | str, key: str, value: str) -> Column:
    """The map with the value of ``key`` replaced; absent keys stay absent."""
    return F.transform_values(column(c), lambda k, v: F.when(k == key, F.lit(value)).otherwise(v))
