"""Records of text files that are read in byte ranges by many tasks, though borders of records depend on what came before.

A line break may end a row of a sheet or lie in a quoted cell; a brace may end an
object of an array, or lie deeper, or in a string. What a piece of text does to
that state is a function of the state it starts in. So each range works out its
function for every state it may start in, the functions of the ranges are
composed in file order (one row per range), and then each range knows the state
it really starts in. Pieces move once, to be numbered within their range; only
records of several pieces, and the last one of a range, move again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = ("_file", "_start")


def within():
    """The pieces of a range in order."""
    return Window.partitionBy(*RANGE).orderBy("_at")


def earlier():
    """The pieces of a range before this one."""
    return within().rowsBetween(Window.unboundedPreceding, -1)


def of_file():
    """Earlier ranges of the file, over summaries of one row per range."""
    return Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)


def of_all():
    """Earlier ranges of all files, over the same summaries."""
    return Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(_file, _start, _at, piece): text between separators, its byte range (file and start) and its order there."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("piece"),
    )


def _count(text: Column, *characters: str) -> Column:
    """How often any of the characters occurs."""
    return F.length(text) - F.length(F.translate(text, "".join(characters), ""))


def _before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _carried(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``totals`` (one row per range) has for their range."""
    return rows.join(totals, list(RANGE))


def _assembled(rows: DataFrame, single: Column, text: Column, glue: str, ended: Column | None = None) -> DataFrame:
    """(_record, text) of each record: rows (``_record``, ``_part``) that are records themselves, and the others put together in order."""
    alone = rows.filter(single).select("_record", text.alias("text"))
    several = rows.filter(~single).groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_start", "_at", "_part"))).alias("_parts"), *([F.bool_or(ended).alias("_ended")] if ended is not None else [])
    )
    joined = F.array_join(F.col("_parts._part"), glue)
    if ended is not None:
        several = several.filter(F.col("_ended") | joined.contains("{"))
        joined = F.when(F.col("_ended"), F.concat(joined, F.lit(glue))).otherwise(joined)
    return alone.unionByName(several.select("_record", joined.alias("text")))


def sheet_records(spark: SparkSession, path: str) -> DataFrame:
    """(_record, text): the records of CSV files, numbered from 1 in order of file name and place.

    Quotes are doubled inside quoted cells, as spreadsheets export them; so a
    line starts inside a cell exactly if an odd number of quotes came before in
    its file. Empty lines between records don't count; those in cells do.
    """
    lines = pieces(spark, path, "\n").withColumn("piece", F.regexp_replace("piece", "\r\\z", ""))
    local = lines.withColumn("_quotes", _count(F.col("piece"), '"')).withColumn("_odd", _before(F.col("_quotes"), earlier()))
    carry = local.groupBy(*RANGE).agg(F.sum("_quotes").alias("_q")).withColumn("_carry", _before(F.col("_q"), of_file())).drop("_q")
    starts = (F.col("_carry") + F.col("_odd")) % 2 == 0
    known = _carried(local, carry).withColumn("_opens", starts).filter(~(F.col("_opens") & (F.col("piece") == "")))
    own = F.col("_opens").cast("int")
    numbered = known.withColumns({
        "_nth": F.sum(own).over(within().rowsBetween(Window.unboundedPreceding, 0)), "_next": F.lead("_opens").over(within()),
    })
    counts = known.groupBy(*RANGE).agg(F.sum(own).alias("_n")).withColumn("_records", _before(F.col("_n"), of_all())).drop("_n")
    rows = _carried(numbered, counts).withColumns({"_record": F.col("_nth") + F.col("_records"), "_part": F.col("piece")})
    return _assembled(rows, F.col("_opens") & F.coalesce("_next", F.lit(False)), F.col("piece"), "\n")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(_record, text): the objects of files that each hold a JSON array (or one object), as JSON texts.

    Pieces end at closing braces. A piece that starts inside a string sees its
    quotes the other way round than one that starts outside, so each has two
    functions: how much deeper the nesting gets, and where it ends. Escaped
    characters are taken out first; no escape can be cut, as a backslash before a
    brace is no JSON. An object cut off at the end of a file stays, unfinished.
    """
    bare = F.regexp_replace("piece", r"\\.", "")
    strings = '"[^"]*(?:"|\\z)'
    at = F.instr(F.col("_bare"), '"')
    outside = [
        F.regexp_replace("_bare", strings, ""),
        F.when(at > 0, F.regexp_replace(F.substring("_bare", at + 1, F.length("_bare")), strings, "")).otherwise(F.lit("")),
    ]
    ends_outside = lambda state: (F.col("_quotes") + state) % 2 == 0
    deeper = [_count(o, "{", "[") - _count(o, "]") - F.when(ends_outside(k), 1).otherwise(0) for k, o in enumerate(outside)]
    local = (
        pieces(spark, path, "}").withColumn("_bare", bare).withColumn("_quotes", _count(F.col("_bare"), '"'))
        .withColumns({"_deeper0": deeper[0], "_deeper1": deeper[1]}).drop("_bare")
        .withColumn("_odd", _before(F.col("_quotes"), earlier()) % 2)
        .withColumns({
            "_step0": F.when(F.col("_odd") == 0, F.col("_deeper0")).otherwise(F.col("_deeper1")),
            "_step1": F.when(F.col("_odd") == 0, F.col("_deeper1")).otherwise(F.col("_deeper0")),
        })
        .withColumns({"_depth0": _before(F.col("_step0"), earlier()), "_depth1": _before(F.col("_step1"), earlier())})
    )
    totals = local.groupBy(*RANGE).agg(
        F.sum("_quotes").alias("_q"), F.sum("_step0").alias("_d0"), F.sum("_step1").alias("_d1"),
        F.min_by(F.col("piece").rlike(r"\A[\s\uFEFF]*\[").cast("int"), "_at").alias("_array"),
    )
    carry = (
        totals.withColumn("_inside", _before(F.col("_q"), of_file()) % 2)
        .withColumns({
            "_depth": _before(F.when(F.col("_inside") == 0, F.col("_d0")).otherwise(F.col("_d1")), of_file()),
            "_base": F.first("_array").over(Window.partitionBy("_file").orderBy("_start")),
        })
        .select(*RANGE, "_inside", "_depth", "_base")
    )
    straight = F.col("_inside") == 0
    state = (F.col("_inside") + F.col("_odd")) % 2
    known = _carried(local, carry).withColumns({
        "_from": F.col("_depth") + F.when(straight, F.col("_depth0")).otherwise(F.col("_depth1")),
        "_step": F.when(straight, F.col("_step0")).otherwise(F.col("_step1")), "_out": ends_outside(state),
    }).withColumn("_ends", F.col("_out") & (F.col("_from") + F.col("_step") == F.col("_base"))).select(*RANGE, "_at", "piece", "_from", "_base", "_ends")
    own = F.col("_ends").cast("int")
    counts = known.groupBy(*RANGE).agg(F.sum(own).alias("_n")).withColumn("_records", _before(F.col("_n"), of_all())).drop("_n")
    opens = F.col("_from") <= F.col("_base")  # less at the start of the file
    # What stands between two objects goes with the piece that opens the second.
    rows = _carried(known.withColumn("_nth", _before(own, earlier())), counts).withColumns({
        "_record": F.col("_nth") + F.col("_records") + 1, "_part": F.when(opens, F.regexp_replace("piece", r"\A[^{]*", "")).otherwise(F.col("piece")),
    })
    return _assembled(rows, opens & F.col("_ends"), F.concat("_part", F.lit("}")), "}", F.col("_ends"))


def read_arrays(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The objects of JSON array files as rows of ``schema``; any number of tasks reads one file."""
    return array_records(spark, path).select(F.from_json("text", schema).alias("_row")).select("_row.*")
