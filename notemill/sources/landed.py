"""Readers for landed payload files. Schemas are given, never inferred from the data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notemill import schemas
from notemill.operators.playlist import widen_numbers
from notemill.operators.running import Running, running
from notemill.sources.ranges import read_arrays, sheet_records

SHEET_MARK = "Difficulty Changes"


def read_songlist(spark: SparkSession, path: str, multiline: bool = True, schema: str = schemas.SONGLIST) -> DataFrame:
    """Song list files: a JSON array each, or one object per line with ``multiline=False``."""
    return read_arrays(spark, path, schema) if multiline else spark.read.schema(schema).json(path)


def _chart_payloads(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    rows = read_arrays(spark, path, schemas.CHART_PAYLOADS) if multiline else spark.read.schema(schemas.CHART_PAYLOADS).json(path)
    return rows.withColumn("first_note_id", F.coalesce("first_note_id", F.lit(1)))


def read_charts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Chart payloads ``{song_id, status, info, chart}``, numbers whole or decimal.

    A long chart may come in parts, each with its ``first_note_id``. Failed responses are dropped, and so is what can't be read; see
    :func:`rejected_charts` for the latter.
    """
    good = F.col("_corrupt_record").isNull() & (F.col("status") == 200)
    return _chart_payloads(spark, path, multiline).filter(good).select("song_id", "first_note_id", "info", "chart")


def rejected_charts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """(song_id, status, payload) of payloads that can't be read in full, to be stored or counted by the caller."""
    rows = _chart_payloads(spark, path, multiline).filter(F.col("_corrupt_record").isNotNull())
    return rows.select("song_id", "status", F.col("_corrupt_record").alias("payload"))


def read_playlist(
    spark: SparkSession, path: str, multiline: bool = True, schema: str = schemas.PLAYLIST,
) -> DataFrame:
    """Playlist JSON; numbers, whole or decimal, become doubles."""
    return widen_numbers(read_arrays(spark, path, schema) if multiline else spark.read.schema(schema).json(path))


def standard_name(name: str) -> str:
    """Lower case, spaces to ``_``, everything but ``[a-z0-9_]`` dropped."""
    return re.sub(r"[^a-z0-9_]", "", name.lower().replace(" ", "_"))


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: standard_name(c) for c in df.columns})


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"source_sheet": F.lit(source), "ingestion_timestamp": F.current_timestamp()})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sheet_titles(spark: SparkSession, folder: str, title_contains: str = SHEET_MARK) -> list[str]:
    """Titles of the exports below ``folder`` (``<title>.csv``, a file or a folder of parts).

    Only file names are listed; there is one title per sheet.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)]
    titles = [n[:-4] for n in names if n.endswith(".csv")]
    return sorted(t for t in titles if title_contains in t)


def read_sheet(spark: SparkSession, folder: str, title: str, multiline: bool = True) -> DataFrame:
    """One exported sheet: an empty row, the header row, then data.

    Columns with an empty header are dropped. ``sheet_row`` numbers the data
    rows from 1 in file order. Quoted cells may hold line breaks, and doubled
    quotes; one file is read by many tasks all the same. ``multiline=False`` saves
    the search for such cells where there are none. An export may also be a
    folder of part files in name order whose first part starts with the two
    heading rows.
    """
    path = f"{folder.rstrip('/')}/{title}.csv"
    first_file = unquote(sorted(spark.read.text(path).inputFiles())[0])
    headings = spark.read.csv(first_file, header=False, multiLine=multiline, escape='"').take(2)
    if len(headings) < 2:
        raise ValueError(f"{path} has no header row")
    cells = list(headings[1].asDict())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    kept = [c for c in cells if headings[1][c]]
    if multiline:
        parsed = sheet_records(spark, path).select(F.from_csv("text", ", ".join(f"`{c}` string" for c in cells), {"escape": '"'}).alias("row"), (F.col("_record") - 2).alias("sheet_row"))
        return parsed.filter("sheet_row > 0").select(*[F.col(f"row.{c}").alias(headings[1][c]) for c in kept], "sheet_row")
    placed = spark.read.schema(schema).csv(path, header=False, escape='"').select(
        *cells,
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # Rows of one block are in file order; blocks are numbered on their summary.
    blocks = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    numbered = running(blocks.withColumn("_all", F.lit(1)), ["_all"], "_block", {"_before": Running("sum", F.col("_n"))}, [])
    offsets = numbered.select(F.col("_block").alias("_b"), F.coalesce("_before", F.lit(0)).alias("_before"))
    local = running(
        placed, ["_block"], "_at", {"_local": Running("sum", F.lit(1).cast("bigint"))}, [], include_current=True
    )
    ordered = local.join(offsets, F.col("_block") == F.col("_b")).withColumn(
        "sheet_row", F.col("_before") + F.col("_local") - 2
    )
    return ordered.filter("sheet_row > 0").select(*[F.col(c).alias(headings[1][c]) for c in kept], "sheet_row")


def read_sheets(
    spark: SparkSession, folder: str, title_contains: str = SHEET_MARK, multiline: bool = True,
) -> DataFrame:
    """All sheets whose title contains the mark, with standard names and lineage."""
    titles = sheet_titles(spark, folder, title_contains)
    if not titles:
        raise FileNotFoundError(f"no sheet with {title_contains!r} in its title below {folder}")
    return union_all([
        with_lineage(standardize_columns(read_sheet(spark, folder, t, multiline)), unquote(t)) for t in titles
    ])
