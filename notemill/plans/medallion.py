"""Refreshing the tables, from landed frames to gold.

Note tables are refreshed for changed songs only; tables with one row per song,
dispute or level are rebuilt (they are small, and a rebuilt row cannot go
stale). An incremental run ends in the same rows as a full one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.functions.scalars import DEFAULT_LANES
from notemill.operators import cdc, chart, density, gold, notes, playlist, reliability
from notemill.operators.density import JUDGE, Kernel
from notemill.session import saved
from notemill.sources import tables

# Table -> (key column, whether it is bucketed by song), in dependency order.
TABLES: dict[str, tuple[str, bool]] = {
    "bronze__songlist": ("id", False),
    "bronze__charts": ("song_id", True),
    "bronze__playlist": ("level", False),
    "bronze__contested": ("song_name", False),
    "silver__playlist": ("song_id", False),
    "silver__notes": ("song_id", True),
    "silver__notes_adjusted": ("song_id", True),
    "silver__vertical_density": ("song_id", True),
    "silver__horizontal_density": ("song_id", True),
    "silver__chart_features": ("song_id", False),
    "silver__contested": ("song_name", False),
    "silver__reliability_scores": ("new_difficulty", False),
    "gold__features": ("song_id", True),
}

VERSION = ["swf_version"]


@contextmanager
def database(spark: SparkSession, name: str, location: str | None = None) -> Iterator[str]:
    """Work in a database of that name, at ``location`` or else in the warehouse: both outlive the session."""
    before = spark.catalog.currentDatabase()
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.quoted(name)}{place}")
    spark.catalog.setCurrentDatabase(name)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)


def ledger(name: str) -> str:
    """The table of what a note table was built from: (song_id, versions)."""
    return f"{name}__ledger"


def plan_mode(exists: bool, has_changes: bool) -> str:
    """``full`` for a missing table, else ``incremental`` or ``skip``."""
    if not exists:
        return "full"
    return "incremental" if has_changes else "skip"


@dataclass
class Medallion:
    """The tables of one database. ``report`` lists (table, mode) of the last run."""

    spark: SparkSession
    as_of_year: int
    buckets: int = 64
    lanes: int = DEFAULT_LANES
    kernel: Kernel = JUDGE
    report: list[tuple[str, str]] = field(default_factory=list)

    # -- helpers ---------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return tables.read_bucketed(self.spark, name) if TABLES[name][1] else tables.read_table(self.spark, name)

    def exists(self, name: str) -> bool:
        return tables.table_exists(self.spark, name)

    def songs(self, name: str, keys: DataFrame | None) -> DataFrame:
        """A note table, all of it or the given songs."""
        if keys is None:
            return self.table(name)
        return tables.read_songs(self.spark, name, keys)

    def rebuild(self, name: str, rows: DataFrame) -> None:
        tables.publish(rows, name)
        self.report.append((name, "full"))

    def refresh(
        self, name: str, source: DataFrame, versions: list[str], transform: Callable[[DataFrame | None], DataFrame],
        held: DataFrame | None = None,
    ) -> None:
        """Bring one note table up to date with ``source`` (song_id, versions).

        What was processed is kept in a ledger (song_id, versions) beside the
        table, and only that is compared: an idle run reads no notes, and a song
        that has no rows to show is not processed again. The ledger follows the
        table, so a run that died between the two repeats its songs. Songs that
        left the source leave the table.
        """
        source = saved(source, "tokens")
        if not self.exists(name):
            tables.create_bucketed(transform(None), name, self.buckets)
            tables.publish(source, ledger(name))
            self.report.append((name, plan_mode(False, True)))
            return
        if self.exists(ledger(name)):
            held = tables.read_table(self.spark, ledger(name))
        held = self.table(name) if held is None else held
        changed, touched = self.frozen_changes(
            cdc.changed_keys(source, held, "song_id", versions, null_safe=True),
            cdc.deleted_keys(held, source, "song_id"),
        )
        mode = plan_mode(True, not touched.isEmpty())
        if mode == "incremental":
            tables.replace_songs(self.spark, name, transform(changed), touched)
        if mode == "incremental" or not self.exists(ledger(name)):
            tables.publish(source, ledger(name))
        self.report.append((name, mode))

    @staticmethod
    def frozen_changes(changed: DataFrame, deleted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Changed keys, and changed or deleted keys, from one written table."""
        key = changed.columns[0]
        both = cdc.freeze(
            changed.withColumn("_changed", F.lit(True)).unionByName(deleted.withColumn("_changed", F.lit(False)))
        )
        return both.filter("_changed").select(key), both.select(key)

    def charted(self) -> DataFrame:
        """(song_id, swf_version) of listed songs whose chart has notes."""
        charts = self.table("bronze__charts").filter("notes > 0").select("song_id").distinct()
        songs = self.table("bronze__songlist").select(F.col("id").alias("song_id"), "swf_version")
        return cdc.scope(songs, charts, "song_id")

    # -- bronze ----------------------------------------------------------------

    def ingest_songs(self, songlist: DataFrame, charts: DataFrame) -> None:
        """Store the song list and the charts of new and updated songs."""
        first = not self.exists("bronze__songlist")
        held = songlist.limit(0) if first else self.table("bronze__songlist")
        as_song = lambda keys: keys.withColumnRenamed("id", "song_id")
        changed, affected = self.frozen_changes(
            as_song(cdc.changed_keys(songlist, held, "id", "swf_version", null_safe=True)),
            as_song(cdc.deleted_keys(held, songlist, "id")),
        )
        # The length is stored so that later steps need not read the nested charts for it.
        # A payload that landed twice counts once; one without notes has not arrived.
        arrived = cdc.latest_payloads(cdc.scope(charts, changed, "song_id")).withColumn("notes", F.size("chart"))
        arrived = saved(arrived.filter("notes > 0"), "arrived")
        if not self.exists("bronze__charts"):
            tables.create_bucketed(arrived, "bronze__charts", self.buckets)
            mode = "full"
        else:
            deleted = affected.join(changed, "song_id", "left_anti")
            touched = cdc.freeze(cdc.combine_keys(arrived.select("song_id"), deleted))
            mode = plan_mode(True, not touched.isEmpty())
            if mode == "incremental":
                tables.replace_songs(self.spark, "bronze__charts", arrived, touched)
        self.report.append(("bronze__charts", mode))
        self.rebuild("bronze__songlist", cdc.settle_versions(songlist, held, arrived.select("song_id")))

    def ingest_playlist(self, raw: DataFrame) -> None:
        self.rebuild("bronze__playlist", playlist.widen_numbers(raw))

    def ingest_contested(self, raw: DataFrame) -> None:
        self.rebuild("bronze__contested", raw)

    # -- silver ----------------------------------------------------------------

    def refresh_playlist(self) -> None:
        self.rebuild(
            "silver__playlist", playlist.clean_playlist(self.table("bronze__playlist"), self.table("bronze__songlist"))
        )

    def refresh_notes(self) -> None:
        """The version joins the charts, one row per song, and rides along from there."""
        listed = self.table("bronze__songlist")
        build = lambda keys: notes.explode_notes(
            cdc.with_version(self.songs("bronze__charts", keys), listed), self.lanes, VERSION
        )
        self.refresh("silver__notes", self.charted(), VERSION, build)

    def refresh_adjusted(self) -> None:
        build = lambda keys: notes.merge_chords(
            notes.separate_ties(self.songs("silver__notes", keys)), self.lanes, carry=VERSION
        )
        self.refresh("silver__notes_adjusted", self.charted(), VERSION, build)

    def refresh_vertical(self) -> None:
        build = lambda keys: density.vertical_density(
            notes.split_chords(self.songs("silver__notes_adjusted", keys), self.lanes), carry=VERSION
        )
        self.refresh("silver__vertical_density", self.charted(), VERSION, build)

    def refresh_horizontal(self) -> None:
        build = lambda keys: density.horizontal_density(
            self.songs("silver__notes_adjusted", keys), self.kernel, self.lanes, carry=VERSION
        )
        self.refresh("silver__horizontal_density", self.charted(), VERSION, build)

    def refresh_chart_features(self) -> None:
        """All songs each time: one row per song, and a moved percentile moves every row."""
        self.rebuild("silver__chart_features", chart.chart_features(self.table("bronze__songlist")))

    def refresh_contested(self) -> None:
        scored = reliability.reliability_weights(
            self.table("bronze__contested"), self.table("silver__playlist"), self.as_of_year
        )
        self.rebuild("silver__contested", reliability.dq_filter(scored))

    def refresh_reliability(self) -> None:
        self.rebuild("silver__reliability_scores", reliability.reliability_scores(self.table("silver__contested")))

    # -- gold ------------------------------------------------------------------

    def refresh_gold(self) -> None:
        """Songs whose version, label, weight or length feature changed.

        Both densities come from the chords in one pass, so no two tables of
        notes are joined.

        Derived doubles are compared rounded: their last bits depend on the
        order of a sum. A gold table from before versions were kept counts as
        changed throughout.
        """
        facts = gold.song_facts(
            self.table("silver__chart_features"), self.table("silver__playlist"),
            self.table("silver__reliability_scores"),
        )
        tokens = {
            "_weight": F.round("sample_weight", 9), "_length": F.round("song_length_log_normalized", 9),
        }
        versions = ["swf_version", "difficulty", *tokens]
        source = self.charted().join(facts, "song_id").withColumns(tokens).select("song_id", *versions)
        held = None
        if self.exists("gold__features"):
            held = self.table("gold__features").withColumns(tokens)
            held = held.select("song_id", *[v for v in versions if v in held.columns])

        def build(keys: DataFrame | None) -> DataFrame:
            wanted = self.charted().join(facts, "song_id")
            if keys is not None:
                wanted = cdc.scope(wanted, keys, "song_id")
            return gold.features_of_songs(
                self.songs("silver__notes_adjusted", keys), saved(wanted, "song-facts"), self.kernel, self.lanes
            )

        self.refresh("gold__features", source, versions, build, held)

    # -- runs ------------------------------------------------------------------

    def run(self, songlist: DataFrame, charts: DataFrame, raw_playlist: DataFrame, contested: DataFrame) -> list[tuple[str, str]]:
        """All tables in dependency order; returns (table, mode)."""
        self.report = []
        self.ingest_songs(songlist, charts)
        self.ingest_playlist(raw_playlist)
        self.ingest_contested(contested)
        self.refresh_all()
        return self.report

    def refresh_all(self) -> None:
        """Silver and gold from the bronze tables."""
        self.refresh_playlist()
        self.refresh_notes()
        self.refresh_adjusted()
        self.refresh_vertical()
        self.refresh_horizontal()
        self.refresh_chart_features()
        self.refresh_contested()
        self.refresh_reliability()
        self.refresh_gold()

    def reset(self) -> None:
        tables.drop_tables(self.spark, [*TABLES, *[ledger(name) for name in TABLES]])
