"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion into a ``noop`` sink: once to warm up, then
``BENCH_RUNS`` times (default 3), of which the median counts. Whole pipeline
runs (``ONCE``) are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from notemill.plans.queries import QUERIES  # noqa: E402
from notemill.session import build_session, clear_scratch  # noqa: E402

HEADLINE = (
    "note_1_explode_notes",
    "note_2_separate_ties",
    "note_3_merge_chords",
    "den_1_vertical_density",
    "den_3_horizontal_density",
    "den_3_horizontal_density_by_pairs",
    "den_note_densities",
    "cht_1_chart_features",
    "cdc_4_changed_keys",
    "dml_1_merge_upsert",
    "dml_4_replace_by_key",
    "prj_11_clean_playlist",
    "rel_2_forward_fill",
    "rel_12_reliability_weights",
    "rel_13_song_consensus",
    "rel_16_reliability_scores",
    "gld_2_assemble_features",
    "gld_features",
)
# Two whole pipeline runs each: timed once, without a warm-up.
ONCE = ("run_incremental_gold",)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - start
        clear_scratch(spark)
        return spent

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    for name in ONCE:
        seconds[name] = round(once(name), 3)
    print(json.dumps({
        "metric": "sum of headline query medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
