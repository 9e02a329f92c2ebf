"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (folder of the tables), BENCH_CPUS. Each query is run in full, its rows
discarded; the first of two runs is warm-up and not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from anteframe.session import build_session
from catalog import QUERIES

HEADLINE = [
    "asof_latest_features",
    "asof_latest_features_fine",
    "latest_with_minutes_before",
    "lookback_pairs",
    "lookback_join_counts",
    "features_keep_unmatched",
    "mean_pivot",
    "coverage_curve",
    "time_window_matrix",
    "timing_stats",
    "history_flags",
    "training_table",
    "longest_prefix_group",
    "report_head",
    "latest_version",
    "unique_per_day",
    "single_or_null",
    "null_safe_join",
    "delay_rows",
    "delay_histogram",
    "counts_by_year",
    "unit_inventory",
    "value_counts_normalised",
    "null_profile",
    "range_normalise",
    "lenient_decimal",
    "embedded_time",
    "quarter_hour_audit",
    "lab_cleaning",
    "lab_features",
    "diagnoses_with_group",
    "unique_reports",
    "cohort_for_labelling",
    "feature_tradeoff",
    "clinic_training_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Small tables: keep all cores busy instead of merging partitions below 1 MB.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first run of a query warms up its generated code, the second one counts.
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
