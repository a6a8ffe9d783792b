"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated) a
selection. Each query runs to its last row into a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "w1_rain_days_per_location",
    "w1_next_flag_in_chunks",
    "w2_latest_row_per_group",
    "w4_codes_by_first_appearance",
    "w5_positions_in_order",
    "p7_f5_f6_drop_word_rows",
    "j2_attach_location",
    "j2_attach_large_dimension",
    "j3_drop_existing_independent",
    "j4_drop_existing_pair",
    "j8_pending_bulletins",
    "a1_modes",
    "i1_impute_mode",
    "a2_median_by_group",
    "a2_median_by_many_groups",
    "i2_u3_impute_group_median",
    "a3_quartiles",
    "i3_f7_cap_iqr",
    "a6_o5_null_shares",
    "a9_correlation_matrix",
    "f8_min_max_scale",
    "a12_classification_report",
    "a13_regression_metrics",
    "i5_balance_many_classes_of_rows",
    "m2_stratified_split",
    "f9_text_between",
    "s2_digest_of_bulletins",
    "s7_o1_sorted_csv",
    "s8_s10_append_new_rows",
    "m11_j6_o3_version_listing",
    "k1_daily_from_bulletins",
    "k1_clean_balanced",
    "m3_p9_forest_metrics",
]


def main() -> None:
    from petrichor.session import build_session
    from petrichor.workload import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__files__maxPartitionBytes="8m",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
