"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   data folder   (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_ONLY     comma-separated query names, for a partial run
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palmares.queries import load  # noqa: E402
from palmares.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_degrees_by_place",
    "f1_null_tolerant_exclusion",
    "f4_rule_delete",
    "r2_replace_by_year_and_code",
    "r3_replace_by_source_wildcards",
    "r4_commune_registration_rules",
    "r11_multi_output_rules",
    "r13_cycle_override_tiers",
    "l2_tiered_lookup",
    "l7_pair_proximity",
    "l17_star_denormalise",
    "l19_lookup_conflicts",
    "d4_degree_group",
    "d5_late_early",
    "a1_cube_with_flag_sums",
    "a2_resum_of_cube",
    "a3_publication_sums",
    "u5_distinct_combinations",
    "normalise_facts",
    "correct_facts_by_source",
    "a3_published_table",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    registry = load()
    registry["a5_row_metrics"].run(spark, folder).collect()  # start the JVM paths and the file cache
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        registry[name].run(spark, folder).write.mode("overwrite").format("noop").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
