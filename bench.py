"""Time the headline queries and print one JSON line.

Each query is collected through the no-op sink, so the whole result is computed but not moved to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = """
project_filter_sort case_bands date_functions dept_stats join_group_sum star_revenue region_order_totals group_to_bag
salted_aggregate dedup_by_key inner_join full_outer_join reduce_side_join join_to_group_average skew_join wordcount
wordcount_strip_punct inverted_index top_n_words rank_family top_n_per_group lag_lead running_total rows_frames
range_frame_value named_window global_sort sample_bytes split_relation streaming_mapreduce delta_compaction acid_update
upsert snapshot_diff cells_put_latest get_versions filter_list delete_tombstones bulk_load_sorted wide_from_cells
dynamic_partition_insert bucket_join count_from_stats jdbc_full_import interceptor_regex_extract stream_fanout
tumbling_sliding_session stateful_per_key merge_scd incremental_rollup
""".split()


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from weftline import registry
    from weftline.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()
    queries["global_count"](spark, sf_dir).collect()  # start the JVM's code paths outside the timing
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
