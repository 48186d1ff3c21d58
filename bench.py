"""Time headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 2: the first run warms up, the median of the others counts),
BENCH_QUERIES (comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import all_queries  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = (
    "a4_word_count a3_group_agg j2_join_star a12_regular_report a13_quality_gate a10_profile_orders w1_rank_within w2_lag_delta "
    "w3_running_total w3_moving_mean a5_parse_access_log a6_status_counts s3_read_csv s4_write_partitioned p1_extract_links "
    "p6_mark_fences p12_clean_shell_blocks a1_link_audit_summary j1_broken_links a9b_count_min g3_erase_subjects g7_fingerprint "
    "g8_redact_text t1_tumbling_counts t3_sessions m2_logistic m8_text_classifier m9_tfidf m18_rolling_anomalies u1_per_group_model"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, "bench", os.environ.get("BENCH_MEMORY", "16g"))
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
