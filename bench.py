"""Benchmark: run the registered queries on one scale factor, print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query is executed in full into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  Before timing, every selected
query runs once, untimed, on the smallest scale factor next to
``BENCH_SF_DIR`` (``BENCH_WARMUP_DIR``; empty string disables) so JVM start-up,
class loading and JIT compilation are not billed to whichever query happens
to run first.  The reported time per query is the best of ``BENCH_REPEAT``
timed runs (default 1) at ``BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from insight.plans.registry import load_all  # noqa: E402
from insight.session import local_session  # noqa: E402

HEADLINE = [
    "guest_origin_top5_numeric", "avg_rate_per_person_text", "rate_by_room_type_band",
    "busy_months_censored", "stay_length_top5_per_group", "totals_by_year_month",
    "column_summary", "column_mean_sd", "freq_3way", "corr_matrix", "boxplot_stats",
    "pair_bins", "na_positions", "column_uniques", "term_counts", "vocabulary",
    "post_search", "page_search_excluding_site", "page_links", "page_body_text",
    "nb_metrics", "score_posts", "score_pages",
]


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    which = os.environ.get("BENCH_QUERIES", "all")
    plans, _ = load_all()
    names = argv[1:] or (sorted(plans) if which == "all" else HEADLINE)
    # one task wave per shuffle on the local cores (measured faster than 2x at sf0.1)
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus)))))
    spark = local_session(cores=cpus, shuffle_partitions=shuffle, driver_memory="16g", app="insight-bench")

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            try:
                plans[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # the timed pass reports failures
                pass
    else:
        plans["dims"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                plans[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # keep benchmarking the rest
                failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
                best = None
                break
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "n_queries": len(times),
        "cpus": int(cpus),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
