"""Print the physical plans of headline queries (docs/PLANS.md is made from this).

    python tests/plan_report.py [sf_dir] > docs/PLANS.md

Broadcast joins are switched off so the plans show the shape they take when
every table is large (shuffle joins); AQE is off so the static plan prints.
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from insight.plans.registry import load_all  # noqa: E402
from insight.session import local_session  # noqa: E402

QUERIES = ["guest_origin_top5_numeric", "stay_length_top5_per_group", "year_price_by_month", "corr_matrix",
           "freq_3way", "boxplot_stats", "nb_predict", "page_links"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans, _ = load_all()
    print("# Physical plans of headline queries (broadcast joins off, AQE off)\n")
    print("Generated by `tests/plan_report.py`; file paths shortened.\n")
    for name in QUERIES:
        df = plans[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:[^\]]*/", "", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        lines = [ln[:260] for ln in plan.splitlines()]
        ex = sum("Exchange" in ln for ln in lines)
        print(f"## {name}\n\nexchanges: {ex}, "
              f"partial aggregates: {sum('partial_' in ln for ln in lines)}, "
              f"cartesian products: {sum('CartesianProduct' in ln for ln in lines)}\n")
        print("```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
