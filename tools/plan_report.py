"""Write PLANS.md: the physical plans of the main queries as they would be
planned for large tables (automatic broadcast off, static plan), reduced to
shuffles, join strategies and what each scan reads."""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from basketry.plans.queries import REGISTRY  # noqa: E402
from basketry.session import local_session  # noqa: E402

QUERIES = ["customer_rfm", "customer_lifetime_value", "customer_features", "items_per_order",
           "items_per_customer", "returns_per_customer", "cohort_retention", "channel_performance",
           "return_drivers", "revenue_by_day", "top_categories", "purchase_summary", "churn_labels"]


def main(sf: str = "/root/testdata/sf0.01", out: str = "PLANS.md") -> None:
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    lines = ["# PLANS", "",
             "Physical plans of the main queries, planned as for large tables (`autoBroadcastJoinThreshold=-1`, AQE off so",
             "the static plan is shown; at run time AQE may still turn a small side into a broadcast and split skewed",
             "partitions). Produced by `tools/plan_report.py` at sf0.01.", "",
             "| query | hash shuffles | sort-merge joins | broadcast joins | nested-loop / cartesian |",
             "| --- | --- | --- | --- | --- |"]
    details = []
    for name in QUERIES:
        plan = REGISTRY[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        count = lambda pat: len(re.findall(pat, plan))
        lines.append(f"| {name} | {count(r'Exchange hashpartitioning')} | {count(r'SortMergeJoin')} | "
                     f"{count(r'BroadcastHashJoin')} | {count(r'BroadcastNestedLoopJoin|CartesianProduct')} |")
        details.append(f"### {name}\n")
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: [^\[]*\[file:[^\]]*/([a-z]+)\.parquet\]"
                             r"(?:.*?PushedFilters: (\[[^\]]*\]))?", plan):
            cols, table, pushed = m.group(1), m.group(2), m.group(3) or "[]"
            cols = ", ".join(re.sub(r"#\d+L?", "", c).strip() for c in cols.split(","))
            details.append(f"* `{table}`: reads {cols}; pushed filters {re.sub(r'#[0-9]+L?', '', pushed)}")
        details.append("")
    open(out, "w").write("\n".join(lines + ["", "## Scans", ""] + details) + "\n")


if __name__ == "__main__":
    main(*sys.argv[1:])
