"""Plan audit: the physical operators that matter at scale, per registered analysis.

``python -m tablecraft.plans.audit [sf_dir] > PLANS.md`` writes one row per
analysis with its shuffle exchanges (by kind), join strategies, windows,
top-k operators, distinct scalar subqueries, generators and any Python
evaluation, read from the physical plan Spark chose (before adaptive
re-planning, which can only remove shuffles or turn joins into broadcasts).
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition shuffles": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "top-k": r"TakeOrderedAndProject",
    "generators": r"\bGenerate ",
    "python": r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas",
}


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Operator counts of ``df``'s physical plan; subqueries counted once each."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    out["scalar subqueries"] = len(set(re.findall(r"Subquery subquery#(\d+)", plan)))
    return out


def main() -> None:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from tablecraft.plans import queries
    from tablecraft.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=8)
    cols = list(PATTERNS) + ["scalar subqueries"]
    print("# Plan audit\n")
    print(f"Physical plans of the registered analyses (`python -m tablecraft.plans.audit {sf_dir}`).")
    print("Counts are operators in the plan Spark chose before adaptive re-planning; shuffles inside")
    print("scalar subqueries are included, each distinct subquery once.  Model fits are not listed.\n")
    print("| analysis | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in sorted(queries().items()):
        if name in ("tune_forest", "predict_class"):
            continue
        s = plan_summary(fn(spark, sf_dir))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
