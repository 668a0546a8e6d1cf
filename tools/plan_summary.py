"""Write PLANS.md: the physical operator chain and Parquet read schema of
every registered query (python tools/plan_summary.py [sf_dir])."""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    from linedocs.plans import catalog
    from linedocs.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    jvm_mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plan_summary.py` on `{sf}` (local[8], AQE on; the plan",
           "before AQE re-optimisation). Operators from the root down to the scans;",
           "`Exchange` is a shuffle, `BroadcastExchange` a broadcast, `ArrowEvalPython`",
           "the Arrow prefix-sum UDF. `ReadSchema` is what the Parquet scan reads.", "",
           "In `file_lines_with_offset` the small per-split table written by pass 1 is",
           "broadcast (within its size bound); pass 2 has no",
           "shuffle and the lines themselves are never shuffled.", ""]
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops = []
        for line in plan.splitlines():
            m = re.match(r"^[\s:+\-*()0-9]*([A-Z][A-Za-z]+)", line)
            if m and m.group(1) not in ("AdaptiveSparkPlan",):
                ops.append(m.group(1))
        text = df._jdf.queryExecution().explainString(jvm_mode)
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
        shuffles = sum(1 for o in ops if o == "Exchange")
        out.append(f"## `{name}`")
        out.append("")
        out.append(f"- operators: {' <- '.join(ops)}")
        out.append(f"- shuffles: {shuffles}; broadcasts: {sum(1 for o in ops if o == 'BroadcastExchange')}")
        for s in schemas:
            out.append(f"- ReadSchema: `{s}`")
        out.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
