"""Plan and execution summary of every catalogue query (writes PLANS.md).

For each query on the given scale factor: the Spark jobs, stages and tasks
one run of the job executes (reused exchanges and subqueries are not
re-run, so this is the real work, unlike plan text where a reused
subquery is printed at every reference), plus flags read from the
physical plan: broadcast joins, nested-loop joins, Python evaluation and
partial window group limits.  Materialised intermediates (checkpoints)
count in the run that builds the query.
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def flags(plan: str) -> dict:
    return {
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "nested_loop": len(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython", plan)),
        "partial_limit": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
    }


def main() -> None:
    from lodestar.plans.catalogue import CATALOGUE
    from lodestar.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session()
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    cols = ["jobs", "stages", "tasks", "sec", "bhj", "smj", "nested_loop", "python", "partial_limit"]
    lines = [
        "# Execution and plan summary of the catalogue queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf}`, local[8]. `jobs/stages/tasks` = what one build + run",
        "executes (size checks and checkpoints included; reused exchanges / subqueries not repeated).",
        "`bhj` / `smj` = broadcast-hash / sort-merge joins in the static plan text, where a scalar subquery",
        "is printed at every reference although it runs once (so joins inside the limits subquery of the",
        "histogram / raster jobs are counted per reference); adaptive execution may also turn sort-merge",
        "into broadcast at run time. `nested_loop` only appears where the bounded table of",
        "group moments is paired (pairwise t); `python` only where p values are computed on that table;",
        "`partial_limit` = window group limits applied before the shuffle (top-k with ties).",
        "",
        "| query | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---:" for _ in cols) + " |",
    ]
    for i, key in enumerate(sorted(CATALOGUE)):
        fn, _ = CATALOGUE[key]
        group = f"report-{i}"
        sc.setJobGroup(group, key)
        try:
            t0 = time.perf_counter()
            df = fn.job(spark, sf)
            plan = df._jdf.queryExecution().executedPlan().toString()
            df.write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            jobs = tracker.getJobIdsForGroup(group)
            stage_ids = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
            infos = [tracker.getStageInfo(s) for s in stage_ids]
            tasks = sum(si.numTasks for si in infos if si is not None)
            f = flags(plan)
            row = {"jobs": len(jobs), "stages": len(stage_ids), "tasks": tasks, "sec": f"{sec:.2f}", **f}
            lines.append(f"| {key} | " + " | ".join(str(row[c]) for c in cols) + " |")
        except Exception as ex:  # noqa: BLE001
            lines.append(f"| {key} | failed: {type(ex).__name__} |" + " |" * (len(cols) - 1))
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out} ({len(CATALOGUE)} queries)")


if __name__ == "__main__":
    main()
