"""Print the physical plans of the main operators (regenerates PLANS.md).

Usage: python tools/show_plans.py [SF_DIR] > PLANS.md
Only the operator lines of each plan are kept: scans (with pushed filters and
read schema), exchanges, joins, aggregates, generators and sorts.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortline.operators import cohort as cohort_ops  # noqa: E402
from cohortline.plans import queries as Q  # noqa: E402
from cohortline.session import get_session, scratch_dir  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Generate|Sort \[|Scan|Union|Window|Filter \(")


def excerpt(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\],?", "", line)
            out.append(line[:220])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    placement = Q._placement(spark, sf, scratch_dir(spark, "plans"))
    cases = [
        ("events_infusions: one scan of the table, three events by Generate", Q.events_infusions(spark, sf)),
        ("events_diagnoses: discharge-time lookup, time filter pushed to the lookup",
         Q.events_diagnoses(spark, sf)),
        ("static_fix: death-time aggregate (partial before the exchange), broadcast", Q.static_fix(spark, sf)),
        ("subject_shard_number: checkpointed subjects, bounded broadcast offsets, bucket window",
         Q.subject_shard_number(spark, sf)),
        ("cohort finalize: subjects' places joined, one exchange, duplicates removed and rows sorted in their task",
         cohort_ops.finalize(Q._cohort_events(spark, sf), placement)),
        ("page_links: one pass over pages", Q.page_links(spark, sf)),
        ("manifest_audit: full outer join of file hashes and the parsed manifest", Q.manifest_audit(spark, sf)),
    ]
    print("# Physical plans of the main operators\n")
    print(f"Generated by `python tools/show_plans.py {sf}` (final adaptive plans, operator lines only).\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{excerpt(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
