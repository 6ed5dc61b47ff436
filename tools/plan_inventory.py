"""Physical-plan inventory of every registered query (dev tool).

Runs each query once (collect at sf0.01), takes the final adaptive plan (automatic broadcast off) and counts
what each costs: shuffle exchanges (materialised shuffle stages), broadcasts, join
strategies, windows, aggregates, generators and any Python evaluation.  Subquery
plans are included.  Writes a markdown table to stdout.

    python tools/plan_inventory.py [/root/testdata/sf0.01] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :"))


def final_plan_text(df) -> str:
    """The executed plan with every "Initial Plan" block and repeated subquery removed."""
    text = df._jdf.queryExecution().executedPlan().toString()
    out, skip_at, seen = [], None, set()
    for line in text.splitlines():
        ind = _indent(line)
        if skip_at is not None:
            if ind > skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = ind
            continue
        m = re.search(r"^\s*[:| ]*\+- (?:Subquery|SubqueryBroadcast) subquery#(\d+)", line)
        if m:
            if m.group(1) in seen:
                skip_at = ind
                continue
            seen.add(m.group(1))
        out.append(line)
    return "\n".join(out)


def count(text: str) -> dict:
    ex = r"Exchange (?:hashpartitioning|SinglePartition|rangepartitioning|RoundRobinPartitioning)"
    return {
        "shuffles": len(set(re.findall(ex + r".*?\[plan_id=(\d+)\]", text))),
        "reused": len(re.findall(r"ReusedExchange", text)),
        "broadcasts": len(set(re.findall(r"BroadcastExchange .*?\[plan_id=(\d+)\]", text))),
        "smj": len(re.findall(r"SortMergeJoin", text)),
        "bhj": len(re.findall(r"BroadcastHashJoin", text)),
        "windows": len(re.findall(r"\bWindow \[", text)),
        "aggs": len(re.findall(r"(?:Hash|Sort|ObjectHash)Aggregate\(", text)),
        "generate": len(re.findall(r"Generate ", text)),
        "python": len(re.findall(r"(?:BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", text)),
        "cartesian": len(re.findall(r"(?:CartesianProduct|BroadcastNestedLoopJoin)", text)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from laminar.plans.registry import QUERIES
    from laminar.session import build_session
    spark = build_session(shuffle_partitions=8)
    # as at scale, where no side is small enough on its own: only checked broadcasts remain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["shuffles", "reused", "broadcasts", "smj", "bhj", "windows", "aggs", "generate", "python",
            "cartesian"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for key, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()
        c = count(final_plan_text(df))
        print(f"| {key} | " + " | ".join(str(c[k]) for k in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
