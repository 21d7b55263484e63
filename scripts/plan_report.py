"""Write PLANS.md: for every registered query of the core, the shape of its physical plan at a scale factor
(shuffles, join strategies, aggregate and window operators), read from Spark's own plans.

usage: python scripts/plan_report.py [sf_dir] [out.md]
"""
from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = {
    "Exchange hashpartitioning": "hash shuffle",
    "Exchange rangepartitioning": "range shuffle",
    "Exchange RoundRobinPartitioning": "spread",
    "Exchange SinglePartition": "single-partition",
    "BroadcastExchange": "broadcast",
    "BroadcastHashJoin": "BHJ",
    "SortMergeJoin": "SMJ",
    "ShuffledHashJoin": "SHJ",
    "HashAggregate": "hash agg",
    "ObjectHashAggregate": "object agg",
    "SortAggregate": "sort agg",
    "Window": "window",
    "TakeOrderedAndProject": "top-k",
    "Generate": "explode",
}


def shape(plan: str) -> Counter:
    c = Counter()
    for line in plan.splitlines():
        node = re.sub(r"^[\s:+\-|*()0-9]*", "", line)
        for k, v in KINDS.items():
            if node.startswith(k):
                c[v] += 1
                break
    return c


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = Path(sys.argv[2] if len(sys.argv) > 2 else Path(__file__).resolve().parents[1] / "PLANS.md")
    from adherence.plans import catalog
    from adherence.session import local_session

    spark = local_session(shuffle_partitions=16)
    cols = list(dict.fromkeys(KINDS.values()))
    lines = [f"# Physical plan shapes ({Path(sf_dir).name}, initial AQE plan)", "",
             "Counts of operators in each registered query's physical plan, generated by "
             "`scripts/plan_report.py`. AQE may still turn a SMJ into a broadcast at runtime.", "",
             "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, fn in sorted(catalog.QUERIES.items()):
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = shape(plan)
        lines.append(f"| {name} | " + " | ".join(str(c.get(k, "")) for k in cols) + " |")
    out.write_text("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
