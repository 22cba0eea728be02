"""Count shuffles and joins in each registered query's physical plan (before AQE re-planning)."""

from __future__ import annotations

import json
import sys

sys.path.insert(0, ".")
from vigil.plans.catalog import QUERIES  # noqa: E402
from vigil.session import get_session  # noqa: E402


def stats(df):
    p = df._jdf.queryExecution().executedPlan().toString()
    return {"exchanges": p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning")
            + p.count("Exchange SinglePartition") + p.count("Exchange RoundRobinPartitioning"),
            "broadcast_exchanges": p.count("BroadcastExchange"),
            "nested_loop": p.count("BroadcastNestedLoopJoin"), "cartesian": p.count("CartesianProduct"),
            "windows": p.count("Window ")}


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", 8)
    skip = {"gbt_scores", "gbt_importance"}
    out = {n: stats(f(spark, d)) for n, f in QUERIES.items() if n not in skip}
    print(json.dumps(out, indent=1))


if __name__ == "__main__":
    main()
