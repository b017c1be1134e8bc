"""Write the executed physical plan of every catalogued query to PLANS.md.

    python tools/plans.py [sf_dir]

Plans are taken after execution, so they show AQE's final choices
(coalesced shuffles, broadcast or sort-merge joins, reused exchanges).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opslens.plans.catalogue import QUERIES  # noqa: E402
from opslens.session import build_session  # noqa: E402

KEEP = re.compile(r"(Scan|Exchange|Aggregate|Join|Expand|Generate|Subquery|Union|Window|Sort|Limit|"
                  r"TakeOrdered|Filter|Project|Coalesce|Reused|InMemory|Write)")


def skeleton(plan: str) -> str:
    """Operator lines only, with long argument lists cut."""
    out = []
    plan = plan.split("== Initial Plan ==")[0]  # AQE prints the final plan first
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[id=\d+\]|\[plan_id=\d+\]", "", line)
        out.append(line[:160].rstrip())
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    parts = ["# Executed physical plans\n",
             f"Generated by `tools/plans.py` at `{sf_dir}`; operator lines only, ids removed.\n"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts.append(f"## {name}\n\n```\n{skeleton(plan)}\n```\n")
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(parts))


if __name__ == "__main__":
    main()
