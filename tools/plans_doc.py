"""Write docs/PLANS.md: the physical plan tree of the headline queries.

Usage: python tools/plans_doc.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stockledger.config import build_session  # noqa: E402
from stockledger.plans.catalog import queries  # noqa: E402

NAMES = (
    "interval_stock",
    "daily_stock",
    "store_benefits",
    "family_rotation",
    "family_benefits_v2",
    "stock_as_of",
    "check_daily_expansion",
)


def tree_and_scans(df) -> tuple[str, list[str]]:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    scans = sorted(
        set(
            re.sub(r"#\d+L?", "", m)
            for m in re.findall(r"PushedFilters: \[[^\n]*\]\nReadSchema: [^\n]*", text)
        )
    )
    return tree, scans


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    q = queries()
    out = [
        "# Physical plans",
        "",
        f"Initial AQE plans (`explain(\"formatted\")`) of the headline queries on `{sf_dir}`,",
        "generated by `tools/plans_doc.py`. `Exchange` is a shuffle, `BroadcastExchange`",
        "ships the measured-small master. AQE may still coalesce partitions or turn a",
        "sort-merge join of tiny aggregates into a broadcast join at run time.",
        "",
    ]
    for name in NAMES:
        tree, scans = tree_and_scans(q[name](spark, sf_dir))
        shuffles = len(re.findall(r"(?<!Broadcast)Exchange \(", tree))
        out += [f"## {name}", "", f"Shuffles: {shuffles}", "", "```", tree.rstrip(), "```", ""]
        out += ["Scans (pushed filters, read schema):", ""]
        out += [f"* `{s.replace(chr(10), ' ')}`" for s in scans]
        out.append("")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
