"""Write condensed physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/show_plans.py [sf_dir]
For each query: the operator tree of ``explain("formatted")`` plus the scan's
ReadSchema / PushedFilters and every Exchange's partitioning.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SHOW = ["rank_article_24h", "rank_article_24h_entry", "rollup_article_7d", "profile_7d", "profile_lineitem_30d",
        "profile_lines_24h", "valid_comments", "csv_roundtrip"]


def condensed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().split("\n")[0] if block.strip() else ""
        for line in block.split("\n"):
            if re.match(r"^(ReadSchema|PushedFilters)", line) or (
                    "Exchange" in head and line.startswith("Arguments")):
                keep.append(f"{head}: {line[:160]}")
    return tree.strip() + "\n\n" + "\n".join(keep)


def main(argv: list[str]) -> None:
    from windtally import get_spark
    from windtally.plans.catalog import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans (condensed)", "",
           f"Generated by `python tools/show_plans.py` on `{os.path.basename(sf_dir)}` "
           "(AQE initial plans; the final plans only coalesce partitions).", ""]
    for name in SHOW:
        out += [f"## {name}", "", "```", condensed(QUERIES[name](spark, sf_dir)), "```", ""]
    with open(f"{ROOT}/docs/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
