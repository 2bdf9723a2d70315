"""Write docs/plans.md: the physical plan tree (explain 'formatted', tree
part) of each headline query at sf0.01, plus the pruned scan schemas.

usage: python tools/explain_plans.py [--sf DIR]
"""
from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    import bench
    from staylens import registry
    from staylens.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `tools/explain_plans.py` at `{a.sf}` (local[8], AQE on; the",
           "initial plan: AQE may still turn sort-merge joins into broadcast joins",
           "at run time once it sees the real sizes).", ""]
    for name in bench.HEADLINE:
        df = registry.queries()[name](spark, a.sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
        out += [f"## {name}", "", "```", tree.strip(), "```", "", "Scans read:", ""]
        out += [f"* `{s}`" for s in scans] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "docs", "plans.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
