"""Write the physical plans of the headline stages to PLANS.md.

    python tools/explain.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabulary.plans import analogues  # noqa: E402
from tabulary.plans.catalog import quality_checks  # noqa: E402
from tabulary.plans.registry import QUERIES, catalog  # noqa: E402
from tabulary.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    t = catalog(spark, sf)
    stages = [
        ("Medicine source: part + per-part minimum supplier (pre-aggregated line items)",
         analogues.medicine_source(spark, sf)),
        ("Generic-indication source: distinct (part, supplier) before any join",
         analogues.generic_indication_source(spark, sf)),
        ("Container child rows: keys from the parents' order, staged without a shuffle",
         t["medicine_package_container"]),
        ("Foreign-key checks: tagged union of child and parent keys, one aggregate", quality_checks(t, ("fk",))),
        ("Top manufacturers: per-key counts, left join keeping zeros, top-k",
         QUERIES["top_manufacturers"](spark, sf)),
        ("First line per order: map-side min(struct)", QUERIES["raw_first_line_per_order"](spark, sf)),
        ("Documents in neither child: distinct keys, anti joins",
         QUERIES["raw_documents_in_neither"](spark, sf)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `python tools/explain.py {sf}` (Spark {spark.version}, local[8]).", ""]
    for title, df in stages:
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        text = "\n".join(line if len(line) <= 300 else line[:300] + " ..."
                         for line in buf.getvalue().rstrip().splitlines())
        out += [f"## {title}", "", "```", text, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
