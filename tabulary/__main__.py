"""Command line: build the catalog from a folder of CSV files, replace the nine
stored tables in OUT_DIR/tables all at once, and write / print the validation report.

    python -m tabulary build SOURCES_DIR OUT_DIR [--collation UTF8_LCASE_RTRIM]
                             [--expect zero|published]
    python -m tabulary validate OUT_DIR [--expect zero|published]

Run it with ``spark-submit`` on a cluster (set ``spark.checkpoint.dir`` to a
shared folder); without a master it starts a local session.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.quality import CheckFailed, assert_checks
from .plans.catalog import PUBLISHED_RESULTS, build_catalog, refresh_catalog, validate
from .session import ensure_checkpoint_dir, local_session
from .sources.csv import read_sources
from .sources.store import TableStore


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    try:
        spark = SparkSession.builder.getOrCreate()
    except Exception:  # noqa: BLE001 - no master configured
        spark = local_session("*")
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tabulary")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="load CSV sources, write the catalog and its checks")
    b.add_argument("sources")
    b.add_argument("out")
    b.add_argument("--collation", default=None, help="collation for name keys")
    v = sub.add_parser("validate", help="check a written catalog")
    v.add_argument("out")
    for p in (b, v):
        p.add_argument("--expect", choices=["zero", "published"], default="zero",
                       help="'published': gate on the counts published for the original files")
    args = ap.parse_args(argv)

    spark = _session()
    out = args.out.rstrip("/")
    store = TableStore(spark, f"{out}/tables")
    if args.cmd == "build":
        tables = build_catalog(read_sources(spark, args.sources), args.collation)
        counts = refresh_catalog(tables, store)
        print(json.dumps({"rows": counts}))
    else:
        tables = store.snapshot()
    report = validate(tables, PUBLISHED_RESULTS if args.expect == "published" else None)
    report.write.mode("overwrite").parquet(f"{out}/_checks")
    for r in spark.read.parquet(f"{out}/_checks").orderBy("check_name").collect():
        print(f"{'ok ' if r.passed else 'BAD'} {r.check_name}: {r.issue_count}")
    try:
        assert_checks(spark.read.parquet(f"{out}/_checks"))
    except CheckFailed as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
