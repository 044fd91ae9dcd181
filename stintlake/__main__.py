"""Command line: ``python -m stintlake <command> ...``

    list [--describe]                      names (and summaries) of the registered queries
    run NAME [--sf DIR] [--show N] [--csv OUT]
                                           run one query (all teams), print or export it
    pipeline --raw DIR --store DIR --start Y --end Y
             [--incremental] [--strict] [--dry-run] [--skip-quality] [--team ID]
                                           the batch pipeline over raw CSV files
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stintlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ls = sub.add_parser("list")
    ls.add_argument("--describe", action="store_true", help="first docstring line of each query")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf", default="/root/testdata/sf0.01")
    r.add_argument("--show", type=int, default=20)
    r.add_argument("--csv", default=None)
    p = sub.add_parser("pipeline")
    p.add_argument("--raw", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--start", type=int, required=True)
    p.add_argument("--end", type=int, required=True)
    p.add_argument("--incremental", action="store_true")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--skip-quality", action="store_true")
    p.add_argument("--team", type=int, default=None)
    a = ap.parse_args(argv)

    from stintlake.plans import catalog

    if a.cmd == "list":
        reg = catalog.registry()
        for n in catalog.names():
            doc = (reg[n].__doc__ or "").strip().splitlines()
            print(f"{n:40s} {doc[0] if doc and a.describe else ''}".rstrip())
        return 0
    from stintlake.session import get_spark

    spark = get_spark()
    if a.cmd == "run":
        df = catalog.run(spark, a.name, a.sf)
        if a.csv:
            from stintlake.sources.files import export_csv
            print(export_csv(df, a.csv))
        else:
            df.show(a.show, truncate=False)
        return 0
    from stintlake.plans.pipeline import PipelineConfig, run_pipeline

    cfg = PipelineConfig(a.start, a.end, mode="incremental" if a.incremental else "full", strict=a.strict,
                         dry_run=a.dry_run, skip_quality=a.skip_quality, team_id=a.team)
    res = run_pipeline(spark, a.raw, a.store, cfg)
    if res.preview is not None:
        res.preview.show(truncate=False)
        return 0
    print(f"run {res.run_id}: loaded {res.loaded}")
    for w in res.warnings:
        print("warning:", w)
    res.summary.show(truncate=False)
    failures = res.quality.collect() if res.quality is not None else []
    for f in failures:
        print(f"quality failure: {f.check} = {f.value} (expected {f.expected})")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
