"""Command line: the pipeline's entry points.

  python -m ledgerline ingest --bronze PATH --source CSV --name NAME
  python -m ledgerline run --bronze PATH --root PATH [--threads 4] [--register] [--incremental]
                          [--fact-buckets B] [--silver-buckets B]
  python -m ledgerline layout --table PATH --out PATH --cols date_key,transaction_type
  python -m ledgerline profile --table PATH --col date_key --lo D --hi D
  python -m ledgerline sample --table PATH --n 10000 --out PATH

Each command prints one JSON line with its result.  ``--master`` is only for
local runs; on a cluster the launcher decides.
"""

from __future__ import annotations

import argparse
import json
import sys

from ledgerline.session import get_session


def _session(args):
    spark = get_session(args.master)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cmd_ingest(args) -> dict:
    from ledgerline.sources import bronze
    from ledgerline.sources.raw import read_raw
    spark = _session(args)
    rows = bronze.ingest_batch(spark, args.bronze, args.name,
                               lambda: read_raw(spark, args.source, multi_line=args.multi_line))
    return {"bronze": args.bronze, "source_file": args.name, "rows": rows}


def cmd_run(args) -> dict:
    from ledgerline.plans import registry
    from ledgerline.sources import bronze
    spark = _session(args)
    res = registry.run(spark, bronze.bronze_view(spark, args.bronze), args.root, threads=args.threads,
                       incremental_silver=args.incremental, bronze_path=args.bronze,
                       fact_buckets=args.fact_buckets, silver_buckets=args.silver_buckets)
    out = {"checks": len(res.checks), "passed": sum(r["status"] == "pass" for r in res.checks),
           "gate": res.gate[0].asDict(), "timings": res.timings}
    if args.register:
        out["tables"] = registry.register_tables(spark, args.root)
    return out


def cmd_layout(args) -> dict:
    from ledgerline.operators import layout
    spark = _session(args)
    cols = [c for c in args.cols.split(",") if c]
    n = layout.zorder(spark, args.table, args.out, cols, n_files=args.files) if cols else \
        layout.compact(spark, args.table, args.out)
    manifest = layout.write_manifest(spark, args.out, cols) if cols else None
    return {"files": n, "out": args.out, "manifest": manifest}


def cmd_profile(args) -> dict:
    from ledgerline.operators import layout
    spark = _session(args)
    m = layout.manifest(spark, args.table, [args.col])
    return layout.profile(m, args.col, args.lo, args.hi).first().asDict()


def cmd_sample(args) -> dict:
    from ledgerline.sources.sample import systematic_sample_files
    spark = _session(args)
    df = systematic_sample_files(spark, args.table, args.n)
    df.write.mode("overwrite").parquet(args.out)
    return {"out": args.out, "rows": spark.read.parquet(args.out).count()}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--bronze", required=True)
    a.add_argument("--source", required=True)
    a.add_argument("--name", required=True)
    a.add_argument("--multi-line", action="store_true")
    a.set_defaults(fn=cmd_ingest)
    a = sub.add_parser("run")
    a.add_argument("--bronze", required=True)
    a.add_argument("--root", required=True)
    a.add_argument("--threads", type=int, default=4)
    a.add_argument("--register", action="store_true")
    a.add_argument("--incremental", action="store_true",
                   help="stage and merge only bronze batches not processed yet")
    a.add_argument("--fact-buckets", type=int, default=None,
                   help="key buckets per fact date partition (new fact tables only)")
    a.add_argument("--silver-buckets", type=int, default=None,
                   help="key buckets per silver event-date partition (with --incremental, new tables only)")
    a.set_defaults(fn=cmd_run)
    a = sub.add_parser("layout")
    a.add_argument("--table", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--cols", default="")
    a.add_argument("--files", type=int, default=None)
    a.set_defaults(fn=cmd_layout)
    a = sub.add_parser("profile")
    a.add_argument("--table", required=True)
    a.add_argument("--col", required=True)
    a.add_argument("--lo", required=True)
    a.add_argument("--hi", required=True)
    a.set_defaults(fn=cmd_profile)
    a = sub.add_parser("sample")
    a.add_argument("--table", required=True)
    a.add_argument("--n", type=int, required=True)
    a.add_argument("--out", required=True)
    a.set_defaults(fn=cmd_sample)
    args = p.parse_args(argv)
    print(json.dumps(args.fn(args), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
