"""Run the stages over feed files; write the questions' full results.

    python -m ledgerstar --daily data.csv \\
        --sheet "Year 2009-2010=y1.csv" --sheet "Year 2010-2011=y2.csv" \\
        [--book online_retail_II.xlsx] [--root <shared folder>] [--keywords kw.json] [--questions]

The layer root defaults to the session's spark.checkpoint.dir (a shared
folder on a cluster).  A feed that is not given keeps its published table.
Each run adds one row per task to the execution log.
"""

from __future__ import annotations

import argparse
import sys

from ledgerstar.functions.categories import load_keywords
from ledgerstar.plans import stages
from ledgerstar.plans.tables import register_tables
from ledgerstar.schemas import DAILY_DATE_FORMAT, HISTORICAL_DATE_FORMAT, NULL_TEXT
from ledgerstar.session import build_session, cluster_conf
from ledgerstar.sources.files import read_daily_csv, read_sheets


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerstar", description=__doc__.split("\n")[0])
    p.add_argument("--daily", default=None, help="daily feed CSV (file or folder); left as published if not given")
    p.add_argument("--daily-encoding", default="ISO-8859-1")
    p.add_argument("--daily-date-format", default=DAILY_DATE_FORMAT)
    p.add_argument("--sheet", action="append", default=[], metavar="NAME=PATH",
                   help="one historical sheet, in workbook order (repeatable); left as published if none is given")
    p.add_argument("--sheet-format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--sheet-date-format", default=HISTORICAL_DATE_FORMAT)
    p.add_argument("--multi-line", action="store_true", help="quoted cells may hold line ends")
    p.add_argument("--keep-null-descriptions", action="store_true", help="do not write a missing description as text")
    p.add_argument("--book", default="online_retail_II.xlsx", help="workbook name for source_file")
    p.add_argument("--root", default=None, help="layer folder (default: under spark.checkpoint.dir)")
    p.add_argument("--keywords", default=None, help="category keyword JSON (ordered), on shared storage")
    p.add_argument("--run-id", default=None)
    p.add_argument("--cores", type=int, default=None, help="cores of the cluster, to size shuffles with --input-gb")
    p.add_argument("--input-gb", type=float, default=None, help="size of the feeds")
    p.add_argument("--questions", action="store_true", help="write the nine questions' results under the root")
    args = p.parse_args(argv)
    if not args.daily and not args.sheet:
        p.error("nothing to do: give --daily, --sheet or both")

    extra = cluster_conf(args.cores, int(args.input_gb * (1 << 30))) if args.cores and args.input_gb else None
    spark = build_session(app="ledgerstar", extra=extra)
    daily = historical = None
    if args.daily:
        daily = read_daily_csv(spark, args.daily, encoding=args.daily_encoding, multi_line=args.multi_line)
    if args.sheet:
        sheets = [tuple(s.split("=", 1)) for s in args.sheet]
        historical = read_sheets(spark, args.book, sheets, fmt=args.sheet_format, multi_line=args.multi_line)
    store = stages.run_stages(
        spark, daily=daily, historical=historical, root=args.root, run_id=args.run_id,
        keywords=load_keywords(spark, args.keywords), daily_date_format=args.daily_date_format,
        historical_date_format=args.sheet_date_format, null_text=None if args.keep_null_descriptions else NULL_TEXT)
    register_tables(store)
    store.last_log_rows(5).show(truncate=False)
    if args.questions:
        for name, df in stages.questions(store).items():
            path = f"{store.root}/questions/{name}"
            df.write.mode("overwrite").parquet(path)
            print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
