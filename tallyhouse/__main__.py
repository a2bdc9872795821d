"""``spark-submit`` entry point of the daily job."""

from __future__ import annotations

import argparse
import logging
import sys

from tallyhouse.plans.daily_run import process_day, processing_report
from tallyhouse.plans.incremental import SummaryStore
from tallyhouse.session import build_session
from tallyhouse.sinks.files import FORMATS
from tallyhouse.sinks.jdbc import JdbcTarget
from tallyhouse.sinks.landed_ids import LandedIds
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.relational import RelationalTarget
from tallyhouse.sources.transactions import LOCAL, OBJECT_STORE

log = logging.getLogger("tallyhouse")


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyhouse", description="Process one day of transactions")
    parser.add_argument("--mode", required=True, choices=[OBJECT_STORE, LOCAL], help="layout of the raw files")
    parser.add_argument("--year", required=True, help="YYYY")
    parser.add_argument("--month", required=True, help="MM")
    parser.add_argument("--day", required=True, help="DD")
    parser.add_argument("--raw", required=True, help="root of the raw JSON files")
    parser.add_argument("--out", required=True, help="root of the output tables")
    parser.add_argument("--format", default="parquet", choices=FORMATS, help="format of the output tables")
    parser.add_argument("--json-lines", action="store_true", help="raw files hold one record per line")
    parser.add_argument("--jdbc-url", help="also append the tables to this database")
    parser.add_argument(
        "--jdbc-property", action="append", default=[], metavar="KEY=VALUE", help="connection property, repeatable"
    )
    parser.add_argument(
        "--connect", metavar="MODULE:FUNCTION", help="write the tables to the database this function connects to, with one commit each"
    )
    parser.add_argument("--landed-ids", metavar="PATH", help="leave out records stored on earlier days, whose ids are kept here")
    parser.add_argument("--summary-store", metavar="PATH", help="also keep summaries here that take late records in")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    properties = dict(p.split("=", 1) for p in args.jdbc_property)
    jdbc = JdbcTarget(args.jdbc_url, properties) if args.jdbc_url else None
    relational = RelationalTarget(args.connect, properties) if args.connect else None
    spark = build_session()
    try:
        result = process_day(
            spark, args.year, args.month, args.day, args.mode, args.raw,
            OutputTarget(args.out, args.format, jdbc, relational), multi_line=not args.json_lines,
            landed=LandedIds(args.landed_ids) if args.landed_ids else None,
            summary_store=SummaryStore(args.summary_store) if args.summary_store else None,
        )
        log.info("run finished\n%s", processing_report(result))
        return 0
    except Exception:
        log.exception("run failed")
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
