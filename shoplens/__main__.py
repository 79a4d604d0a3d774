"""Command line: run the three analyses the way their original programs ran.

    python -m shoplens session --input DIR --output DIR --params '{"startDate": ...}'
    python -m shoplens area    --input DIR --output DIR --params '{"startDate": ...}'
    python -m shoplens ads     --input DIR --tables DIR --checkpoint DIR [--once]
    python -m shoplens ads     --format kafka --option kafka.bootstrap.servers=h:9092 \\
                               --option subscribe=ads --tables DIR --checkpoint DIR

``--input`` is a folder of input tables (events, customer, nation, region,
part); results are appended under ``--output`` with the run id on each row.
"""

from __future__ import annotations

import argparse
import sys

from shoplens.params import TaskParams
from shoplens.plans.jobs import jdbc_sink, parquet_sink, run_area_job, run_session_job
from shoplens.plans.model import Model
from shoplens.session import build_session
from shoplens.sources.native import NativeModel
from shoplens.streaming import ad_stream
from shoplens.streaming.sources import FILES_PER_TRIGGER, events_click_stream, parsed_line_stream


def _args(argv):
    p = argparse.ArgumentParser(prog="shoplens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("session", "area"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--output", help="folder for parquet results")
        s.add_argument("--jdbc-url", help="database for the results instead of --output")
        s.add_argument("--jdbc-option", action="append", default=[], help="connection property k=v")
        s.add_argument("--table-prefix", default="")
        s.add_argument("--native", action="store_true",
                       help="--input is a folder or catalog database of the original's own tables")
        s.add_argument("--params", required=True, help="task JSON")
        s.add_argument("--master")
        if name == "session":
            s.add_argument("--sample-total", type=int, default=100)
            s.add_argument("--seed")
            s.add_argument("--top", type=int, default=10)
    a = sub.add_parser("ads")
    a.add_argument("--input", help="folder of input tables (events stream + dimensions)")
    a.add_argument("--format", help="line source instead: kafka or text")
    a.add_argument("--path", help="folder for a text line source")
    a.add_argument("--option", action="append", default=[], help="source option k=v")
    a.add_argument("--tables", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--threshold", type=int, default=100)
    a.add_argument("--interval", default="5 seconds")
    a.add_argument("--max-files", type=int, default=FILES_PER_TRIGGER, help="files a batch takes at most")
    a.add_argument("--max-offsets", type=int, default=10_000_000, help="Kafka records a batch takes at most")
    a.add_argument("--once", action="store_true", help="process what is there, then stop")
    a.add_argument("--master")
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = _args(sys.argv[1:] if argv is None else argv)
    spark = build_session(args.master)
    if args.cmd in ("session", "area"):
        params = TaskParams.from_json(args.params)
        m = NativeModel(spark, args.input) if args.native else Model(spark, args.input)
        if not (args.output or args.jdbc_url):
            raise SystemExit("give --output or --jdbc-url")
        sink = parquet_sink(args.output) if args.output else jdbc_sink(
            args.jdbc_url, dict(o.split("=", 1) for o in args.jdbc_option), args.table_prefix)
        if args.cmd == "session":
            taskid = run_session_job(m.actions(params), m.users(), m.products(), params, sink,
                                     sample_total=args.sample_total, seed=args.seed,
                                     top_n=args.top)
        else:
            taskid = run_area_job(m.actions(params), m.products(), m.city_dim(), sink)
        print(taskid)
        return 0
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    tables = ad_stream.AdTables.at(spark, args.tables)
    if args.format:
        opts = dict(o.split("=", 1) for o in args.option)
        bound = {"kafka": ("maxOffsetsPerTrigger", args.max_offsets), "text": ("maxFilesPerTrigger", args.max_files)}
        if args.format in bound:
            opts.setdefault(bound[args.format][0], str(bound[args.format][1]))
        q = ad_stream.start_line_pipeline(parsed_line_stream(spark, args.format, opts, args.path), tables,
                                          args.checkpoint, args.threshold, trigger)
    else:
        log, geo = events_click_stream(spark, args.input, args.max_files)
        q = ad_stream.start_ad_pipeline(log, tables, args.checkpoint, args.threshold, trigger, geo=geo)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
