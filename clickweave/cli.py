"""Command-line entry points.

    python -m clickweave.cli silver --bronze raw.events --silver clean.events [--day 2024-01-15|yesterday|all]
    python -m clickweave.cli bronze --source kafka --topic t --servers host:9092 --target raw.events
    python -m clickweave.cli publish --table raw.events --topic t --servers host:9092
    python -m clickweave.cli profile --table raw.events
    python -m clickweave.cli quality --table raw.events

Settings (endpoints, credentials, catalogs) come from ``--conf key=value``
or the usual spark-submit configuration, never from code.
"""

from __future__ import annotations

import argparse
import json
import sys

from clickweave.session import build_session


def _conf(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        key, _, value = p.partition("=")
        out[key] = value
    return out


def print_all(frame) -> None:
    """Every row, in the frame's order, partition by partition."""
    print("\t".join(frame.columns))
    for row in frame.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))
    print()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="clickweave")
    ap.add_argument("--conf", action="append", default=[], help="spark setting key=value")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("silver", help="cleanse one day of the raw table")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--day", default="yesterday", help="YYYY-MM-DD, 'yesterday' or 'all'")
    s.add_argument("--keep-good-copy", action="store_true",
                   help="drop incomplete rows before dedup")
    s.add_argument("--session-scope", default="day", choices=("day", "all"))
    s.add_argument("--rows-per-task", type=int, default=1_000_000,
                   help="larger sessions may take the broadcast path")
    s.add_argument("--format", default="parquet", help="provider of a table that is created")

    b = sub.add_parser("bronze", help="run the raw stream job")
    b.add_argument("--source", default="kafka")
    b.add_argument("--topic")
    b.add_argument("--servers")
    b.add_argument("--path", help="input folder for a file-based source")
    b.add_argument("--target", required=True, help="raw table (created if missing)")
    b.add_argument("--format", default="parquet", help="provider of a table that is created")
    b.add_argument("--checkpoint")
    b.add_argument("--trigger", default="15 minutes", help="interval, 'availableNow' or 'once'")
    b.add_argument("--max-records-per-trigger", type=int, help="broker records per batch (default: no limit)")
    b.add_argument("--max-files-per-trigger", type=int, help="files per batch of a file source (default: no limit)")
    b.add_argument("--payload-format", default="json", choices=("json", "avro"))
    b.add_argument("--tolerate-data-loss", action="store_true")

    e = sub.add_parser("publish", help="encode a table's events and send them to the broker")
    e.add_argument("--table", required=True)
    e.add_argument("--topic", required=True)
    e.add_argument("--servers", required=True)
    e.add_argument("--schema-id", type=int, default=1)
    e.add_argument("--payload-format", default="json", choices=("json", "avro"))

    for name, text in (("profile", "row counts: total, per event type, top cities"),
                       ("quality", "contract checks: enums, required and conditional fields, "
                                   "event mix, ingestion lag, signed-in share")):
        p = sub.add_parser(name, help=text)
        p.add_argument("--table", required=True)

    args = ap.parse_args(argv)
    spark = build_session(f"clickweave-{args.cmd}", conf=_conf(args.conf))

    if args.cmd == "silver":
        from clickweave.plans.silver import run_silver

        day = None if args.day == "all" else args.day
        report = run_silver(spark, args.bronze, args.silver, day,
                            drop_nulls_first=args.keep_good_copy,
                            session_scope=args.session_scope,
                            rows_per_task=args.rows_per_task, fmt=args.format)
        print(json.dumps(report))
    elif args.cmd == "bronze":
        from clickweave.sources.stream import read_records
        from clickweave.streaming.ingest import start_bronze_stream

        records = read_records(spark, args.source, topic=args.topic,
                               bootstrap_servers=args.servers, path=args.path,
                               max_records_per_trigger=args.max_records_per_trigger,
                               max_files_per_trigger=args.max_files_per_trigger,
                               fail_on_data_loss=not args.tolerate_data_loss)
        query = start_bronze_stream(records, args.target, checkpoint=args.checkpoint,
                                    trigger=args.trigger, payload_format=args.payload_format,
                                    fmt=args.format)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()
    elif args.cmd == "publish":
        from clickweave.functions.envelope import encode
        from clickweave.sinks.tables import write_kafka
        from clickweave.sources.tables import read_bronze

        write_kafka(encode(read_bronze(spark, args.table), args.schema_id, args.payload_format),
                    args.topic, args.servers)
    else:
        from clickweave.operators import profile, quality
        from clickweave.sources.tables import read_table

        df = read_table(spark, args.table)
        if args.cmd == "profile":
            frames = (profile.total(df), profile.counts_by(df, "event_type"), profile.top_values(df, "city", 10))
        else:
            frames = (quality.enum_domains(df), quality.required_fields(df), quality.conditional_fields(df),
                      quality.event_mix(df).orderBy("event_type"), quality.ingestion_lag(df).orderBy("event_date"),
                      quality.auth_share(df).orderBy("event_date"))
        for frame in frames:
            print_all(frame)
    return 0


if __name__ == "__main__":
    sys.exit(main())
