"""Command line: the pipeline's jobs as subcommands.

    spark-submit -m clickmart ingest  --source kafka --servers host:9092 --topic clicks \\
                 --bronze PATH --rejects PATH --checkpoint PATH [--trigger "5 seconds"]
    python -m clickmart ingest --source text --input DIR ... --available-now
    python -m clickmart refresh --bronze PATH --out PATH [--as-of TS] [--no-checks]
    python -m clickmart cleanup --bronze PATH --out PATH
    python -m clickmart compact --bronze PATH --before DAY [--clean]
    python -m clickmart checks  --bronze PATH [--as-of TS]
    python -m clickmart plan    --query NAME --tables DIR   # formatted physical plan

A query with ranks or tiles sorts its table before its plan is known, so ``plan`` runs those jobs.

The session comes from the environment (``spark-submit`` settings, including
``spark.checkpoint.dir``); nothing here sets cluster configuration.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickmart")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="stream JSON events into bronze")
    ing.add_argument("--source", choices=["kafka", "text"], default="kafka")
    ing.add_argument("--servers", help="kafka.bootstrap.servers")
    ing.add_argument("--topic", help="topic to subscribe to")
    ing.add_argument("--input", help="directory of JSON-lines files (text source)")
    ing.add_argument("--bronze", required=True)
    ing.add_argument("--rejects", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--trigger", default="5 seconds")
    ing.add_argument("--option", action="append", default=[], metavar="K=V", help="source option, such as maxOffsetsPerTrigger=100000 (repeatable)")
    ing.add_argument("--jdbc", action="append", default=[], metavar="K=V", help="append to a database, too: url, dbtable, user, password, driver (repeatable)")
    ing.add_argument("--drop-landed", action="store_true", help="drop events that compacted days have already")
    ing.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    ref = sub.add_parser("refresh", help="rebuild silver and gold from bronze, run the checks")
    ref.add_argument("--bronze", required=True)
    ref.add_argument("--out", required=True)
    ref.add_argument("--as-of", default=None, help="timestamp used for CURRENT_TIMESTAMP (default: now)")
    ref.add_argument("--no-checks", action="store_true")

    cln = sub.add_parser("cleanup", help="report and remove duplicate event ids (keep last)")
    cln.add_argument("--bronze", required=True)
    cln.add_argument("--out", required=True)

    cmp_ = sub.add_parser("compact", help="rewrite closed days of a streamed bronze table into large files")
    cmp_.add_argument("--bronze", required=True)
    cmp_.add_argument("--before", required=True, help="days before this one (YYYY-MM-DD)")
    cmp_.add_argument("--clean", action="store_true", help="then delete what no reader of the new state opens")

    chk = sub.add_parser("checks", help="run the 24 checks and print the summary")
    chk.add_argument("--bronze", required=True)
    chk.add_argument("--as-of", default=None)

    pln = sub.add_parser("plan", help="print the physical plan of a registered query")
    pln.add_argument("--query", required=True)
    pln.add_argument("--tables", required=True, help="directory with the driver tables")
    return p


def _pairs(given: list[str]) -> dict[str, str]:
    """``["k=v", ...]`` as a dict."""
    bad = [x for x in given if "=" not in x]
    if bad:
        raise SystemExit(f"not K=V: {', '.join(bad)}")
    return dict(x.split("=", 1) for x in given)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"clickmart-{args.cmd}").getOrCreate()

    from .sources.bronze import read_bronze

    if args.cmd == "plan":
        from .plans.registry import run

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            run(args.query, spark, args.tables).explain("formatted")
        text = buf.getvalue()
        print(text)
        return {"plan": text}
    if args.cmd == "ingest":
        from .streaming.ingest import read_events, run_ingest

        options = _pairs(args.option)
        if args.source == "kafka":
            options = {"kafka.bootstrap.servers": args.servers, "subscribe": args.topic, **options}
        stream = read_events(spark, args.source, args.input, **options)
        run_ingest(
            stream,
            args.bronze,
            args.rejects,
            args.checkpoint,
            trigger=args.trigger,
            available_now=args.available_now,
            jdbc_options=_pairs(args.jdbc) or None,
            drop_landed=args.drop_landed,
        )
        result: dict = {"ingest": "stopped"}
    elif args.cmd == "refresh":
        from .plans.refresh import refresh

        result = refresh(spark, read_bronze(spark, args.bronze), args.out, args.as_of, run_checks=not args.no_checks)
    elif args.cmd == "cleanup":
        from .plans.cleanup import cleanup_duplicates

        result = cleanup_duplicates(read_bronze(spark, args.bronze), args.out)
    elif args.cmd == "compact":
        from .sources.compaction import clean, compact

        result = compact(spark, args.bronze, args.before)
        if args.clean:
            result["cleaned"] = clean(spark, args.bronze)
    else:
        from .plans import gold, quality, silver
        from .session import materialise

        bronze = read_bronze(spark, args.bronze)
        stg = materialise(silver.stg_clickstream_events(bronze, args.as_of), "stg")
        sessions = materialise(silver.int_user_sessions(stg, args.as_of), "sessions")
        models = {
            quality.BRONZE: bronze,
            quality.STG: stg,
            quality.DAILY: gold.mart_daily_metrics(stg, sessions, args.as_of, sort=False),
            quality.FUNNEL: gold.mart_conversion_funnel(sessions, sort=False),
            quality.PRODUCTS: gold.mart_product_performance(stg, args.as_of, sort=False),
            quality.USERS: gold.mart_user_behavior(sessions, args.as_of, sort=False),
        }
        rows = quality.check_summary(models).collect()  # 24 summary rows
        result = {"checks": [r.asDict() for r in rows]}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
