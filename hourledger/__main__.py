"""Command line of the pipeline, for spark-submit or ``python -m hourledger``.

Periods and the report day are arguments; only the load time stamp is taken from the clock.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from hourledger.operators import report
from hourledger.operators.invoices import InvoiceRules
from hourledger.plans import pipeline
from hourledger.plans.pipeline import PipelineConfig
from hourledger.plans.tables import HOURS, USERS
from hourledger.session import build_session
from hourledger.sinks.std_table import read_std


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hourledger", description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--database", default="hourledger")
    parser.add_argument("--master", help="only for a local run")
    commands = parser.add_subparsers(dest="command", required=True)

    hydrate = commands.add_parser("hydrate", help="land users and billable hours from page dumps")
    hydrate.add_argument("--pages", required=True, help="folder with users, project-tasks, time-entries")
    hydrate.add_argument("--start", required=True)
    hydrate.add_argument("--end", required=True)

    run = commands.add_parser("run", help="landing -> raw -> std -> check")
    run.add_argument("--day", required=True, help="date shown in the summary line")
    run.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    run.add_argument("--drop-superseded", action="store_true")

    dashboard = commands.add_parser("dashboard", help="key figures, users, one user's hours")
    dashboard.add_argument("--user", help="display name whose hours to show")

    mapping = commands.add_parser("map", help="set the issuer company of an email")
    mapping.add_argument("--email", required=True)
    mapping.add_argument("--issuer", required=True)

    invoices = commands.add_parser("invoices", help="validate and store <email>/<name>.xml documents")
    invoices.add_argument("--documents", required=True, help="inbox; each file is read once")
    invoices.add_argument("--receiver", required=True, help="expected receiver id")
    invoices.add_argument("--keyword", action="append", default=[], help="required wording; repeatable")
    invoices.add_argument("--domain", help="company email domain")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    spark = build_session(master=args.master)
    cfg = PipelineConfig(
        args.root, args.database, getattr(args, "mode", "incremental"),
        drop_superseded=getattr(args, "drop_superseded", False),
    )
    if args.command == "hydrate":
        pipeline.hydrate(spark, cfg, args.pages, args.start, args.end, now)
    elif args.command == "run":
        print(pipeline.run_pipeline(spark, cfg, args.day))
    elif args.command == "dashboard":
        users = read_std(spark, cfg.std_table(USERS), USERS)
        hours = read_std(spark, cfg.std_table(HOURS), HOURS)
        report.kpis(users, hours).show()
        shown = report.user_series(hours, users, args.user) if args.user else report.display_users(hours, users)
        shown.show(truncate=False)
    elif args.command == "map":
        entered = spark.createDataFrame([(args.email, args.issuer)], "email string, issuer_company string")
        pipeline.add_mappings(spark, cfg, entered, now)
    elif args.command == "invoices":
        rules = InvoiceRules(args.receiver, tuple(args.keyword), company_domain=args.domain)
        pipeline.process_inbox(spark, cfg, args.documents, rules, pipeline.stored_hours(spark, cfg))
        decided = pipeline.decisions(spark, cfg)
        decided.groupBy("batch", "first_failure").agg(F.count("*").alias("invoices")).show(truncate=False)


if __name__ == "__main__":
    main()
