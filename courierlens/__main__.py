"""Command line: build a dataset, show reports, run the flow.

    python -m courierlens build OUT --orders 50000
    python -m courierlens show STAR --names report_overview dash_kpis
    python -m courierlens show STAR            (every report)
    python -m courierlens flow STAR OUT --rounds 200

STAR is a folder with the three Parquet tables, with ``--layout landing`` a landing zone of
CSV files, with ``--layout flat`` a folder with one CSV file per table.
Works under spark-submit; a local session is started when none exists.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from courierlens.operators.quality import run_tests
from courierlens.plans import dashboard, gold, marts, pipeline, reports, staging, validation
from courierlens.plans.delay_model import ROUNDS
from courierlens.session import local_session, release_application_folder
from courierlens.sources import builder, files, tables
from courierlens.sources.tables import Star

REPORTS = {
    **{name: (lambda s, f=report: f(s.orders)) for name, report in gold.FROM_GOLD.items()},
    "dash_alerts": lambda s: dashboard.alerts(s.orders),
    "dash_district_weather_wide": lambda s: dashboard.district_weather_wide(s.orders),
    "report_worst_captains": lambda s: reports.worst_captains(s.orders, s.captains),
    "report_slowest_restaurants": lambda s: reports.slowest_restaurants(s.orders, s.restaurants),
    "dash_captain_scatter": lambda s: dashboard.captain_scatter(s.orders, s.captains),
    "dash_top_captains": lambda s: dashboard.top_captains(s.orders, s.captains),
    "dash_attention_captains": lambda s: dashboard.attention_captains(s.orders, s.captains),
    "mart_captain_performance": lambda s: marts.captain_performance(
        s.orders, staging.stg_captains(s.captains)
    ),
    **{
        name: (lambda s, n=name: validation.validation_report(s)[n])
        for name in ("check_row_counts", "check_sample")
    },
    "dq_results": lambda s: run_tests(staging.staged(s), staging.DATA_TESTS),
}

LAYOUTS = ["parquet", "landing", "flat"]


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or local_session()


def _load(spark: SparkSession, path: str, layout: str) -> Star:
    if layout == "parquet":
        return tables.load_star(tables.parquet_reader(spark, path))
    return Star.of(files.read_raw(spark, path, flat=layout == "flat"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="courierlens", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="build a dataset of any size")
    build.add_argument("out")
    build.add_argument("--orders", type=int, default=50_000)
    build.add_argument("--captains", type=int, default=200)
    build.add_argument("--restaurants", type=int, default=80)
    build.add_argument("--seed", type=int, default=builder.DEFAULT_SEED)
    build.add_argument("--csv", action="store_true", help="also land the tables as CSV")

    show = commands.add_parser("show", help="print reports")
    show.add_argument("star")
    show.add_argument("--names", nargs="+", choices=REPORTS, default=list(REPORTS), metavar="NAME")
    show.add_argument("--layout", choices=LAYOUTS, default="parquet")
    show.add_argument("--rows", type=int, default=50)

    flow = commands.add_parser("flow", help="run data tests, marts, reports and models")
    flow.add_argument("star")
    flow.add_argument("out")
    flow.add_argument("--layout", choices=LAYOUTS, default="parquet")
    flow.add_argument("--rounds", type=int, default=ROUNDS)
    flow.add_argument("--no-models", action="store_true")
    flow.add_argument("--extra-features", nargs="+", default=[], metavar="COLUMN")

    args = parser.parse_args(argv)
    spark = _session()
    try:
        _run(spark, args)
    finally:
        release_application_folder(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "build":
        star = builder.build_star(spark, args.orders, args.captains, args.restaurants, args.seed)
        tables.save_star(star, args.out)
        written = tables.load_star(tables.parquet_reader(spark, args.out))
        if args.csv:
            files.land(written.tables(), args.out)
        validation.build_summary(written.orders).show(truncate=False)
    elif args.command == "show":
        star = _load(spark, args.star, args.layout)
        for name in args.names:
            print(name)
            REPORTS[name](star).show(args.rows, truncate=False)
    else:
        written = pipeline.run_pipeline(
            spark,
            _load(spark, args.star, args.layout),
            args.out,
            train_models=not args.no_models,
            rounds=args.rounds,
            extra_features=tuple(args.extra_features),
        )
        for name, path in written.items():
            print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
