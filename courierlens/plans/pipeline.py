"""The whole flow: raw star, data tests, marts, gold cube, reports, models."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.operators.quality import run_tests
from courierlens.plans import dashboard, delay_model, demand_model, marts, reports, staging, validation
from courierlens.plans.gold import FROM_GOLD, captain_parts, gold_cube, restaurant_parts
from courierlens.plans.gold_store import source_files
from courierlens.sources.tables import Star, load_star, parquet_reader, save_star
from courierlens.sources.versions import mark, marked


class DataTestsFailed(RuntimeError):
    """The staged tables break a declared column test."""


def input_fingerprint(spark: SparkSession, star: Star, *settings: object) -> str | None:
    """A digest of the files behind the star and of the settings; None for rows that come from no file."""
    totals = []
    for table in star.tables().values():
        paths = table.inputFiles()
        if not paths:
            return None
        each = F.xxhash64("path", "length", "modified").cast("decimal(38,0)")
        totals.append(tuple(source_files(spark, paths).agg(F.count(F.lit(1)), F.sum(each)).first()))
    return hashlib.sha256(repr((totals, settings)).encode()).hexdigest()[:16]


def run_pipeline(
    spark: SparkSession,
    star: Star,
    out: str,
    train_models: bool = True,
    rounds: int = delay_model.ROUNDS,
    accept_failures: bool = False,
    extra_features: tuple[str, ...] = (),
) -> dict[str, str]:
    """Write every product below ``out`` and return name -> path.

    After the data tests three grouped passes over the fact feed the gold tables, and
    all reports and marts come from those. Each product is a table of its own, so
    later steps start from written data.

    A product is marked when it is whole, with the fingerprint of the files it came from. A
    run that finds the mark of its own inputs leaves the product as it is, so a run after a
    failure writes only what is missing. A star that comes from no files is written anew.
    """
    written: dict[str, str] = {}
    print_ = input_fingerprint(spark, star, rounds, extra_features)

    def once(name: str, path: str, make: Callable[[], None]) -> None:
        """Make the product unless its mark says that it is there."""
        if print_ is None or not marked(spark, out, name, print_):
            make()
            if print_ is not None:
                mark(spark, out, name, print_)
        written[name] = path

    def write(layer: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{out.rstrip('/')}/{layer}/{name}"
        once(name, path, lambda: df.write.mode("overwrite").parquet(path))
        return spark.read.parquet(path)

    bronze = f"{out.rstrip('/')}/bronze"
    once("bronze", bronze, lambda: save_star(star, bronze))
    del written["bronze"]
    star = load_star(parquet_reader(spark, bronze))
    views = staging.staged(star)
    orders, captains, restaurants = (
        views[n] for n in (staging.STG_ORDERS, staging.STG_CAPTAINS, staging.STG_RESTAURANTS)
    )

    tested = write("quality", "dq_results", run_tests(views, staging.DATA_TESTS))
    failed = tested.filter("failures > 0").collect()  # one row per declared test
    if failed and not accept_failures:
        raise DataTestsFailed(", ".join(f"{r.table_name}.{r.column_name} {r.test}" for r in failed))

    cube = write("gold", "gold_cube", gold_cube(orders))
    by_captain = write("gold", "captain_parts", captain_parts(orders))
    by_restaurant = write("gold", "restaurant_parts", restaurant_parts(orders))

    write("marts", "mart_captain_performance", marts.captain_performance(by_captain, captains))
    for name, report in FROM_GOLD.items():
        write("marts" if name.startswith("mart_") else "reports", name, report(cube))
    write("reports", "report_worst_captains", reports.worst_captains(by_captain, captains))
    write("reports", "report_slowest_restaurants", reports.slowest_restaurants(by_restaurant, restaurants))
    scatter = write("reports", "dash_captain_scatter", dashboard.captain_scatter(by_captain, captains))
    write("reports", "dash_top_captains", dashboard.best_of(scatter))
    write("reports", "dash_attention_captains", dashboard.worst_of(scatter))
    write("reports", "dash_district_weather_wide", dashboard.district_weather_wide(cube))
    write("reports", "check_row_counts", validation.row_counts(star.tables()))
    write("reports", "check_sample", validation.order_sample(orders))

    slots = write("gold", "demand_slots", demand_model.demand_slots(cube))
    write("gold", "demand_slot_stats", demand_model.slot_stats(slots))
    if train_models:
        trainers = {
            "delay": lambda: delay_model.train(star, rounds, extra_features=extra_features),
            "demand": lambda: demand_model.train(cube, rounds),
        }
        for name, train in trainers.items():
            path = f"{out.rstrip('/')}/models/{name}"

            def model_products(name: str = name, train: Callable = train, path: str = path) -> None:
                run = train()
                delay_model.save_model(run.model, path)
                run.metrics().write.mode("overwrite").parquet(f"{out.rstrip('/')}/models/{name}_metrics")
                ranked = delay_model.importances(spark, run.model)
                ranked.write.mode("overwrite").parquet(f"{out.rstrip('/')}/models/{name}_importance")

            once(f"{name}_model", path, model_products)
            for kind in ("metrics", "importance"):
                written[f"{name}_{kind}"] = f"{out.rstrip('/')}/models/{name}_{kind}"
    return written
