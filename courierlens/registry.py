"""Named queries: callables (spark, folder of source tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courierlens.functions import rules
from courierlens.functions.rounding import half_up, settled
from courierlens.operators.boosting import BoostedTrees, described, importances_of
from courierlens.operators.metrics import class_profile, classification_metrics, regression_metrics
from courierlens.operators.permutation import permutation_importance
from courierlens.operators.quality import accepted_values, not_null, quarantine, run_tests, unique
from courierlens.operators.split import hash_split, stratified_split
from courierlens.plans import (
    dashboard,
    delay_model,
    demand_model,
    gold,
    gold_store,
    marts,
    reports,
    staging,
    validation,
)
from courierlens.schemas import DIM_CAPTAINS, DIM_RESTAURANTS, FACT_ORDERS, star_schemas
from courierlens.session import application_folder
from courierlens.sources import builder, files, tables
from courierlens.plans.pipeline import run_pipeline
from courierlens.sources.adapter import LABELS, table_path
from courierlens.sources.tables import Star
from courierlens.sources.working_copy import materialize, star_folder, working_star
from courierlens.streaming import raised
from courierlens.streaming.alerts import late_orders

Query = Callable[[SparkSession, str], DataFrame]

def over_star(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, root: build(working_star(spark, root))


def over_orders(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, root: build(working_star(spark, root).orders)


def over_captains(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        star = working_star(spark, root)
        return build(star.orders, star.captains)

    return run


def over_restaurants(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        star = working_star(spark, root)
        return build(star.orders, star.restaurants)

    return run


def _time_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("order_time", rules.moment_text(F.col("order_time")))


def _source(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(root, table))


def _exchange_folder(spark: SparkSession, name: str) -> str:
    return application_folder(spark, "exchange", f"{name}-{uuid.uuid4().hex[:12]}")


# sources and sinks


def landed_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders after a trip through the CSV landing zone."""
    base = _exchange_folder(spark, "landing")
    files.land({FACT_ORDERS: working_star(spark, root).orders}, base)
    path = files.entity_path(base, FACT_ORDERS)
    return _time_as_text(files.read_csv(spark, path, star_schemas("long")[FACT_ORDERS]))


def landed_dimension(table: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        base = _exchange_folder(spark, "landing")
        files.land({table: working_star(spark, root).tables()[table]}, base)
        return files.read_csv(spark, files.entity_path(base, table), star_schemas("long")[table], multi_line=True)

    return run


def warehouse_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders from a warehouse copy that spells its columns in capitals."""
    star = working_star(spark, root)
    shouted = Star.of({n: t.toDF(*[c.upper() for c in t.columns]) for n, t in star.tables().items()})
    folder = _exchange_folder(spark, "warehouse")
    tables.save_star(shouted, folder)
    return _time_as_text(tables.load_star(tables.parquet_reader(spark, folder)).orders)


def catalog_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders saved as a table of the catalog, and read back through it."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    tables.save_table(working_star(spark, root).orders, name, path=_exchange_folder(spark, name))
    schema = star_schemas()[FACT_ORDERS]
    return _time_as_text(tables.conform(tables.catalog_reader(spark)(name), schema))


# products whose columns are parts, which no other query returns
PARTS_ONLY = {"gold_cube", "captain_parts", "restaurant_parts"}


def content_digest(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, and ``content``, a sum of hashes of all rows by their named values.

    Numbers count by their value to four places, so neither type nor notation matters.
    """
    def named(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.concat(F.lit(f"{name}="), F.coalesce(text.try_cast("decimal(30,4)").cast("string"), text))

    digest = F.md5(F.concat_ws("|", *[named(c) for c in sorted(df.columns)]))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).cast("string").alias("content"))


def flow_products(spark: SparkSession, root: str) -> DataFrame:
    """The whole flow without models: every product's rows and content, as read back from what was written."""
    written = run_pipeline(spark, working_star(spark, root), _exchange_folder(spark, "flow"), train_models=False)
    found = []
    for name, path in written.items():
        digest = content_digest(spark.read.parquet(path))
        if name in PARTS_ONLY:
            digest = digest.withColumn("content", F.lit(None).cast("string"))
        found.append(digest.select(F.lit(name).alias("product"), "n_rows", "content"))
    return reduce(DataFrame.unionByName, found)


def _refreshed_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Gold tables that were folded from a first load of the fact, and then from files that came later."""

    def refresh(star: Star) -> dict[str, DataFrame]:
        fact, store = _exchange_folder(spark, "arriving"), _exchange_folder(spark, "gold-store")
        # a third of the orders in each load, by their own hash
        load = F.pmod(F.xxhash64("order_id"), F.lit(3))
        for i in range(3):
            star.orders.where(load == i).write.mode("append").parquet(fact)
            gold_store.refresh_gold(spark, fact, store, ids="long")
        return gold_store.stored_gold(spark, store)

    return _trained(spark, root, "refreshed-gold", refresh)


def refreshed_captains(spark: SparkSession, root: str) -> DataFrame:
    """The captain mart from incrementally folded parts."""
    parts = _refreshed_gold(spark, root)["captain_parts"]
    return marts.captain_performance(parts, staging.stg_captains(working_star(spark, root).captains))


def refreshed_zones(spark: SparkSession, root: str) -> DataFrame:
    """The zone mart from incrementally folded parts."""
    return marts.zone_analysis(_refreshed_gold(spark, root)["gold_cube"])


def refreshed_slots(spark: SparkSession, root: str) -> DataFrame:
    """The demand slots from incrementally folded parts."""
    return demand_model.demand_slots(_refreshed_gold(spark, root)["gold_cube"])


def refreshed_restaurants(spark: SparkSession, root: str) -> DataFrame:
    """The slowest restaurants from incrementally folded parts."""
    return reports.slowest_restaurants(_refreshed_gold(spark, root)["restaurant_parts"], working_star(spark, root).restaurants)


def _ids(spark: SparkSession, root: str, table: str, key: str) -> DataFrame:
    return _source(spark, root, table).select(F.col(key).alias("id"))


def built_captains(spark: SparkSession, root: str) -> DataFrame:
    return builder.build_captains(_ids(spark, root, "supplier", "s_suppkey"))


def built_restaurants(spark: SparkSession, root: str) -> DataFrame:
    return builder.build_restaurants(_ids(spark, root, "part", "p_partkey"))


def built_orders(spark: SparkSession, root: str) -> DataFrame:
    # the dimensions are written first: their sizes are then known to the joins
    captains = materialize(built_captains(spark, root), "built-captains")
    restaurants = materialize(built_restaurants(spark, root), "built-restaurants")
    ids = _ids(spark, root, "orders", "o_orderkey")
    return builder.build_orders(ids, captains, restaurants, partitions=spark.sparkContext.defaultParallelism)


# rules and projections


def peak_flags(orders: DataFrame) -> DataFrame:
    hour = rules.hour_of_day(F.col("order_time"))
    return orders.select(
        "order_id",
        rules.moment_text(F.col("order_time")).alias("order_time"),
        hour.alias("hour_of_day"),
        rules.day_of_week(F.col("order_time")).alias("day_of_week"),
        rules.peak_flag(hour).alias("is_peak_hour"),
    )


def delay_enrichment(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "prep_time_min",
        "delivery_time_min",
        rules.delayed_flag(F.col("delivery_time_min")).alias("is_delayed"),
    )


def status_rule(orders: DataFrame) -> DataFrame:
    status = rules.order_status(
        F.col("delivery_time_min"), F.col("weather"), F.col("traffic_level"), LABELS, F.col("order_id") % 100
    )
    return orders.select("order_id", "weather", "traffic_level", "delivery_time_min", status.alias("status"))


def order_labels(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Keys padded with zeros, a name with its prefix, and a value rounded to one place."""
    named = orders.join(restaurants.select("restaurant_id", "name"), "restaurant_id")
    return named.select(
        "order_id",
        rules.numbered_key("ORD", F.col("order_id"), 6).alias("order_key"),
        rules.numbered_key("CUST", F.col("customer_id"), 5).alias("customer_key"),
        F.concat(F.lit("Restaurant "), F.col("name")).alias("restaurant_label"),
        half_up(F.round(F.col("order_value_sar") * 100).cast("long"), F.lit(100), 1).alias("value_rounded"),
    )


def orphan_orders(orders: DataFrame, captains: DataFrame) -> DataFrame:
    """Orders whose captain is not among those rated three and better, by captain: what a left join leaves open."""
    listed = captains.where("rating >= 3.0").select("captain_id", "name")
    counted = orders.groupBy("captain_id").agg(F.count(F.lit(1)).alias("n_orders"))
    return counted.join(listed, "captain_id", "left").where("name IS NULL").select("captain_id", "n_orders")


# data tests

RAW_TESTS = [
    unique("lineitem", "l_orderkey"),
    not_null("lineitem", "l_suppkey"),
    accepted_values("lineitem", "l_returnflag", ["A"]),
    unique("orders", "o_orderkey"),
    unique("orders", "o_custkey"),
    accepted_values("orders", "o_orderpriority", ["1-URGENT", "2-HIGH"]),
    not_null("part", "p_name"),
    unique("part", "p_name"),
]


def raw_tests(spark: SparkSession, root: str) -> DataFrame:
    """The generic column tests on the source tables, where several of them fail."""
    names = dict.fromkeys(t.table for t in RAW_TESTS)
    return run_tests({n: _source(spark, root, n) for n in names}, RAW_TESTS)


RAW_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "part": ["p_partkey"]}


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the source tables that break a column test, with the tests they break."""
    found = []
    for name, keys in RAW_KEYS.items():
        tests = [t for t in RAW_TESTS if t.table == name]
        rows = _source(spark, root, name).select(*dict.fromkeys([*keys, *[t.column for t in tests]]))
        _, rejected = quarantine(rows, tests, _exchange_folder(spark, "quarantine"))
        row_id = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        found.append(rejected.select(F.lit(name).alias("table_name"), row_id.alias("row_id"), F.array_join("broken", ", ").alias("tests")))
    return reduce(DataFrame.unionByName, found)


def district_weather_text(orders: DataFrame) -> DataFrame:
    """The heat map by rows, its maps written out."""
    pairs = F.transform(F.map_entries("rates"), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string")))
    return dashboard.district_weather_map(orders).select(
        "weather", F.size("rates").cast("long").alias("districts"), F.array_join(pairs, ", ", "none").alias("rates")
    )


# a week with two delayed orders is worth an alert at the test tables' density
WEEKS = raised.Watch(bound=2, every=7 * 86_400)


def raised_levels(orders: DataFrame) -> DataFrame:
    found = raised.raised_alerts(orders, WEEKS)
    return found.withColumn("window_start", rules.moment_text(F.col("window_start")))


# model data


def ml_features(star: Star) -> DataFrame:
    # joined once and written: the label codes come from these rows
    return delay_model.encoded_features(materialize(delay_model.training_rows(star), "feature-rows"))


def ml_demand_features(orders: DataFrame) -> DataFrame:
    return demand_model.encoded_slots(materialize(demand_model.demand_slots(orders), "feature-slots"))


def _split_profile(split: DataFrame) -> DataFrame:
    return split.groupBy("split", delay_model.LABEL).agg(F.count(F.lit(1)).alias("n"))


def ml_split_profile(star: Star) -> DataFrame:
    rows = delay_model.training_rows(star).withColumn("split", hash_split(F.col("order_id")))
    return _split_profile(rows)


def ml_stratified_split(star: Star) -> DataFrame:
    # joined once and written: finding the cuts and splitting read the rows three times
    rows = materialize(delay_model.training_rows(star).select("order_id", delay_model.LABEL), "split-rows")
    return stratified_split(rows, "order_id", delay_model.LABEL).select("order_id", "split")


def ml_metrics_on_rule(orders: DataFrame) -> DataFrame:
    """The model metrics for the rule "an order in a peak hour is late"."""
    return classification_metrics(orders, delay_model.LABEL, "is_peak_hour")


def demand_metrics_on_mean(orders: DataFrame) -> DataFrame:
    """The model metrics for the training mean per district and traffic level."""
    # written once: a filter on the split must not travel below the slot aggregate
    split = materialize(demand_model.split_slots(demand_model.demand_slots(orders)), "mean-slots")
    scored = demand_model.mean_predictor(split, ["district", "traffic_level"])
    return regression_metrics(scored, demand_model.LABEL, "prediction")


def demand_slot_split(orders: DataFrame) -> DataFrame:
    split = demand_model.split_slots(demand_model.demand_slots(orders))
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("slots"), F.sum(demand_model.LABEL).alias("orders")
    )


_RUNS: dict[tuple[str, ...], object] = {}


def _trained(spark: SparkSession, root: str, name: str, train: Callable[[Star], object]):
    """Train once per application and source; the model queries share the result."""
    key = (name, spark.sparkContext.applicationId, star_folder(spark, root))
    if key not in _RUNS:
        _RUNS[key] = train(working_star(spark, root))
    return _RUNS[key]


def _delay_run(spark: SparkSession, root: str) -> delay_model.DelayRun:
    return _trained(spark, root, "delay", delay_model.train)


def _demand_run(spark: SparkSession, root: str) -> demand_model.DemandRun:
    return _trained(spark, root, "demand", lambda s: demand_model.train(s.orders))


def _small_run(spark: SparkSession, root: str) -> demand_model.DemandRun:
    """Three rounds over all rows: trees that another engine can grow from the same slots."""
    small = {"rounds": 3, "depth": 3, "row_share": 1.0, "least_rows": 20}
    return _trained(spark, root, "small", lambda s: demand_model.train(s.orders, **small))


def _reloaded(spark: SparkSession, root: str, run: delay_model.DelayRun | demand_model.DemandRun) -> BoostedTrees:
    """The model of a run after a trip through its folder, once per run."""

    def trip(_: Star) -> BoostedTrees:
        path = _exchange_folder(spark, "model")
        delay_model.save_model(run.model, path)
        return delay_model.load_model(spark, path)

    return _trained(spark, root, f"reloaded-{id(run)}", trip)


def ml_delay_model(spark: SparkSession, root: str) -> DataFrame:
    """What any right run has: all test rows scored by a saved and reloaded model, better than the majority."""
    run = _delay_run(spark, root)
    first = run.scored.select("order_id", delay_model.LABEL, "prediction", vector_to_array("probability")[1].alias("p"))
    again = _reloaded(spark, root, run).transform(run.scored.drop(*run.added()))
    both = first.join(again.select("order_id", F.col("prediction").alias("again")), "order_id")
    late = F.sum(delay_model.LABEL)
    right = F.count_if(F.col(delay_model.LABEL) == F.col("prediction"))
    n = F.count(F.lit(1))
    return both.agg(
        n.alias("n_test"),
        late.alias("late"),
        F.count_if(F.col("p").between(0, 1)).alias("scores_in_range"),
        F.count_if(F.col("prediction") != F.col("again")).alias("reload_mismatches"),
        rules.flag(right > F.greatest(late, n - late)).alias("beats_majority"),
    )


def ml_demand_model(spark: SparkSession, root: str) -> DataFrame:
    """What any right run has: all test slots scored with numbers, the same after saving and reloading."""
    run = _demand_run(spark, root)
    keys = demand_model.SLOT_KEYS
    first = run.scored.select(*keys, demand_model.LABEL, "prediction")
    again = _reloaded(spark, root, run).transform(run.scored.drop(*run.added()))
    both = first.join(again.select(*keys, F.col("prediction").alias("again")), keys)
    return both.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum(demand_model.LABEL).alias("orders"),
        F.count_if(F.abs("prediction") < float("inf")).alias("finite_scores"),
        F.count_if(F.col("prediction") != F.col("again")).alias("reload_mismatches"),
    )


def ml_tree_scores(spark: SparkSession, root: str) -> DataFrame:
    """Every test order scored from the stored label and node tables alone."""
    run = _delay_run(spark, root)
    scored = _reloaded(spark, root, run).score(run.rows.filter("split = 'test'"))
    return scored.select("order_id", delay_model.LABEL, "score", "prediction")


def ml_delay_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Confusion cells and ratios of the delay model on its test rows."""
    return _delay_run(spark, root).metrics()


def ml_demand_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Errors of the demand model on its test slots."""
    return _demand_run(spark, root).metrics()


RULE_FEATURES = ["is_peak_hour", "weather", "traffic_level"]


def ml_permutation_on_rule(orders: DataFrame) -> DataFrame:
    """What the rule "an order in a peak hour is late" loses when one column's values change places."""
    wrong = (F.col(delay_model.LABEL) != F.col("is_peak_hour")).cast("long")
    rows = orders.select("order_id", delay_model.LABEL, *RULE_FEATURES)
    return permutation_importance(rows, "order_id", RULE_FEATURES, lambda df: df, wrong)


def ml_delay_permutation(spark: SparkSession, root: str) -> DataFrame:
    """What the delay model loses on its test rows when one raw column's values change places."""
    run = _delay_run(spark, root)
    inputs = [next((c for c, code in delay_model.CODES.items() if code == f), f) for f in delay_model.FEATURES]
    rows = run.rows.filter("split = 'test'").select("order_id", delay_model.LABEL, *inputs)
    wrong = (F.col(delay_model.LABEL) != F.col("prediction")).cast("long")
    return permutation_importance(rows, "order_id", inputs, run.model.transform, wrong)


def ml_small_demand_trees(spark: SparkSession, root: str) -> DataFrame:
    """The node table of the small demand model, with the labels that go left."""
    model = _small_run(spark, root).model
    return described(model.nodes(), model.encoding).select(
        "tree",
        "node",
        "feature",
        "threshold",
        "left_labels",
        settled(F.col("gain"), 6).alias("gain"),
        F.col("weighted_rows").cast("long").alias("n_rows"),
        settled(F.col("value"), 6).alias("value"),
    )


def ml_small_demand_scores(spark: SparkSession, root: str) -> DataFrame:
    """Every test slot scored from the node table of the small demand model."""
    run = _small_run(spark, root)
    scored = _reloaded(spark, root, run).score(run.slots.filter("split = 'test'"))
    return scored.select(*demand_model.SLOT_KEYS, demand_model.LABEL, settled(F.col("score"), 6).alias("score"))


def ml_small_demand_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Errors of the small demand model on its test slots."""
    return _small_run(spark, root).metrics()


def ml_small_demand_importance(spark: SparkSession, root: str) -> DataFrame:
    """The ranked shares of the small demand model's features in its gains, from the node table."""
    shares = importances_of(_small_run(spark, root).model.nodes())
    return shares.select("feature", settled(F.col("importance"), 6).alias("importance")).orderBy(F.desc("importance"), "feature")


def ml_small_demand_scenarios(spark: SparkSession, root: str) -> DataFrame:
    """The sample forecast of the small demand model, in numbers."""
    return demand_model.score_scenarios(_reloaded(spark, root, _small_run(spark, root)), _scenarios(spark, root))


def _scenarios(spark: SparkSession, root: str) -> DataFrame:
    """The busiest districts, each with its hour, and an unknown one."""
    busiest = reports.busiest_districts(working_star(spark, root).orders).collect()
    names = [r["district"] for r in busiest] + ["no such district"]
    return demand_model.sample_scenarios(spark, names, weather="clear", traffic=LABELS.heavy)


def _importance_facts(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """Every feature once, with a share between 0 and 1, and all shares adding up to 1."""
    ranked = delay_model.importances(spark, model, digits=None)
    # one row per feature
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))
    return ranked.select(
        "feature",
        rules.flag(F.col("importance").between(0, 1)).alias("in_range"),
        rules.flag(F.abs(total - 1) < 1e-6).alias("adds_up"),
    )


def ml_delay_importance(spark: SparkSession, root: str) -> DataFrame:
    return _importance_facts(spark, _delay_run(spark, root).model)


def ml_demand_importance(spark: SparkSession, root: str) -> DataFrame:
    return _importance_facts(spark, _demand_run(spark, root).model)


def ml_demand_scenarios(spark: SparkSession, root: str) -> DataFrame:
    """The sample forecast from a reloaded model.

    ``predicted`` says whether the model gave a number: the unknown district has none. The
    numbers themselves, which SQL can check, are those of ``ml_small_demand_scenarios``.
    """
    scored = demand_model.score_scenarios(_reloaded(spark, root, _demand_run(spark, root)), _scenarios(spark, root))
    return scored.withColumn("predicted", rules.flag(F.col("predicted_orders").isNotNull())).drop("predicted_orders")


QUERIES: dict[str, Query] = {
    # staging
    "stg_orders": over_orders(lambda o: _time_as_text(staging.stg_orders(o))),
    "stg_captains": over_star(lambda s: staging.stg_captains(s.captains)),
    "stg_restaurants": over_star(lambda s: staging.stg_restaurants(s.restaurants)),
    # operational reports
    "report_overview": over_orders(reports.overview),
    "report_busiest_districts": over_orders(reports.busiest_districts),
    "report_weather_impact": over_orders(reports.weather_impact),
    "report_hours": over_orders(reports.busiest_hours),
    "report_worst_captains": over_captains(reports.worst_captains),
    "report_slowest_restaurants": over_restaurants(reports.slowest_restaurants),
    "report_slowest_restaurants_by_id": over_restaurants(reports.slowest_restaurants_by_id),
    # validation
    "check_row_counts": over_star(lambda s: validation.row_counts(s.tables())),
    "check_status": over_orders(validation.by_status),
    "check_districts": over_orders(validation.top_districts),
    "check_sample": over_orders(validation.order_sample),
    "order_summary": over_orders(validation.build_summary),
    # marts
    "mart_captain_performance": over_captains(
        lambda o, c: marts.captain_performance(o, staging.stg_captains(c))
    ),
    "mart_zone_analysis": over_orders(marts.zone_analysis),
    "gold_cube": over_orders(
        lambda o: gold.gold_cube(o)
        .withColumn("sum_value", F.col("sum_hundredths") / F.lit(100.0))
        .drop("sum_hundredths")
    ),
    # gold tables that follow their source
    "refreshed_captain_mart": refreshed_captains,
    "refreshed_zone_mart": refreshed_zones,
    "refreshed_demand_slots": refreshed_slots,
    "refreshed_slowest_restaurants": refreshed_restaurants,
    # dashboard datasets
    "dash_kpis": over_orders(dashboard.kpis),
    "dash_status_share": over_orders(dashboard.status_share),
    "dash_weather_delay": over_orders(dashboard.weather_delay),
    "dash_districts": over_orders(dashboard.district_orders),
    "dash_hourly": over_orders(dashboard.hourly_orders),
    "dash_traffic": over_orders(dashboard.traffic_impact),
    "dash_captain_scatter": over_captains(dashboard.captain_scatter),
    "dash_top_captains": over_captains(dashboard.top_captains),
    "dash_attention_captains": over_captains(dashboard.attention_captains),
    "dash_captain_ranking": over_captains(dashboard.ranked_captains),
    "dash_district_weather": over_orders(dashboard.district_weather),
    "dash_district_weather_wide": over_orders(dashboard.district_weather_wide),
    "dash_district_weather_map": over_orders(district_weather_text),
    "dash_hour_district": over_orders(dashboard.hour_district),
    "dash_alerts": over_orders(dashboard.alerts),
    "late_orders_per_hour": over_orders(
        lambda o: late_orders(o).withColumns(
            {c: rules.moment_text(F.col(c)) for c in ("window_start", "window_end")}
        )
    ),
    "raised_alerts": over_orders(raised_levels),
    # data tests
    "dq_results": over_star(lambda s: run_tests(staging.staged(s), staging.DATA_TESTS)),
    "dq_results_raw": raw_tests,
    "dq_rejected_rows": rejected_rows,
    # rules
    "peak_flags": over_orders(peak_flags),
    "delay_enrichment": over_orders(delay_enrichment),
    "status_rule": over_orders(status_rule),
    "order_labels": over_restaurants(order_labels),
    "orphan_orders": over_captains(orphan_orders),
    # demand and model data
    "demand_slots": over_orders(demand_model.demand_slots),
    "demand_slot_stats": over_orders(lambda o: demand_model.slot_stats(demand_model.demand_slots(o))),
    "demand_slot_split": over_orders(demand_slot_split),
    "demand_metrics_on_mean": over_orders(demand_metrics_on_mean),
    "ml_features": over_star(ml_features),
    "ml_demand_features": over_orders(ml_demand_features),
    "ml_split_profile": over_star(ml_split_profile),
    "ml_stratified_split": over_star(ml_stratified_split),
    "ml_class_ratio": over_star(lambda s: class_profile(delay_model.training_rows(s), delay_model.LABEL)),
    "ml_metrics_on_rule": over_orders(ml_metrics_on_rule),
    "ml_permutation_on_rule": over_orders(ml_permutation_on_rule),
    # sources, sinks and builders
    "landed_orders": landed_orders,
    "landed_captains": landed_dimension(DIM_CAPTAINS),
    "landed_restaurants": landed_dimension(DIM_RESTAURANTS),
    "warehouse_orders": warehouse_orders,
    "catalog_orders": catalog_orders,
    "flow_products": flow_products,
    "built_captains": built_captains,
    "built_restaurants": built_restaurants,
    "built_orders": lambda spark, root: _time_as_text(built_orders(spark, root)),
    "build_summary": lambda spark, root: validation.build_summary(built_orders(spark, root)),
    # learners
    "ml_delay_model": ml_delay_model,
    "ml_delay_importance": ml_delay_importance,
    "ml_demand_model": ml_demand_model,
    "ml_demand_importance": ml_demand_importance,
    "ml_demand_scenarios": ml_demand_scenarios,
    "ml_small_demand_trees": ml_small_demand_trees,
    "ml_small_demand_scores": ml_small_demand_scores,
    "ml_small_demand_metrics": ml_small_demand_metrics,
    "ml_small_demand_importance": ml_small_demand_importance,
    "ml_small_demand_scenarios": ml_small_demand_scenarios,
}

# values of the models of 200 rounds, which no SQL can grow
LEARNED: dict[str, Query] = {
    "ml_delay_permutation": ml_delay_permutation,
    "ml_tree_scores": ml_tree_scores,
    "ml_delay_metrics": ml_delay_metrics,
    "ml_demand_metrics": ml_demand_metrics,
}
