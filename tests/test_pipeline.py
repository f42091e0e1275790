from __future__ import annotations

import pytest

from courierlens.plans import pipeline
from courierlens.plans.delay_model import load_model
from courierlens.plans.gold import FROM_GOLD
from courierlens.plans.pipeline import DataTestsFailed, run_pipeline
from courierlens.sources.tables import Star, load_star, parquet_reader, save_star


def test_whole_flow(spark, built, tmp_path):
    written = run_pipeline(spark, built, str(tmp_path), rounds=2)
    assert set(FROM_GOLD) <= set(written)
    for name in ("dq_results", "mart_captain_performance", "gold_cube", "dash_top_captains", "delay_metrics"):
        assert spark.read.parquet(written[name]).count() > 0
    total = built.orders.count()
    assert spark.read.parquet(written["report_overview"]).first()["total_orders"] == total
    assert spark.read.parquet(written["demand_slot_stats"]).first()["slots"] > 0
    assert len(load_model(spark, written["delay_model"]).encoding.features) == 10
    again = run_pipeline(spark, built, str(tmp_path), train_models=False)
    assert spark.read.parquet(again["report_overview"]).first()["total_orders"] == total


def test_failing_data_tests_stop_the_flow(spark, built, make, tmp_path):
    bad = make([{"order_id": "X"}, {"order_id": "X"}])
    with pytest.raises(DataTestsFailed, match="order_id unique"):
        run_pipeline(spark, bad, str(tmp_path / "bad"), train_models=False)
    written = run_pipeline(spark, bad, str(tmp_path / "kept"), train_models=False, accept_failures=True)
    assert spark.read.parquet(written["dq_results"]).filter("failures > 0").count() == 1
    assert isinstance(bad, Star)


def test_a_second_run_writes_only_what_is_missing(spark, built, tmp_path, monkeypatch):
    out = str(tmp_path / "flow")
    made = []
    real = pipeline.mark
    monkeypatch.setattr(pipeline, "mark", lambda s, root, name, state: (made.append(name), real(s, root, name, state)))

    def broken(*_):
        raise OSError("lost")

    # the first run dies in the middle of the reports
    with monkeypatch.context() as m:
        m.setattr(pipeline.reports, "worst_captains", broken)
        with pytest.raises(OSError):
            pipeline.run_pipeline(spark, built, out, train_models=False)
    before = list(made)
    assert "gold_cube" in before and "report_worst_captains" not in before
    made.clear()
    written = pipeline.run_pipeline(spark, built, out, train_models=False)
    assert set(made).isdisjoint(before) and "report_worst_captains" in made
    assert set(written) == {n for n in [*before, *made] if n != "bronze"}
    made.clear()
    pipeline.run_pipeline(spark, built, out, train_models=False)
    assert made == []
    direct = pipeline.reports.worst_captains(built.orders, built.captains)
    found = spark.read.parquet(written["report_worst_captains"])
    assert sorted(map(str, found.collect())) == sorted(map(str, direct.collect()))


def test_other_inputs_are_computed_anew(spark, make, tmp_path):
    out = str(tmp_path / "flow")
    for n in (3, 5):
        save_star(make([{}] * n), str(tmp_path / "star"))
        star = load_star(parquet_reader(spark, str(tmp_path / "star")))
        written = pipeline.run_pipeline(spark, star, out, train_models=False)
        assert spark.read.parquet(written["report_overview"]).first().total_orders == n
    # rows that come from no file have no fingerprint
    assert pipeline.input_fingerprint(spark, make([{}])) is None
