from __future__ import annotations

from pathlib import Path

import pytest
from conftest import values

from courierlens.plans import gold_store, marts, staging
from courierlens.plans.demand_model import demand_slots
from courierlens.plans.gold import captain_parts, gold_cube
from courierlens.sources import tables
from courierlens.sources.versions import current, publish


def rows(df):
    return sorted(map(str, df.collect()))


def test_versions_change_whole(spark, tmp_path):
    root = str(tmp_path / "store")
    assert current(spark, root) is None

    def write(n):
        return lambda folder: spark.range(n).write.parquet(f"{folder}/t")

    first = publish(spark, root, write(1))
    assert current(spark, root) == first

    def torn(folder):
        write(5)(folder)
        raise OSError("lost")

    with pytest.raises(OSError):
        publish(spark, root, torn)
    assert current(spark, root) == first
    for n in (2, 3, 4):
        last = publish(spark, root, write(n))
    assert current(spark, root) == last
    assert spark.read.parquet(f"{last}/t").count() == 4
    # the two newest stay, and no name points to a folder that is gone
    kept = sorted(p.name for p in (tmp_path / "store" / "versions").iterdir() if not p.name.startswith("."))
    assert len(kept) == 2 and all((tmp_path / "store" / k).exists() for k in kept)
    assert not Path(first).exists()


class Broken:
    """A dimension that cannot be written."""

    @property
    def write(self):
        raise OSError("lost between two tables")


def test_a_star_is_replaced_whole_or_not_at_all(spark, make, tmp_path):
    root = str(tmp_path / "star")
    tables.save_star(make([{}, {}]), root)
    old = tables.load_star(tables.parquet_reader(spark, root))
    new = make([{}] * 5, captains=[{}, {"captain_id": "CAP002"}])
    with pytest.raises(OSError):
        tables.save_star(tables.Star(new.orders, new.captains, Broken()), root)
    seen = tables.load_star(tables.parquet_reader(spark, root))
    assert seen.orders.count() == 2 and seen.captains.count() == 1
    tables.save_star(new, root)
    # who began before reads on
    assert old.orders.count() == 2
    seen = tables.load_star(tables.parquet_reader(spark, root))
    assert seen.orders.count() == 5 and seen.captains.count() == 2
    # a star can be read from the folder it replaces
    tables.save_star(tables.Star(seen.orders.limit(3), seen.captains, seen.restaurants), root)
    assert tables.load_star(tables.parquet_reader(spark, root)).orders.count() == 3


@pytest.fixture()
def arriving(spark, built, tmp_path):
    """A function that adds a share of the orders as new files, and the folders."""
    fact, store = str(tmp_path / "fact"), str(tmp_path / "store")

    def add(i, of=4):
        part = built.orders.where(f"pmod(xxhash64(order_id), {of}) = {i}")
        part.repartition(2).write.mode("append").parquet(fact)

    return add, fact, store


def whole(spark, fact):
    return spark.read.schema(gold_store.star_schemas()["fact_orders"]).parquet(fact)


def assert_whole(spark, built, fact, store):
    gold, orders = gold_store.stored_gold(spark, store), whole(spark, fact)
    assert rows(gold["gold_cube"]) == rows(gold_cube(orders))
    assert rows(gold["captain_parts"]) == rows(captain_parts(orders))
    captains = staging.stg_captains(built.captains)
    assert values(marts.captain_performance(gold["captain_parts"], captains)) == values(marts.captain_performance(orders, captains))
    assert values(marts.zone_analysis(gold["gold_cube"])) == values(marts.zone_analysis(orders))
    assert rows(demand_slots(gold["gold_cube"])) == rows(demand_slots(orders))


def test_only_new_files_are_scanned(spark, built, arriving):
    add, fact, store = arriving
    add(0)
    first = gold_store.refresh_gold(spark, fact, store)
    assert first.rebuilt and len(first.scanned) == 2
    add(1)
    second = gold_store.refresh_gold(spark, fact, store)
    assert not second.rebuilt and len(second.scanned) == 2 and not set(first.scanned) & set(second.scanned)
    assert_whole(spark, built, fact, store)
    third = gold_store.refresh_gold(spark, fact, store)
    assert third.scanned == [] and third.folder == second.folder


def test_a_failed_refresh_folds_nothing_twice(spark, built, arriving, monkeypatch):
    add, fact, store = arriving
    add(0)
    gold_store.refresh_gold(spark, fact, store)
    add(1)

    def dies_before_it_is_visible(spark, root, write):
        write(f"{root}/v-00000099-lost")
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(gold_store, "publish", dies_before_it_is_visible)
        with pytest.raises(OSError):
            gold_store.refresh_gold(spark, fact, store)
    assert len(gold_store.refresh_gold(spark, fact, store).scanned) == 2
    assert_whole(spark, built, fact, store)


def test_changed_and_lost_files_are_folded_anew(spark, built, arriving):
    add, fact, store = arriving
    add(0)
    add(1)
    gold_store.refresh_gold(spark, fact, store)
    lost = next(Path(fact).glob("part-*.parquet"))
    lost.unlink()
    again = gold_store.refresh_gold(spark, fact, store)
    assert again.rebuilt and len(again.scanned) == 3
    assert_whole(spark, built, fact, store)


def test_stores_begin_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        gold_store.stored_gold(spark, str(tmp_path / "none"))
