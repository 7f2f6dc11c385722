from __future__ import annotations

import time

import pytest

import sample
from tillbook.plans import analytics, jobs
from tillbook.sources import landing
from tillbook.streaming import OrderFeed

NEW_ORDER = {
    "order_id": "1016",
    "customer_id": "7",
    "product_id": "104",
    "quantity": "3",
    "order_ts": "2024-05-22 12:00:00",
    "status": "COMPLETED",
}


@pytest.fixture
def feed(spark, layers):
    sample.land(spark, layers)
    return OrderFeed(spark, layers)


def staged(feed, *columns):
    return sample.bag(feed.layers.staged_orders(feed.spark).read().select(*columns))


def test_new_order_scenario(spark, layers, feed):
    feed.seed()
    assert len(staged(feed, "order_id")) == 15
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER])
    feed.run_once()
    assert len(staged(feed, "order_id")) == 16
    found = layers.staged_orders(spark).read().filter("order_id = 1016").drop("_loaded_at")
    assert sample.values(found) == [("1016", "7", "104", "3", "2024-05-22 12:00:00", "COMPLETED")]
    jobs.refresh_marts(spark, layers)
    assert sample.values(analytics.kpis(jobs.load_star(spark, layers).fact)) == [("14", "17908.00", "1279.14")]


def test_run_without_new_files_does_nothing(spark, layers, feed):
    feed.seed()
    before = layers.staged_orders(spark).state()
    feed.run_once()
    assert layers.staged_orders(spark).state() == before
    with pytest.raises(RuntimeError):
        feed.seed()


def test_late_update_overwrites_whatever_its_time(spark, layers, feed):
    feed.seed()
    late = NEW_ORDER | {"order_id": "1003", "order_ts": "1999-01-01 00:00:00", "status": "cancelled", "quantity": "x"}
    landing.insert_rows(spark, layers, "orders", [late, late | {"order_id": None}])
    feed.run_once()
    row = [row for row in staged(feed, "order_id", "customer_id", "quantity", "order_ts", "status") if row[0] == "1003"]
    assert row == [("1003", "7", "1", "1999-01-01 00:00:00", "CANCELLED")]


def test_references_are_checked_in_the_seed_only_unless_asked(spark, layers, feed):
    stranger = NEW_ORDER | {"customer_id": "99"}
    unknown = NEW_ORDER | {"product_id": "999", "order_id": "1017"}
    landing.insert_rows(spark, layers, "orders", [stranger, unknown])
    feed.seed()
    assert len(staged(feed, "order_id")) == 15
    landing.insert_rows(spark, layers, "orders", [stranger, unknown])
    feed.run_once()
    assert len(staged(feed, "order_id")) == 17
    jobs.refresh_marts(spark, layers)
    star = jobs.load_star(spark, layers)
    assert star.fact.count() == 14  # the unknown product drops out at the join, the unknown customer stays
    assert sum(row.orders for row in analytics.revenue_by_city(star.fact, star.customers).collect()) == 13
    strict = OrderFeed(spark, layers, enforce_refs=True)
    landing.insert_rows(spark, layers, "orders", [stranger | {"order_id": "1018"}, NEW_ORDER | {"order_id": "1019"}])
    strict.run_once()
    assert len(staged(feed, "order_id")) == 18


def test_crash_after_the_merge_is_not_merged_twice(spark, layers, feed, monkeypatch):
    feed.seed()
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER])
    merge = OrderFeed._merge

    def merge_and_die(self, batch, batch_id):
        merge(self, batch, batch_id)
        raise RuntimeError("executor of the driver lost")

    monkeypatch.setattr(OrderFeed, "_merge", merge_and_die)
    with pytest.raises(Exception, match="lost"):
        feed.run_once()
    monkeypatch.undo()
    after_crash = layers.staged_orders(spark).state()
    assert after_crash["last_batch"] == 1
    feed.run_once()
    assert layers.staged_orders(spark).state() == after_crash
    assert len(staged(feed, "order_id")) == 16


def test_crash_before_the_merge_is_made_good(spark, layers, feed, monkeypatch):
    def die(self, batch, batch_id):
        raise RuntimeError("lost")

    monkeypatch.setattr(OrderFeed, "_merge", die)
    with pytest.raises(Exception, match="lost"):
        feed.seed()
    monkeypatch.undo()
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER | {"product_id": "999"}])
    feed.run_once()
    assert layers.staged_orders(spark).state()["last_batch"] == 1
    assert len(staged(feed, "order_id")) == 16  # 15 of the seed, checked, and one of the second batch, unchecked


def test_lost_checkpoint_is_refused(spark, layers, feed):
    feed.seed()
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER])
    with pytest.raises(Exception, match="is fed by"):
        OrderFeed(spark, layers, name="other").run_once()
    assert len(staged(feed, "order_id")) == 15


def test_resume_and_suspend(spark, layers, feed):
    feed.seed()
    query = feed.resume("1 second")
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER])
    deadline = time.time() + 60
    while time.time() < deadline and len(staged(feed, "order_id")) < 16:
        time.sleep(0.5)
    query.stop()
    assert not query.isActive
    assert len(staged(feed, "order_id")) == 16
    landing.insert_rows(spark, layers, "orders", [NEW_ORDER | {"order_id": "1017"}])
    feed.run_once()
    assert len(staged(feed, "order_id")) == 17


def test_feed_compacts_after_so_many_batches(spark, layers):
    sample.land(spark, layers)
    feed = OrderFeed(spark, layers, compact_after=2)
    feed.seed()
    for number in range(1016, 1019):
        landing.insert_rows(spark, layers, "orders", [NEW_ORDER | {"order_id": str(number)}])
        feed.run_once()
    state = layers.staged_orders(spark).state()
    assert len(state["folders"]) > 1 and (len(state["batches"]), state["last_batch"]) == (1, 3)
    assert len(staged(feed, "order_id")) == 18
