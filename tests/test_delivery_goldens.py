"""Case-study queries over the delivery-shop seed rows; expected values are
the results of the original answers on those rows."""

import datetime as dt

import pytest
from fixtures import (CUSTOMER_ORDERS, PIZZA_NAMES, PIZZA_RECIPES, PIZZA_TOPPINGS, RUNNER_ORDERS, RUNNERS,
                      load, rows)

from tallyframe.operators.append import appended
from tallyframe.plans import delivery as D
from tallyframe.sources.literal import frame


@pytest.fixture(scope="module")
def shop(spark):
    return D.Shop(*(load(spark, t) for t in (RUNNERS, CUSTOMER_ORDERS, RUNNER_ORDERS, PIZZA_NAMES,
                                             PIZZA_RECIPES, PIZZA_TOPPINGS)))


def test_cancelled_literal(shop):
    assert rows(D.cancelled_orders_per_runner_literal(shop)) == [
        (1, dt.date(2021, 1, 1), 2), (2, dt.date(2021, 1, 3), 1), (3, dt.date(2021, 1, 8), 1)]


def test_counts(shop):
    assert rows(D.pizza_types_ordered(shop)) == [(2,)]
    assert rows(D.pizzas_ordered(shop)) == [(14,)]
    assert rows(D.unique_orders(shop)) == [(10,)]
    assert rows(D.delivered_orders_per_runner(shop)) == [(1, 4), (2, 3), (3, 1)]
    assert rows(D.orders_per_pizza(shop)) == [("Meatlovers", 8), ("Vegetarian", 4)]
    assert rows(D.orders_per_customer_and_pizza(shop)) == sorted([
        (101, "Meatlovers", 2), (101, "Vegetarian", 1), (102, "Meatlovers", 2), (102, "Vegetarian", 1),
        (103, "Meatlovers", 2), (103, "Vegetarian", 1), (104, "Meatlovers", 2), (105, "Vegetarian", 1)])
    assert rows(D.max_pizzas_in_order(shop)) == [(3,)]


def test_changes(shop):
    assert rows(D.changes_per_customer(shop)) == [(101, 0, 2), (102, 0, 3), (103, 3, 0), (104, 2, 1), (105, 1, 0)]
    assert rows(D.pizzas_with_both_changes(shop)) == [(1,)]


def test_calendar(shop):
    assert rows(D.pizzas_per_hour(shop)) == [(11, 1), (13, 3), (18, 3), (19, 1), (21, 3), (23, 3)]
    assert rows(D.pizzas_per_weekday(shop)) == [(4, 5), (5, 3), (6, 1), (7, 5)]
    assert rows(D.runner_signups_per_week(shop)) == [(0, 1), (1, 2), (2, 1)]


def test_times_and_numbers(shop):
    assert rows(D.avg_minutes_to_pickup_literal(shop)) == [(18.25,)]
    got = [(r[0], r[4], r[3]) for r in rows(D.pizzas_vs_preparation(shop))]
    assert sorted(got) == sorted([(4, 3, 29), (3, 2, 21), (10, 2, 15), (1, 1, 10), (2, 1, 10), (5, 1, 10),
                                  (7, 1, 10), (8, 1, 20)])
    assert rows(D.avg_distance_literal(shop))[0][0] == pytest.approx(18.15)
    assert rows(D.longest_shortest_duration_literal(shop)) == [("40", "10")]
    assert rows(D.delivery_time_range(shop)) == [(30.0,)]
    got = rows(D.avg_duration_and_distance_per_runner(shop))
    exp = [(1, 22.25, 15.85), (2, 26.6667, 23.9333), (3, 15.0, 10.0)]
    for g, e in zip(got, exp):
        assert g[0] == e[0] and g[1] == pytest.approx(e[1], abs=1e-3) and g[2] == pytest.approx(e[2], abs=1e-3)
    assert rows(D.success_rate_per_runner(shop)) == [(1, 100.0), (2, 75.0), (3, 50.0)]


def test_ingredients(shop):
    assert rows(D.standard_ingredients(shop)) == [
        (1, "Meatlovers", "Bacon,BBQ Sauce,Beef,Cheese,Chicken,Mushrooms,Pepperoni,Salami"),
        (2, "Vegetarian", "Cheese,Mushrooms,Onions,Peppers,Tomatoes,Tomato Sauce")]
    assert rows(D.most_common_extra(shop)) == [("Bacon", 4)]
    assert rows(D.most_common_exclusion(shop)) == [("Cheese", 4)]


def test_modification_labels(shop):
    assert rows(D.modification_labels_literal(shop)) == sorted([
        (4, 103, "Meatlovers - Excluded 2xCheese"), (4, 103, "Vegetarian - Excluded Cheese"),
        (5, 104, "Meatlovers - Extra Bacon"), (7, 105, "Vegetarian - Extra Bacon"),
        (9, 103, "Meatlovers - Excluded Cheese - Extra Bacon,Chicken"),
        (10, 104, "Meatlovers - Excluded BBQ Sauce,Mushrooms - Extra Bacon,Cheese")])


def test_order_item_labels_every_line(shop):
    got = [r[1] for r in rows(D.order_item_labels(shop), "order_id", "order_item")]
    assert len(got) == 14
    assert "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese" in got
    assert got.count("Meatlovers") == 5


def test_ingredient_lists(shop):
    got = dict(rows(D.ingredient_lists(shop), "order_id", "ingredient_list"))
    assert got[5] == "Meatlovers: 2xBacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
    lists = [r[1] for r in rows(D.ingredient_lists(shop), "order_id", "ingredient_list") if r[0] == 10]
    assert "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami" in lists


def test_ingredient_totals(shop):
    got = {r[0]: r[1:] for r in rows(D.ingredient_totals_literal(shop))}
    assert got["Bacon"] == (9, None, 4, 13)
    assert got["Mushrooms"] == (12, 1, None, 11)
    assert got["Cheese"] == (12, 4, 1, 9)
    assert got["Tomatoes"] == (3, None, None, 3)
    assert len(got) == 12


def test_income(shop):
    assert rows(D.income_per_runner_literal(shop)) == [(1, 70), (2, 68), (3, 22)]
    assert rows(D.income_with_extra_charge_literal(shop)) == [(1, 71), (2, 70), (3, 23)]
    assert rows(D.income_with_cheese_charge(shop)) == [(1, 71), (2, 68), (3, 22)]
    assert rows(D.profit_after_runner_pay(shop))[0][0] == pytest.approx(138 - 0.3 * 145.2)


def test_ratings(spark, shop):
    cands = frame(spark, "order_id int, rating int", [(1, 5), (6, 3), (2, 9), (42, 4)])
    v = D.validate_ratings(shop, cands)
    assert rows(v.where("reject_reason is null"), "order_id", "runner_id", "rating") == [(1, 1, 5)]
    assert rows(v.where("reject_reason is not null"), "order_id", "reject_reason") == [
        (2, "rating out of range"), (6, "parent not eligible"), (42, "unknown parent")]
    detail = D.delivery_detail(shop, v.where("reject_reason is null"))
    assert rows(detail, "order_id", "minutes_to_pickup", "total_pizzas") == [(1, 10, 1)]


def test_rate_orders_procedure(spark, shop, tmp_path):
    target = str(tmp_path / "order_rating")
    rate = lambda order, rating, call: D.rate_orders(shop, frame(spark, "order_id int, rating int", [(order, rating)]), target, call)
    assert rate(8, 4, "first").count() == 0
    assert rows(rate(9, 5, "second"), "order_id", "reject_reason") == [(9, "parent not eligible")]
    assert rate(8, 4, "first").count() == 0  # the first call again
    assert rows(appended(spark, target, ["order_id", "runner_id", "rating"])) == [(8, 2, 4)]
