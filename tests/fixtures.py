"""Case-study seed rows used as test inputs (values as an insert script writes
them: strings, NULL as None)."""

from tallyframe.sources.literal import frame

RUNNERS = ("runner_id int, registration_date date", [
    (1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")])

CUSTOMER_ORDERS = ("order_id int, customer_id int, pizza_id int, exclusions string, extras string, "
                   "order_time timestamp", [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, None, "1", "2020-01-08 21:00:29"),
    (6, 101, 2, None, None, "2020-01-08 21:03:13"),
    (7, 105, 2, None, "1", "2020-01-08 21:20:29"),
    (8, 102, 1, None, None, "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, None, None, "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49")])

RUNNER_ORDERS = ("order_id int, runner_id int, pickup_time string, distance string, duration string, "
                 "cancellation string", [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, None, None, None, "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", None),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", None),
    (9, 2, None, None, None, "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", None)])

PIZZA_NAMES = ("pizza_id int, pizza_name string", [(1, "Meatlovers"), (2, "Vegetarian")])

PIZZA_RECIPES = ("pizza_id int, toppings string", [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")])

PIZZA_TOPPINGS = ("topping_id int, topping_name string", [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")])

PLANS = ("plan_id int, plan_name string, price decimal(5,2)", [
    (0, "trial", "0"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"), (3, "pro annual", "199"),
    (4, "churn", None)])

# Subscription rows of the customers in the published payments example.
SUBSCRIPTIONS_SAMPLE = ("customer_id int, plan_id int, start_date date", [
    (1, 0, "2020-08-01"), (1, 1, "2020-08-08"),
    (2, 0, "2020-09-20"), (2, 3, "2020-09-27"),
    (13, 0, "2020-12-15"), (13, 1, "2020-12-22"), (13, 2, "2021-03-29"),
    (15, 0, "2020-03-17"), (15, 2, "2020-03-24"), (15, 4, "2020-04-29"),
    (16, 0, "2020-05-31"), (16, 1, "2020-06-07"), (16, 3, "2020-10-21"),
    (18, 0, "2020-07-06"), (18, 2, "2020-07-13"),
    (19, 0, "2020-06-22"), (19, 2, "2020-06-29"), (19, 3, "2020-08-29")])

# The published payments example for those customers.
PAYMENTS_EXPECTED = [
    (1, 1, "basic monthly", "2020-08-08", "9.90", 1), (1, 1, "basic monthly", "2020-09-08", "9.90", 2),
    (1, 1, "basic monthly", "2020-10-08", "9.90", 3), (1, 1, "basic monthly", "2020-11-08", "9.90", 4),
    (1, 1, "basic monthly", "2020-12-08", "9.90", 5),
    (2, 3, "pro annual", "2020-09-27", "199.00", 1),
    (13, 1, "basic monthly", "2020-12-22", "9.90", 1),
    (15, 2, "pro monthly", "2020-03-24", "19.90", 1), (15, 2, "pro monthly", "2020-04-24", "19.90", 2),
    (16, 1, "basic monthly", "2020-06-07", "9.90", 1), (16, 1, "basic monthly", "2020-07-07", "9.90", 2),
    (16, 1, "basic monthly", "2020-08-07", "9.90", 3), (16, 1, "basic monthly", "2020-09-07", "9.90", 4),
    (16, 1, "basic monthly", "2020-10-07", "9.90", 5), (16, 3, "pro annual", "2020-10-21", "189.10", 6),
    (18, 2, "pro monthly", "2020-07-13", "19.90", 1), (18, 2, "pro monthly", "2020-08-13", "19.90", 2),
    (18, 2, "pro monthly", "2020-09-13", "19.90", 3), (18, 2, "pro monthly", "2020-10-13", "19.90", 4),
    (18, 2, "pro monthly", "2020-11-13", "19.90", 5), (18, 2, "pro monthly", "2020-12-13", "19.90", 6),
    (19, 2, "pro monthly", "2020-06-29", "19.90", 1), (19, 2, "pro monthly", "2020-07-29", "19.90", 2),
    (19, 3, "pro annual", "2020-08-29", "199.00", 3)]

REGIONS = ("region_id int, region_name string", [
    (1, "Australia"), (2, "America"), (3, "Africa"), (4, "Asia"), (5, "Europe")])

CUSTOMER_NODES_1 = ("customer_id int, region_id int, node_id int, start_date date, end_date date", [
    (1, 3, 4, "2020-01-02", "2020-01-03"), (1, 3, 4, "2020-01-04", "2020-01-14"),
    (1, 3, 2, "2020-01-15", "2020-01-16"), (1, 3, 5, "2020-01-17", "2020-01-28"),
    (1, 3, 3, "2020-01-29", "2020-02-18"), (1, 3, 2, "2020-02-19", "2020-03-16"),
    (1, 3, 2, "2020-03-17", "9999-12-31")])

TRANSACTIONS_1 = ("customer_id int, txn_date date, txn_type string, txn_amount int", [
    (1, "2020-01-02", "deposit", 312), (1, "2020-03-05", "purchase", 612),
    (1, "2020-03-17", "deposit", 324), (1, "2020-03-19", "purchase", 664)])


def load(spark, spec):
    ddl, data = spec
    return frame(spark, ddl, data)


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
