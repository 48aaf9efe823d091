"""Shuffles and sizes of the shared steps, and their results on rows with repeats and nulls."""

import datetime

import pytest
from pyspark.sql import functions as F

from basketlens.functions.prefix import smallest_n
from basketlens.operators import features, forecasting, quality
from basketlens.sources import star_schema

from conftest import LINE, ORDER, rows


def day(number):
    return datetime.datetime(1995, 1, 1) + datetime.timedelta(days=number)


@pytest.fixture
def folder(spark, tmp_path):
    orders = [(1, 7, day(0)), (200001, 7, day(0)), (2, 7, day(3)), (3, 8, day(1)), (3, 8, day(1)),
              (None, 8, day(5)), (4, 8, day(5)), (5, None, day(2)), (6, 9, None), (8, 9, day(4))]
    items = [(1, 50, 2), (1, 50, 1), (1, 51, 3), (200001, 50, 1), (2, 51, 1), (2, 50, 2), (2, 50, None),
             (3, 60, 1), (4, 60, 1), (4, None, 2), (8, 60, 1), (99, 60, 1)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"),
            ("lineitem", items, "l_orderkey long, l_partkey long, l_linenumber int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_orders_are_numbered_over_chunks_with_few_shuffles(spark, folder):
    orders = star_schema.orders(spark, folder)
    found = {tuple(r) for r in orders.select("order_id", "user_id", "eval_set", "order_number",
                                             "days_since_prior_order").collect()}
    assert found == {(1, 7, "prior", 1, None), (200001, 7, "prior", 2, 0.0), (2, 7, "train", 3, 3.0),
                     (3, 8, "prior", 1, None), (3, 8, "prior", 2, 0.0), (4, 8, "train", 4, 0.0),
                     (8, 9, "test", 2, None)}
    assert shuffles(star_schema.orders(spark, folder)) <= 4


def test_lines_are_shuffled_twice(spark, folder):
    orders = spark.createDataFrame(
        star_schema.orders(spark, folder).collect(), star_schema.orders(spark, folder).schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = star_schema.order_lines(spark, folder, orders)
        # Twice the lines, once their orders.
        assert shuffles(lines) <= 3
        found = sorted((tuple(r) for r in lines.select(
            "order_id", "product_id", "add_to_cart_order", "reordered", "order_number").collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == sorted([
        (1, 50, 1, 0, 1), (1, 51, 2, 0, 1), (200001, 50, 1, 1, 2), (2, 51, 1, 1, 3), (2, 50, 2, 1, 3),
        (3, 60, 1, 0, 1), (3, 60, 1, 1, 2), (4, 60, 1, 1, 4), (4, None, 2, None, 4), (8, 60, 1, 0, 2)], key=repr)


def test_tasks_of_the_line_table_follow_its_source(spark, folder, monkeypatch):
    monkeypatch.setattr(star_schema, "LINE_BYTES_PER_TASK", 10)
    lines = star_schema.order_lines(spark, folder, star_schema.orders(spark, folder))
    assert lines.rdd.getNumPartitions() > 50


def test_days_without_orders_are_not_shuffled(spark):
    series = spark.createDataFrame(
        [(key, datetime.date(1995, 1, 1) + datetime.timedelta(days=n), y)
         for key, n, y in [("a", 0, 2), ("a", 3, 1), ("b", 2, 4), ("c", 40, 1), (None, 38, 5)]],
        "series_key string, ds date, y long")
    report = forecasting.series_report(forecasting.intermittent_days(series, 3), 5)
    # Days with orders go by series once; neither the window nor the report moves them again.
    assert report._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    found = {r["series_key"]: (r["days"], r["volume"], r["active_days"]) for r in report.collect()}
    assert found == {"a": (41, 3, 2), "b": (39, 4, 1), "c": (1, 1, 1), None: (3, 0, 0)}


def test_arrays_of_intermittent_series_equal_their_days(spark):
    series = spark.createDataFrame(
        [(key, datetime.date(1995, 1, 1) + datetime.timedelta(days=n), 1 + n % 3)
         for key, step in [("a", 1), ("b", 5), ("c", 17)] for n in range(0, 60, step)],
        "series_key string, ds date, y long")
    days = forecasting.intermittent_days(series)
    dense = {}
    for r in days.orderBy("series_key", "ds").collect():
        dense.setdefault(r["series_key"], []).append(float(r["y"]))
    made = forecasting.intermittent_series(series, 2)
    assert {r["series_key"]: r["train"] for r in made.collect()} == dense
    plain = forecasting.forecast_arima(days).orderBy("series_key", "forecast_date").collect()
    assert forecasting.forecast_arima(made).orderBy("series_key", "forecast_date").collect() == plain


@pytest.fixture
def history(spark):
    """Orders and lines with repeats, nulls, a user without a past and one without a train order."""
    orders = [(1, 7, "prior", 1), (2, 7, "prior", 2), (3, 7, "train", 3), (4, 8, "prior", 1),
              (5, 8, "test", 2), (6, 9, "train", 1), (7, None, "test", 1)]
    places = {o: (u, n, s) for o, u, s, n in orders}
    bought = [(1, 50, 1, 0), (1, 51, 2, 0), (2, 50, 1, 1), (2, None, 2, None), (3, 50, 3, 1), (3, 50, 3, 1),
              (3, None, 1, None), (3, 52, 2, 0), (4, 50, 1, 0), (6, 50, 1, 0), (7, 50, 1, None)]
    return (spark.createDataFrame([(o, u, s, n, 0, 0, 0.0) for o, u, s, n in orders], ORDER),
            spark.createDataFrame([(o, p, c, r, *places[o]) for o, p, c, r in bought], LINE))


def test_pairs_meet_their_users_in_the_given_tasks(history):
    orders, lines = history
    found = features.user_product_features(orders, lines, tasks=60)
    assert found.rdd.getNumPartitions() == 60
    wanted = [(7, 50, 2, 1.0, 0, 1.0, 1), (7, 51, 1, 0.5, 1, 2.0, 0), (7, None, 0, 0.0, 0, None, 0)]
    assert rows(found) == rows(features.user_product_features(orders, lines)) == sorted(wanted, key=repr)
    assert rows(features.user_product_features(orders, lines, 1)) == sorted(wanted, key=repr)


def test_item_stats_meet_in_the_given_tasks(history, products):
    _, lines = history
    found = features.customer_item_stats(lines, products, 60)
    assert found.rdd.getNumPartitions() == 60
    assert rows(found) == rows(features.customer_item_stats(lines, products))


def test_keys_meet_their_parents_in_the_given_tasks(history, products, aisles, departments):
    orders, lines = history
    prior, train = (lines.filter(lines["eval_set"] == split) for split in ("prior", "train"))
    plain = quality.foreign_keys(products, aisles, departments, orders, prior, train)
    found = quality.foreign_keys(products, aisles, departments, orders, prior, train, 61)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Both sides of the join have the given tasks.
    assert plan.count(", 61), REPARTITION_BY_NUM") == 2
    assert rows(found) == rows(plain)
    assert {r["foreign_key"]: (r["status"], r["orphan_count"], r["rows_checked"]) for r in found.collect()} == {
        quality.RELATIONS["aisle"]: ("PASS", 0, 4), quality.RELATIONS["department"]: ("PASS", 0, 4),
        quality.RELATIONS["prior_order"]: ("PASS", 0, 5), quality.RELATIONS["prior_product"]: ("FAIL", 2, 4),
        quality.RELATIONS["train_order"]: ("PASS", 0, 5), quality.RELATIONS["train_product"]: ("FAIL", 2, 4)}


def test_a_sample_by_score_joins_no_rows(spark):
    marks = [None, None, 0.9, 0.5, 0.5, 0.5, 0.51, 0.1, 0.1, 0.0]
    df = spark.createDataFrame(list(enumerate(marks)), "id long, mark double")
    drawn = smallest_n(df, F.col("mark"), 6, ["id"], cells=10)
    assert "Join" not in drawn._jdf.queryExecution().executedPlan().toString()
    # Rows without a score count but are never drawn; ties go to the smaller id.
    for n, wanted in [(0, []), (2, []), (3, [9]), (5, [7, 8, 9]), (7, [3, 4, 7, 8, 9]),
                      (8, [3, 4, 5, 7, 8, 9]), (9, [3, 4, 5, 6, 7, 8, 9]), (99, [2, 3, 4, 5, 6, 7, 8, 9])]:
        found = smallest_n(df, F.col("mark"), n, ["id"], cells=10)
        assert sorted(r["id"] for r in found.collect()) == wanted
    assert smallest_n(df.limit(0), F.col("mark"), 3, ["id"]).count() == 0
