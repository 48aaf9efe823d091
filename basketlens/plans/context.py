"""The tables a query reads, derived on first use from one source folder."""

from functools import cached_property

from pyspark.sql import functions as F

from basketlens.operators import (cleaning, features, forecasting, graph, prediction,
                                  segmentation, serving)
from basketlens.sources import star_schema
from basketlens.sources.stage import fingerprint, staged, tasks_for

# Persona thresholds for the star-schema source, whose gaps are months rather than days.
STAR_THRESHOLDS = {"loyal_orders": 9, "loyal_reorder": 0.05, "bulk_basket": 4,
                   "bulk_departments": 5, "risk_interval": 200, "risk_recency": 260}


class Retail:
    """Cleaned tables, features, segments and edges of one source at one grain.

    At ``aisle`` grain an aisle takes the place of a product, which makes repeat purchases
    and pairs frequent. Tables the pipeline materialises are staged once per application.
    """

    def __init__(self, spark, folder, grain="product"):
        self.spark, self.folder, self.grain = spark, str(folder), grain

    @cached_property
    def source(self):
        """The folder with the state of its files, so that changed data is derived anew."""
        return fingerprint(self.spark, [f"{self.folder}/{t}.parquet"
                                        for t in ("orders", "lineitem", "part")])

    def _staged(self, name, build, partition_by=()):
        return staged(self.spark, self.source, name, build, partition_by)

    @cached_property
    def at_aisle(self):
        return Retail(self.spark, self.folder, "aisle")

    @cached_property
    def departments(self):
        return self._staged("departments", lambda: cleaning.clean_reference(
            star_schema.departments(self.spark, self.folder), ["department_id"], ["department"]))

    @cached_property
    def aisles(self):
        return self._staged("aisles", lambda: cleaning.clean_reference(
            star_schema.aisles(self.spark, self.folder), ["aisle_id"], ["aisle"]))

    @cached_property
    def products(self):
        return self._staged(f"products_{self.grain}", lambda: cleaning.clean_reference(
            star_schema.products(self.spark, self.folder, self.grain),
            ["product_id", "aisle_id", "department_id"], ["product_name"]))

    @cached_property
    def raw_orders(self):
        return self._staged("raw_orders", lambda: star_schema.orders(self.spark, self.folder))

    @cached_property
    def raw_lines(self):
        return star_schema.raw_lines(self.spark, self.folder)

    @cached_property
    def orders(self):
        return cleaning.clean_orders(self.raw_orders)

    @cached_property
    def customers(self):
        return cleaning.customer_dimension(self.orders)

    @cached_property
    def lines(self):
        return self._staged(f"lines_{self.grain}", lambda: star_schema.order_lines(
            self.spark, self.folder, self.raw_orders, self.grain), ["eval_set"])

    def lines_of(self, split):
        """The bare line table of one split, as the raw source would deliver it."""
        return self.lines.filter(F.col("eval_set") == split).select(
            "order_id", "product_id", "add_to_cart_order", "reordered")

    @cached_property
    def product_features(self):
        return self._staged(f"product_features_{self.grain}", lambda: features.product_features(
            self.lines, self.products))

    @cached_property
    def customer_features(self):
        return self._staged(f"customer_features_{self.grain}", lambda: features.customer_features(
            self.orders, self.lines, self.products, tasks=self.line_tasks))

    @cached_property
    def pair_features(self):
        return self._staged(f"pair_features_{self.grain}", lambda: features.user_product_features(
            self.orders, self.lines, tasks=self.line_tasks))

    @cached_property
    def labelled(self):
        """Customers with a cluster by a fixed rule: many orders, large baskets."""
        many = (F.col("user_total_orders") > 9).cast("int")
        large = (F.col("user_avg_basket_size") > 4).cast("int")
        return self.customer_features.withColumn("cluster", many * 2 + large)

    @cached_property
    def segments(self):
        return segmentation.name_segments(self.labelled, STAR_THRESHOLDS)

    @cached_property
    def bought(self):
        return self._staged(f"bought_{self.grain}", lambda: graph.bought_edges(self.lines))

    @cached_property
    def min_support(self):
        return 25 if self.grain == "aisle" else 2

    @cached_property
    def pairs(self):
        return self._staged(f"co_purchase_{self.grain}", lambda: graph.co_purchase_edges(
            self.lines, self.product_features, min_support=self.min_support))

    @cached_property
    def matrix(self):
        """Every candidate pair with its features; fits take all those of training users."""
        return prediction.training_matrix(self.pair_features, self.customer_features,
                                          self.product_features)

    @cached_property
    def scored(self):
        """Validation pairs with two fixed scores: the serving blend and the order rate."""
        return self._staged(f"scored_{self.grain}", self._fixed_scores)

    def _fixed_scores(self):
        blend = serving.heuristic_score(F.col("prod_reorder_rate"), F.col("user_reorder_rate"))
        names = F.explode(F.array(
            F.struct(F.lit("blend").alias("model"), blend.cast("double").alias("score")),
            F.struct(F.lit("order_rate").alias("model"),
                     F.least("up_order_rate", F.lit(1.0)).alias("score")))).alias("s")
        return prediction.split_by_user(self.matrix)[1].select("target", names).select(
            "s.model", "target", "s.score")

    @cached_property
    def timeline_days(self):
        return self._staged("timeline_days", lambda: forecasting.fill_days(
            forecasting.daily_volume(forecasting.order_timeline(self.orders), None, None)))

    @cached_property
    def department_days(self):
        return self._staged("department_days", lambda: forecasting.fill_days(
            forecasting.daily_volume_by(self.orders, self.lines, self.products)))

    @cached_property
    def product_volume(self):
        """Daily orders of every product on the days that have any."""
        return self._staged("product_volume", lambda: forecasting.daily_volume_by(
            self.orders, self.lines, self.products, "product_id"))

    @cached_property
    def line_tasks(self):
        """Number of tasks among which tables of the size of the lines are dealt."""
        return tasks_for(self.spark, f"{self.folder}/lineitem.parquet", star_schema.LINE_BYTES_PER_TASK)

    @cached_property
    def fit_tasks(self):
        """Number of tasks that hold the rows of a model fit, the same on clusters of any size."""
        return tasks_for(self.spark, f"{self.folder}/lineitem.parquet", star_schema.LINE_BYTES_PER_TASK,
                         least=prediction.FIT_TASKS)

    @cached_property
    def product_days(self):
        """Daily orders of every product, days without orders included."""
        return forecasting.intermittent_days(self.product_volume, self.line_tasks)

    @cached_property
    def product_series(self):
        """The product days as one array per product, in packs for a fit."""
        return forecasting.intermittent_series(self.product_volume, self.line_tasks)

    @cached_property
    def backtest(self):
        return forecasting.average_backtest(forecasting.holdout_split(self.timeline_days))

    @cached_property
    def demand_forecast(self):
        """The platform's next 30 days by the seasonal ARIMA fitted to all its days."""
        return self._staged("demand_forecast", lambda: forecasting.forecast_arima(
            self.timeline_days).drop("series_key", "reason"))
