"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time is the median of warm runs after one unmeasured run. Tables the pipeline
materialises are written by the unmeasured runs and timed on their own as ``stage_*``.
Model fits are timed once, after a small fit has warmed the JVM.
"""

import json
import logging
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlens.operators import prediction  # noqa: E402
from basketlens.plans import queries  # noqa: E402
from basketlens.plans.context import Retail  # noqa: E402
from basketlens.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "c2_orders", "c5_order_lines", "v4_foreign_keys", "a1_top_products",
    "a2_volume_by_day_hour", "a3_retention", "a5_order_baskets", "e5_repurchase_interval",
    "e7_basket_size_stats", "e13_departments", "e18_top_pairs", "f2_product_features",
    "f5_customer_features", "f7_f8_pair_features", "g5_cluster_profile", "g7_segment_summary",
    "p1_training_matrix", "p7_p8_ranking_metrics", "p10_threshold_sweep", "t1_timeline",
    "t5_average_backtest", "t12_department_days", "h3_bought_edges", "h4_co_purchase",
    "h4_co_purchase_product", "h6_recommendations", "r2_reorder_list", "r3_bought_together",
    "b5_kpis", "t8_forecast", "t10_leaderboard", "t12_forecast"]


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(job):
    started = time.perf_counter()
    job()
    return round(time.perf_counter() - started, 3)


def main():
    logging.disable(logging.WARNING)
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for grain in ("product", "aisle"):
        retail = Retail(spark, FOLDER, grain)
        for table in ("raw_orders", "lines", "product_features", "customer_features",
                      "pair_features", "bought", "pairs"):
            taken = timed(lambda t=table, r=retail: getattr(r, t))
            if table != "raw_orders" or grain == "product":
                times[f"stage_{table}_{grain}"] = taken
    for name in HEADLINE:
        def job(name=name):
            noop(queries.build(name)(spark, FOLDER))
        job()
        times[name] = round(statistics.median(timed(job) for _ in range(RUNS)), 3)

    retail = Retail(spark, FOLDER, "aisle")
    train, _ = prediction.split_by_user(retail.matrix)
    with prediction.held_rows(train) as rows:
        rows.count()
        prediction.fit_boosted(rows, rounds=2)
        times["fit_logistic"] = timed(lambda: prediction.fit_logistic(rows))
        times["fit_forest_80"] = timed(lambda: prediction.fit_forest(rows))
        times["fit_boosted_150"] = timed(lambda: prediction.fit_boosted(rows))
    times["g2_g3_k_sweep"] = timed(lambda: noop(queries.build("g2_g3_k_sweep")(spark, FOLDER)))

    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(FOLDER),
                      "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
