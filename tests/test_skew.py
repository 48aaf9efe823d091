"""Results stay whole when one user, one product and one order hold a third of all rows."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as contract  # noqa: E402
from basketlens.plans import queries  # noqa: E402
from check_results import connect, difference  # noqa: E402

SOURCE = "/root/testdata/sf0.001"
NAMES = ["c2_orders", "c5_order_lines", "c5_order_lines_aisle", "v5_split_foreign_keys",
         "a1_top_products", "a4_customer_summary", "e13_departments", "f2_aisle_features",
         "f5_customer_features", "f7_f8_pair_features", "g5_cluster_profile", "t1_timeline",
         "t12_department_days", "h3_bought_edges", "h4_co_purchase_product",
         "h6_recommendations", "p2_sample", "p7_p8_ranking_metrics"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    third = F.pmod(F.col("o_orderkey"), F.lit(3)) == 0
    spark.read.parquet(f"{SOURCE}/orders.parquet").withColumn(
        "o_custkey", F.when(third, 7).otherwise(F.col("o_custkey")).cast("bigint")
    ).coalesce(1).write.parquet(f"{folder}/orders_dir")
    mark = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_linenumber"), F.lit(6))
    spark.read.parquet(f"{SOURCE}/lineitem.parquet").withColumns({
        "l_partkey": F.when(mark < 2, 5).otherwise(F.col("l_partkey")).cast("bigint"),
        "l_orderkey": F.when(mark.isin(2, 3), 8).otherwise(F.col("l_orderkey")).cast("bigint")
    }).coalesce(1).write.parquet(f"{folder}/lineitem_dir")
    for table in ("orders", "lineitem"):
        part = next(p for p in os.listdir(f"{folder}/{table}_dir") if p.endswith(".parquet"))
        os.link(f"{folder}/{table}_dir/{part}", f"{folder}/{table}.parquet")
    os.symlink(f"{SOURCE}/part.parquet", f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_source_agrees_with_sql(spark, skewed, name):
    found = contract.queries()[name](spark, skewed).toPandas()
    assert difference(found, connect(skewed).execute(contract.oracle_sql()[name]).df()) is None


def test_no_plan_pairs_tables_without_a_key(spark):
    """Model fits aside, no query uses a cross product or a nested loop."""
    fitted = {"g2_g3_k_sweep", "g4_clusters", "g7_fitted_summary", "p4_logistic_scores",
              "p5_forest_scores", "p6_boosted_scores", "p11_importances",
              "p11_forest_importances", "p12_leaderboard", "p13_batch_scores",
              "t12_product_forecast"}
    for name in set(queries.CATALOGUE) - fitted:
        plan = queries.build(name)(spark, SOURCE)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
