"""Validation, cleaning, sources and sinks on hand-made frames."""

import inspect
import json
import os
import sys

import pytest
from conftest import ORDER, rows
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as contract  # noqa: E402
from basketlens.functions.columns import pair_hash  # noqa: E402
from basketlens.functions.prefix import (quantile_sketches, rank_errors,  # noqa: E402
                                          sketched_quantiles, with_cells)
from basketlens.operators import cleaning, features, graph, prediction, quality  # noqa: E402
from basketlens.sources import readers, sinks, star_schema  # noqa: E402
from check_results import connect, difference  # noqa: E402
from basketlens.sources.stage import fingerprint, forget, staged  # noqa: E402


def test_clean_orders_tells_first_order_from_zero_gap(spark):
    raw = spark.createDataFrame([(1, 7, "prior", 1, 0, 9, None), (2, 7, "prior", 2, 1, 9, 0.0)],
                                ORDER)
    assert rows(cleaning.clean_orders(raw), "order_id", "days_since_prior_order",
                "is_first_order") == [(1, 0.0, 1), (2, 0.0, 0)]


def test_customer_dimension_flags(spark):
    orders = spark.createDataFrame([
        (1, 7, "prior", 1, 0, 9, None), (2, 7, "train", 2, 1, 9, 3.0),
        (3, 8, "test", 1, 1, 9, None)], ORDER)
    assert rows(cleaning.customer_dimension(orders)) == [(7, 2, 1, 0), (8, 1, 0, 1)]


def test_dedupe_keeps_lowest_position(spark):
    raw = spark.createDataFrame([(1, 5, 3, 1), (1, 5, 2, 0), (1, 6, 1, 0)],
                                "order_id long, product_id long, add_to_cart_order int, "
                                "reordered int")
    assert rows(cleaning.dedupe_lines(raw)) == [(1, 5, 2, 0), (1, 6, 1, 0)]
    assert rows(cleaning.dedupe_report(raw)) == [(3, 2, 1)]


def test_trim_and_cast(spark):
    raw = spark.createDataFrame([("3", "  milk ")], "aisle_id string, aisle string")
    assert rows(cleaning.clean_reference(raw, ["aisle_id"], ["aisle"])) == [(3, "milk")]


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    found = {r["column_name"]: r for r in quality.profile({"t": df}).collect()}
    assert (found["a"]["min_value"], found["a"]["max_value"]) == (1.0, 2.0)
    assert (found["b"]["null_count"], found["b"]["null_pct"]) == (2, 66.67)
    assert rows(quality.duplicate_rows({"t": df})) == [("t", 3, 1)]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    row = quality.profile({"t": df}).collect()[0]
    assert (row["total_rows"], row["null_count"], row["null_pct"]) == (0, 0, 0.0)


def test_orphans_are_counted_once_per_key(spark, products, aisles, departments):
    orders = spark.createDataFrame([(1, 7, "prior", 1, 0, 9, None),
                                    (2, 7, "train", 2, 0, 9, 1.0)], ORDER)
    schema = "order_id long, product_id long"
    prior = spark.createDataFrame([(1, 1), (2, 1), (2, 99), (9, 99)], schema)
    train = spark.createDataFrame([(2, 1)], schema)
    found = {r["foreign_key"]: (r["status"], r["orphan_count"], r["rows_checked"])
             for r in quality.foreign_keys(products, aisles, departments, orders, prior,
                                           train).collect()}
    assert found["prior_lines.order_id -> orders.order_id (prior)"] == ("FAIL", 2, 4)
    assert found["prior_lines.product_id -> products.product_id"] == ("FAIL", 1, 4)
    assert found["train_lines.order_id -> orders.order_id (train)"] == ("PASS", 0, 1)
    assert found["products.aisle_id -> aisles.aisle_id"] == ("PASS", 0, 4)


def test_domain_rules_find_each_fault(spark):
    orders = spark.createDataFrame([(1, 7, "prior", 1, 7, 24, 1.0), (2, 7, "prior", 2, 0, 0, 1.0)],
                                   ORDER)
    lines = spark.createDataFrame([(2, 0), (1, 1)], "reordered int, add_to_cart_order int")
    assert {r["violations"] for r in quality.domain_rules(orders, lines).collect()} == {1}


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c")], "k int, v string")
    found = {r["rule"]: r["violations"]
             for r in quality.constraints({"t": (df, ["k"], ["k", "v"])}).collect()}
    assert found == {"UNIQUE (k)": 1, "NOT NULL (k)": 1, "NOT NULL (v)": 1}


def test_schema_differences(spark):
    a = spark.createDataFrame([], "x int, y string")
    b = spark.createDataFrame([], "x long, z string")
    assert rows(quality.schema_differences(a, b.schema)) == [
        ("x", "bigint", "int"), ("y", None, "string"), ("z", "string", None)]


def test_csv_round_trip_and_union(spark, tmp_path):
    df = spark.createDataFrame([(1, "a, b"), (2, None)], "aisle_id int, aisle string")
    sinks.write_union([df, df], str(tmp_path / "t"))
    assert readers.read_csv(spark, str(tmp_path / "t"), readers.SCHEMAS["aisles"]).count() == 4


def test_missing_source_is_an_empty_table(spark, tmp_path):
    df = readers.read_optional(spark, str(tmp_path / "none"), "source bigint, target bigint")
    assert df.columns == ["source", "target"] and df.count() == 0


def test_artifact_as_parquet_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "aisle_id int, aisle string")
    saved = sinks.save_artifact(df, str(tmp_path), "aisles")
    back = readers.read_csv(spark, f"{tmp_path}/aisles.csv", readers.SCHEMAS["aisles"])
    assert rows(saved) == rows(back) == [(1, "a")]


def test_metrics_document(spark, tmp_path):
    a = spark.createDataFrame([("m", 0.5)], "model string, roc_auc double")
    b = spark.createDataFrame([(0.1, 1.0), (0.2, 0.5)], "threshold double, recall double")
    sinks.write_metrics(str(tmp_path / "r"), models=a, sweep=b)
    text = [x for p in (tmp_path / "r").glob("*.json") for x in p.read_text().splitlines()]
    assert len(text) == 1 and len(json.loads(text[0])["sweep"]) == 2
    assert rows(readers.read_report(spark, str(tmp_path / "r"), "models")) == [("m", 0.5)]


def test_load_counts(spark, tmp_path):
    df = spark.range(3)
    assert rows(sinks.load_tables({"t": df}, str(tmp_path))) == [("t", 3)]


def test_upsert_keeps_old_and_adds_new(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, name string, n int")
    new = spark.createDataFrame([(2, 20), (3, 30)], "k int, n int")
    assert rows(graph.upsert(old, new, ["k"])) == [(1, "a", 1), (2, "b", 20), (3, None, 30)]


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path, key = str(tmp_path / "t"), ["k"]
    old = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("name"), F.lit(1).alias("n"))
    sinks.write_buckets(old, path, key, 8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    updates = spark.createDataFrame([(3, 30), (1000, 7)], "k long, n int")
    sinks.upsert_buckets(updates, path, key, graph.upsert, 8)
    sinks.upsert_buckets(updates.limit(0), path, key, graph.upsert, 8)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    kept = {p for p in before if after.get(p) == before[p]}
    assert 6 <= len({p.parent for p in kept}) < 8
    found = {r["k"]: (r["name"], r["n"]) for r in spark.read.parquet(path).collect()}
    assert len(found) == 201 and found[3] == ("a", 30) and found[1000] == (None, 7)
    assert all(found[k] == ("a", 1) for k in range(200) if k != 3)


def test_written_values_are_compared(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    sinks.load_tables({"t": good}, str(tmp_path))
    other = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(quality.verify_written({"t": good}, str(tmp_path))) == [("t", 2, 2, True)]
    assert rows(quality.verify_written({"t": other}, str(tmp_path))) == [("t", 2, 2, False)]
    assert rows(quality.verify_written({"t": good.limit(1)}, str(tmp_path))) == [("t", 1, 2, False)]


def test_merged_sketches_keep_their_rank_error(spark):
    df = spark.range(20000).select((F.col("id") % 7).alias("g"), F.pow(F.rand(3), 3).alias("v")).persist()
    sketches = quantile_sketches(df, ["g"], "v")
    found = rank_errors(df, "v", sketched_quantiles(sketches, [0.0, 0.1, 0.5, 0.99, 1.0])).collect()
    assert len(found) == 5 and all(r["rank_error"] <= 0.015 and r["n"] == 20000 for r in found)
    assert sketched_quantiles(quantile_sketches(df.limit(0), ["g"], "v"), [0.5]).count() == 0


def test_staged_table_is_built_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)
    source = "unit"
    assert staged(spark, source, "t", build).count() == 2
    assert staged(spark, source, "t", build).count() == 2
    assert len(calls) == 1
    forget(source)
    staged(spark, source, "t", build)
    assert len(calls) == 2


def test_changed_source_has_another_fingerprint(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = fingerprint(spark, [path])
    assert before == fingerprint(spark, [path])
    spark.range(4).write.mode("overwrite").parquet(path)
    assert before != fingerprint(spark, [path])


def test_discover_counts_files(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "t"))
    row = readers.discover(spark, {"t": str(tmp_path / "t")}).collect()[0]
    assert (row["file_count"], row["row_count"]) == (2, 10) and row["total_bytes"] > 0


def test_key_sample_is_repeatable(spark):
    df = spark.range(10000)
    part = readers.key_sample(df, "id", 0.25)
    assert 2300 < part.count() < 2700
    assert part.exceptAll(readers.key_sample(df.orderBy(F.desc("id")), "id", 0.25)).count() == 0


@pytest.mark.parametrize("bad", [0, 21])
def test_top_k_range(spark, bad):
    from basketlens.operators import serving
    with pytest.raises(ValueError):
        serving.reorder_list(None, None, top_k=bad)


def test_orphan_lines_and_bad_values_fail_the_checks(spark, tmp_path):
    """Faults in the source reach the registered checks, on both engines."""
    source = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    odd = lines.limit(3).withColumns({
        "l_orderkey": F.lit(10**9).cast("long"), "l_partkey": F.lit(10**9).cast("long"),
        "l_linenumber": F.lit(0).cast(lines.schema["l_linenumber"].dataType),
        "l_quantity": F.lit(-1).cast(lines.schema["l_quantity"].dataType)})
    lines.unionByName(odd).coalesce(1).write.parquet(str(tmp_path / "dir"))
    part = next(p for p in os.listdir(tmp_path / "dir") if p.endswith(".parquet"))
    os.link(tmp_path / "dir" / part, tmp_path / "lineitem.parquet")
    for table in ("orders", "part"):
        os.symlink(f"{source}/{table}.parquet", tmp_path / f"{table}.parquet")
    db = connect(str(tmp_path))
    for name in ("v4_foreign_keys", "v7_domain_rules"):
        found = contract.queries()[name](spark, str(tmp_path)).toPandas()
        assert difference(found, db.execute(contract.oracle_sql()[name]).df()) is None
        if name == "v4_foreign_keys":
            failed = found[found["status"] == "FAIL"]["foreign_key"].tolist()
            assert sorted(failed) == ["prior_lines.order_id -> orders.order_id (prior)",
                                      "prior_lines.product_id -> products.product_id"]
        else:
            assert found.set_index("rule")["violations"]["quantity is positive"] == 3
            assert found.set_index("rule")["violations"]["add_to_cart_order starts at 1"] == 3


def test_no_default_cuts_rows(spark):
    """Operators take everything unless a caller names a limit."""
    for function, names in [
            (features.training_cohort, ["n"]), (features.user_product_features, ["cohort_size"]),
            (graph.nodes, ["customers"]), (graph.co_purchase_edges, ["top_products"])]:
        defaults = inspect.signature(function).parameters
        assert all(defaults[n].default is None for n in names), function


def test_models_are_fitted_on_a_sample_but_score_all(spark, monkeypatch):
    monkeypatch.setattr(prediction, "FIT_ROWS", 10)
    pairs = spark.range(100).select(
        F.col("id").alias("user_id"), F.col("id").alias("product_id"),
        (F.col("id") % 2).cast("int").alias("target"),
        *[F.rand(i).alias(c) for i, c in enumerate(prediction.FEATURES)])
    with prediction.held_rows(pairs, 10) as held:
        assert held.count() == 10
        model = prediction.fit_logistic(held, max_iter=2)
    assert prediction.score(model, pairs).count() == 100


def test_pair_hash_tells_pairs_apart(spark):
    pairs = spark.range(1000).select(F.col("id").alias("u")).crossJoin(
        spark.range(1000).select(F.col("id").alias("p")))
    hashed = pairs.select(pair_hash("u", "p").alias("h"))
    assert hashed.distinct().count() > 990000
    low = hashed.filter("h < 0.1").count()
    assert 95000 < low < 105000


def test_upsert_merges_edges_and_adds_columns(spark):
    old = spark.createDataFrame([(1, 2, "B", 5)], "source int, target int, type string, n int")
    new = spark.createDataFrame([(1, 2, "B", 7, 0.5), (1, 2, "B", 6, 0.1), (3, 4, "B", 1, None)],
                                "source int, target int, type string, n int, weight double")
    found = rows(graph.upsert(old, new, ["source", "target", "type"]))
    assert found == [(1, 2, "B", 7, 0.5), (3, 4, "B", 1, None)]


def test_tables_of_a_folder_are_found(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    (tmp_path / "notes.txt").write_text("x")
    assert list(readers.tables_in(spark, str(tmp_path))) == ["a", "b"]


def test_cells_hold_equal_shares_despite_an_outlier(spark):
    """One extreme value and crowded scores leave no cell with most of the distinct values."""
    values = spark.range(20000).select(
        F.lit("m").alias("k"), F.when(F.col("id") == 0, 1e12).otherwise(
            0.5 + F.col("id") / 1e9).alias("v"))
    cells = with_cells(values, ["k"], "v", 64).groupBy("_cell").count()
    assert cells.agg(F.max("count")).first()[0] < 20000 / 64 * 3


def test_a_day_of_very_many_orders_is_numbered_in_chunks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(star_schema, "IDS_PER_CHUNK", 10)
    spark.range(1, 101).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"),
        F.lit("2020-01-01").alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    found = star_schema.orders(spark, str(tmp_path)).orderBy("order_id")
    assert [r["order_number"] for r in found.collect()] == list(range(1, 101))
