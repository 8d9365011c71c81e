"""Plan-shape assertions: the physical plans that must hold at cluster scale."""

import os
import tempfile

import pytest

from conftest import SF_SMALL
from starloom.plans import MODELS
from starloom.sources.views import Mart, materialize_mart

# nested-loop joins are allowed only against frames of proven small size:
# one-row aggregates (thresholds, scalar subqueries), the 4-row week range
# of the inventory derivation, one row per call center (q77)
NESTED_LOOP_OK = {"q09", "q14a", "q14b", "q21", "q22", "q23a", "q23b", "q24a", "q24b", "q37", "q39a", "q39b",
                  "q44", "q54", "q61", "q72", "q77", "q82"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    m = Mart(spark, SF_SMALL)
    return {name: plan_of(fn(m)) for name, fn in MODELS.items()}


def test_rollups_cascade(plans):
    """No model multiplies rows for its subtotals: each level reads the next finer one."""
    assert [n for n in ("q05", "q14a", "q18", "q22", "q27", "q36", "q67", "q70", "q77", "q80", "q86") if "Expand" in plans[n]] == []


def test_no_cartesian_products(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p] == []


def test_nested_loops_only_against_bounded_sides(plans):
    assert sorted(n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p and n not in NESTED_LOOP_OK) == []


@pytest.mark.parametrize("name,node", [("q10", "LeftSemi"), ("q35", "LeftSemi"), ("q69", "LeftAnti"),
                                       ("q16", "LeftAnti"), ("q94", "LeftAnti"), ("q78", "LeftAnti"),
                                       ("q95", "LeftSemi"), ("q23a", "LeftSemi")])
def test_subqueries_become_semi_and_anti_joins(plans, name, node):
    assert node in plans[name]


def test_rank_filter_becomes_window_group_limit(plans):
    assert "WindowGroupLimit" in plans["q67"]


def test_no_python_in_plans(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p or "ArrowEvalPython" in p] == []


def test_filters_and_pruning_reach_the_scan(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="starloom-plan-"), "mart")
    materialize_mart(spark, SF_SMALL, out)
    plan = plan_of(MODELS["q07"](Mart(spark, out)))
    assert "PushedFilters: [IsNotNull(d_year), EqualTo(d_year,1998)" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "ss_sold_date_sk" in ln][0]
    # only the columns q07 needs are read from store_sales
    assert "ss_net_profit" not in scan and "ss_quantity" in scan


FACTS = {"ss_": "store_sales", "cs_": "catalog_sales", "ws_": "web_sales", "sr_": "store_returns", "cr_": "catalog_returns",
         "wr_": "web_returns", "inv_": "inventory"}


def fact_scans(plan):
    """Fact scans that a plan evaluates: those outside of shared frames, and those of each shared frame once."""
    found, shared_depth, seen = [], None, set()
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*|"))
        if shared_depth is not None and depth <= shared_depth:
            shared_depth = None
        if "InMemoryRelation" in line:
            shared_depth = depth
        if "FileScan parquet [" not in line:
            continue
        columns = line.split("FileScan parquet [")[1].split("]")[0]  # with the ids that tell one scan from another
        if shared_depth is None or columns not in seen:
            found += [t for p, t in FACTS.items() if columns.startswith(p)]
        if shared_depth is not None:
            seen.add(columns)
    return sorted(found)


@pytest.fixture(scope="module")
def written_mart(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="starloom-plan-"), "mart")
    materialize_mart(spark, SF_SMALL, out)
    return Mart(spark, out)


@pytest.mark.parametrize("name,scans", [("q14a", ["catalog_sales", "store_sales", "web_sales"]), ("q14b", ["catalog_sales", "store_sales", "web_sales"]),
                                        ("q23a", ["catalog_sales", "store_sales", "web_sales"]), ("q23b", ["catalog_sales", "store_sales", "web_sales"]),
                                        ("q44", ["store_sales"]),
                                        ("q49", ["catalog_returns", "catalog_sales", "store_returns", "store_sales", "web_returns", "web_sales"])])
def test_each_fact_is_read_once_without_exchange_reuse(spark, written_mart, name, scans):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert fact_scans(plan_of(MODELS[name](written_mart))) == scans
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_shared_frame_is_evaluated_once(spark):
    """Counted by the tasks themselves: every input row passes once, whatever reads the frame."""
    from starloom.operators.relational import shared, sharing

    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    def build():
        s = shared(spark.range(1000).mapInArrow(count, "id long"))
        groups = s.groupBy((s.id % 7).alias("k")).count()
        return s.where("id = 0").crossJoin(groups).unionByName(s.select("id", s.id.alias("k"), s.id.alias("count")))

    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = sharing(build)
        assert rows.value == 0  # nothing runs while the frame is built
        assert out.count() == 1007 and rows.value == 1000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_building_a_model_starts_no_job(spark, written_mart):
    group = "starloom-no-job"
    spark.sparkContext.setJobGroup(group, "building models")
    try:
        for name in ("q14a", "q23a", "q44", "q49"):
            MODELS[name](written_mart)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# no fact, no date filter, or one on the ship date or on one side of a sale-to-return join only
NOT_PRUNED = {"q09", "q16", "q24a", "q24b", "q28", "q41", "q44", "q62", "q76", "q84", "q88", "q90", "q93", "q94", "q95", "q96", "q99"}


def test_day_partitions_are_pruned_by_date_filters(spark, monkeypatch):
    """The layout that bytes a day choose at scale, here chosen for a few days of orders: every model that
    filters the date of a fact through date_dim prunes at least one fact's folders at run time."""
    from starloom.sources import mart, views

    src, out = tempfile.mkdtemp(prefix="starloom-days-"), os.path.join(tempfile.mkdtemp(prefix="starloom-plan-"), "mart")
    for t in mart.SOURCE_TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t in ("orders", "lineitem"):
            keys = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("pmod(o_orderkey, 100) < 3").selectExpr("o_orderkey AS key")
            df = df.join(keys, df["o_orderkey" if t == "orders" else "l_orderkey"] == keys.key, "left_semi")
        df.coalesce(1).write.parquet(f"{src}/{t}.parquet")
    monkeypatch.setattr(views, "DAY_BYTES", 0)
    materialize_mart(spark, src, out)
    assert any(name.startswith("ss_sold_date_sk=") for name in os.listdir(os.path.join(out, "store_sales")))
    m = Mart(spark, out)
    assert m.store_sales.count() == Mart(spark, src).store_sales.count() > 0
    pruned = {n for n, fn in MODELS.items() if "dynamicpruning" in plan_of(fn(m))}
    assert set(MODELS) - pruned == NOT_PRUNED



@pytest.mark.parametrize("name", ["q13", "q28", "q48", "q49", "q85"])
def test_conditions_on_money_read_finished_columns(plans, name):
    """No condition carries the money formulas once per mention; q49's returns have one, with its four unit costs."""
    filters = [line for line in plans[name].splitlines() if " Filter " in line or "- *Filter" in line]
    assert filters and max(line.count("9901") for line in filters) <= 4


@pytest.mark.parametrize("rows", [[], [(1, 5, "a"), (1, 5, "a"), (2, -5, None), (3, None, "b"), (None, 7, ""), (4, 3, "c")]])
def test_pinned_keeps_rows(spark, rows):
    """Also those that come twice or hold nulls; columns keep names and types."""
    from pyspark.sql import functions as F

    from starloom.operators.relational import pinned

    df = spark.createDataFrame(rows, "k long, v int, s string").withColumn("m", F.expr("CAST(v * 0.5 AS DECIMAL(7,2))"))
    out = pinned(df, "m", "v")
    assert sorted(out.dtypes) == sorted(df.dtypes)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(out.select(df.columns).collect(), key=key) == sorted(df.collect(), key=key)
    assert out.where("m > 1 AND v < 6").count() == df.where("m > 1 AND v < 6").count()


def test_limit_is_a_parameter(spark):
    import inspect
    import re

    m, limited = Mart(spark, SF_SMALL), {}
    for name, fn in MODELS.items():
        default = inspect.signature(fn.__wrapped__).parameters.get("limit")
        if default is not None:
            assert default.default == 100
            limited[name] = fn(m, limit=7)._jdf.queryExecution().logical().toString()
    assert len(limited) == 75
    # every such model keeps 7 rows; none has another limit of 100 left
    assert [n for n, p in limited.items() if not re.search(r"GlobalLimit 7\b", p) or re.search(r"GlobalLimit 100\b", p)] == []
    assert MODELS["q42"](m, limit=None)._jdf.queryExecution().logical().toString().count("Limit") == 0
