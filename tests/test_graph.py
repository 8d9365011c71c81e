"""Dependency order of models, shared nodes written once."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.operators.datatests import audit, failed
from starloom.plans import MODELS
from starloom.plans.graph import Node, dependency_order, model_graph, run, run_models
from starloom.sources import catalog
from starloom.sources.views import Mart


def _node(*reads):
    return Node(lambda frames: None, reads)


def test_order_puts_reads_first_and_leaves_out_the_rest():
    nodes = {"a": _node(), "b": _node("a"), "c": _node("a", "b"), "d": _node("c"), "other": _node("a")}
    order = dependency_order(nodes, ["d"])
    assert sorted(order) == ["a", "b", "c", "d"]
    assert all(order.index(r) < order.index(n) for n in order for r in nodes[n].reads)
    assert dependency_order(nodes, []) == []


def test_cycles_and_unknown_names_are_named():
    with pytest.raises(ValueError, match="(a -> b -> a|b -> a -> b)"):
        dependency_order({"a": _node("b"), "b": _node("a"), "x": _node("a")}, ["x"])
    with pytest.raises(KeyError, match="'gone' is no node, but 'a' reads it"):
        dependency_order({"a": _node("gone")}, ["a"])


def test_a_shared_node_is_written_once_and_read_from_there(spark):
    path, built = tempfile.mkdtemp(), []

    def base(frames):
        built.append("base")
        return spark.range(10).withColumn("v", F.col("id") * 2)

    nodes = {"base": Node(base), "sum": Node(lambda f: f["base"].agg(F.sum("v").alias("s")), ("base",)),
             "top": Node(lambda f: f["base"].where("v > 10").crossJoin(f["sum"]), ("base", "sum"))}
    for _ in range(2):  # a second run replaces the rows
        frames = run(spark, nodes, ["top", "sum"], path)
        assert frames["sum"].first().s == 90 and frames["top"].count() == 4
    assert built == ["base", "base"] and sorted(os.listdir(path)) == ["base", "sum", "top"]
    assert frames["top"].inputFiles()[0].split("/")[-2] == "top"


def test_models_share_staged_tables(spark):
    mart, path = Mart(spark, SF_SMALL), tempfile.mkdtemp()
    nodes = model_graph(mart, ["q42", "q52", "q93"])
    assert set(nodes["q42"].reads) == {"store_sales", "date_dim", "item"}
    assert {n for n, node in nodes.items() if node.written} == {"q42", "q52", "q93", "store_sales", "date_dim", "item"}
    frames = run_models(mart, ["q42", "q52"], path, q42={"year": 1997})
    assert sorted(os.listdir(path)) == ["date_dim", "item", "q42", "q52", "store_sales"]
    assert sorted(map(tuple, frames["q42"].collect())) == sorted(map(tuple, MODELS["q42"](mart, year=1997).collect()))
    assert sorted(map(tuple, frames["q52"].collect())) == sorted(map(tuple, MODELS["q52"](mart).collect()))


def test_audit_counts_repeats_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (None, None)], "a int, b int")
    report = audit({"t": df, "empty": df.limit(0), "keyless": df}, {"t": ("a", "b"), "empty": ("a",)}, {"t": 6, "keyless": 7})
    assert {r.table_name: tuple(r)[1:] for r in report.collect()} == {
        "t": (6, 6, 1, 3), "empty": (None, 0, 0, 0), "keyless": (7, 6, None, None)}
    assert sorted(r.table_name for r in failed(report).collect()) == ["keyless", "t"]


def test_audit_of_all_raw_tables_with_literal_counts(spark):
    tables = {t: spark.createDataFrame([], catalog.schema(t)) for t in catalog.TABLE_NAMES}
    report = audit(tables, catalog.PRIMARY_KEYS, catalog.SF1_ROW_COUNTS)
    got = {r.table_name: r for r in report.collect()}
    assert len(got) == 25 and all(r.expected_rows == catalog.SF1_ROW_COUNTS[t] and r.actual_rows == 0 for t, r in got.items())
    assert failed(report).count() == 25


@pytest.mark.parametrize("name", ["q04", "q11", "q74"])
def test_sales_meet_customers_as_sums(spark, name):
    plan = MODELS[name](Mart(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    # below every aggregate lie sales and days only: no customer name is a group key of it
    assert [x for x in plan.splitlines() if "Aggregate [" in x and ("c_customer_id" in x or "c_last_name" in x)] == []
