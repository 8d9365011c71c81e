"""Operator helpers on tiny frames with NULLs, ties and duplicates."""

import pytest
from pyspark.sql import functions as F

from starloom.functions import nz_div, safe_div, top
from starloom.operators import relational as R
from starloom.operators.datatests import expect_row_count, expect_unique


def rows(df, *cols):
    """Collected rows in a stable order; NULLs sort last."""
    out = [tuple(r) for r in df.select(*(cols or df.columns)).collect()]
    return sorted(out, key=lambda t: tuple((v is None, v) for v in t))


def test_semi_anti_with_null_keys(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "j int")
    assert rows(R.semi_join(a, b, a.k == b.j)) == [(1,)]
    # NOT EXISTS keeps the NULL-key row: NULL never matches
    assert rows(R.anti_join(a, b, a.k == b.j)) == sorted([(2,), (None,)], key=lambda x: (x[0] is None, x))


def test_exists_any_is_or_of_exists(spark):
    a = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    b = spark.createDataFrame([(1,), (1,)], "x int")
    c = spark.createDataFrame([(3,)], "y int")
    assert rows(R.exists_any(a, "k", b, c)) == [(1,), (3,)]


def test_in_or_keeps_row_count(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    b = spark.createDataFrame([(2,), (2,), (2,)], "x int")
    out = R.in_or(a, F.col("v") > 25, "k", b, "x")
    assert rows(out) == [(2, 20), (3, 30)]


def test_compare_to_group_avg_exact(spark):
    df = spark.createDataFrame([("a", 10), ("a", 20), ("a", 36), ("b", 5)], "g string, v int")
    # avg(a) = 22, 1.2 * 22 = 26.4
    assert rows(R.compare_to_group_avg(df, "g", "v", 12, 10), "g", "v") == [("a", 36)]


def test_scalar_one_row_and_failure(spark):
    one = spark.createDataFrame([(7,)], "x int")
    assert R.scalar(one, "x").collect()[0]["x"] == 7
    many = spark.createDataFrame([(1,), (2,)], "x int")
    with pytest.raises(Exception):
        R.scalar(many, "x").collect()


def test_set_operations_treat_nulls_as_equal(spark):
    a = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(None,), (2,)], "k int")
    assert rows(R.intersect(a, b)) == sorted([(2,), (None,)], key=lambda x: (x[0] is None, x))
    assert rows(R.except_(a, b)) == [(1,)]
    assert R.union_distinct([a, b]).count() == 3
    assert R.union_all([a, b]).count() == 5


def test_top_n_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", 1), ("b", 2)], "g string, v int")
    out = R.top_n_per_group(df, "g", F.col("v").desc(), 1)
    assert rows(out, "g", "v", "rk") == [("a", 5, 1), ("a", 5, 1), ("b", 2, 1)]


def test_neighbours_equal_rank_self_join(spark):
    data = [("a", 1, 10), ("a", 2, 20), ("a", 3, 30), ("b", 1, 5), (None, 1, 7), (None, 2, 8), (None, 3, 9)]
    df = spark.createDataFrame(data, "g string, t int, v int")
    got = rows(R.neighbours(df, "g", "t", "v"), "g", "t", "v", "psum", "nsum")
    # only the middle row of a non-NULL group has both neighbours
    assert got == [("a", 2, 20, 10, 30)]


def test_running_sum(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", 1, 10)], "g string, t int, v int")
    assert rows(R.running(df, "g", "t", "v"), "g", "t", "running") == [("a", 1, 1), ("a", 2, 3), ("a", 3, 6),
                                                                      ("b", 1, 10)]


def test_rollup_agg_matches_plain_rollup(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", "x", 4)], "k1 string, k2 string, v int")
    got = rows(R.rollup_agg(df, ["k1", "k2"], ["v"]), "k1", "k2", "v")
    want = rows(df.rollup("k1", "k2").agg(F.sum("v").alias("v")), "k1", "k2", "v")
    assert got == want


def test_cascaded_rollup_matches_plain_rollup(spark):
    """NULL keys stay apart from subtotals, repeated rows and NULL values count as in a plain rollup; no rows give no total."""
    data = [("a", "x", 1), ("a", "x", 1), ("a", None, 2), (None, "x", 3), (None, None, 4), ("b", "y", None)]
    df = spark.createDataFrame(data, "k1 string, k2 string, v int")
    out = R.cascaded_rollup(df, ["k1", "k2"], F.sum("v").alias("s"), F.count("v").alias("n"))
    want = df.rollup("k1", "k2").agg(F.sum("v").alias("s"), F.count("v").alias("n"), (F.grouping("k1") + F.grouping("k2")).alias("_level"))
    assert rows(out, "k1", "k2", "s", "n", "_level") == rows(want, "k1", "k2", "s", "n", "_level")
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert R.cascaded_rollup(df.limit(0), ["k1", "k2"], F.sum("v").alias("s")).count() == 0


def test_pivot_share_self_join_role(spark):
    df = spark.createDataFrame([("n1", "A", 1), ("n1", "B", 3), ("n2", "A", 5)], "n string, p string, v int")
    assert rows(R.pivot_sum(df, "n", "p", ["A", "B"], "v")) == [("n1", 1, 3), ("n2", 5, None)]
    shares = {r["p"]: r["share"] for r in R.share_of(df.where("n = 'n1'"), "n", "v").collect()}
    assert shares == {"A": 25.0, "B": 75.0}
    y = spark.createDataFrame([("k", 2000, 1), ("k", 2001, 2), ("k", 2003, 4)], "key string, yr int, v int")
    assert rows(R.self_join(y, "key", "yr", 1), "yr1", "yr2") == [(2000, 2001)]
    assert R.role(y, "d1").columns == ["d1_key", "d1_yr", "d1_v"]
    assert R.tag_channel(y, "web").columns[0] == "channel"


def test_top_breaks_ties_with_all_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z")], "k int, s string")
    assert [tuple(r) for r in top(df, 2, "-k").collect()] == [(1, "a"), (1, "b")]
    nulls = spark.createDataFrame([(None,), (1,)], "k int")
    assert [r[0] for r in top(nulls, None, "k").collect()] == [1, None]


def test_guarded_division(spark):
    df = spark.createDataFrame([(1, 0), (3, 2)], "a int, b int")
    got = df.select(safe_div(F.col("a"), F.col("b")).alias("s"), nz_div(F.col("a"), F.col("b")).alias("z")).collect()
    assert [tuple(r) for r in got] == [(None, None), (1.5, 1.5)]


def test_data_tests(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert expect_row_count(df, 5).count() == 0
    assert expect_row_count(df, 4).collect()[0]["actual_row_count"] == 5
    dup = {r["k"]: r["n"] for r in expect_unique(df, "k").collect()}
    assert dup == {1: 2, None: 2}


@pytest.mark.parametrize("descending", [False, True])
def test_global_rank_equals_single_partition_rank(spark, descending):
    import random

    from pyspark.sql import Window

    rnd = random.Random(7)
    data = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5, 3.5, 3.5, 7.0, rnd.random()])) for i in range(1500)]
    df = spark.createDataFrame(data, "k int, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    want = df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("long"))
    got = R.global_rank(df, "v", "r", descending=descending).select(*want.columns)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_expected_count_report_flags_only_mismatches(spark):
    from starloom.operators.datatests import expected_count_report
    from starloom.sources.catalog import SF1_ROW_COUNTS

    assert len(SF1_ROW_COUNTS) == 25 and SF1_ROW_COUNTS["store_sales"] == 2880404
    tables = {"store": spark.range(12).toDF("s"), "warehouse": spark.range(4).toDF("w")}
    rows = [tuple(r) for r in expected_count_report(tables, SF1_ROW_COUNTS).collect()]
    assert rows == [("warehouse", 5, 4)]


def test_global_rank_without_exchange_reuse(spark):
    from pyspark.sql import functions as F

    from starloom.operators.relational import global_rank, top_ranks

    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(20000).select("id", F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double").alias("v")).repartition(8)
        df = df.withColumn("v", F.when(F.col("id") % 97 == 0, None).otherwise(F.col("v")))
        want = df.toPandas()["v"].rank(method="min", na_option="bottom")
        got = global_rank(df, "v", "rk", partitions=16).toPandas()
        assert sorted(got["rk"]) == sorted(want.astype(int))
        assert (got.sort_values("id")["rk"].values == df.toPandas().assign(r=want).sort_values("id")["r"].astype(int).values).all()
        best = top_ranks(df, "v", "rk", 10).toPandas()
        assert set(best["id"]) == set(got[got["rk"] <= 10]["id"]) and (best.set_index("id")["rk"] == got.set_index("id")["rk"].loc[best["id"]]).all()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_long_keys_keep_distinct_ids(spark):
    from starloom.sources import mart as M

    spark.sql("SELECT 123456789 AS p_partkey, 'a' AS p_name UNION ALL SELECT 123456780, 'b'").createOrReplaceTempView("long_part")
    ids = spark.sql(M.table_sql("item", M.SPARK, {"src_part": "long_part"})).select("i_item_id").distinct().count()
    assert ids == 2


def test_q08_zip_list_is_whole():
    from starloom.plans.q08_zips import Q08_ZIPS

    assert len(set(Q08_ZIPS)) == 400 and all(len(z) == 5 for z in Q08_ZIPS)


def test_no_local_checkpoint_folder_on_a_cluster():
    from starloom.session import is_local

    assert is_local("local[8]") and is_local("local")
    assert not any(map(is_local, ("spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x")))


def test_global_rank_of_any_type(spark):
    """Buckets keep the order of negative, tiny, huge, infinite and undefined numbers, and of texts and dates."""
    from starloom.operators.relational import global_rank

    inf, nan = float("inf"), float("nan")
    numbers = [0.0, -0.0, 1.5, 1.5, -1.5, 5e-324, -5e-324, 1.7e308, -1.7e308, inf, -inf, nan, None, None, 1.0000001, 1.0, 2.0 ** 62, -7.25]
    frames = [spark.createDataFrame([(v,) for v in numbers], "v double"), spark.createDataFrame([(i,) for i in (2 ** 62, 2 ** 62 + 1, -3, 0, None, 7, 7)], "v long"),
              spark.createDataFrame([(x,) for x in ("", "a", "ab", "abc", "abcd", "abce", "é", "日本", None, "a", "Z")], "v string"),
              spark.sql("SELECT explode(array(DATE '1969-12-31', DATE '1970-01-01', DATE '2020-02-02', NULL, DATE '2020-02-02')) AS v")]
    for df in frames:
        df.createOrReplaceTempView("ranked_values")
        for descending in (False, True):
            want = spark.sql(f"SELECT v, cast(rank() OVER (ORDER BY v {'DESC' if descending else 'ASC'} NULLS LAST) AS bigint) AS r FROM ranked_values")
            got = global_rank(df, "v", "r", descending=descending).select("v", "r")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
