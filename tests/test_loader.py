"""Bulk load of pipe-delimited raw files (S1-S4) and the table catalog."""

import os
import tempfile

import pytest

from conftest import SF_SMALL
from starloom.sources import catalog, loader
from starloom.sources.views import Mart, materialize_mart


def _scratch():
    return tempfile.mkdtemp(prefix="starloom-test-")


def test_catalog_shapes():
    assert len(catalog.TABLE_NAMES) == 25
    assert len(catalog.columns("store_sales")) == 23
    assert len(catalog.columns("catalog_sales")) == 34
    assert len(catalog.columns("web_sales")) == 34
    assert len(catalog.columns("date_dim")) == 28
    assert catalog.columns("store_sales")[13] == ("ss_sales_price", "DECIMAL(7,2)")
    assert any("CREATE TABLE IF NOT EXISTS tpc.store_sales" in s for s in catalog.create_tables_sql("tpc"))


def test_lines_of_a_derived_table_are_not_one_generated_method(spark):
    """The text of all columns is made outside whole-stage code, where the generated code is split."""
    lines = loader.to_lines(Mart(spark, SF_SMALL).store_sales, "store_sales").select("value")
    assert len(lines.collect()) > 0
    final = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    made = [n for n in final if "Project [concat" in n]
    assert made and not [n for n in made if "*(" in n.split("Project")[0]]


def test_lines_hold_nulls_empty_texts_and_absent_columns(spark):
    rows = [(1, "a b", "x"), (2, None, ""), (None, "", None), (1, "a b", "x")]
    df = spark.createDataFrame(rows, "r_reason_sk long, r_reason_id string, r_reason_desc string")
    assert [r.value for r in loader.to_lines(df, "reason").collect()] == ["1|a b|x|", "2|||", "|||", "1|a b|x|"]
    assert {r.value for r in loader.to_lines(df.drop("r_reason_id"), "reason").collect()} == {"1||x|", "2|||", "|||"}


def test_raw_file_format(spark):
    d = _scratch()
    m = Mart(spark, SF_SMALL)
    path = loader.write_dat(m.store.limit(3), "store", loader.dat_path(d, "store"))
    text = spark.read.text(path).collect()[0][0]
    assert text.endswith("|") and text.count("|") == len(catalog.columns("store"))


@pytest.mark.parametrize("table", ["store_sales", "date_dim", "customer_address", "store"])
def test_load_roundtrip_plain_and_gzip(spark, table):
    d = _scratch()
    src = Mart(spark, SF_SMALL).table(table)
    loader.write_dat(src, table, loader.dat_path(d, table))
    loader.write_dat(src, table, loader.dat_path(d, table, True), compressed=True)
    plain = loader.load_dat(spark, loader.dat_path(d, table), table)
    gz = loader.load_dat(spark, loader.dat_path(d, table, True), table, cast=True)
    assert plain.columns == [c for c, _ in catalog.columns(table)]
    typed = src.select(*[src[c].cast(plain.schema[c].dataType) for c in src.columns])
    assert plain.select(*src.columns).exceptAll(typed).count() == 0
    assert typed.exceptAll(plain.select(*src.columns)).count() == 0
    assert gz.exceptAll(plain).count() == 0


def test_empty_field_is_null_and_trailing_delimiter(spark):
    d = _scratch()
    p = os.path.join(d, "reason.dat")
    with open(p, "w") as f:
        f.write("1|AAAA|Stopped working|\n2||Gift exchange|\n3|CCCC||\n")
    rows = sorted(loader.load_dat(spark, p, "reason").collect())
    assert [r["r_reason_id"] for r in rows] == ["AAAA", None, "CCCC"]
    assert rows[2]["r_reason_desc"] is None


def test_preflight_and_idempotent_load(spark):
    d, out = _scratch(), _scratch()
    m = Mart(spark, SF_SMALL)
    tables = ["store", "warehouse"]
    assert loader.missing_inputs(spark, d, tables) == tables
    with pytest.raises(FileNotFoundError) as err:
        loader.load_raw(spark, d, out, tables)
    assert "store" in str(err.value) and "warehouse" in str(err.value)
    for t in tables:
        loader.write_dat(m.table(t), t, loader.dat_path(d, t))
    loader.load_raw(spark, d, out, tables)
    loader.load_raw(spark, d, out, tables)  # a re-run replaces, never appends
    loaded = loader.load_parquet(spark, out, tables)
    assert loaded["store"].count() == m.store.count()
    assert loaded["warehouse"].count() == m.warehouse.count()


def test_materialized_mart_reads_back(spark):
    out = os.path.join(_scratch(), "mart")
    materialize_mart(spark, SF_SMALL, out)
    lazy, stored = Mart(spark, SF_SMALL), Mart(spark, out)
    assert stored.materialized
    for t in ["store_sales", "inventory", "date_dim"]:
        assert stored.table(t).exceptAll(lazy.table(t)).count() == 0


def test_models_as_views_and_tables(spark):
    from starloom.plans.registry import build_models, register_models

    m = Mart(spark, SF_SMALL)
    frames = build_models(m, ["q03", "q42"])
    assert set(frames) == {"q03", "q42"}
    assert register_models(m, ["q42"], prefix="model_") == ["model_q42"]
    assert spark.table("model_q42").count() == frames["q42"].count()
    out = _scratch()
    register_models(m, ["q42"], mode="table", path=out)
    assert spark.read.parquet(os.path.join(out, "q42")).count() == frames["q42"].count()


def test_failed_overwrite_keeps_the_old_rows(spark):
    def failing_after_some_rows(batches):
        for batch in batches:
            yield batch
            raise RuntimeError("task killed in the middle")

    path = os.path.join(_scratch(), "t")
    loader.write_table(spark.range(10), path)
    with pytest.raises(Exception, match="killed in the middle"):
        loader.write_table(spark.range(1000).repartition(3).mapInArrow(failing_after_some_rows, "id long"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    assert os.listdir(os.path.dirname(path)) == ["t"]  # no staged folder is left
    loader.write_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)  # reads the table it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1, 11))


def test_broken_off_swap_is_ended(spark):
    from starloom.sources.views import restore_table

    path = os.path.join(_scratch(), "t")
    loader.write_table(spark.range(10), path)
    os.rename(path, path + ".replaced")  # the job died between the two renames
    restore_table(spark, path)
    assert spark.read.parquet(path).count() == 10
    os.rename(path, path + ".replaced")
    loader.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(os.path.dirname(path)) == ["t"]


@pytest.mark.parametrize("compressed", [False, True])
def test_reject_channel(spark, compressed, monkeypatch):
    import gzip

    d = _scratch()
    n = len(catalog.columns("reason"))
    good = [f"{i}|AAAA{i}|" + ("x" if i % 3 else "") + "|" for i in range(50)]
    bad = ["word|AAAA|x|", "7|short", "8|A|x||", "", "99999999999999999999|A|x|"]
    assert n == 3
    path = loader.dat_path(d, "reason", compressed)
    with (gzip.open(path, "wt") if compressed else open(path, "w")) as f:
        f.write("\n".join(good[:20] + bad + good[20:] ) + "\n")
    monkeypatch.setattr(loader, "GZIP_BYTES", 64)
    rows, rejected = loader.load_dat_checked(spark, path, "reason")
    assert sorted(r.r_reason_sk for r in rows.collect()) == list(range(50))
    reasons = {r.line: r.reason for r in rejected.collect()}
    assert reasons["word|AAAA|x|"] == "r_reason_sk: word" and reasons["8|A|x||"] == "5 fields" and reasons[""] == "1 fields"
    assert reasons["99999999999999999999|A|x|"].startswith("r_reason_sk: ")
    assert rows.count() + rejected.count() == 55
    if compressed:
        assert spark.read.text(path).rdd.getNumPartitions() == 1 < rows.rdd.getNumPartitions()


def test_load_with_rejects_folder(spark):
    d, out, bad = _scratch(), _scratch(), _scratch()
    with open(loader.dat_path(d, "reason"), "w") as f:
        f.write("1|A|x|\nx|A|y|\n2|B|z|\n")
    loader.load_raw(spark, d, out, ["reason"], rejects_dir=bad)
    assert spark.read.parquet(os.path.join(out, "reason")).count() == 2
    assert [tuple(r) for r in spark.read.parquet(os.path.join(bad, "reason")).collect()] == [("x|A|y|", "r_reason_sk: x")]
    with pytest.raises(Exception):
        loader.load_raw(spark, d, out, ["reason"])
    assert spark.read.parquet(os.path.join(out, "reason")).count() == 2  # the load that failed left the rows


def test_catalog_tables_keep_their_types(spark):
    d, where = _scratch(), _scratch()
    with open(loader.dat_path(d, "reason"), "w") as f:
        f.write("1|A|x|\n2|B|z|\n")
    name = "starloom_test_load"
    for _ in range(2):
        assert loader.load_tables(spark, d, name, ["reason"], location=where) == [f"{name}.reason"]
    assert spark.table(f"{name}.reason").count() == 2
    assert [f.dataType.simpleString().upper() for f in spark.table(f"{name}.reason").schema] == [t.upper() for _, t in catalog.columns("reason")]


def test_layout_follows_bytes_a_day():
    from starloom.sources.views import DAY_BYTES, FILE_BYTES, day_files

    assert day_files(1 << 30, 2000) == 0 and day_files(10 ** 14, 2000) == -(-(10 ** 14 // 2000) // FILE_BYTES)
    assert day_files(DAY_BYTES * 2000, 2000) == 1 and day_files(5, 3, day_bytes=0) == 1 and day_files(0, 0) == 0
