"""Data tests that return rows only when something is wrong."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expect_row_count(df: DataFrame, expected) -> DataFrame:
    """One row ``actual_row_count`` when the count differs, else no row.

    ``expected`` is a number or a one-column, one-row DataFrame of the
    expected count (computed by Spark from other tables).
    """
    actual = df.agg(F.count(F.lit(1)).alias("actual_row_count"))
    if isinstance(expected, DataFrame):
        exp = expected.select(F.col(expected.columns[0]).cast("long").alias("expected_row_count"))
        return actual.crossJoin(exp).where(F.col("actual_row_count") != F.col("expected_row_count"))
    return actual.where(F.col("actual_row_count") != F.lit(int(expected)))


def row_count_report(checks: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """All row-count checks in one job: (table_name, expected_rows, actual_rows)."""
    parts = []
    for name, (df, expected) in sorted(checks.items()):
        actual = df.agg(F.count(F.lit(1)).alias("actual_rows"))
        exp = expected.select(F.col(expected.columns[0]).cast("long").alias("expected_rows"))
        parts.append(exp.crossJoin(actual).select(F.lit(name).alias("table_name"), "expected_rows", "actual_rows"))
    return reduce(DataFrame.unionByName, parts)


def expect_unique(df: DataFrame, keys) -> DataFrame:
    """The key values that occur more than once, with their count.

    A partial aggregation per key: at scale the shuffle carries one row
    per distinct key and map partition, not the table.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def expected_count_report(tables: dict, expected: dict) -> DataFrame:
    """T1 over loaded raw tables with literal expectations (e.g. the SF1 counts):
    one row (table_name, expected_rows, actual_rows) per mismatching table,
    all tables counted in one union job."""
    parts = [df.agg(F.count(F.lit(1)).alias("actual_rows"))
             .select(F.lit(name).alias("table_name"), F.lit(int(expected[name])).cast("long").alias("expected_rows"),
                     "actual_rows")
             for name, df in sorted(tables.items())]
    report = reduce(DataFrame.unionByName, parts)
    return report.where(F.col("expected_rows") != F.col("actual_rows"))


def audit(tables: dict, keys: dict, expected: dict | None = None) -> DataFrame:
    """T1 and T2 of many tables in one job, each table read once.

    ``keys`` names the key columns of a table; ``expected`` its literal row count.  A row
    for each table: ``table_name``, ``expected_rows`` (NULL where none is given),
    ``actual_rows``, ``duplicate_keys`` (key values without NULL that occur more than once) and
    ``null_keys`` (rows with a NULL in the key); both are NULL for a table without key.  An empty
    table has zeros.  Rows are counted per key with partial aggregation, so a hot
    key costs one row for each map partition.
    """
    parts = []
    for name, df in sorted(tables.items()):
        key = list(keys.get(name, ()))
        if key:
            broken = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
            found = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("actual_rows"),
                F.count_if((F.col("_n") > 1) & ~broken).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(broken, F.col("_n"))), F.lit(0)).alias("null_keys"))
        else:
            none = F.lit(None).cast("long")
            found = df.agg(F.count(F.lit(1)).alias("actual_rows")).select("actual_rows", none.alias("duplicate_keys"), none.alias("null_keys"))
        want = (expected or {}).get(name)
        parts.append(found.select(F.lit(name).alias("table_name"), F.lit(want).cast("long").alias("expected_rows"),
                                  "actual_rows", "duplicate_keys", "null_keys"))
    return reduce(DataFrame.unionByName, parts)


def failed(report: DataFrame) -> DataFrame:
    """The rows of an ``audit`` that are wrong: another count than expected, a key that repeats or is NULL."""
    return report.where((F.col("expected_rows") != F.col("actual_rows")) | (F.col("duplicate_keys") > 0) | (F.col("null_keys") > 0))
