"""Scalar helpers shared by the query models (section 2.3 / 2.6 of the survey).

All helpers return plain ``pyspark.sql.functions`` expressions, so they
stay inside whole-stage code generation; there is no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(name: str) -> Column:
    return F.col(name)


def dbl(x) -> Column:
    """Cast to double (final type of every non-integer measure)."""
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def dsum(x) -> Column:
    """Exact decimal sum, delivered as double."""
    return F.sum(x).cast("double")


def davg(x) -> Column:
    """Mean as sum/count in double: avg(decimal) types differ between engines."""
    x = F.col(x) if isinstance(x, str) else x
    return (F.sum(x).cast("double") / F.count(x))


def lsum(x) -> Column:
    """Integer sum as bigint."""
    return F.sum(x).cast("long")


def safe_div(a: Column, b: Column, default=None) -> Column:
    """a / b in double when b > 0, else ``default`` (NULL unless given)."""
    q = a.cast("double") / b.cast("double")
    out = F.when(b > 0, q)
    return out if default is None else out.otherwise(F.lit(default))


def nz_div(a: Column, b: Column) -> Column:
    """a / b in double, NULL when b is zero (SQL ``a / nullif(b, 0)``)."""
    return a.cast("double") / F.when(b != 0, b.cast("double"))


def add_days(d: Column, n: int) -> Column:
    return F.date_add(d, n)


def date(s: str) -> Column:
    return F.lit(s).cast("date")


def r6(x: Column) -> Column:
    """Round a double to 6 places (stddev sums differ in the last digit)."""
    return F.round(x, 6)


def top(df: DataFrame, n: int | None, *keys) -> DataFrame:
    """Sort (nulls last) by ``keys`` then every other column; keep ``n`` rows.

    A key is a column name, ``-name`` for descending, or a Column.  The
    remaining output columns break ties so the kept rows are a function
    of the data alone.  ``orderBy(...).limit(n)`` plans as
    TakeOrderedAndProject: each partition keeps its own top n, only
    n rows per partition reach the final task.
    """
    orders, used = [], set()
    for k in keys:
        if isinstance(k, str):
            if k.startswith("-"):
                orders.append(F.col(k[1:]).desc_nulls_last())
                used.add(k[1:])
            else:
                orders.append(F.col(k).asc_nulls_last())
                used.add(k)
        else:
            orders.append(k)
    orders += [F.col(x).asc_nulls_last() for x in df.columns if x not in used]
    out = df.orderBy(*orders)
    return out.limit(n) if n else out
