"""Relational building blocks of the query models (survey section 2.2).

Each helper is a short composition of DataFrame operations that Catalyst
plans like the equivalent SQL; none collects data to the driver.  The
query models use the DataFrame API directly; these helpers name the
recurring patterns and are what the operator-level entries exercise.
"""

from __future__ import annotations

import weakref
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_all(df: DataFrame) -> DataFrame:
    """R2: ``SELECT *`` over a derived table."""
    return df.select("*")


def where_any(df: DataFrame, *preds: Column) -> DataFrame:
    """OR of predicates (kept above a join when they span tables)."""
    return df.where(reduce(lambda a, b: a | b, preds))


def semi_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """EXISTS / IN (subquery) as a left semi join."""
    return a.join(b, on, "left_semi")


def anti_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """NOT EXISTS as a left anti join (NULL keys never match)."""
    return a.join(b, on, "left_anti")


def exists_any(a: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """EXISTS(b) OR EXISTS(c): one semi join on the union of the keys.

    Each ``other`` has one column holding the correlated key.
    """
    keys = reduce(DataFrame.unionByName, [o.select(F.col(o.columns[0]).alias("_k")) for o in others])
    return a.join(keys, a[key] == keys["_k"], "left_semi")


def in_or(a: DataFrame, cond: Column, col: str, b: DataFrame, b_col: str) -> DataFrame:
    """``cond OR a.col IN (SELECT b_col FROM b)``.

    A left join against the distinct values of ``b_col`` supplies the
    membership flag without changing the row count of ``a``.
    """
    ids = b.select(F.col(b_col).alias("_in")).distinct()
    return a.join(ids, a[col] == ids["_in"], "left").where(cond | F.col("_in").isNotNull()).drop("_in")


def compare_to_group_avg(df: DataFrame, keys, value: str, num: int, den: int, op: str = ">") -> DataFrame:
    """Rows whose ``value`` compares to (num/den) x the average of their group.

    Decorrelated into one aggregate per group joined back; the comparison
    is done in exact arithmetic as ``value * count * den op sum * num``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    stats = df.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    lhs, rhs = F.col(value) * F.col("_n") * den, F.col("_s") * num
    cond = {">": lhs > rhs, ">=": lhs >= rhs, "<": lhs < rhs, "<=": lhs <= rhs}[op]
    return df.join(stats, keys).where(cond).drop("_s", "_n")


def scalar(df: DataFrame, col: str) -> DataFrame:
    """An uncorrelated scalar subquery as a one-row frame.

    More than one input row fails the query at run time, as in SQL.
    """
    return (df.agg(F.max(col).alias(col), F.count(F.lit(1)).alias("_rows"))
            .where(F.assert_true(F.col("_rows") <= 1, "scalar subquery returned more than one row").isNull())
            .drop("_rows"))


def cross_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of keyless results (one-row or per-group aggregates)."""
    return a.crossJoin(b)


def role(dim: DataFrame, alias: str) -> DataFrame:
    """A role-playing copy of a dimension with prefixed column names."""
    return dim.select(*[F.col(c).alias(f"{alias}_{c}") for c in dim.columns])


def self_join(df: DataFrame, keys, period: str, shift: int, suffixes=("1", "2")) -> DataFrame:
    """Rows of period p next to the rows of period p + shift, same keys."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = df.select(*[F.col(c).alias(c + suffixes[0]) for c in df.columns])
    b = df.select(*[F.col(c).alias(c + suffixes[1]) for c in df.columns])
    cond = [F.col(k + suffixes[0]) == F.col(k + suffixes[1]) for k in keys]
    cond.append(F.col(period + suffixes[1]) == F.col(period + suffixes[0]) + shift)
    return a.join(b, reduce(lambda x, y: x & y, cond))


def pivot_sum(df: DataFrame, keys, pivot: str, values, measure: str, names=None) -> DataFrame:
    """Conditional sums, one column per listed value of ``pivot``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = names or [f"{v}".lower().replace(" ", "_") for v in values]
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(pivot) == v, F.col(measure))).alias(n)
                                   for v, n in zip(values, names)])


def share_of(df: DataFrame, part, value: str, name: str = "share") -> DataFrame:
    """A value relative to the total of its partition (window over grouped rows)."""
    part = [part] if isinstance(part, str) else list(part)
    total = F.sum(value).over(W.partitionBy(*part))
    return df.withColumn(name, F.col(value).cast("double") * 100 / total.cast("double"))


def top_n_per_group(df: DataFrame, part, order: Column, n: int, rank_col: str = "rk") -> DataFrame:
    """Rank within a partition and keep rank <= n.

    Spark plans the filter as a window group limit, so each map partition
    keeps at most n rows per group before the shuffle.
    """
    part = [part] if isinstance(part, str) else list(part)
    w = W.partitionBy(*part).orderBy(order)
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= n)


def running(df: DataFrame, part, order: str, col: str, fn=F.sum, name: str = "running") -> DataFrame:
    """``fn(col)`` over rows from the partition start to the current row."""
    part = [part] if isinstance(part, str) else list(part)
    w = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name, fn(col).over(w))


def neighbours(df: DataFrame, part, order, value: str) -> DataFrame:
    """Previous and next value in order; rows lacking either are dropped.

    Equal to the self-join on rank +/- 1 when the order has no ties and the
    partition keys are not NULL (NULL keys never join), so those are removed.
    """
    part = [part] if isinstance(part, str) else list(part)
    order = [order] if isinstance(order, str) else list(order)
    w = W.partitionBy(*part).orderBy(*order)
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in part]))
    return (keyed.withColumn("_prev", F.lag(F.lit(1)).over(w)).withColumn("_next", F.lead(F.lit(1)).over(w))
            .withColumn("psum", F.lag(value).over(w)).withColumn("nsum", F.lead(value).over(w))
            .where(F.col("_prev").isNotNull() & F.col("_next").isNotNull()).drop("_prev", "_next"))


def rollup_agg(df: DataFrame, keys, sums) -> DataFrame:
    """Subtotals over ``keys``; sums are pre-aggregated at the finest
    level so the rollup expands grouped rows instead of input rows."""
    keys = list(keys)
    fine = df.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    return fine.rollup(*keys).agg(*[F.sum(s).alias(s) for s in sums],
                                  *[F.grouping(k).cast("long").alias(f"g_{k}") for k in keys])


def cascaded_rollup(df: DataFrame, keys, *partials) -> DataFrame:
    """Subtotals over ``keys``, each level summed from the next finer one.

    ``partials`` are aliased sums and counts, which add up; averages and ratios are taken
    from them afterwards.  Input rows are grouped once, and a level reads the groups of
    the level before it instead of a copy of the finest groups for every level.
    ``_level`` is the number of keys that are rolled up, counted from the right: it parts
    a subtotal from a group whose key is NULL.  Without input rows there is no total.
    """
    keys = list(keys)
    level = shared(df.groupBy(*keys).agg(*partials))
    types = {f.name: f.dataType for f in level.schema}
    sums = [x for x in level.columns if x not in keys]
    out = level.withColumn("_level", F.lit(0))
    for n in range(len(keys) - 1, -1, -1):
        groups = [] if n else [F.count(F.lit(1)).alias("_groups")]
        level = level.groupBy(*keys[:n]).agg(*[F.sum(x).alias(x) for x in sums], *groups)
        if not n:
            level = level.where("_groups > 0").drop("_groups")
        rolled = [F.lit(None).cast(types[k]).alias(k) for k in keys[n:]]
        out = out.unionByName(level.select(*keys[:n], *rolled, *sums, F.lit(len(keys) - n).alias("_level")))
    return out


def tag_channel(df: DataFrame, name: str, col: str = "channel") -> DataFrame:
    """A literal channel column in front of the rows."""
    return df.select(F.lit(name).alias(col), "*")


def union_all(dfs) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(dfs) -> DataFrame:
    """Set union (duplicates removed across all inputs)."""
    return union_all(dfs).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set intersection; NULLs compare equal."""
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference; NULLs compare equal."""
    return a.subtract(b)


def shared(df: DataFrame) -> DataFrame:
    """A sub-plan with several consumers, evaluated once whatever exchange reuse does.

    The executors keep its rows (memory, then disk) from the first action on; nothing runs
    before that, and blocks that are lost with an executor are made again from their
    lineage.  Inside a model the rows go when the model's result is no longer referenced;
    elsewhere call ``unpersist`` on the returned frame.  Frames derived from a result
    that is gone stay right, they evaluate the sub-plan anew.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    if _OPEN:
        _OPEN[-1].append(df)
    return df


_OPEN: list[list[DataFrame]] = []  # shared frames of the models that are being built


def sharing(build):
    """Calls ``build`` and ties the shared frames made in it to the life of its result."""
    _OPEN.append([])
    try:
        out = build()
    finally:
        frames = _OPEN.pop()
    if frames:
        weakref.finalize(out, _release, frames).atexit = False
    return out


def _release(frames: list[DataFrame]) -> None:
    for f in frames:
        f.unpersist()


def pinned(df: DataFrame, *cols: str) -> DataFrame:
    """The same rows with ``cols`` computed once each, before any condition on them.

    Spark moves a condition below the projection that makes its columns and writes their
    whole formula out at each mention; the nested money formulas of the mart then grow to
    a filter that the JVM never compiles.  Conditions are not moved below a generator whose
    values they test, so behind one struct a row they read the finished values; those on
    the other columns still move.
    """
    rest = [F.col(n) for n in df.columns if n not in cols]
    return df.select(*rest, F.inline(F.array(F.struct(*[F.col(n) for n in cols]))))


def value_bucket(col: str, kind: T.DataType) -> Column:
    """A bucket number that never falls as the value grows, so ranks can be counted bucket by bucket.

    Numbers: 4096 buckets for each doubling of the magnitude (a logarithm never falls as its
    argument grows), at most about 2**24 of them, NaN the last.  Texts: their first three bytes.
    NULL has the bucket NULL.
    """
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(F.col(col).cast("binary"), 1, 3)), 6, "0")
        return F.conv(head, 16, 10).cast("long")
    v = (F.unix_micros(F.col(col).cast("timestamp")) if isinstance(kind, (T.DateType, T.TimestampType)) else F.col(col)).cast("double")
    size = F.greatest(F.lit(1.0), F.floor((F.log2(F.least(F.abs(v), F.lit(1.7e308))) + 1100) * 4096))
    return (F.when(F.isnan(v), F.lit(1e8)).when(v > 0, size).when(v < 0, -size).when(v == 0, F.lit(0.0))).cast("long")


def global_rank(df: DataFrame, col: str, name: str, descending: bool = False,
                partitions: int | None = None) -> DataFrame:
    """Exact ``rank() OVER (ORDER BY col [DESC] NULLS LAST)`` without a single-task window.

    rank(v) = 1 + number of rows ordered before v.  Rows are first counted
    per distinct value (ties collapse in a partial aggregation, so a value
    shared by a third of the rows is one row here); ``value_bucket`` deals the
    distinct values to buckets in order, a running count inside each bucket
    plus the total of all earlier buckets (one row per bucket, a bounded number)
    gives each value its rank, and the rank is joined back by value (NULL-safe).
    The bucket follows from the value alone, so nothing is sampled and nothing runs
    before the action.  ``partitions`` is the number of tasks the buckets are dealt to
    (default: the session's shuffle partitions).
    """
    kind = df.schema[col].dataType
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    bucket_order = F.col("_b").desc_nulls_last() if descending else F.col("_b").asc_nulls_last()
    vals = shared(df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", value_bucket(col, kind)))
    dealt = vals.repartition(partitions, "_b") if partitions else vals
    before = F.sum("_c").over(W.partitionBy("_b").orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    local = dealt.withColumn("_before", F.coalesce(before, F.lit(0)))
    earlier = F.sum("_t").over(W.orderBy(bucket_order).rowsBetween(W.unboundedPreceding, -1))
    offsets = (vals.groupBy("_b").agg(F.sum("_c").alias("_t"))
               .select(F.col("_b").alias("_ob"), F.coalesce(earlier, F.lit(0)).alias("_off")))
    ranks = (local.join(offsets, F.col("_b").eqNullSafe(F.col("_ob")))
             .select(F.col(col).alias("_v"), (F.col("_off") + F.col("_before") + 1).cast("long").alias(name)))
    return df.join(ranks, df[col].eqNullSafe(ranks["_v"])).drop("_v")


def top_ranks(df: DataFrame, col: str, name: str, n: int, descending: bool = False) -> DataFrame:
    """Rows whose ``rank() OVER (ORDER BY col [DESC] NULLS LAST)`` is at most ``n``, with that rank.

    They lie among the n smallest distinct values, which one TakeOrdered
    finds (n rows per task); the running count over those n rows is the rank.
    """
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    vals = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).orderBy(order).limit(n)
    before = F.sum("_c").over(W.orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    ranks = vals.select(F.col(col).alias("_v"), (F.coalesce(before, F.lit(0)) + 1).cast("long").alias(name)).where(F.col(name) <= n)
    return df.join(ranks, df[col].eqNullSafe(ranks["_v"])).drop("_v")
