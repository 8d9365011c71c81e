"""Mixing sources to target weights by pivotal dependent rounding.

A source with target t and size s wants every document t/s times; the whole
part is given to all, and the fraction f left over is a copy probability.
The pivotal method pairs two fractional probabilities and randomly moves
mass (counted in words, so the source's total stays exact) from one to the
other until one of them is 0 or 1; the one left over meets the next.  Units
are dealt into buckets of about ``FAN`` by hash, each bucket is folded to at
most one residual, and residuals meet again in groups of ``FAN`` buckets: a
reduction tree of log(n) levels in which no group grows with the input.
Inclusion probabilities are kept exactly; a source's taken words differ from
its target by less than one document.

Everything is DataFrame operations; random numbers are hashes of the two
ids and the seed, so reruns agree.

Defined results
* size is the number of words; null or empty text has size 0 and is taken 0 times.
* null sources are one source, ordered last.
* rows that repeat (doc_id, source, size) are one unit whose mass is their
  total size; each of them is taken equally often.
* a null doc_id: each row is a unit of its own, by a row number that is written once with its size.
* an empty table gives an empty result.
* input columns other than doc_id, source and text are not needed; those in ``carry`` are returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import stored, word_count

FAN = 32
UNIT = "struct<r:bigint,k:bigint,m:bigint,f:double>"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) for every source: the total of all sizes shared by
    weight, no target above ``cap`` times its source's size.

    Sharing the excess again and again ends at target = min(cap * size, level * weight)
    for one level; the sources that are capped are those with the smallest
    size / weight, so the level follows from running sums in that order.
    The windows run over one row per source."""
    by = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
          .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                         ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int")))
          .withColumn("_cap", F.col("source_size") * F.lit(cap)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    by = by.withColumn("_level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    # the first source in this order that its share does not cap sets the level of all that follow
    by = by.withColumn("_free", F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(everything))
    level = F.col("_free").getField("_level")
    return by.select("source", "source_size",
                     F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w"))).alias("target"))


def _random(a: Column, b: Column, seed: int) -> Column:
    """Uniform in [0, 1) from two ids."""
    return F.pmod(F.xxhash64(a, b, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _meet(acc: Column, x: Column, seed: int) -> Column:
    """One pivotal step: the waiting unit of ``acc`` meets ``x``."""
    a = acc["cur"]
    ma, mb = a["m"].cast("double"), x["m"].cast("double")
    a_gains = F.least(ma * (1 - a["f"]), mb * x["f"])  # words that can move from x to a
    x_gains = F.least(ma * a["f"], mb * (1 - x["f"]))
    to_a = _random(a["k"], x["k"], seed) * (a_gains + x_gains) < x_gains
    a_done = F.when(to_a, ma * (1 - a["f"]) <= mb * x["f"]).otherwise(ma * a["f"] <= mb * (1 - x["f"]))
    x_done = F.when(to_a, mb * x["f"] <= ma * (1 - a["f"])).otherwise(mb * (1 - x["f"]) <= ma * a["f"])
    a_f = F.when(to_a, a["f"] + a_gains / ma).otherwise(a["f"] - x_gains / ma)
    x_f = F.when(to_a, x["f"] - a_gains / mb).otherwise(x["f"] + x_gains / mb)
    none = F.lit(None).cast(UNIT)

    def unit(u: Column, f: Column) -> Column:
        return F.struct(u["r"].alias("r"), u["k"].alias("k"), u["m"].alias("m"), f.alias("f"))

    def done(u: Column, up: Column) -> Column:
        return F.array(F.struct(u["k"].alias("k"), u["m"].alias("m"), up.cast("int").alias("up")))

    both = F.concat(done(a, to_a), done(x, ~to_a))
    met = F.struct(
        F.when(a_done & x_done, none).when(a_done, unit(x, x_f)).otherwise(unit(a, a_f)).alias("cur"),
        F.concat(acc["done"], F.when(a_done & x_done, both).when(a_done, done(a, to_a)).otherwise(done(x, ~to_a))).alias("done"))
    return F.when(a.isNull(), F.struct(x.alias("cur"), acc["done"].alias("done"))).otherwise(met)


def _folded(units: DataFrame, seed: int) -> DataFrame:
    """Each (source, bucket) to its decided units and one residual at most.

    Heavy units meet first, so what is left over is a light one and the
    source's total ends close to its target."""
    empty = F.struct(F.lit(None).cast(UNIT).alias("cur"), F.array().cast("array<struct<k:bigint,m:bigint,up:int>>").alias("done"))
    return (units.groupBy("_s", "_b").agg(F.array_sort(F.collect_list("_u")).alias("_us"))
            .select("_s", "_b", F.aggregate("_us", empty, lambda acc, x: _meet(acc, x, seed)).alias("_v"))
            .select("_s", "_b", "_v.cur", "_v.done"))


def pivotal_round(units: DataFrame, seed: int = 8) -> DataFrame:
    """(_s, _k, _m, up): rounding of units (_s source, _k id, _m mass > 0, _f in (0, 1))."""
    biggest = units.groupBy("_s").count().agg(F.max("count")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(biggest, 2), FAN)))
    level = units.withColumns({
        "_h": F.xxhash64("_k", "_m", F.lit(seed)),
    }).select("_s", F.pmod("_h", F.lit(FAN ** (levels - 1))).alias("_b"),
              F.struct((-F.col("_m")).alias("r"), F.col("_k").alias("k"), F.col("_m").alias("m"), F.col("_f").alias("f")).alias("_u"))
    decided = None
    for depth in range(levels):
        folded = stored(_folded(level, seed + depth), f"level{depth}")
        here = folded.select("_s", F.inline("done").alias("_k", "_m", "up"))
        decided = here if decided is None else decided.unionByName(here)
        level = folded.filter(F.col("cur").isNotNull()).select("_s", F.floor(F.col("_b") / FAN).alias("_b"), F.col("cur").alias("_u"))
    # one residual for each source is left: it goes up with its own probability
    last = level.select("_s", F.col("_u.k").alias("_k"), F.col("_u.m").alias("_m"),
                        (_random(F.col("_u.k"), F.col("_u.m"), seed) < F.col("_u.f")).cast("int").alias("up"))
    return decided.unionByName(last)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 8,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (words) and copies for every row of ``docs``; with ``carry``, those columns in place of doc_id."""
    sizes = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size"), F.monotonically_increasing_id().alias("_row"),
                               *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]), "sizes")
    targets = stored(source_targets(sizes, weights, cap), "targets").withColumn("_s", F.xxhash64("source"))
    ratio = F.col("target") / F.col("source_size")
    placed = (sizes.withColumn("_s", F.xxhash64("source"))
              .join(targets.drop("source"), "_s")
              .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("long"))
              .withColumn("_f", F.when(F.col("source_size") > 0, ratio - F.floor(ratio)).otherwise(0.0))
              .withColumn("_k", F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("row"), "_row", "size", "_s"))
                          .otherwise(F.xxhash64("doc_id", "size", "_s"))))
    units = (placed.filter((F.col("size") > 0) & (F.col("_f") > 0))
             .groupBy("_s", "_k", "_f").agg(F.sum("size").alias("_m")))
    ups = pivotal_round(units, seed).filter("up = 1").select("_s", "_k", F.lit(1).alias("_up"))
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.coalesce(F.col("_up"), F.lit(0))).otherwise(0).cast("long")
    named = [F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)] or ["doc_id"]
    return (placed.join(ups, ["_s", "_k"], "left")
            .select(*named, "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies")))
