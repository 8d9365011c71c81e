"""Spark views over the driver parquet files and the derived retail mart.

``Mart(spark, src_dir)`` registers one temp view per driver table and
one per mart table.  View names carry a short suffix derived from the
source folder, so marts of several scale factors can live in one
session.  Everything stays lazy: a query that touches three mart tables
scans only the parquet columns those tables need (Catalyst prunes the
rest of the mart SELECT).

``materialize_mart`` writes the mart once as parquet for clusters that run
many queries over it; a ``Mart`` pointed at that folder reads it instead
of re-deriving.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import mart as M

# a fact is partitioned by day from this many bytes a day on; fewer make folders of tiny files
DAY_BYTES = 64 << 20
# a day's rows are dealt to as many tasks as keep a file near this size
FILE_BYTES = 256 << 20

# partition column of each fact when the mart is written out
_FACT_PARTITION = {
    "store_sales": "ss_sold_date_sk",
    "store_returns": "sr_returned_date_sk",
    "catalog_sales": "cs_sold_date_sk",
    "catalog_returns": "cr_returned_date_sk",
    "web_sales": "ws_sold_date_sk",
    "web_returns": "wr_returned_date_sk",
    "inventory": "inv_date_sk",
}

_MARKER = "_MART_COMPLETE"


def _norm_path(path: str) -> str:
    """Absolute local paths; URIs with a scheme (hdfs://, s3a://, ...) as given."""
    return path.rstrip("/") if "://" in path else os.path.abspath(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence through the cluster's Hadoop file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Mart:
    """Lazy access to the 24 mart tables of one source folder."""

    _cache: dict[tuple[int, str], "Mart"] = {}

    def __new__(cls, spark: SparkSession, src_dir: str):
        key = (id(spark), _norm_path(src_dir))
        inst = cls._cache.get(key)
        if inst is None or inst.spark is not spark:
            inst = super().__new__(cls)
            inst._init(spark, _norm_path(src_dir))
            cls._cache[key] = inst
        return inst

    @classmethod
    def forget(cls, spark: SparkSession, src_dir: str) -> None:
        """Drop what is known of a folder; its next use lists it anew."""
        cls._cache.pop((id(spark), _norm_path(src_dir)), None)

    def _init(self, spark: SparkSession, src_dir: str) -> None:
        self.spark = spark
        self.src_dir = src_dir
        self.suffix = hashlib.sha1(src_dir.encode()).hexdigest()[:8]
        self._frames: dict[str, DataFrame] = {}
        self.materialized = _exists(spark, os.path.join(src_dir, _MARKER))
        self.names = {f"src_{t}": f"src_{t}_{self.suffix}" for t in M.SOURCE_TABLES}
        self.names["mart_base"] = f"mart_base_{self.suffix}"
        self._registered = False

    def _register_sources(self) -> None:
        if self._registered:
            return
        if not self.materialized:
            for t in M.SOURCE_TABLES:
                path = os.path.join(self.src_dir, f"{t}.parquet")
                self.spark.read.parquet(path).createOrReplaceTempView(self.names[f"src_{t}"])
            base = M.table_sql("mart_base", M.SPARK, self.names)
            self.spark.sql(base).createOrReplaceTempView(self.names["mart_base"])
        self._registered = True

    def table(self, name: str) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            if self.materialized:
                df = self.spark.read.parquet(os.path.join(self.src_dir, name))
            else:
                self._register_sources()
                df = self.spark.sql(M.table_sql(name, M.SPARK, self.names))
            self._frames[name] = df
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in M.MART_TABLES:
            return self.table(name)
        raise AttributeError(name)

    def register_views(self, prefix: str = "") -> list[str]:
        """One temp view per mart table, for ``spark.sql`` users."""
        out = []
        for name in M.MART_TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)
            out.append(prefix + name)
        return out


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder of any file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _rename(spark: SparkSession, a: str, b: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(a).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(a), path(b)):
        raise OSError(f"cannot rename {a} to {b}")


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write ``df`` as the table at ``path``, in place of what is there.

    The rows are written to a folder beside it first and swapped in when all of them
    are there: a write that fails leaves the old rows readable, and ``df`` may read
    the table it replaces.  Should the job die between the two renames, the old
    rows lie in ``<path>.replaced``, and the next call (or ``restore_table``) puts them back.
    """
    spark = df.sparkSession
    path = _norm_path(path)
    staged, old = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.replaced"
    restore_table(spark, path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.parquet(staged)
    except BaseException:
        _delete(spark, staged)
        raise
    if _exists(spark, path):
        _rename(spark, path, old)
    _rename(spark, staged, path)
    _delete(spark, old)


def restore_table(spark: SparkSession, path: str) -> None:
    """Ends a swap that was broken off: old rows come back if no new ones took their place."""
    old = f"{_norm_path(path)}.replaced"
    if _exists(spark, old):
        if _exists(spark, path):
            _delete(spark, old)
        else:
            _rename(spark, old, _norm_path(path))


def day_files(n_bytes: int, days: int, day_bytes: int | None = None) -> int:
    """Files for each day of a fact of ``n_bytes`` over ``days``; 0 if days are too small for folders of their own."""
    a_day = n_bytes / max(days, 1)
    return 0 if a_day < (DAY_BYTES if day_bytes is None else day_bytes) else -(-int(a_day) // FILE_BYTES) or 1


def materialize(df: DataFrame, name: str, mode: str = "view", path: str | None = None,
                partition_by: str | None = None) -> DataFrame:
    """Expose a result as a temp view, or write it as a parquet table."""
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    if mode != "table" or path is None:
        raise ValueError("mode must be 'view', or 'table' with a path")
    replace_table(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def materialize_mart(spark: SparkSession, src_dir: str, out_dir: str,
                     partition_facts: bool | None = None) -> str:
    """Write every mart table once as parquet under ``out_dir``.

    A fact whose days hold ``DAY_BYTES`` or more on average is partitioned by its date key, so
    the filters on ``date_dim`` prune days (dynamic partition pruning); each day's
    rows are dealt to tasks by a salt that keeps files near ``FILE_BYTES``, so no day is one
    task.  Smaller facts are sorted by the key inside files.  ``partition_facts`` sets the
    layout of all facts instead.  Each table is swapped in whole, and the marker
    file is written last.
    """
    _delete(spark, os.path.join(out_dir, _MARKER))  # until the end this folder is not a mart
    Mart.forget(spark, out_dir)
    mart = Mart(spark, src_dir)
    lazy_base, base_rows = None, None
    if not mart.materialized:
        # the lineitem x orders join feeds all seven facts: run it once,
        # write it, and derive every fact from the written copy
        mart._register_sources()
        lazy_base = spark.table(mart.names["mart_base"])
        base_path = f"{ensure_checkpoint_dir(spark)}/mart-base-{uuid.uuid4().hex}"
        lazy_base.write.parquet(base_path)
        base = spark.read.parquet(base_path)
        base.createOrReplaceTempView(mart.names["mart_base"])
        base_rows = base.count()
        mart._frames.clear()
    for name in M.MART_TABLES:
        df = mart.table(name)
        key = _FACT_PARTITION.get(name)
        if key is not None:
            if partition_facts is None:
                source = base_path if lazy_base is not None else os.path.join(src_dir, name)
                files = _files_by_size(df, key, path_bytes(spark, source), base_rows)
            else:
                files = 1 if partition_facts else 0
            if files and not df.isEmpty():  # without a row there would be no file to read the columns from
                salt = F.pmod(F.xxhash64(*df.columns), F.lit(files))
                df = df.withColumn("_salt", salt).repartition(key, "_salt").drop("_salt")
            else:
                df = df.sortWithinPartitions(key)
                key = None
        materialize(df, name, "table", os.path.join(out_dir, name), key)
    spark.createDataFrame([("ok",)], "s string").coalesce(1).write.mode("overwrite").text(
        os.path.join(out_dir, _MARKER))
    if lazy_base is not None:  # the source's own views are as before
        lazy_base.createOrReplaceTempView(mart.names["mart_base"])
        mart._frames.clear()
        _delete(spark, base_path)
    Mart.forget(spark, out_dir)
    return out_dir


def _files_by_size(df: DataFrame, key: str, source_bytes: int, base_rows: int | None) -> int:
    """``day_files`` of a fact; one that is derived is taken to have as many bytes a row as the written base."""
    if source_bytes * M.INVENTORY_WEEKS < DAY_BYTES:
        return 0  # all days together hold less
    rows, days = df.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    return day_files(source_bytes if base_rows is None else source_bytes * rows // max(base_rows, 1), days)
