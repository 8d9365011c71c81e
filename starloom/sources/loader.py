"""Bulk load of pipe-delimited ``.dat`` files and parquet scans.

Raw files are ``<table>.dat`` (optionally ``.dat.gz``): fields separated by
``|``, no header, a trailing ``|`` on every row, an empty field meaning
NULL.  Spark's CSV reader parses them in parallel on the executors (gzip
files are read natively, one task per file since gzip does not split);
the schema is explicit, never inferred.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog
from .views import path_bytes, replace_table

_TRAILING = "_trailing_field"
GZIP_BYTES = 16 << 20  # compressed bytes whose rows one task takes on after reading


def dat_path(directory: str, table: str, compressed: bool = False) -> str:
    return os.path.join(directory, f"{table}.dat" + (".gz" if compressed else ""))


def missing_inputs(spark: SparkSession, directory: str, tables=catalog.TABLE_NAMES,
                   compressed: bool = False) -> list[str]:
    """S3: the raw files that do not exist, checked through the Hadoop file system.

    Works for any file system the cluster is configured for (local, HDFS,
    object stores); nothing is read.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(dat_path(directory, t, compressed))
        if not p.getFileSystem(conf).exists(p):
            missing.append(t)
    return missing


def load_dat(spark: SparkSession, path: str, table: str, cast: bool = False) -> DataFrame:
    """Read one delimited file with the table's schema.

    ``cast=False``: the typed schema is applied by the parser; the trailing
    delimiter produces one extra empty field, declared and dropped.
    ``cast=True``: every field is read as text by position and cast to the
    column's type afterwards (the variant used for gzipped extracts whose
    text may not parse directly); extra trailing fields are ignored.
    """
    cols = catalog.columns(table)
    reader = (spark.read.option("sep", "|").option("header", "false")
              .option("nullValue", "").option("emptyValue", None))
    if not cast:
        ddl = catalog.ddl(table) + f", {_TRAILING} STRING"
        df = reader.option("mode", "FAILFAST").schema(ddl).csv(path)
        return df.drop(_TRAILING)
    raw = _spread(spark, reader.option("mode", "PERMISSIVE").option("inferSchema", "false").csv(path), path)
    return raw.select(*[F.col(f"_c{i}").cast(t).alias(n) for i, (n, t) in enumerate(cols)])


def _spread(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Rows of gzip files, which one task each must read, dealt out to tasks of about GZIP_BYTES each."""
    if not path.endswith(".gz"):
        return df
    tasks = -(-path_bytes(spark, path) // GZIP_BYTES)
    return df.repartition(tasks) if tasks > 1 else df


def parse_lines(lines: DataFrame, table: str, line: str = "value") -> DataFrame:
    """Raw lines to the table's columns, ``_line`` and ``_reason``.

    A line is good (``_reason`` NULL) if it has one field for each column, a trailing
    delimiter or none, and every field that is not empty reads as its column's type;
    else the reason names the number of fields, or the first such column and its text.
    """
    cols = catalog.columns(table)
    fields = F.split(F.col(line), r"\|", -1)
    split = lines.select(F.col(line).alias("_line"), fields.alias("_fields"))
    n = F.size("_fields")
    whole = (n == len(cols)) | ((n == len(cols) + 1) & (F.get("_fields", F.lit(len(cols))) == ""))
    raw = [F.nullif(F.get("_fields", F.lit(i)), F.lit("")) for i in range(len(cols))]
    typed = [r.try_cast(t) for r, (_, t) in zip(raw, cols)]
    unread = F.coalesce(*[F.when(r.isNotNull() & t.isNull(), F.concat(F.lit(f"{name}: "), r)) for r, t, (name, _) in zip(raw, typed, cols)])
    reason = F.when(~whole, F.concat(n.cast("string"), F.lit(" fields"))).otherwise(unread)
    return split.select(*[t.alias(name) for t, (name, _) in zip(typed, cols)], "_line", reason.alias("_reason"))


def load_dat_checked(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with a reject channel: the good rows with the table's types, and (line, reason) of all others.

    Nothing is dropped: every line of the file is in one of the two.  Both read the file
    when they are used; gzip files are dealt out after reading.
    """
    rows = parse_lines(_spread(spark, spark.read.text(path), path), table)
    good = rows.where("_reason IS NULL").drop("_line", "_reason")
    return good, rows.where("_reason IS NOT NULL").select(F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Idempotent write; a re-run replaces the table's rows whole (see ``replace_table``), never appends."""
    if mode == "overwrite":
        replace_table(df, path)
    else:
        df.write.mode(mode).parquet(path)


def _check_inputs(spark, dat_dir, tables, compressed) -> None:
    missing = missing_inputs(spark, dat_dir, tables, compressed)
    if missing:
        raise FileNotFoundError("missing raw files for: " + ", ".join(missing))


def load_raw(spark: SparkSession, dat_dir: str, out_dir: str, tables=catalog.TABLE_NAMES,
             compressed: bool = False, rejects_dir: str | None = None) -> dict[str, str]:
    """Load every table's raw file and write it as parquet under ``out_dir``.

    All inputs are checked first; one error lists every missing file.  With ``rejects_dir`` the
    lines that do not read as their table's types are written there, one folder for each
    table, and the rest is loaded; without it such a line ends the load.
    """
    _check_inputs(spark, dat_dir, tables, compressed)
    out = {}
    for t in tables:
        path, target = dat_path(dat_dir, t, compressed), os.path.join(out_dir, t)
        if rejects_dir is None:
            df = load_dat(spark, path, t, cast=compressed)
        else:
            df, rejected = load_dat_checked(spark, path, t)
            write_table(rejected, os.path.join(rejects_dir, t))
        write_table(df, target)
        out[t] = target
    return out


def load_tables(spark: SparkSession, dat_dir: str, database: str, tables=catalog.TABLE_NAMES,
                compressed: bool = False, location: str | None = None) -> list[str]:
    """S5 with S8: load raw files into catalog tables, which are made if absent (under ``location``, or managed).

    Each load goes through the table's own types, as the catalog has them, and replaces
    its rows, so a second load leaves the same counts.  Lines that do not read end the load.
    """
    _check_inputs(spark, dat_dir, tables, compressed)
    for statement in catalog.create_tables_sql(database, location):
        if statement.startswith("CREATE DATABASE") or any(f" {database}.{t} (" in statement for t in tables):
            spark.sql(statement)
    for t in tables:
        own = spark.table(f"{database}.{t}").schema
        df = load_dat(spark, dat_path(dat_dir, t, compressed), t, cast=compressed)
        df.select(*[F.col(f.name).cast(f.dataType) for f in own]).write.insertInto(f"{database}.{t}", overwrite=True)
    return [f"{database}.{t}" for t in tables]


def load_parquet(spark: SparkSession, directory: str, tables=catalog.TABLE_NAMES) -> dict[str, DataFrame]:
    """Parquet-backed tables (vectorized reader, pushdown, pruning)."""
    return {t: spark.read.parquet(os.path.join(directory, t)) for t in tables}


def to_lines(df: DataFrame, table: str) -> DataFrame:
    """``df`` and ``value``, its rows in the raw layout of ``table``: every spec column in order,
    ``|``-separated with a trailing ``|``, NULL and absent columns empty.

    The fields go through an array and a function of its elements: a plain concatenation of them all is
    generated, with the formulas of a derived table in it, as one method too long for the JVM to compile."""
    fields = [F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string") for name, _ in catalog.columns(table)]
    texts = F.transform(F.array(*fields), lambda v: F.coalesce(v, F.lit("")))
    return df.withColumn("value", F.concat_ws("|", texts, F.lit("")))


def write_dat(df: DataFrame, table: str, path: str, compressed: bool = False) -> str:
    """Write ``df`` in the raw layout of ``table``.

    The inverse of :func:`load_dat`, used to produce raw extracts (and to
    test the loader on real data).  Runs as one distributed text write.
    """
    writer = to_lines(df, table).select("value").write.mode("overwrite")
    if compressed:
        writer = writer.option("compression", "gzip")
    writer.text(path)
    return path
