"""A training corpus from raw documents: five of the operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a stage's result
is written as Parquet and read again as the next one's ``docs``, so a lost
executor or a failed stage repeats that stage only.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import stored, table
from starloom.llm.decontamination import find_leaks
from starloom.llm.langid import keep_identified
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.mixing import mix_sources
from starloom.llm.near_dedup import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays unclear (posterior under 0.5), go."""
    return keep_identified(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of two or more lines, and of lines of 50 or more words, are cut from the texts; every document stays."""
    out = dedup_lines(docs.select(*COLUMNS), long_words=50)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; rows without an id come after all others.
    Different texts of one id are documents of their own; of repeated rows of one id and text one stays."""
    docs = docs.select(*COLUMNS)
    own_text = F.xxhash64("text")
    texts = docs.groupBy("doc_id").agg(F.min(own_text).alias("_lo"), F.max(own_text).alias("_hi"))
    if texts.filter("doc_id IS NULL OR _lo < _hi").isEmpty():  # every id names one text
        kept = near_duplicates(docs).filter("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # a row key that sorts like the id, written once with the rows; _spread parts rows without an id (or of one id) among tasks
    spread = docs.withColumn("_spread", F.monotonically_increasing_id())
    keyed = stored(spread.orderBy(F.col("doc_id").asc_nulls_last(), "_spread").withColumn("_row", F.monotonically_increasing_id()).drop("_spread"), "keyed")
    kept = near_duplicates(keyed, id_col="_row").filter("kept").select(F.col("doc_id").alias("_row"))
    out = keyed.join(kept, "_row", "left_semi").select(*COLUMNS)
    named = out.filter("doc_id IS NOT NULL").withColumn("_text", own_text).dropDuplicates(["doc_id", "_text"]).drop("_text")
    return named.unionByName(out.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), carry=tuple(COLUMNS))
    return found.filter(F.size("items") == 0).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies and the words taken."""
    return mix_sources(docs, carry=tuple(COLUMNS)).filter("copies > 0").select(*COLUMNS, "size", "source_size", "target", "taken", "copies")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# trained models and iterations: not expressible in SQL, tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if (name, stage) == STAGES[-1] else stored(out, name)
    return docs
