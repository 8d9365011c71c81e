"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir

# a word is a maximal run of characters other than space, tab, LF, VT, FF, CR
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once into the cluster's shared checkpoint folder and read it
    back: the later plan has no lineage before this point, so a lost executor
    costs only the tasks of the current step."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/starloom-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of a text, null counting as empty."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def bounded_sample(df: DataFrame, key: Column, bound: int, seed: int = 1, within: Column | None = None) -> DataFrame:
    """At most ``bound`` rows (for each value of ``within``), those with the smallest hash of ``key``: the
    same rows in every run.  Rows whose hash lies above twice the share that is needed are dropped where
    they are, so about 2 * ``bound`` rows of a value meet in the window, however many there are."""
    out = df.withColumns({"_h": F.xxhash64(key, F.lit(seed)), "_t": key, "_w": F.lit(0) if within is None else within})
    counts = out.groupBy("_w").agg((F.lit(2.0 * bound + 64) / F.count("*")).alias("_share"))
    near = F.col("_h").cast("double") <= F.lit(-(2.0 ** 63)) + F.least(F.lit(1.0), F.col("_share")) * F.lit(2.0 ** 64)
    ranked = out.join(counts, "_w").filter(near).withColumn("_r", F.row_number().over(Window.partitionBy("_w").orderBy("_h", "_t")))
    return ranked.filter(F.col("_r") <= bound).drop("_h", "_t", "_r", "_w", "_share")


BITMAP = 27


def bitmap_place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << BITMAP))


def id_bitmap(ids: DataFrame, key: str) -> np.ndarray:
    """A bitmap of 2**27 bits (16 MB, whatever the number of ids) with the hashed places of ``ids``.
    A broadcast copy lets map tasks drop most rows of other ids before a join on the id removes the rest;
    with very many ids it fills up and drops less, never a row that is wanted."""
    place = bitmap_place(F.col(key)) + 1
    rows = (ids.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect())
    out = np.zeros(1 << (BITMAP - 3), np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["b"] - 1) * len(part)
        out[at:at + len(part)] = part
    return out


def in_bitmap(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


# ---- vectorised text hashing (numpy, inside tasks) -------------------------

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n (kept for the next call)."""
    if "r" not in _POWERS or len(_POWERS["r"]) < n:
        size = max(n, 1 << 16)
        for k, base in (("r", _R), ("inv", _R_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["r"], _POWERS["inv"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of byte value j times R**j for j < i."""
    r, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * r[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes wherever they stand."""
    _, inv = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def batch_bytes(column, budget: int = 1 << 21):
    """Runs of rows of an Arrow string or binary column as (first row, bytes, offsets),
    each run of about ``budget`` bytes at most unless one value alone is larger; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buf = column.buffers()
    n = len(column)
    offsets = np.frombuffer(buf[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + budget, "right")) - 1)
        to = min(to, n)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word's index of each text (one more for the end)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a word never crosses two texts
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]
