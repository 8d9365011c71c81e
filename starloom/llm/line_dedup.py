"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every document is a sequence of line IDs.  The *name* of a position at depth
h is the smallest position whose next h lines are the same (the head of its
interval in the suffix array: all positions of one name share a common
prefix of at least h lines).  Depth 1 groups equal lines; depth 2h groups
equal pairs (name at p, name at p + h), so each round doubles the common
prefix.  Positions that are alone in their interval can never join a longer
one and leave at once, so each round works on fewer rows than the last.
An interval at depth ``min_lines`` with two or more positions is a repeated
run; its head is the earliest copy and stays, and the lines covered by its
later copies go.  Overlapping intervals join to maximal runs: a line is in a
later copy of some run of ``min_lines`` or more lines exactly if an interval
of depth ``min_lines`` covers it, so no deeper round can change the answer.

With ``long_words`` a line of that many words is a run by itself: its later
copies go whatever their neighbours are, also where blank lines part the
paragraphs and where the line is the whole text.

Only DataFrame operations: grouping (with partial aggregation, so a line that
a third of all documents share is one row per map task) and equi-joins (which
adaptive execution splits when one key is hot).

Defined results
* null or empty text: no lines to compare; the text is returned as it is.
* blank lines (white space only) belong to no run and always stay.
* null doc_id: the row has no position; it is returned unchanged.
* repeated rows of one doc_id and text are one document; each row gets its result.
* different texts of one doc_id are different documents, told apart by 29 bits of
  a hash of the text (two such texts are taken for one with probability 2**-29).
* lines split at line feeds only; a carriage return belongs to its line.
* other columns pass through; internal names start with ``__line``; n_lines,
  n_removed and n_runs replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored, word_count

# a position is (_d id, _v variant, _i line number); as one number that sorts alike it is
# id * 2**61 + variant * 2**32 + line number, which 38 digits hold for every id, and hash aggregates take it (they take no struct)
PLACE = "decimal(38,0)"
AT = ["_d", "_v", "_i"]


def _variant(text: Column) -> Column:
    """29 bits of the text: parts different texts of one id."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 29) - 1))


def _place() -> Column:
    within = F.shiftleft(F.col("_v"), 32) + F.col("_i")
    return (F.col("_d").cast("decimal(19,0)") * F.lit(1 << 61).cast("decimal(19,0)") + within.cast("decimal(19,0)")).cast(PLACE)


def _heads(rows: DataFrame, *key: str) -> DataFrame:
    """The earliest position of every key that stands at two positions or more."""
    return (rows.groupBy(*key).agg(F.min(_place()).alias("_n"), F.max(_place()).alias("_last"))
            .filter("_n < _last").drop("_last"))


def _doubled(names: DataFrame, other: DataFrame, shift: int) -> DataFrame:
    """Names of windows that join the window at p with the one at p + shift."""
    pairs = (names.select(*AT, F.col("_n").alias("_a"))
             .join(other.select("_d", "_v", (F.col("_i") - shift).alias("_i"), F.col("_n").alias("_b")), AT))
    return pairs.join(stored(_heads(pairs, "_a", "_b"), "heads"), ["_a", "_b"]).select(*AT, "_n")


def line_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 1) -> DataFrame:
    """Depth 1: (_d, _v, _i, _n) of every line of ``least_words`` words or more that occurs at two positions or more."""
    lines = (docs.filter(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("_d"), _variant(F.col(text_col)).alias("_v"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_i", "_line"))
             .filter(F.col("_line").rlike(r"[^\x20\x09-\x0D]") if least_words < 2 else word_count(F.col("_line")) >= least_words)
             .select(*AT, F.xxhash64("_line").alias("_h"), F.hash("_line").alias("_g")))
    # heads are written out: a join of two shuffled sides is one that adaptive execution can split at a hot line
    return lines.join(stored(_heads(lines, "_h", "_g"), "heads"), ["_h", "_g"]).select(*AT, "_n").distinct()


def repeated_runs(docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_d, _v, _i, _n): every window of ``min_lines`` lines that occurs twice or more, with its earliest position."""
    names, depth = line_names(docs, id_col, text_col), 1
    while 2 * depth <= min_lines:
        names, depth = _doubled(names, names, depth), 2 * depth
    if depth < min_lines:  # two overlapping windows of the last depth
        names = _doubled(names, names, min_lines - depth)
    return names


def _kept(lines: Column, gone: Column) -> Column:
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n")


def dedup_lines(docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None) -> DataFrame:
    """``docs`` with its text cleaned of later copies of repeated line runs, and
    the columns n_lines, n_removed (lines) and n_runs (maximal removed runs)."""
    later = repeated_runs(docs, min_lines, id_col, text_col).filter(F.col("_n") < _place()).select(*AT, F.lit(min_lines).alias("_size"))
    if long_words is not None:
        later = later.unionByName(line_names(docs, id_col, text_col, long_words).filter(F.col("_n") < _place()).select(*AT, F.lit(1).alias("_size")))
    gone = (later.select(F.col("_d").alias("__line_doc"), F.col("_v").alias("__line_variant"), F.explode(F.sequence("_i", F.col("_i") + F.col("_size") - 1)).alias("_i"))
            .groupBy("__line_doc", "__line_variant").agg(F.collect_set("_i").alias("__line_gone")))
    lines, gone_here = F.split(F.col(text_col), "\n", -1), F.col("__line_gone")
    out = docs.join(gone, (F.col(id_col).cast("long") == F.col("__line_doc")) & (_variant(F.col(text_col)) == F.col("__line_variant")), "left")
    return out.withColumns({
        "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.when(gone_here.isNull(), F.lit(0)).otherwise(F.size(gone_here)).cast("long"),
        "n_runs": F.when(gone_here.isNull(), F.lit(0)).otherwise(F.size(F.array_except(gone_here, F.transform(gone_here, lambda i: i + 1)))).cast("long"),
        text_col: F.when(gone_here.isNull(), F.col(text_col)).otherwise(_kept(lines, gone_here)),
    }).drop("__line_doc", "__line_variant", "__line_gone")
