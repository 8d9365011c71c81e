"""The registered queries of the operators and of the pipeline, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import sentencepiece_bpe
from starloom.llm.collocation import mine
from starloom.llm.common import table
from starloom.llm.decontamination import find_leaks
from starloom.llm.langid import identify
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.lm_score import score_texts
from starloom.llm.mixing import mix_sources
from starloom.llm.near_dedup import near_duplicates
from starloom.llm.pii import find_pii
from starloom.llm.quality import score_quality
from starloom.llm.substring_dedup import dedup_substrings
from starloom.llm.vector_dedup import link_vectors
from starloom.llm.whitening import whiten


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items whose question and answer it holds."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("leaked", F.size("items") > 0)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that strings of 200 bytes found elsewhere cover."""
    return dedup_substrings(table(spark, sf_dir, "documents"), length=200)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    return find_pii(table(spark, sf_dir, "documents"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and its component."""
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the token counts and under the mixed model."""
    return score_texts(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes."""
    return mix_sources(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    return identify(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated runs of two or more lines."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "n_runs", "text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best-scored phrases of 2 to 5 words that occur 100 times or more."""
    return mine(table(spark, sf_dir, "documents"), least=100, longest=5, cover_percent=100, top=2000)


def op12_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Every document's ids under the public 32k BPE vocabulary and the text decoded from them, as digests."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_bpe.decode(sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), model), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole vector along the 32 leading components of the table."""
    return whiten(table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_pii": op4_pii,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_quality": op6_quality,
    "op7_lm_score": op7_lm_score,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op10_line_dedup": """
WITH lines AS (
  SELECT d.doc_id, CAST(i AS BIGINT) AS i, string_split(d.text, chr(10))[i + 1] AS line
  FROM documents d, range(0, CAST(len(string_split(d.text, chr(10))) AS BIGINT)) AS r(i)
  WHERE d.text IS NOT NULL),
runs AS (
  SELECT a.doc_id, a.i, a.line AS line1, b.line AS line2
  FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.i = a.i + 1
  WHERE regexp_matches(a.line, '[^\\x20\\x09-\\x0D]') AND regexp_matches(b.line, '[^\\x20\\x09-\\x0D]')),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line1, line2 ORDER BY doc_id, i) AS nth FROM runs),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM ranked, (VALUES (0), (1)) AS v(k) WHERE nth > 1),
marked AS (
  SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS removed FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i),
starts AS (
  SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS first_of_run FROM marked),
texts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
         count(*) FILTER (WHERE first_of_run) AS n_runs,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT removed), '') AS text
  FROM starts GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
       coalesce(t.n_runs, 0) AS n_runs, t.text AS text
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
""",
    "op11_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM lists GROUP BY lang),
grams AS (
  SELECT l.lang, s.k, array_to_string(l.w[i:i + s.k - 1], ' ') AS phrase
  FROM lists l, (VALUES (1), (2), (3), (4), (5)) AS s(k), unnest(range(1, len(l.w) - s.k + 2)) AS p(i)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS c FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, k, string_split(phrase, ' ') AS w, phrase, c AS a FROM f WHERE k > 1),
inside AS (
  SELECT c.lang, array_to_string(c.w[i:i + s.k - 1], ' ') AS phrase, max(c.a) AS longer
  FROM cand c, (VALUES (2), (3), (4)) AS s(k), unnest(range(1, c.k - s.k + 2)) AS p(i)
  WHERE s.k < c.k GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, array_to_string(c.w[:j], ' ') AS first, array_to_string(c.w[j + 1:], ' ') AS rest
  FROM kept c, unnest(range(1, c.k)) AS p(j)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, x.c AS l, y.c AS r, t.n, (1000 * c.a * t.n) // (x.c * y.c) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
""",
}
