"""The registered queries and the pipeline."""

import re

import pytest

import brute
import corpus_pipeline
from conftest import SF_SMALL
from starloom.llm.entries import ORACLE_SQL, QUERIES
from starloom.oracle.check import compare


def test_all_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES if n != "pipeline"} == {str(i) for i in range(1, 14)}
    assert "pipeline" in QUERIES and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, duck_small, name):
    ok, msg, _ = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE_SQL[name])
    assert ok, msg


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    got = {r.doc_id: r for r in out.collect()}
    assert set(out.columns) >= set(docs.columns)
    # stage by stage, brute force: no language rejected here, then lines, near copies, leaks
    first = docs.orderBy("doc_id").collect()
    from test_llm_operators import brute_lines

    texts = brute_lines([(r.doc_id, r.text) for r in first], 2)
    comp = brute.near_components(list(texts.items()))
    norm = lambda s: " " + " ".join(re.findall(r"[^\W_]+", s.lower())) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    stay = {i for i, t in texts.items() if comp[i][1] == i and not any(x in norm(t) for x in items)}
    assert set(got) <= stay
    assert all(r.text == texts[i] and r.copies >= 1 and r.taken == r.copies * r.size for i, r in got.items())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]


def test_null_ids(spark):
    """Rows without an id are deduplicated like others, and mixed row by row."""
    text = lambda n: " ".join(f"w{n}x{j}" for j in range(40))
    rows = [(2 ** 63 - 1, text(0)), (None, text(0)), (None, text(0) + " more"), *[(None, text(1))] * 5, (None, text(2)), (None, None), (-7, text(3)), (5, text(3))]
    d = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, d, SF_SMALL).collect()), key=str)
    assert got == sorted([(2 ** 63 - 1, text(0)), (None, text(1)), (None, text(2)), (None, None), (-7, text(3))], key=str)

    # 60 rows of 10 words without an id in each source, weights 1 and 2
    d = spark.createDataFrame([(None, f"{s}{i} " * 10, "en", s, i) for s in "ab" for i in range(60)], d.schema).repartition(3).cache()
    out = corpus_pipeline.mixing(spark, d, SF_SMALL).collect()
    assert len({r.text for r in out}) == len(out) <= 120
    for s, target in (("a", 400), ("b", 800)):
        assert abs(sum(r.taken for r in out if r.source == s) - target) <= 10
