"""Output column types are the same in Spark and in the DuckDB oracle."""

import __spark_entry__ as entry
from conftest import SF_SMALL
from starloom.operators.entries import OPERATOR_QUERIES
from starloom.plans import MODELS

_SPARK = {"int": "int32", "smallint": "int32", "tinyint": "int32", "bigint": "int64", "double": "double",
          "float": "double", "string": "string", "date": "date", "boolean": "boolean"}
_DUCK = {"INTEGER": "int32", "SMALLINT": "int32", "TINYINT": "int32", "BIGINT": "int64", "DOUBLE": "double",
         "FLOAT": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def _spark_type(t):
    return t if t.startswith("decimal") else _SPARK.get(t, t)


def _duck_type(t):
    t = str(t).upper()
    return t.lower().replace(" ", "") if t.startswith("DECIMAL") else _DUCK.get(t, t.lower())


def test_output_types_match(spark, duck_small):
    queries, sqls = entry.queries(), entry.oracle_sql()
    diffs = {}
    for name in sorted([*MODELS, *OPERATOR_QUERIES]):
        df = queries[name](spark, SF_SMALL)
        st = {f.name: _spark_type(f.dataType.simpleString()) for f in df.schema.fields}
        dt = {r[0]: _duck_type(r[1]) for r in duck_small.execute(f"DESCRIBE {sqls[name]}").fetchall()}
        if st != dt:
            diffs[name] = sorted(set(st.items()) ^ set(dt.items()))
    assert diffs == {}
