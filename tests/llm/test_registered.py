"""Registered queries against their SQL."""

import duckdb
import pandas as pd
import pytest

from tests.llm.test_texts import PII
from tests.oracle import _rows, connect
from tidemark.llm import oracles, queries, sanitise


def same(df, con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    left, right = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(columns, cursor.fetchall())
    assert len(left) == len(right) and all(repr(a) == repr(b) for a, b in zip(left, right, strict=True))
    return left


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_same_rows(spark, sf_dir, name):
    assert same(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), oracles.SQL[name])


def test_disclosing_words_in_sql(spark):
    texts = [f"report {i}: Zorblatt wrote from z@corp.org about the budget" for i in range(4)]
    texts += [f"plain note {i} about the budget" for i in range(9)] + ["Zorblatt again, no address; zorblatts differ"]
    texts += [f"the budget of {c}@else.org" for c in "abcdef"] + ["Zorblatt at z@corp.org"] * 3 + PII
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    found = same(sanitise.digest(sanitise.findings(rows)), con, oracles.SQL["op10_pii"])
    assert sum("term" in repr(r) for r in found) >= 5


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = {*entry.queries()} - {*__import__("suite.registry").registry.CHECKS}
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
