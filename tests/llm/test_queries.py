"""The registered queries against their SQL, and that the rest does without this subpackage."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tallyframe.llm import queries as Q

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(Q.oracle_sql()[name])
    df = Q.queries()[name](spark, SF)
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    at = [want.columns.index(c) for c in order]
    assert sorted(tuple(r[c] for c in order) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_the_rest_imports_without_it(tmp_path):
    code = ("import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n        if name.startswith('tallyframe.llm') or name == "
            "'corpus_pipeline':\n            raise ModuleNotFoundError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\n"
            "assert e.queries() and not any(n.startswith('op1') for n in e.queries()) and e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
