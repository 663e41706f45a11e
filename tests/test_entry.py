"""The driver's contract."""

import os
import re

import pytest

import __spark_entry__ as entry_module


def test_names():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 80
    assert all(callable(q) for q in queries.values()) and all(isinstance(s, str) for s in sql.values())


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="needs the given tables")
def test_entry(spark):
    rows = {r.op: r.n_rows for r in entry_module.entry(spark).collect()}
    assert set(rows) == {"del", "upd", "ins"} and min(rows.values()) > 0


def test_the_library_does_not_import_the_corpus_part():
    root = os.path.join(os.path.dirname(entry_module.__file__), "ferrywright")
    for folder, _, names in os.walk(root):
        if os.sep + "llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                assert not re.search(r"\bllm\b", open(os.path.join(folder, name)).read())
