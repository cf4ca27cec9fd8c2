"""The driver's contract, the SQL of every query that has one, and what core code may import."""

import ast
import math
import os
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}{'/*.parquet' if os.path.isdir(f'{SF}/{f}') else ''}'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 9) if not math.isinf(v) else v
    return str(v) if not isinstance(v, (int, bool)) else v


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    want = duck.sql(f"select {', '.join(sorted(rel.columns))} from rel").fetchall()
    assert Counter(tuple(map(plain, r)) for r in rows) == Counter(tuple(map(plain, r)) for r in want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_only_the_entry_knows_the_text_subpackage():
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT).as_posix()
        if rel.startswith(("sluice/llm/", "tests/llm/")) or rel == "__spark_entry__.py":
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("sluice.llm") for n in names), rel
