"""The driver's contract, and what may import what."""

import ast
import importlib
from pathlib import Path

import __spark_entry__ as entry
from locuslathe.plans import event_queries, file_queries, general, record_queries

ROOT = Path(entry.__file__).parent


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["run_id", "chrom", "std_type", "span_kind", "span_start", "span_end"] and df.head() is not None


def test_names():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 50
    assert {"p1_found", "p3_found", "p5_found"} <= set(q)
    own = [m.QUERIES for m in (general, event_queries, record_queries, file_queries)]
    assert sum(map(len, own)) == len({k for m in own for k in m})


def test_nothing_outside_imports_llm():
    for path in (ROOT / "locuslathe").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
    importlib.reload(entry)


def test_p_queries_leave_columns_as_stated(spark):
    sf = "/root/testdata/sf0.001"
    want = {
        "p1_found": ["chrom", "std_type"],
        "p3_found": ["run_id", "chrom", "std_type", "span_kind", "span_start", "span_end"],
        "p5_found": ["line_id", "reason"],
    }
    for name, cols in want.items():
        df = entry.queries()[name](spark, sf)
        assert df.columns == cols and df.count() > 0
