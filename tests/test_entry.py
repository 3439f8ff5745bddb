"""The driver's contract, and every query that has SQL against DuckDB on the smallest tables."""

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from loomtext import catalog

TABLES = Path("/root/testdata/sf0.001")
NAMES = "documents embeddings pages benchmark labels conversations events".split()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in NAMES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    out = catalog.QUERIES[name](spark, str(TABLES))
    want = db.sql(catalog.SQL[name])
    assert sorted(out.columns) == sorted(want.columns)
    assert _rows(out.columns, out.collect()) == _rows(want.columns, want.fetchall())


def test_entry(spark):
    got = {r.label: r.n for r in __spark_entry__.entry(spark).collect()}
    assert got == {"English": 168, "Sheng": 28, "English and Swahili": 1, "Swahili": 0, "Unknown": 3}


def test_registered_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_entry_without_the_training_data_operators(tmp_path):
    """A copy of the repository without their folders and the pipeline."""
    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "loomtext", tmp_path / "loomtext", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.SQL))]
