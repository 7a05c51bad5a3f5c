import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_entry_has_rows_and_names_agree(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_rest_stands_without_the_subpackage(tmp_path):
    """A copy without llm and the pipeline still imports and has the other queries."""
    import shutil

    for name in ("moraine", "__spark_entry__.py"):
        src = ROOT / name
        (shutil.copytree if src.is_dir() else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "moraine/llm", ignore_errors=True)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), e.oracle_sql() and 1)"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0 and said.stdout.split()[1:] == ["False", "1"], said.stderr


def normal(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def test_queries_match_their_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    from moraine.plans import registry

    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    bad = []
    for name, sql in registry.ORACLES.items():
        df = registry.QUERIES[name](spark, sf)
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        order = sorted(cols)
        a = sorted(tuple(normal(r[c]) for c in order) for r in df.collect())
        b = sorted(tuple(normal(r[cols.index(c)]) for c in order) for r in cur.fetchall())
        if sorted(df.columns) != order or a != b:
            bad.append(name)
    assert not bad
