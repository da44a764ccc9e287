"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from gleaner.plans import catalog
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(repr(r[i]) for i in at) for r in rel.fetchall())
    assert got


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0 and any(r.ignored for r in rows)


def test_entry_lists_the_engine_queries():
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry_without_the_optional_parts(tmp_path):
    """The entry module imports, and lists the engine's queries, without the optional subpackage."""
    import shutil
    import subprocess
    import sys

    from tests.conftest import ROOT

    shutil.copytree(ROOT / "gleaner", tmp_path / "gleaner", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(q) == set(e.oracle_sql()) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_entry_without_a_library_of_the_optional_parts():
    import subprocess
    import sys

    from tests.conftest import ROOT

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'page_titles' in q and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(ROOT)})
